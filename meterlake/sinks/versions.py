"""Folders whose content changes as a whole: complete versions, and a marker that names the current one.

A version is written beside the others, and readers see it once its marker is there. The marker takes its name in
one step of the file system, so there is no moment without a current version, and a writer that dies at any point
leaves the one before. Spark does not list folders that begin with an underscore, so versions stand inside the folder
that they are versions of.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from meterlake.sources.paths import delete, exists, move, read_text, siblings, write_text

_VERSIONS = "_versions"
_MARK = "current-"


def _markers(spark: SparkSession, base: str) -> list[str]:
    return siblings(spark, f"{base.rstrip('/')}/{_VERSIONS}/{_MARK}")


def current(spark: SparkSession, base: str) -> str | None:
    """Folder of the current version, if there is one."""
    markers = _markers(spark, base)
    return f"{base.rstrip('/')}/{_VERSIONS}/{read_text(spark, markers[-1])}/data" if markers else None


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read or change: the current version of a path that has versions, else the path itself."""
    return current(spark, path) or path


def publish(spark: SparkSession, base: str, write: Callable[[str], None]) -> str:
    """Write a version and make it the current one; gives its folder.

    Of two writers that publish at once, the second one fails and its version is never seen. What a failed or dead writer
    has left is removed by `retire`.
    """
    base = base.rstrip("/")
    markers = _markers(spark, base)
    number = int(markers[-1].rsplit(_MARK, 1)[1]) + 1 if markers else 0
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    folder = f"{base}/{_VERSIONS}/{name}/data"
    write(folder)
    draft = f"{base}/{_VERSIONS}/{name}/marker"
    write_text(spark, draft, name)
    move(spark, draft, f"{base}/{_VERSIONS}/{_MARK}{number:08d}")
    return folder


def retire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove all but the last `keep` versions, and what writers that died have left; gives the folders removed.

    For the owner of the folder, while nobody writes. Readers of a version that is kept are not disturbed, so with
    two of them a reader has until the publication after next.
    """
    base = base.rstrip("/")
    markers = _markers(spark, base)
    for marker in markers[:-keep]:
        delete(spark, marker)
    kept = {read_text(spark, marker) for marker in markers[-keep:]}
    removed = [path for path in siblings(spark, f"{base}/{_VERSIONS}/v") if path.rsplit("/", 1)[1] not in kept]
    for path in removed:
        delete(spark, path)
    if markers and exists(spark, base):  # what the folder held before it had versions
        for path in siblings(spark, f"{base}/"):
            if not path.rsplit("/", 1)[1].startswith("_"):
                delete(spark, path)
    return removed
