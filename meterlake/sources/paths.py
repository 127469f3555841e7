"""Folders of any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _opened(spark, path)
    return fs.exists(hadoop_path)


def depth(spark: SparkSession, path: str) -> int:
    """Where the names below a folder stand in an absolute path that is cut at its slashes."""
    fs, hadoop_path = _opened(spark, path)
    return len(fs.makeQualified(hadoop_path).toUri().getPath().rstrip("/").split("/"))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _opened(spark, path)
    fs.delete(hadoop_path, True)


def siblings(spark: SparkSession, prefix: str) -> list[str]:
    """Files and folders whose path begins with ``prefix``, in order."""
    folder, name = prefix.rsplit("/", 1)
    fs, parent = _opened(spark, folder)
    if not fs.exists(parent):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(parent))
    return sorted(f"{folder}/{found}" for found in names if found.startswith(name))


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Length and modification time."""
    fs, hadoop_path = _opened(spark, path)
    status = fs.getFileStatus(hadoop_path)
    return status.getLen(), status.getModificationTime()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop_path = _opened(spark, source)
    _, to = _opened(spark, target)
    if not fs.rename(hadoop_path, to):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop_path = _opened(spark, path)
    out = fs.create(hadoop_path, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _opened(spark, path)
    opened = fs.open(hadoop_path)
    try:
        return bytes(opened.readAllBytes()).decode("utf-8")
    finally:
        opened.close()


def first_line(spark: SparkSession, path: str, chunk: int = 1 << 16) -> str | None:
    """The first line of a text file that is not blank, packed files included; only as much as needed is read."""
    fs, hadoop_path = _opened(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(hadoop_path)
    opened = fs.open(hadoop_path)
    try:
        text = opened if codec is None else codec.createInputStream(opened)
        held = b""
        while more := bytes(text.readNBytes(chunk)):
            held = (held + more).lstrip(b"\r\n \t")
            if b"\n" in held or b"\r" in held:
                break
        lines = held.decode("utf-8", "replace").lstrip("\ufeff").splitlines()
        return lines[0] if lines else None
    finally:
        opened.close()
