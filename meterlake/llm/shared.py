"""Checkpoints in the cluster's shared folder, and union-find over link tables."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from itertools import count
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()
#: Settled frames between two collections of the driver's garbage.
TIDY_EVERY = 6
_SETTLED = count(1)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, which may not have it installed."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def settled(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the folder of spark.checkpoint.dir.

    All executors share that folder, so a lost executor costs no rows. The files stay until `release` removes them or
    the folder's owner does. Only where the session names no folder, as in tests, one is made.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    kept = df.checkpoint()
    if next(_SETTLED) % TIDY_EVERY == 0:
        tidy(df.sparkSession)
    return kept


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that nothing refers to any more.

    It does so when the driver collects its garbage, which a driver with memory to spare puts off while disks fill.
    """
    gc.collect()
    spark._jvm.System.gc()


def release(df: DataFrame) -> None:
    """Remove the files of a settled frame that nothing will read again: all that came of it is settled too."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() == "Repartition":  # gathered
        plan = plan.child()
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers each that one task may hold; up to here a frame needs no shuffle at all.
TASK_ROWS = 1 << 20


def settled_in(df: DataFrame, few: bool) -> DataFrame:
    """`settled`, in one partition if the rows are known to be few: then grouping and joining shuffle nothing."""
    df = settled(df)
    return df.coalesce(1) if few else df


def components(links: DataFrame, few: bool = False) -> DataFrame:
    """Distributed union-find: the smallest node of each linked node's component.

    links has `a` and `b` of one orderable type. Returns (node, root) for every node of a link between
    two different nodes, roots included. Null ends are ignored. Alternates the two star steps of
    the published MapReduce algorithm: every node hands its neighbours the smallest one it knows.
    Minima are aggregated before any shuffle, and joins on a hot node are left to the
    skew handling of adaptive execution. The number of rounds grows with the logarithm of the nodes.
    It ends when the edges are separate stars: no `lo` is a `hi`, and every `hi` has one `lo`.
    `few` says that the links are known to be at most TASK_ROWS; else they are counted, and edges never become more.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    few = few or edges.count() <= TASK_ROWS
    edges = edges.coalesce(1) if few else edges
    while not _unsettled(edges).isEmpty():
        former, edges = edges, settled_in(_small_star(_large_star(edges)), few)
        release(former)
    roots = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
    return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that have several smaller neighbours, or smaller as well as larger ones."""
    several = edges.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").select("hi")
    return several.unionByName(edges.select("hi").join(edges.select(F.col("lo").alias("hi")), "hi", "left_semi"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi")
    lower = moved.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return lower.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def packed(docs: DataFrame) -> DataFrame:
    """The whole row as `row`, its id and text, and two hashes that tell rows apart.

    Further columns may have any names, since they stay inside `row`. Rows that agree in id and text share
    their hashes.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        doc_id.alias("doc_id"),
        text.alias("text"),
        F.xxhash64(doc_id, text).alias("r1"),
        F.xxhash64(F.lit(1), text, doc_id, text.isNull()).alias("r2"),
    )


#: 64-bit words of a mask; a mask has at most this many rows, whatever the data.
MASK_WORDS = 1 << 17


def _word(key: str) -> Column:
    return F.pmod(F.col(key), F.lit(MASK_WORDS)).cast("int")


def _bit(key: str) -> Column:
    return F.shiftrightunsigned(F.col(key), 58).cast("int")


def mask_of(keys: DataFrame, key: str) -> DataFrame:
    """Bit mask of the hashes that occur, at most MASK_WORDS rows."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key))
    return keys.groupBy(_word(key).alias("mask_word")).agg(F.bit_or(bit).alias("mask"))


def marked(rows: DataFrame, key: str, mask: DataFrame) -> DataFrame:
    """rows with `may`: false only if the mask rules the hash out. The mask is broadcast; its size is fixed."""
    joined = rows.join(F.broadcast(mask), _word(key) == F.col("mask_word"), "left")
    may = F.coalesce(F.call_function("getbit", F.col("mask"), _bit(key)) == 1, F.lit(False))
    return joined.withColumn("may", may).drop("mask_word", "mask")


def masked(rows: DataFrame, key: str, mask: DataFrame) -> DataFrame:
    return marked(rows, key, mask).where("may").drop("may")
