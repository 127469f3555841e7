"""Merkle manifest of a dataset: digests of every row, every source and the whole, with a proof for each row.

The rows of a source are the leaves of its tree, and the sources' roots are the leaves of one tree above. Trees
are built level by level, with one small aggregation each. Proofs come from pointer jumping: every node holds the
siblings on its way to an ancestor, and a join with that ancestor's own siblings doubles the distance. Nodes are
named by their place in the level, so an ancestor's name is arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterlake.llm.shared import settled

#: Nodes that make one node of the level above.
FAN = 3
#: Leaves that meet one row in a join are at most FAN to this power, however many lie below an ancestor.
BLOCK_LEVELS = 4
#: Rows of one source that meet one copy of its root, where the roots are too many for a broadcast.
SOURCE_ROWS = 100_000
#: Largest table that is broadcast, in rows and in bytes of its texts; a larger one is joined by key.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 1 << 22

EMPTY = "X''"


def framed(value: Column) -> Column:
    """A value with its length, so that no two lists of values read alike: `-`, or bytes, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*(framed(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def small(table: DataFrame, *texts: str) -> DataFrame:
    """The table, marked for a broadcast if it is proven to be small."""
    size = table.agg(F.count("*").alias("n"), *(F.sum(F.octet_length(t)).alias(t) for t in texts)).first()
    fits = size["n"] <= BROADCAST_ROWS and sum(size[t] or 0 for t in texts) <= BROADCAST_BYTES
    return F.broadcast(table) if fits else table


def ordered(rows: DataFrame, *order: str) -> DataFrame:
    """rows in order over all partitions by range, with `part`, their partition, and `at`, which ascends.

    Equal rows are told apart by where they were read, so a mass of them is spread too.
    """
    by = [F.col(c).asc_nulls_first() for c in (*order, "at")]
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    return settled(rows).withColumn("part", F.shiftright("at", 33))


def shifts(rows: DataFrame, group: str) -> DataFrame:
    """What leads from `at` to the place in a group, from 0: one row for each group and partition it lies in."""
    parts = rows.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    of_group = Window.partitionBy(group)
    before = F.sum("rows").over(of_group.orderBy("part")) - F.col("rows")
    return parts.select(group, "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(of_group).alias("size"))


def climb(level: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Trees over leaves (tree, n, size, digest, held): the runs of each level, and (tree, digest) of the roots.

    n is the place in the tree, size the leaves of it. A run holds up to FAN neighbours in order, `held` of leaves with them.
    Its own place is that of its parent, and `left` the nodes of the parent's level.
    """
    most = level.agg(F.max("size")).first()[0] or 0
    held = level.schema["held"].dataType
    roots, runs = level.where("size = 1").select("tree", "digest"), []
    level = level.withColumn("left", F.col("size"))
    while most > 1:
        run = level.where("left > 1").groupBy("tree", "size", "left", F.expr(f"n div {FAN}").alias("n"))
        run = run.agg(F.sort_array(F.collect_list(F.struct("n", "digest", "held"))).alias("run"))
        run = settled(run.withColumn("left", F.expr(f"(left + {FAN - 1}) div {FAN}")))
        runs.append(run)
        digest = F.unhex(F.sha2(F.array_join(F.transform("run.digest", hexed), ""), 256))
        level = run.select("tree", "n", "size", digest.alias("digest"), F.lit(None).cast(held).alias("held"), "left")
        roots = roots.unionByName(level.where("left = 1").select("tree", "digest"))
        most = -(-most // FAN)
    return runs, roots


def steps(run: DataFrame) -> DataFrame:
    """The nodes of a level, each with the way to its parent: the siblings to the left and to the right."""
    nodes = run.select("tree", "size", "run", F.posexplode("run").alias("at", "node"))
    sides = {}
    for side, sign in (("left", "<"), ("right", ">")):
        siblings = [f"IF({i} {sign} at, coalesce(get(run, {i}).digest, {EMPTY}), {EMPTY})" for i in range(FAN)]
        sides[side] = F.expr(f"concat({', '.join(siblings)})").alias(side)
    way = F.array(F.struct(*sides.values())).alias("way")
    return nodes.select("tree", F.col("node.n").alias("n"), "size", way, F.col("node.digest").alias("digest"), "node.held")


def jump(nodes: DataFrame, ancestors: DataFrame, nodes_key: list[Column], ancestors_key: list[Column]) -> DataFrame:
    """nodes whose way is continued by that of the ancestor with their key, where it has one."""
    names = [f"key{i}" for i in range(len(nodes_key))]
    onward = ancestors.select(*(k.alias(f"of_{n}") for k, n in zip(ancestors_key, names)), F.col("way").alias("onward"))
    columns = nodes.columns
    nodes = nodes.withColumns(dict(zip(names, nodes_key)))
    same = [F.col(n) == F.col(f"of_{n}") for n in names]
    way = F.when(F.col("onward").isNull(), F.col("way")).otherwise(F.concat("way", "onward")).alias("way")
    return nodes.join(onward, same, "left").select(*(way if c == "way" else c for c in columns))


def ways(runs: list[DataFrame]) -> DataFrame:
    """Leaves (tree, n, size, way, digest, held) with their way to the root, by pointer jumping.

    In each round the ways reach twice as far. Of inner nodes only those go on whose level a later jump can
    meet, so they are few. An ancestor of many leaves has a copy for each block of them: no key of a join is hot.
    """
    leaves = steps(runs[0])
    inner = [steps(run).withColumn("level", F.lit(i)) for i, run in enumerate(runs) if i]
    distance = 1
    while distance < len(runs):
        if distance == 1:
            upper = inner[0]
            for nodes in inner[1:]:
                upper = upper.unionByName(nodes)
        levels = min(distance, BLOCK_LEVELS)
        copies, block = FAN ** (distance - levels), FAN**levels
        blocks = f"sequence(n * {copies}, least((n + 1) * {copies}, (size + {block - 1}) div {block}) - 1)"
        ancestors = upper.where(F.col("level") == distance)
        ancestors = ancestors.select("tree", "way", F.expr(f"explode({blocks})").alias("n")) if copies > 1 else ancestors
        key = [F.col("tree"), F.col("n")]
        leaves = jump(leaves, ancestors, [F.col("tree"), F.expr(f"n div {block}")], key)
        following = upper.where(f"level % {2 * distance} = 0")
        above = [F.col("tree"), F.expr(f"n div {FAN**distance}"), F.col("level") + distance]
        upper = settled(jump(following, upper, above, [*key, F.col("level")]))
        distance *= 2
    return leaves


def proven(runs: list[DataFrame], level: DataFrame) -> DataFrame:
    """All leaves with their ways; the only leaf of a tree is its root and has none."""
    alone = level.where("size = 1").select("tree", "n", "size", F.expr(f"slice(array(struct({EMPTY} AS left, {EMPTY} AS right)), 1, 0) AS way"), "digest", "held")
    return ways(runs).unionByName(alone) if runs else alone


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """Leaf, source root, root and proof of every row, and the root that the row at hand leads to.

    docs has doc_id, source, lang, n_chars and text; nulls in any of them are values of their own. tampered_text is the
    text that somebody may have put in place of the original one: null, where the row is unchanged. Its leaf, folded with
    the original siblings, gives `folded_root`, and `verified` tells whether that is the root.
    Rows of a source are in order of doc_id, nulls first, and then of their digests. Rows that agree in everything are
    leaves of their own. An empty table has no rows. Other columns are not carried.
    """
    doc_id, n_chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    leaf = F.unhex(leaf_digest(doc_id, source, lang, n_chars, text))
    put = F.lit(None).cast("string") if tampered_text is None else tampered_text
    other = F.when(put.isNotNull() & ~put.eqNullSafe(text), F.unhex(leaf_digest(doc_id, source, lang, n_chars, put)))
    rows = ordered(
        settled(docs.select(doc_id.alias("doc_id"), source.alias("source"), leaf.alias("digest"), other.alias("other"))),
        "source", "doc_id", "digest",
    )
    parts = settled(shifts(rows, "source"))
    sources = ordered(parts.select("source", "size").distinct(), "source").withColumn("tree", F.lit(-1))
    trees = sources.join(small(shifts(sources, "tree").withColumnsRenamed({"size": "sources", "tree": "top"})), "part")
    trees = trees.select(F.col("source").alias("of"), (F.col("at") + F.col("shift")).alias("tree"), "sources")
    parts = parts.join(trees, F.col("source").eqNullSafe(F.col("of"))).select("of", F.col("part").alias("of_part"), "tree", "shift", "size", "sources")
    parts = settled(parts)
    here = F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    leaves = rows.join(small(parts, "of"), here).select(
        "tree", (F.col("at") + F.col("shift")).alias("n"), "size", "digest", F.struct("doc_id", "other").alias("held")
    )
    runs, subroots = climb(leaves)
    tops = subroots.join(parts.select("tree", "size", "sources").distinct(), "tree")
    tops = tops.select(
        F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("n"), F.col("sources").alias("size"), "digest",
        F.struct(F.col("tree").alias("tree"), F.col("size").alias("leaves")).alias("held"),
    )
    tops = settled(tops)
    top_runs, roots = climb(tops)
    root = roots.first()
    above = settled(proven(top_runs, tops).select("held.tree", "held.leaves", F.col("digest").alias("subroot"), F.col("way").alias("onward")))
    found = _with_source(proven(runs, leaves), above)
    way = F.concat("way", "onward")
    proof = F.sha2(F.array_join(F.transform(way, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""), 256)
    folded = F.aggregate(
        way,
        hexed(F.coalesce("held.other", "digest")),
        lambda node, s: F.sha2(F.concat(hexed(s["left"]), node, hexed(s["right"])), 256),
    )
    top = F.lit(root["digest"].hex() if root else None).cast("string")
    return found.select(
        "held.doc_id",
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        top.alias("root"),
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == top).alias("verified"),
    )


def _with_source(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """Each leaf with its source's root and what lies above. Without a broadcast, a source has a copy for some leaves each."""
    table = small(above)
    if table is not above:
        return leaves.join(table, "tree")
    copies = F.expr(f"explode(sequence(0L, (leaves - 1) div {SOURCE_ROWS}))").alias("copy")
    return leaves.withColumn("copy", F.expr(f"n div {SOURCE_ROWS}")).join(above.select("*", copies), ["tree", "copy"])
