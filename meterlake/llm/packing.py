"""Best-fit packing of token sequences in a hierarchy of residual bins.

Every partition packs its pieces best-fit, largest first. Bins that are nearly full, or too full for
the smallest bin left anywhere, are finished. The other bins become items of the next round, on fewer
partitions, until one partition holds them or no bin finds a partner any more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterlake.llm import arrays
from meterlake.llm.shared import settled
from meterlake.llm.token_counts import merger

SEQUENCE_TOKENS = 1024
END_ID = 2
#: Items that one task packs. Two bins of one task that fit together are always merged, so of each task
#: at most one bin stays half empty: packing apart costs less than one sequence in this many items.
TASK_ITEMS = 50_000
#: Tokens that may stay free in a bin that takes no further part.
SLACK = 4

PIECE = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Token sequences of all texts, cut to the capacity: one row for each piece.

    The ids of a text are followed by `end_id`, so a null or empty text has one piece of one token.
    Only longer sequences are cut; the first piece may be shorter, all others are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merger(tokenizer)
        for batch in arrays.pieces(batches):
            tokens, n = bpe.encode(*arrays.column_bytes(batch.column("text")))
            ids = np.full(len(tokens) + len(n), end_id, "<u4")
            ids[np.arange(len(tokens)) + np.repeat(np.arange(len(n)), n)] = tokens
            n = n + 1
            count = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), count)
            piece = arrays.ragged(np.zeros(len(n), np.int64), count)
            first = (n - (count - 1) * capacity)[row]
            length = np.where(piece == 0, first, capacity)
            start = np.where(piece == 0, 0, first + (piece - 1) * capacity)
            ends = np.cumsum(length)
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(piece, pa.int32()),
                pa.array(start),
                pa.array(length),
                pa.array(crc, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = PIECE.replace(":", "") + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: largest first, each into the fullest bin with room for it.

    Bins are kept by their free room. A bit for every free room that occurs finds the best one.
    """
    bin_of = np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, bins = capacity, bins, bins + 1
        bin_of[item] = chosen
        if room > size:
            by_room[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bin_of


def pack_bins(bins: DataFrame, capacity: int) -> DataFrame:
    """One round: the bins of each partition, put together best-fit."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        load = table.column("load").to_numpy()
        parts = table.column("parts").combine_chunks()
        bin_of = best_fit(load, capacity)
        order = np.argsort(bin_of, kind="stable")
        at = np.asarray(parts.offsets).astype(np.int64)
        count = np.diff(at)
        values = parts.values.take(pa.array(arrays.ragged(at[:-1][order], count[order])))
        n = int(bin_of.max()) + 1
        total = np.bincount(bin_of, weights=load, minlength=n).astype(np.int64)
        ends = np.cumsum(np.bincount(bin_of, weights=count, minlength=n).astype(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values)
        yield pa.RecordBatch.from_arrays([pa.array(total), lists], names=["load", "parts"])

    return bins.mapInArrow(pack, bins.schema)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Place pieces of at most `capacity` tokens into sequences: one row for each sequence."""
    bins = settled(pieces.select("length", F.array(F.struct(*(c for c in pieces.columns if c != "ids"))).alias("parts")).withColumnRenamed("length", "load"))
    full = bins.where(F.col("load") >= capacity - SLACK)
    open_bins = bins.where(F.col("load") < capacity - SLACK)
    finished, tasks = [full], None
    while (n := open_bins.count()) > 0:
        wanted = -(-n // TASK_ITEMS)
        if tasks is not None and (wanted >= tasks or tasks == 1):
            break  # no fewer partitions than before, so no bin would meet a new one
        tasks = wanted
        packed = settled(pack_bins(open_bins.repartition(tasks), capacity))
        least = packed.agg(F.min("load")).first()[0]
        stuck = (F.col("load") >= capacity - SLACK) | (F.col("load") + least > capacity)
        finished.append(packed.where(stuck))
        open_bins = packed.where(~stuck)
    out = open_bins
    for rows in finished:
        out = out.unionByName(rows)
    return out.withColumn("sequence_id", F.monotonically_increasing_id())


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Where every piece of every document stands in the packed sequences.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, with the piece's token
    ids too if asked for. Each row of docs is packed, repeated rows and null ids included; a null or empty
    text is its end token alone. An empty table gives no rows. Other columns are not carried.
    Ties between bins go to the one filled last.
    """
    sequences = pack_pieces(cut_pieces(docs, tokenizer, capacity, end_id), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            values = parts.flatten()
            if not len(values):
                continue
            count = np.diff(np.asarray(parts.offsets))
            row = np.repeat(np.arange(len(count)), count)
            length = values.field("length").to_numpy(zero_copy_only=False)
            before = np.cumsum(length) - length
            offset = before - before[np.cumsum(count) - count][row]
            columns = [values.field(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("sequence_id").take(pa.array(row)), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = PIECE.replace(":", "") + ", sequence_id long, offset long"
    placed = sequences.select("sequence_id", "parts").mapInArrow(place, schema)
    if not with_ids:
        return placed
    # Copies of one document have the same pieces: number them, so that each finds its own place.
    key = ["doc_id", "piece", "length", "ids_crc32"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("start"))
    ids = cut_pieces(docs, tokenizer, capacity, end_id, with_ids=True).withColumn("nth", nth)
    joined = placed.withColumn("nth", nth).alias("p").join(
        ids.alias("i"), F.expr(" and ".join(f"p.{c} <=> i.{c}" for c in [*key, "nth"])), "left"
    )
    return joined.select("p.*", "i.ids").drop("nth")
