"""Repeated passages by a sparse suffix array.

Of all word suffixes of all texts only those at minimiser positions are kept: positions whose word gram
has the smallest hash of some window. Equal passages choose equal positions, so a passage that is long enough has
a kept suffix near its begin in each of its copies. Suffixes are grouped by the hash of their first words, the head.
The two places of a head meet; where a head has more places, all passages of the least length around it are
looked up, and each meets its first place in the corpus. Such matches are extended to both sides over the words of the two texts, and what
reaches the least length is cut from the later text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.shared import marked, mask_of, masked, packed, release, settled

LEAST_WORDS = 50
GRAM = 6
WINDOW = 16
#: Words that two suffixes must share: what a passage of the least length has from its first kept position on.
HEAD = LEAST_WORDS - WINDOW + 1

KEY = "doc_id long, r1 long"
SPANS = "array<struct<begin:int,end:int>>"
PLACE = "struct<none:boolean,doc_id:bigint,r1:bigint,at:int>"


def minimisers(grams: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """Indices of grams that are the last smallest of some window inside one text.

    Of equal grams closer than a window, as in periodic texts, only every window's first is kept.
    """
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    least, span = grams.copy(), 1
    while span < window:  # least[i]: of the `span` grams from i on
        step = min(span, window - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    begin = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    low = least[begin]
    # Every window's last smallest gram: the largest index with that value that isn't beyond the window.
    kept = np.zeros(n, bool)
    offset = np.full(len(begin), -1, np.int64)
    for j in range(window - 1, -1, -1):
        open_ = np.flatnonzero(offset < 0)
        if not len(open_):
            break
        hit = open_[grams[begin[open_] + j] == low[open_]]
        offset[hit] = j
    kept[begin + offset] = True
    at = np.flatnonzero(kept)
    close = np.zeros(len(at), bool)
    for back in (1, 2, 3):
        close[back:] |= (grams[at[back:]] == grams[at[:-back]]) & (at[back:] - at[:-back] < window) & (owner[at[back:]] == owner[at[:-back]])
    if close.any():
        run = np.maximum.accumulate(np.where(close, -1, np.arange(len(at))))
        first = at[run]
        turn = (at - first) // window
        anew = np.ones(len(at), bool)
        anew[1:] = (run[1:] != run[:-1]) | (turn[1:] != turn[:-1])
        at = at[anew]
    return at


def suffixes(rows: DataFrame, least_words: int) -> DataFrame:
    """Kept suffixes of all texts: hash of the head, hashes of the passages around it, and place.

    Passage number i has the least length and begins i words before the head; null where the text doesn't reach.
    """
    head_words = least_words - WINDOW + 1

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            data, offsets = arrays.column_bytes(batch.column("text"))
            starts, ends, owner = arrays.words(data, offsets)
            words = arrays.span_hashes(data, starts, ends)
            grams, first = arrays.grams(words, owner, GRAM)
            at = first[minimisers(grams, owner[first], WINDOW)]
            begin = arrays.bounds(owner, batch.num_rows)
            stop = begin[1:][owner[at]] if len(at) else at
            at, stop = at[at + head_words <= stop], stop[at + head_words <= stop]
            heads = range_hashes(words, at, at + head_words)
            row = owner[at]
            start = at[:, None] - np.arange(WINDOW)
            inside = (start >= begin[row][:, None]) & (start + least_words <= stop[:, None])
            passages = np.zeros(start.shape, np.uint64)
            passages[inside] = range_hashes(words, start[inside], start[inside] + least_words)
            flat = pa.array(arrays.as_long(passages.ravel()), mask=~inside.ravel())
            windows = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * WINDOW), flat)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(arrays.as_long(heads)),
                    windows,
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("r1").take(pa.array(row)),
                    pa.array((at - begin[row]).astype(np.int32)),
                ],
                names=["head", "windows", "doc_id", "r1", "at"],
            )

    return rows.select("doc_id", "r1", "text").mapInArrow(select, f"head long, windows array<long>, {KEY}, at int")


def range_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch of words."""
    up, down = arrays.powers(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(arrays.mixed(words) * up[:-1], out=total[1:])
    return arrays.mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def _matches(repeated: DataFrame) -> DataFrame:
    """Pairs of a later and an earlier place, and `ahead`: words from the later place to a kept one.

    The two places of a head that has no more meet directly. Places of other heads meet by the passages of the least
    length around the head: each one with the first place of the same passage, whatever else shares the head.
    """
    direct = repeated.where("windows is null").select("head", "place")
    ends = direct.groupBy("head").agg(F.max("place").alias("late"), F.min("place").alias("early"))
    around = repeated.where("windows is not null").select("place", F.posexplode("windows").alias("ahead", "passage"))
    begin = F.col("place").withField("at", F.col("place.at") - F.col("ahead"))
    around = around.where("passage is not null").select("passage", begin.alias("late"), "ahead").repartition("passage")
    firsts = around.groupBy("passage").agg(F.min("late").alias("early"), F.max("late").alias("last"))
    firsts = firsts.where("early <> last").select("passage", "early")
    met = around.join(firsts, "passage").select("late", "early", "ahead")
    return ends.select("late", "early", F.lit(0).alias("ahead")).unionByName(met).where("late <> early")


def repeated_spans(source: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Word spans (doc_id, r1, begin, end) that an earlier place has too. Earlier: smaller id, then position."""
    found = suffixes(source, least_words).withColumn(
        "place", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "at")
    )
    # Few heads repeat. A mask of fixed size keeps most other suffixes out of the second shuffle.
    heads = settled(found.groupBy("head").agg(F.count("*").alias("n")).where("n > 1"))
    many = masked(found.select("head", "windows", "place"), "head", mask_of(heads, "head"))
    # Only heads of more than two places need their passages.
    many = marked(many, "head", mask_of(heads.where("n > 2"), "head"))
    many = many.select("head", "place", F.when(F.col("may"), F.col("windows")).alias("windows")).join(heads, "head")
    many = settled(many.select("head", "place", F.when(F.col("n") > 2, F.col("windows")).alias("windows")))
    # In one text a passage repeats only beyond its own end.
    apart = "late.doc_id is distinct from early.doc_id or late.r1 <> early.r1 or late.at - early.at >= " + str(least_words)
    lines = (
        _matches(many)
        .where(apart)
        .groupBy(F.col("late.doc_id").alias("doc_id"), F.col("late.r1").alias("r1"), F.col("early.doc_id").alias("other_id"), F.col("early.r1").alias("o1"))
        .agg(F.collect_set(F.struct((F.col("late.at") - F.col("early.at")).alias("shift"), (F.col("late.at") + F.col("ahead")).alias("at"))).alias("hits"))
    )
    lines = settled(lines)
    release(many)
    release(heads)
    wanted = lines.select("doc_id", "r1").unionByName(lines.select(F.col("other_id").alias("doc_id"), F.col("o1").alias("r1"))).distinct()
    same = lambda a, b: (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))) & (F.col(f"{a}.r1") == F.col(f"{b}.r1"))
    wanted = settled(wanted)
    texts = masked(source.select("doc_id", "r1", "text"), "r1", mask_of(wanted, "r1"))
    texts = texts.alias("s").join(wanted.alias("w"), same("s", "w"), "left_semi").select("doc_id", "r1", "text").distinct()
    held = settled(texts)
    late, early = held.alias("a"), held.select(F.col("doc_id").alias("other_id"), F.col("r1").alias("o1"), F.col("text").alias("other")).alias("b")
    joined = lines.alias("l").join(late, same("l", "a")).join(
        early, (F.col("l.o1") == F.col("b.o1")) & F.col("l.other_id").eqNullSafe(F.col("b.other_id"))
    )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            row, begin, end = [], [], []
            flat, cut = zip(*(text_words(batch.column(c)) for c in ("text", "other")))
            hits = batch.column("hits")
            shifts, ats = (hits.flatten().field(c).to_numpy() for c in ("shift", "at"))
            at = np.append(0, np.cumsum(np.asarray(hits.value_lengths())))
            for r in range(batch.num_rows):
                a, b = (f[c[r] : c[r + 1]] for f, c in zip(flat, cut))
                for x, y in extended(a, b, shifts[at[r] : at[r + 1]], ats[at[r] : at[r + 1]], least_words):
                    row.append(r)
                    begin.append(x)
                    end.append(y)
            columns = [batch.column(c).take(pa.array(row, pa.int64())) for c in ("doc_id", "r1")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=["doc_id", "r1", "begin", "end"])

    return joined.select("l.doc_id", "l.r1", "hits", "text", "other").mapInArrow(extend, f"{KEY}, begin int, end int")


def extended(a: np.ndarray, b: np.ndarray, shifts: np.ndarray, ats: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of a, at least so long, that b has `shift` words earlier around the given hits.

    A shift is passed over only if the matches around its hits end inside of what other shifts have covered.
    """
    out: list[tuple[int, int]] = []
    covered = np.zeros(len(a) + 1, bool)
    for shift in np.unique(shifts).tolist():
        if not _reaches_beyond(a, b, shift, np.unique(ats[shifts == shift]), covered):
            continue
        first, last = max(0, shift), min(len(a), len(b) + shift)
        equal = a[first:last] == b[first - shift : last - shift]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
        for x, y in zip((edge[::2] + first).tolist(), (edge[1::2] + first).tolist()):
            if y - x >= least and not covered[x:y].all():
                out.append((x, y))
                covered[x:y] = True
    return out


def _reaches_beyond(a: np.ndarray, b: np.ndarray, shift: int, at: np.ndarray, covered: np.ndarray) -> bool:
    """Whether a hit is not covered, or matches up to a word next to the covered stretch it lies in."""
    if not covered[at].all():
        return True
    bare = np.flatnonzero(~covered)  # the last one is the end of the text
    after = np.searchsorted(bare, at)
    for number in np.unique(after).tolist():
        hits = at[after == number]
        right, left = int(bare[number]), int(bare[number - 1]) if number else -1
        for begin, end in ((int(hits[-1]), right + 1), (left, int(hits[0]) + 1)):
            inside = begin >= max(0, shift) and end <= min(len(a), len(b) + shift)
            if inside and np.array_equal(a[begin:end], b[begin - shift : end - shift]):
                return True
    return False


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts one behind another, and where each text's begin."""
    data, offsets = arrays.column_bytes(texts)
    starts, ends, owner = arrays.words(data, offsets)
    return arrays.span_hashes(data, starts, ends), arrays.bounds(owner, len(texts))


def cut_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int) -> tuple[bytes, np.ndarray, np.ndarray, int]:
    """The text without the word spans, each up to the next word, the spans cut, and the number of words in them.

    Spans that go to the end of a text are no longer than it; the whole of a text of too few words is no passage.
    """
    offsets = np.array([0, len(data)])
    starts, ends, _ = arrays.words(data, offsets)
    end = np.minimum(end, len(starts))
    begin, end = begin[end - begin >= least], end[end - begin >= least]
    gone = np.zeros(len(starts) + 1, np.int64)
    np.add.at(gone, begin, 1)
    np.add.at(gone, end, -1)
    gone = np.cumsum(gone)[:-1] > 0
    keep = np.ones(len(data), bool)
    following = np.append(starts[1:], len(data))
    for word in np.flatnonzero(gone).tolist():
        keep[starts[word] : following[word]] = False
    return data[keep].tobytes(), begin, end, int(gone.sum())


#: End of a span that goes to the end of its text.
TO_THE_END = 2**31 - 1


def whole_texts(source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mask of rows whose text no earlier row has, and spans (doc_id, r1, begin, end) of the others' whole texts."""
    texts = source.where("text is not null").select(
        F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(2), "text").alias("t2"),
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1").alias("at"),
    )
    texts = settled(texts.distinct())
    firsts = texts.groupBy("t1", "t2").agg(F.min("at").alias("first"))
    copies = texts.join(firsts, ["t1", "t2"]).where("at <> first")
    copies = copies.select("at.doc_id", "at.r1", F.lit(0).alias("begin"), F.lit(TO_THE_END).alias("end"))
    return mask_of(firsts.select("first.r1"), "r1"), copies


def cut_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every row of docs as `row`, with `text` without repeated passages, `words_cut` and the `spans` cut.

    Of each passage of at least `least_words` words that stands in several places, the first stays: the one in the
    text of the smallest id, or the earliest in one text. Words are runs without white space; what lies between
    words may differ. Rows alike in id and text are cut alike and don't repeat each other. Ids that are null
    come last. Null texts stay null. Texts may become empty; no row goes. Where one text repeats the same few words
    over and over, kept positions lie a window apart, so up to WINDOW words more than the least length may stay.
    """
    source = packed(docs)
    # A copy of a whole text repeats all of it, and no place in it is a first one: only other texts have suffixes.
    firsts, copies = whole_texts(source)
    found = repeated_spans(masked(source, "r1", firsts), least_words).unionByName(copies)
    spans = found.groupBy("doc_id", "r1").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    spans = settled(spans)
    rows = marked(source, "r1", mask_of(spans, "r1"))
    # Only rows that may lose words are joined, and so shuffled; their text goes along once, in the row.
    touched = rows.where("may").drop("text").alias("s").join(
        spans.alias("c"), F.col("s.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("s.r1") == F.col("c.r1")), "left"
    ).select("s.row", F.col("s.row")["text"].cast("string").alias("text"), "c.spans")
    rest = rows.where("not may").select("row", "text", F.lit(0).cast("long").alias("words_cut"), F.lit(None).cast(SPANS).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.pieces(batches, arrays.HELD_BYTES):
            texts, spans = batch.column("text"), batch.column("spans")
            out, count, cuts = texts.to_pylist(), [0] * batch.num_rows, [None] * batch.num_rows
            has = np.flatnonzero(np.asarray(spans.is_valid()))
            for r in has.tolist():
                both = spans[r].values
                begin, end = (both.field(c).to_numpy() for c in ("begin", "end"))
                raw = np.frombuffer((out[r] or "").encode("utf-8", "surrogatepass"), np.uint8)
                left, begin, end, count[r] = cut_spans(raw, begin, end, least_words)
                if count[r]:
                    out[r] = left.decode("utf-8", "surrogatepass")
                    cuts[r] = [{"begin": x, "end": y} for x, y in zip(begin.tolist(), end.tolist())]
            columns = [batch.column("row"), pa.array(out, pa.string()), pa.array(count, pa.int64()), pa.array(cuts, spans.type)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "words_cut", "spans"])

    return touched.mapInArrow(cut, rest.schema).unionByName(rest)
