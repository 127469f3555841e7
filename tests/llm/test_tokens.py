"""Token counts, BPE and packing against the tokenizers library."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_making import AWKWARD, SF, documents, odd_documents, texts_of
from tokenizers import Tokenizer

from meterlake.llm import arrays, queries, token_counts, trie_bpe
from meterlake.llm.packing import best_fit, cut_pieces, pack_documents, pack_pieces
from meterlake.llm.shared import ship_package

BYTE, WORD = (queries.tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def texts(spark):
    return {**texts_of(spark), **{10_000 + i: t for i, t in enumerate(AWKWARD)}}


@pytest.fixture(scope="module")
def docs(spark, texts):
    ship_package(spark)
    return documents(spark, [*texts.items()]).repartition(3).cache()


def encoded(path, texts):
    return Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)


def test_character_classes_equal_the_librarys():
    """Every character between two letters, as the tokenizer's own splitting sees it."""
    split = Tokenizer.from_file(BYTE).pre_tokenizer
    bpe = token_counts.merger(BYTE)
    points = [c for c in range(1, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    for part in range(0, len(points), 4000):
        text = "a".join(map(chr, points[part : part + 4000]))
        data = np.frombuffer(text.encode(), np.uint8)
        mine = token_counts.pre_tokens(data, np.array([0, len(data)]))
        whole = [len(text[: a].encode()) for _, (a, _) in split.pre_tokenize_str(text)]
        assert mine[:-1].tolist() == whole
    assert bpe is token_counts.merger(BYTE)


def test_token_counts(docs, texts):
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, BYTE).collect()}
    for (i, text), e in zip(texts.items(), encoded(BYTE, texts.values())):
        assert got[i].n_tokens == len(e.ids) and got[i].over_limit == (len(e.ids) > 1024)
        assert got[i].n_bytes == len((text or "").encode())


def test_trie_bpe(docs, texts):
    got = {r.doc_id: r for r in trie_bpe.round_trip(docs, WORD, with_values=True).collect()}
    tokenizer = Tokenizer.from_file(WORD)
    for i, e in zip(texts, encoded(WORD, texts.values())):
        plain = tokenizer.decode(e.ids, skip_special_tokens=False)
        assert got[i].ids == e.ids and got[i].decoded == plain and got[i].n_tokens == len(e.ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()


def test_forgetting_changes_nothing(monkeypatch, texts):
    from meterlake.llm import arrays, memory

    monkeypatch.setattr(memory, "REMEMBERED", 50)
    bpe = token_counts.Merger(BYTE)
    import pyarrow as pa

    for text, e in zip(texts.values(), encoded(BYTE, texts.values())):
        ids, n = bpe.encode(*arrays.column_bytes(pa.array([text], pa.string())))
        assert ids.tolist() == e.ids and n.tolist() == [len(e.ids)]


def test_packing(docs, texts):
    placed = pack_documents(docs, BYTE).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    total = 0
    for i, e in zip(texts, encoded(BYTE, texts.values())):
        ids = np.array([*e.ids, 2], "<u4")
        total += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // 1024)))
        assert [r.length for r in pieces[1:]] == [1024] * (len(pieces) - 1)
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_sequence) <= -(-total // 1024) + 2


def test_packing_over_many_partitions(spark, monkeypatch):
    from meterlake.llm import packing

    monkeypatch.setattr(packing, "TASK_ITEMS", 40)
    random = np.random.default_rng(1)
    sizes = [int(x) for x in random.integers(1, 700, 800)]
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECE.replace(":", "").replace("bigint", "long"))
    bins = pack_pieces(pieces, 1024).collect()
    assert sorted(p.doc_id for b in bins for p in b.parts) == list(range(800))
    assert all(b.load == sum(p.length for p in b.parts) <= 1024 for b in bins)
    assert len(bins) <= -(-sum(sizes) // 1024) + 800 // 40


def test_best_fit_leaves_no_two_bins_that_fit_together():
    random = np.random.default_rng(2)
    for n in (0, 1, 50, 500):
        sizes = random.integers(1, 101, n)
        bin_of = best_fit(sizes, 100)
        load = np.sort(np.bincount(bin_of, weights=sizes))
        assert (load <= 100).all() and (len(load) < 2 or load[0] + load[1] > 100)


def test_ids_can_be_had_with_the_places(spark, docs, texts):
    few = docs.where("doc_id < 20")
    rows = pack_documents(few, BYTE, with_ids=True).collect()
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert len(r.ids) == r.length
        whole[r.doc_id] += r.ids
    for i in whole:
        assert whole[i] == [*encoded(BYTE, [texts[i]])[0].ids, 2]


def test_odd_and_empty_tables(spark):
    odd, empty = odd_documents(spark), odd_documents(spark).limit(0)
    n = odd.count()
    assert token_counts.count_tokens(odd, BYTE).count() == n and token_counts.count_tokens(empty, BYTE).count() == 0
    assert trie_bpe.round_trip(odd, WORD).count() == n and trie_bpe.round_trip(empty, WORD).count() == 0
    assert pack_documents(odd, BYTE).where("piece = 0").count() == n and pack_documents(empty, BYTE).count() == 0


def test_queries_run_over_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op3_trie_bpe", "op6_token_counts"):
        assert queries.QUERIES[name](spark, SF).count() == n


def doubling(first, second, letters):
    """A word that alternates two letters in the doubling order, and its mirror image."""
    a, b = first, second
    while len(a) < letters:
        a, b = a + b, b + a
    return a, b


def hard_texts():
    """Words whose hashes agree modulo powers of two, and a text longer than a piece of a batch."""
    pairs = [doubling(x, y, 2048) for x, y in ("ab", "th", "qz", "eo", "01", "xy")]
    texts = [t for a, b in pairs for t in (f"{a} {b}", f"{b} {a} {a}", a, b)]
    return [*texts, "some words, 1234 and don't\n" * 90_000]


def test_alike_hashes_and_long_texts_equal_the_library(spark):
    ship_package(spark)
    texts = dict(enumerate(hard_texts()))
    assert len(texts[len(texts) - 1]) > arrays.PIECE_BYTES
    df = documents(spark, [*texts.items()]).coalesce(1)
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, BYTE).collect()}
    pieces = defaultdict(list)
    for r in cut_pieces(df, BYTE, 1024, 2).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    trips = {r.doc_id: r for r in trie_bpe.round_trip(df, WORD).collect()}
    words = Tokenizer.from_file(WORD)
    for i, byte, word in zip(texts, encoded(BYTE, texts.values()), encoded(WORD, texts.values())):
        assert counts[i] == len(byte.ids)
        ids = np.array([*byte.ids, 2], "<u4")
        for start, length, crc in pieces[i]:
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
        assert sum(length for _, length, _ in pieces[i]) == len(ids)
        assert trips[i].n_tokens == len(word.ids)
        assert trips[i].ids_sha256 == hashlib.sha256(np.array(word.ids, "<u4").tobytes()).hexdigest()
        assert trips[i].decoded_sha256 == hashlib.sha256(words.decode(word.ids, skip_special_tokens=False).encode()).hexdigest()


def test_hashes_tell_doubling_words_apart():
    for x, y in ("ab", "th", "01"):
        a, b = doubling(x, y, 4096)
        data = np.frombuffer((a + b + a).encode(), np.uint8)
        at = np.array([0, len(a), 2 * len(a)])
        h = arrays.span_hashes(data, at, at + len(a))
        assert h[0] == h[2] != h[1]
        assert not arrays.equal_spans(data, at[:2], at[1:], data, at[1:], at[1:] + len(a)).any()
