"""Alignment of tokenizers against a plain recomputation with the libraries."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from llm_making import AWKWARD, documents, odd_documents, texts_of
from tokenizers import Tokenizer

from meterlake.llm import align, arrays, queries
from meterlake.llm.shared import ship_package
from meterlake.llm.token_counts import byte_letters

BYTE, PIECE = (queries.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TRICKY = [
    "a▁b", "▁", "<0x0A>", "<s> </s> <unk>", "  two  blanks ", " ", "   ", "\t\n", "tail ", "<|endoftext|> x<|endoftext|>", "\x00b\x00",
    "日本語", "😀 é é", "\xa0x　y", "." * 700, " " * 100 + "x", "a" * 5000,
]


@pytest.fixture(scope="module")
def both():
    plain = Tokenizer.from_file(BYTE)
    plain.encode_special_tokens = True
    return plain, sentencepiece.SentencePieceProcessor(model_file=PIECE)


BYTE_OF = {c: b for b, c in enumerate(byte_letters())}


def plainly(both, text):
    """Ids and bytes of both tokenizers, or nothing."""
    plain, pieces = both
    if not text:
        return [], [], [], []
    wanted = (" " + text).encode()
    a = plain.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(map(BYTE_OF.get, t)) for t in a.tokens]
    b = pieces.encode(text)
    b_bytes = [
        bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in b)
    ]
    if b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
        return [], [], [], []
    return a.ids, a_bytes, b, b_bytes


def expected(both, rows):
    held = []
    total = Counter()
    for i, text in rows:
        a, a_bytes, b, b_bytes = plainly(both, text)
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        links, groups = [], []
        first = [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            after = [side.index(cut, k) + 1 for side, k in zip(ends, first)]
            sides = [range(*x) for x in zip(first, after)]
            first = after
            groups.append(",".join(str(a[k]) for k in sides[0]) + "|" + ",".join(str(b[k]) for k in sides[1]))
            for x in sides[0]:
                for y in sides[1]:
                    start = max(ends[0][x] - len(a_bytes[x]), ends[1][y] - len(b_bytes[y]))
                    if start < min(ends[0][x], ends[1][y]):
                        links.append((a[x], b[y]))
        total.update(links)
        held.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    for i, n_a, n_b, n_groups, links, groups in held:
        best = sum(total[link] == most[link[1]] for link in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        yield i, n_a, n_b, n_groups, len(links), best, sum(total[link] for link in links), digest


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def same(both, df, hot_pairs):
    got = align.align_documents(df, BYTE, PIECE, hot_pairs).select(*COLUMNS).collect()
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected(both, rows), key=repr)


@pytest.mark.parametrize("hot_pairs", [align.HOT_PAIRS, 40])
def test_texts_of_the_tables(spark, both, hot_pairs):
    """With all pairs broadcast, and with most of them joined."""
    ship_package(spark)
    texts = {**{i: t and t[:3000] for i, t in texts_of(spark).items()}, **{10**6 + i: t for i, t in enumerate(TRICKY)}}
    same(both, documents(spark, [*texts.items()]).repartition(3), hot_pairs)


def test_odd_rows(spark, both):
    ship_package(spark)
    df = odd_documents(spark)
    for name in ("pair", "n", "uid", "rare"):
        df = df.withColumn(name, df.doc_id)
    got = align.align_documents(df, BYTE, PIECE, 10).select(*COLUMNS).collect()
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(expected(both, rows), key=repr)
    assert align.align_documents(documents(spark, []), BYTE, PIECE).collect() == []
    assert [tuple(r)[1:] for r in align.align_documents(documents(spark, [(1, None)]), BYTE, PIECE).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_a_text_longer_than_a_piece(both):
    text = "some words, 1234 and more\n" * (arrays.PIECE_BYTES // 20)
    a, b = align.tokenizers(BYTE, PIECE)
    held = align.align(pa.array(["short one", text, ""]), a, b)
    ids_a, _, ids_b, _ = plainly(both, text)
    assert held.ids[0][held.bounds[0][1] : held.bounds[0][2]].tolist() == ids_a
    assert held.ids[1][held.bounds[1][1] : held.bounds[1][2]].tolist() == ids_b


def test_words_of_one_hash_and_different_bytes(both, monkeypatch):
    """Bytes decide, whatever the hashes say."""
    monkeypatch.setattr(arrays, "quick_hashes", lambda data, starts, ends: np.full(len(starts), 7, np.uint64))
    a, b = align.PlainMerger(BYTE), align.Pieces(PIECE)
    texts = [t for t in AWKWARD + TRICKY if t and len(t) < 300]
    held = align.align(pa.array(texts), a, b)
    for i, text in enumerate(texts):
        ids_a, _, ids_b, _ = plainly(both, text)
        assert held.ids[0][held.bounds[0][i] : held.bounds[0][i + 1]].tolist() == ids_a
        assert held.ids[1][held.bounds[1][i] : held.bounds[1][i + 1]].tolist() == ids_b


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), min_size=1, max_size=40), min_size=1, max_size=5), st.data())
def test_gallop_finds_what_bisection_finds(parts, data):
    ends = np.cumsum(np.concatenate([np.array(p) for p in parts]))
    bounds = np.append(0, np.cumsum([len(p) for p in parts]))
    wanted, low, high, guess = [], [], [], []
    for first, last in zip(bounds[:-1], bounds[1:]):
        for value in data.draw(st.lists(st.integers(0, int(ends[-1]) + 3), max_size=10)):
            wanted.append(value), low.append(first), high.append(last), guess.append(data.draw(st.integers(int(first), int(last) - 1)))
    found = align.gallop(*(np.array(x, np.int64) for x in (wanted,)), ends, *(np.array(x, np.int64) for x in (low, high, guess)))
    assert found.tolist() == [f + int(np.searchsorted(ends[f:l], w)) for w, f, l in zip(wanted, low, high)]
