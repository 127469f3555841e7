"""Token counts by rank-synchronous merging of pre-tokens held as ragged arrays.

Each text is cut into pre-tokens with array operations over its bytes. The distinct
pre-tokens of a batch lie one behind another in one array of symbol ids. A round looks up
the merge rank of every neighbouring pair, finds the lowest rank of each pre-token, and
applies that merge in all of them at once. Pre-tokens without a mergeable pair leave the
array. The symbols that survive are the tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Regex, pre_tokenizers

from meterlake.llm import arrays
from meterlake.llm.memory import SpanMemory

TOKEN_LIMIT = 1024
_NONE = np.int64(1) << 40

OTHER_SPACE, BLANK, LETTER, DIGIT, MARK = range(5)


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of every code point: white space, blank, letter, number, or anything else.

    Characters younger than Unicode 3.2 are asked from the tokenizers library, whose release of Unicode decides.
    """
    table = np.full(0x110000, MARK, np.uint8)
    valid = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, valid))
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (OTHER_SPACE, r"\s+")):
        for run in regex.finditer(pattern, everything):
            table[valid[run.start()] : valid[run.end() - 1] + 1] = kind
    category = unicodedata.ucd_3_2_0.category
    young = [c for c in np.flatnonzero(table != MARK).tolist() if category(chr(c)) == "Cn"]
    table[young] = MARK
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for _, (first, last) in split.pre_tokenize_str("".join(map(chr, young))):
            table[young[first:last]] = kind
    table[0x20] = BLANK
    return table


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character each byte belongs to."""
    table = character_classes()
    kinds = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return kinds
    first = data[lead].astype(np.int64)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = np.where(size == 2, first & 0x1F, np.where(size == 3, first & 0x0F, first & 0x07))
    last = len(data) - 1
    for j in (1, 2, 3):
        longer = size > j
        point = np.where(longer, (point << 6) | (data[np.minimum(lead + j, last)] & 0x3F), point)
    kind = table[np.minimum(point, 0x10FFFF)]
    kinds[lead] = kind
    for j in (1, 2, 3):
        longer = size > j
        kinds[lead[longer] + j] = kind[longer]
    return kinds


def contractions(data: np.ndarray, quote: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Length of the English contraction at each apostrophe, 0 if none. stop: where its text ends."""
    n = len(data)
    one = np.where(quote + 1 < stop, data[np.minimum(quote + 1, n - 1)], 0)
    two = np.where(quote + 2 < stop, data[np.minimum(quote + 2, n - 1)], 0)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    r, v, e, ll = (ord(c) for c in "rvel")
    long = (((one == r) | (one == v)) & (two == e)) | ((one == ll) & (two == ll))
    return np.where(short, 2, np.where(long, 3, 0))


def pre_tokens(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where pre-tokens of byte-level BPE begin, for segments that begin at `cuts`."""
    n = len(data)
    kinds = byte_classes(data)
    space = kinds <= BLANK
    run = np.where(space, OTHER_SPACE, kinds)
    begin = np.zeros(n + 1, bool)
    begin[1:n] = run[1:] != run[:-1]
    begin[n] = True
    inner = cuts[cuts < n]
    begin[inner] = True
    head = np.zeros(n + 1, bool)
    head[inner] = True
    # The last white space before a word stands alone, or joins the word if it is a blank.
    word = np.flatnonzero(begin[:n] & ~head[:n] & ~space)
    word = word[space[word - 1]]
    blank = kinds[word - 1] == BLANK
    begin[word[blank]] = False
    begin[word[blank] - 1] = True
    alone = word[~blank] - 1
    while len(back := np.flatnonzero((data[alone] & 0xC0) == 0x80)):  # to its first byte
        alone[back] -= 1
    begin[alone] = True
    quote = np.flatnonzero((data == 0x27) & begin[:n])
    if len(quote):
        stop = cuts[np.searchsorted(cuts, quote, side="right")]
        size = contractions(data, quote, stop)
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        begin[quote + size] = True
    return np.flatnonzero(begin)


class PairTable:
    """Open-addressing table from a pair of symbols to its merge: rank and new symbol."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        bits = max(4, int(len(left) * 4 - 1).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, _NONE, np.int64)
        keys = (left.astype(np.int64) << 32) | right
        rest, place = np.arange(len(keys)), self._place(keys)
        while len(rest):
            free = self.keys[place] == -1
            _, chosen = np.unique(np.where(free, place, -1 - np.arange(len(place))), return_index=True)
            chosen = chosen[free[chosen]]
            self.keys[place[chosen]] = keys[rest[chosen]]
            self.rank[place[chosen]] = rest[chosen]
            keep = np.ones(len(rest), bool)
            keep[chosen] = False
            rest, place = rest[keep], (place[keep] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        place = self._place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.rank[place], _NONE)
        rest = np.flatnonzero((held != keys) & (held != -1))
        place = place[rest]
        while len(rest):
            place = (place + 1) & self.mask
            held = self.keys[place]
            hit = held == keys[rest]
            out[rest[hit]] = self.rank[place[hit]]
            on = ~hit & (held != -1)
            rest, place = rest[on], place[on]
        return out


class Merger(SpanMemory):
    """Byte-level BPE of a tokenizer file over many pre-tokens at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.vocabulary = vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.table = PairTable(left, right)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.first = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.forget()

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of sequences one behind another, to their tokens in the same order."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_symbols, done_owner = [], []
        rank = self._pair_ranks(symbols, owner)
        while len(symbols):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.append(begin, len(owner)))
            least = np.minimum.reduceat(rank, begin)
            if not (on := least < _NONE).all():
                rest = np.repeat(on, length)
                done_symbols.append(symbols[~rest])
                done_owner.append(owner[~rest])
                symbols, owner, rank = symbols[rest], owner[rest], rank[rest]
                least, length = least[on], length[on]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, length))
            # A pair of two like symbols can overlap itself: of neighbouring hits take every second.
            if len(close := np.flatnonzero(np.diff(hit) == 1)):
                follows = np.zeros(len(hit), bool)
                follows[close + 1] = True
                first = np.maximum.accumulate(np.where(follows, -1, np.arange(len(hit))))
                hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[hit] = True
            symbols, owner, rank, changed = symbols[keep], owner[keep], rank[keep], changed[keep]
            changed[:-1] |= changed[1:]  # a new symbol changes its own pair and the one before
            at = np.flatnonzero(changed)
            rank[at] = self._ranks_at(symbols, owner, at)
        symbols = np.concatenate([*done_symbols, symbols])
        owner = np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(sizes))

    def _pair_ranks(self, symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbols), _NONE, np.int64)
        at = np.flatnonzero(owner[1:] == owner[:-1])
        rank[at] = self.table.ranks(symbols[at], symbols[at + 1])
        return rank

    def _ranks_at(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        rank = np.full(len(at), _NONE, np.int64)
        inside = np.flatnonzero(at + 1 < len(symbols))
        inside = inside[owner[at[inside]] == owner[at[inside] + 1]]
        rank[inside] = self.table.ranks(symbols[at[inside]], symbols[at[inside] + 1])
        return rank

    def encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = ends - starts
        return self.merge(self.first[data[arrays.ragged(starts, size)]], size)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and text of each pre-token and special token."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts, special = self.segments(data, offsets)
        begin = pre_tokens(data, cuts)
        starts, ends = begin[:-1], begin[1:]
        token = special[np.searchsorted(cuts, starts, side="right") - 1]
        if (token >= 0).any():  # a special's string is one token, however it would be cut
            first = (token < 0) | np.isin(starts, cuts)
            starts, token = starts[first], token[first]
            ends = np.append(starts[1:], len(data))
        return np.where(token >= 0, token, self.entries(data, starts, ends)), arrays.owners(starts, offsets)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        return self.total(*self.spans(data, offsets), len(offsets) - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one behind another, and the number of each text."""
        return self.gather(*self.spans(data, offsets), len(offsets) - 1)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@lru_cache(2)
def merger(path: str) -> Merger:
    return Merger(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than `limit` tokens.

    One row in, one row out, without a shuffle. A null text counts as empty: 0 bytes, 0 tokens.
    Repeated rows and null ids stay. Other columns are not carried.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merger(tokenizer)
        for batch in arrays.pieces(batches):
            data, offsets = arrays.column_bytes(batch.column("text"))
            n = bpe.counts(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
