"""BPE encoding and decoding of words by a depth-first walk over a trie of distinct words.

The greedy merges of BPE have a local form: two neighbouring tokens stay apart for good if no merge
across their border would have come before the merges that made them. So the encoding of a prefix
is known from its last token alone. The walk visits the distinct words of a batch in sorted
order, which is the depth-first order of their trie, and holds the last token of every
prefix on the current path. A prefix shared by many words is encoded once.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterlake.llm import arrays
from meterlake.llm.memory import SpanMemory
from meterlake.llm.token_counts import BLANK, DIGIT, byte_classes, byte_letters, contractions

WORD_END = "</w>"
#: Token pairs whose stability a worker remembers; the memory is emptied beyond it.
REMEMBERED_PAIRS = 2_000_000


def normalised(text: str) -> str:
    """Composed form in lower case, letter by letter: a capital sigma never turns into the final form."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def word_spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of segments beginning at `cuts`: letter runs, single numbers, runs of marks, contractions."""
    n = len(data)
    kinds = byte_classes(data)
    space = kinds <= BLANK
    lead = (data & 0xC0) != 0x80
    begin = np.ones(n + 1, bool)
    begin[1:n] = kinds[1:] != kinds[:-1]
    begin[:n] |= kinds == DIGIT
    begin[cuts[cuts < n]] = True
    begin[:n] &= lead
    quote = np.flatnonzero((data == 0x27) & begin[:n])
    if len(quote):
        size = contractions(data, quote, cuts[np.searchsorted(cuts, quote, side="right")])
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        begin[quote + size] = True
    at = np.flatnonzero(begin)
    keep = ~space[at[:-1]]
    return at[:-1][keep], at[1:][keep]


class TrieEncoder(SpanMemory):
    """Encoder and decoder for a BPE vocabulary with marked word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        byte_of = {letter: bytes([b]) for b, letter in enumerate(byte_letters())}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.specials = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.rank = {i: -1 for i in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[int, int] = {}
        for r, (a, b) in enumerate(pairs):
            made = vocab[a + b]
            self.rank[made], self.parts[made] = r, (vocab[a], vocab[b])
            self.merges[vocab[a] << 20 | vocab[b]] = r
        self.stable_pairs: dict[int, bool] = {}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        proper: dict[int, bool] = {}
        strings = {i: s for s, i in vocab.items()}
        for i in sorted(strings, key=self.rank.__getitem__):
            made = self.parts.get(i)
            proper[i] = made is None or proper[made[0]] and proper[made[1]] and self.apart(*made, self.rank[i])
            s = strings[i]
            if proper[i] and s.encode() not in self.specials:
                ends = s.endswith(WORD_END)
                held = self.final if ends else self.inner
                held[b"".join(byte_of[c] for c in (s[: -len(WORD_END)] if ends else s))] = i
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.strings = {i: s.encode() for i, s in strings.items()} | {i: s for s, i in self.specials.items()}
        self.forget()

    def forget(self) -> None:
        super().forget()
        self.decoded = [self.strings[i] for i in self.specials.values()]

    def apart(self, a: int, b: int, own: int = 1 << 40) -> bool:
        """Whether tokens a and b, side by side, are never merged across their border before rank `own`.

        Undoes the merges of both from the latest back. Between two of them the border has one pair
        of symbols; if that pair has a merge of a rank in this gap, it comes first. Of equal
        ranks the one further left comes first.
        """
        left_next = right_next = own
        while True:
            r = self.merges.get(a << 20 | b)
            if r is not None and r < left_next and (r < right_next or r == right_next != own):
                return False
            if self.rank[a] > self.rank[b]:
                left_next = self.rank[a]
                a = self.parts[a][1]
            elif self.rank[b] >= 0:
                right_next = self.rank[b]
                b = self.parts[b][0]
            else:
                return True

    def last_token(self, word: bytes, end: int, states: list[int], table: dict[bytes, int]) -> tuple[int, int]:
        """Last token of the encoding of word[:end], and where it begins; states: last token of each prefix."""
        whole = table.get(word[:end]) if end <= self.longest else None
        if whole is not None:
            return whole, 0
        stable = self.stable_pairs
        for begin in range(max(1, end - self.longest), end):
            token = table.get(word[begin:end])
            if token is None:
                continue
            before = states[begin]
            key = before << 20 | token
            held = stable.get(key)
            if held is None:
                held = stable[key] = self.apart(before, token)
            if held:
                return token, begin
        raise ValueError(f"the vocabulary can't spell {word!r}")

    def encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if len(self.stable_pairs) > REMEMBERED_PAIRS:
            self.stable_pairs.clear()
        encoded: list[list[int]] = [[]] * len(words)
        states, begins, path = [-1], [0], b""
        last_token, inner, final = self.last_token, self.inner, self.final
        for i in sorted(range(len(words)), key=words.__getitem__):
            word = words[i]
            shared, most = 0, min(len(word) - 1, len(states) - 1)
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del states[shared + 1 :], begins[shared + 1 :]
            for end in range(shared + 1, len(word)):
                token, begin = last_token(word, end, states, inner)
                states.append(token)
                begins.append(begin)
            path = word
            token, at = last_token(word, len(word), states, final)
            tokens = [token]
            while at:
                tokens.append(states[at])
                at = begins[at]
            tokens.reverse()
            encoded[i] = tokens
        strings = self.strings
        self.decoded += [b" ".join([strings[t] for t in tokens]) for tokens in encoded]
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((t for tokens in encoded for t in tokens), np.int32, int(counts.sum())), counts

    def prepared(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries of all words and special tokens of the texts, their text, and nothing else."""
        raw, number, owner = [], [], []
        for i, text in enumerate(texts):
            for part, special in self.split_specials(text or ""):
                raw.append(b"" if special >= 0 else normalised(part).encode("utf-8", "surrogatepass"))
                number.append(special)
                owner.append(i)
        cuts = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(x) for x in raw], out=cuts[1:])
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner, number = np.array(owner, np.int64), np.array(number, np.int64)
        special = np.flatnonzero(number >= 0)
        if len(data):
            starts, ends = word_spans(data, cuts)
            segment = arrays.owners(starts, cuts)
            entries = self.entries(data, starts, ends)
        else:
            segment, entries = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(special):
            segment, entries = np.concatenate([segment, special]), np.concatenate([entries, number[special]])
            order = np.argsort(segment, kind="stable")
            segment, entries = segment[order], entries[order]
        return entries, owner[segment] if len(owner) else segment

    def split_specials(self, text: str) -> list[tuple[str, int]]:
        """The text between special tokens with -1, and the special tokens with their entry."""
        out = [(text, -1)]
        for number, string in enumerate(self.specials):
            string = string.decode()
            if string not in text:
                continue
            cut = []
            for part, special in out:
                if special >= 0:
                    cut.append((part, special))
                    continue
                for j, piece in enumerate(part.split(string)):
                    cut += [(string, number)] * (j > 0) + [(piece, -1)]
            out = cut
        return out


@lru_cache(2)
def trie_encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def round_trip(docs: DataFrame, tokenizer: str, with_values: bool = False) -> DataFrame:
    """Encode every text and decode it again: token count and digests, on request ids and decoded text.

    One row in, one row out, without a shuffle. A null text counts as empty. Digests are of the ids as
    little-endian unsigned 32-bit integers and of the decoded text in UTF-8. Strings of special tokens in a
    text become those tokens. Decoding joins tokens by blanks, as a vocabulary without a decoder does.
    Repeated rows and null ids stay. Other columns are not carried.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = trie_encoder(tokenizer)
        for batch in arrays.pieces(batches):
            entries, owner = bpe.prepared(batch.column("text").to_pylist())
            n = batch.num_rows
            ids, counts = bpe.gather(entries, owner, n)
            first, last = arrays.bounds(owner, n)[:-1].tolist(), arrays.bounds(owner, n)[1:].tolist()
            raw = memoryview(ids.astype("<u4")).cast("B") if len(ids) else memoryview(b"")
            ends = np.cumsum(counts)
            begins = (ends - counts).tolist()
            decoded = [b" ".join([bpe.decoded[e] for e in entries[a:b].tolist()]) for a, b in zip(first, last)]
            columns = [
                batch.column("doc_id"),
                pa.array(counts),
                pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(begins, ends.tolist())]),
                pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            ]
            if with_values:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids)))
                columns.append(pa.array([x.decode("utf-8") for x in decoded]))
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_values else ""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, schema)
