"""Encodings of distinct byte spans, remembered by a worker from batch to batch."""

from __future__ import annotations

import numpy as np

from meterlake.llm import arrays

#: Distinct spans a worker remembers, and their bytes. The memory is emptied beyond; results don't depend on it.
REMEMBERED, REMEMBERED_BYTES = 600_000, 1 << 25


class SpanMemory:
    """Token ids of byte spans. A subclass encodes new spans; entry i holds the ids of one span.

    The first entries are the special tokens, in the order of `specials`. Hashes find an entry, but the bytes decide:
    spans of one hash and different bytes have entries of their own.
    """

    specials: dict[bytes, int]

    def encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the spans one behind another, and the number of each span."""
        raise NotImplementedError

    def forget(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids = np.array([*self.specials.values()], np.int32)
        self.starts = np.arange(len(self.ids))
        self.sizes = np.ones(len(self.ids), np.int64)
        self.held = np.zeros(0, np.uint8)  # bytes of the spans, one behind another
        self.held_ends = np.zeros(len(self.ids) + 1, np.int64)
        self.rivals: dict[bytes, int] = {}  # entries of spans whose hash has an entry of other bytes

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of each byte span; new spans are encoded first."""
        hashes, at, which = np.unique(arrays.quick_hashes(data, starts, ends), return_index=True, return_inverse=True)
        which = which.reshape(-1)
        if len(self.known) > REMEMBERED or len(self.held) > REMEMBERED_BYTES:
            self.forget()
        numbers = np.full(len(hashes), -1, np.int64)
        if len(self.known):
            place = np.searchsorted(self.known, hashes)
            place[place == len(self.known)] = 0
            numbers = np.where(self.known[place] == hashes, self.number[place], -1)
        if len(new := np.flatnonzero(numbers < 0)):
            numbers[new] = self.add(data, starts[at[new]], ends[at[new]])
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.number = known[order], np.concatenate([self.number, numbers[new]])[order]
        found = numbers[which]
        other = ~arrays.equal_spans(data, starts, ends, self.held, self.held_ends[found], self.held_ends[found + 1])
        for i in np.flatnonzero(other).tolist():
            span = data[starts[i] : ends[i]].tobytes()
            if span not in self.rivals:
                self.rivals[span] = int(self.add(data, starts[i : i + 1], ends[i : i + 1])[0])
            found[i] = self.rivals[span]
        return found

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Encode spans as new entries and give their numbers."""
        ids, counts = self.encode_new(data, starts, ends)
        numbers = len(self.sizes) + np.arange(len(starts))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.sizes = np.concatenate([self.sizes, counts])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.held_ends = np.concatenate([self.held_ends, len(self.held) + np.cumsum(ends - starts)])
        self.held = np.concatenate([self.held, data[arrays.ragged(starts, ends - starts)]])
        return numbers

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts cut at the strings of special tokens: ends of all segments, and each one's entry or -1."""
        found: list[tuple[int, int, int]] = []
        whole = data.tobytes()
        for number, string in enumerate(self.specials):
            at = whole.find(string)
            while at >= 0:
                ends = np.array([at, at + len(string) - 1])
                inside = np.ptp(arrays.owners(ends, offsets)) == 0
                if inside:
                    found.append((at, at + len(string), number))
                at = whole.find(string, at + (len(string) if inside else 1))
        cuts = np.unique(np.concatenate([offsets, np.array([x for a, b, _ in found for x in (a, b)], np.int64)]))
        special = np.full(len(cuts) - 1, -1, np.int64)
        for a, _, number in found:
            special[np.searchsorted(cuts, a)] = number
        return cuts, special

    def gather(self, entries: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a list of entries one behind another, and the number of each of n owners."""
        size = self.sizes[entries]
        return self.ids[arrays.ragged(self.starts[entries], size)], self.total(entries, owner, n)

    def total(self, entries: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(owner, weights=self.sizes[entries], minlength=n).astype(np.int64)
