"""Whole record batches of text as numpy arrays: byte buffers, words, hashes.

Operators of this package that run in Python get Arrow batches from Spark and work on
the byte buffer of a text column at once, never on one row at a time. Batches are cut
into pieces of a few megabytes, so memory follows the largest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 21
#: The same where each word has many numbers: more of them take more memory, and no less time.
HELD_BYTES = 1 << 18
#: Powers are held for whole numbers of so many places: no more than the pieces at hand need.
POWER_STEP = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}
#: Base and prime of the two polynomials that name byte spans.
_POLYNOMIALS = ((1_103_515_245, 2_147_483_647), (1_664_525_223, 2_147_483_629))
_PRIME_POWERS: dict[tuple[int, int], np.ndarray] = {}


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each text begins and ends; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, (at - at[0]).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut by the bytes of their column `text`, and `other` if there is one; a longer row is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = sum(column_bytes(batch.column(c))[1] for c in ("text", "other") if c in batch.schema.names)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
            last = min(last, first + 4096, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the hash base and of its inverse, modulo 2 to the 64th."""
    if len(_POWERS.get("up", ())) < n:
        size = -(-n // POWER_STEP) * POWER_STEP
        for name, base in (("up", _BASE), ("down", _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        if size > 16 * PIECE_BYTES:  # one huge text: don't keep its tables
            return _POWERS.pop("up")[:n], _POWERS.pop("down")[:n]
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prime_powers(n: int, base: int, prime: int) -> np.ndarray:
    """First n powers of the base modulo a prime below 2 to the 31st, by doubling."""
    held = _PRIME_POWERS.get((base, prime))
    if held is not None and len(held) >= n:
        return held[:n]
    size = -(-n // POWER_STEP) * POWER_STEP
    out = np.ones(size, np.uint32)
    done = 1
    while done < size:
        more = min(done, size - done, 1 << 16)
        out[done : done + more] = out[:more].astype(np.uint64) * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    if size <= 16 * PIECE_BYTES:  # one huge text: don't keep its table
        _PRIME_POWERS[base, prime] = out
    return out[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a common integer hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes have equal hashes wherever they stand.

    Polynomials modulo two primes: unlike those modulo a power of two, they tell apart texts that alternate
    two letters in doubling patterns.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    values = data.astype(np.uint64) + np.uint64(salt * 2 + 1)
    h = (ends - starts).astype(np.uint64) << np.uint64(7)
    for base, prime in _POLYNOMIALS:
        p = np.uint64(prime)
        up, down = prime_powers(n, base, prime), prime_powers(n + 1, pow(base, -1, prime), prime)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up % p, out=total[1:])
        h = mixed(h ^ ((total[ends] - total[starts]) % p * down[starts] % p))
    return h


def quick_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cheaper hash of byte spans, modulo 2 to the 64th, for callers that compare the bytes of equal hashes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def equal_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray
) -> np.ndarray:
    """For each pair of spans, in two arrays, whether their bytes agree."""
    size = ends - starts
    same = size == other_ends - other_starts
    at = np.flatnonzero(same & (size > 0))
    size = size[at]
    differ = data[ragged(starts[at], size)] != other[ragged(other_starts[at], size)]
    if differ.any():
        wrong = np.searchsorted(np.cumsum(size), np.flatnonzero(differ), side="right")
        same[at[wrong]] = False
    return same


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of the mask inside one text."""
    n = len(mask)
    before = np.zeros(n, bool)
    before[1:] = mask[:-1]
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    before[cut] = False
    after[cut - 1] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, owners(starts, offsets)


def owners(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the text each byte position lies in."""
    return np.searchsorted(offsets, starts, side="right") - 1


def bounds(owner: np.ndarray, n: int) -> np.ndarray:
    """Where the items of each of n owners begin in a list sorted by owner; n + 1 values."""
    return np.searchsorted(owner, np.arange(n + 1))


def grams(h: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k consecutive items of one owner, and the index of its first item."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * _BASE + h[j : j + n]
    first = np.flatnonzero(owner[:n] == owner[k - 1 :])
    return mixed(total[first]), first


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of many slices one after another: begin[0]..., begin[1]..., and so on."""
    total = int(length.sum())
    shift = np.repeat(begin - (np.cumsum(length) - length), length)
    return shift + np.arange(total)


WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of anything but ASCII white space: start, end and text number."""
    return runs(WORD_BYTES[data], offsets)


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
