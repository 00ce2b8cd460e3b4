"""Vectorised helpers over the UTF-8 bytes of many texts, used inside Spark tasks."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_STEP = 4 * 1024 * 1024

SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@cache
def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64)) | U64(1)


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; grown when a longer text comes."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        p = np.full(max(n, 1 << 16) + 1, U64(base))
        p[0] = U64(1)
        _powers[base] = have = np.multiply.accumulate(p)
    return have[: n + 1]


def _forward(n: int) -> np.ndarray:
    return _power_table(_BASE, n)


def _backward(n: int) -> np.ndarray:
    return _power_table(pow(_BASE, -1, 1 << 64), n)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Sums of codes[i] * base**i, from which the hash of any slice follows."""
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * _forward(len(codes))[:-1], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per slice; equal slices of equal length have equal hashes wherever they lie."""
    h = (sums[ends] - sums[starts]) * _backward(len(sums) - 1)[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all slices of one width."""
    if len(codes) < width:
        return np.zeros(0, U64)
    sums = prefix_hashes(codes)
    n = len(codes) - width + 1
    return mix((sums[width:] - sums[:-width]) * _backward(len(codes))[:n])


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: empty), and the offset of each text and of the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def steps(off: np.ndarray, size: int = _STEP):
    """Ranges of texts with about ``size`` bytes, a longer text alone, so that scratch arrays stay small."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def pieces(batches, size: int = _STEP // 2):
    """Arrow batches with a column ``text`` cut into slices of bounded text, a longer text alone."""
    for batch in batches:
        for a, b in steps(text_buffer(batch.column("text"))[1], size):
            yield batch.slice(a, b - a)


def word_bounds(
    raw: np.ndarray, off: np.ndarray, between: np.ndarray = SPACES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every run of bytes not between words, and the word offset of each text and the end."""
    n = len(raw)
    inside = ~between[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = off[1:-1]
    heads = edges[edges < n]
    first[heads] = inside[heads]
    tails = edges[edges > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def word_hashes(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of every text, and the word offset of each text and of the end.

    A word is a run of bytes outside [\\x20\\x09-\\x0D]; ``lower`` lower-cases A-Z first.
    """
    raw, off = text_buffer(texts)
    parts, counts = [], [np.zeros(1, np.int64)]
    codes = _byte_codes()
    if lower:
        codes = codes.copy()
        codes[65:91] = codes[97:123]
    for a, b in steps(off):
        piece, at = raw[off[a] : off[b]], off[a : b + 1] - off[a]
        starts, ends, bounds = word_bounds(piece, at)
        parts.append(slice_hashes(prefix_hashes(codes[piece]), starts, ends))
        counts.append(np.diff(bounds))
    return np.concatenate([np.zeros(0, U64), *parts]), np.cumsum(np.concatenate(counts))


def byte_codes(raw: np.ndarray) -> np.ndarray:
    return _byte_codes()[raw]


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def run_bounds(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true values."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in one of the given windows of one width."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


# --- sorted keys on the wire ----------------------------------------------------------


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences of the fewest whole bytes."""
    n = len(keys)
    steps_ = np.diff(keys)
    width = max(1, (int(steps_.max()).bit_length() + 7) // 8) if n > 1 else 1
    body = np.ascontiguousarray(steps_).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    head = np.array([n, width], "<u4").tobytes() + (int(keys[0]) if n else 0).to_bytes(8, "little")
    return head + body


def unpack_keys(data: bytes) -> tuple[np.ndarray, memoryview]:
    """The keys, and what follows them."""
    n, width = (int(x) for x in np.frombuffer(data, "<u4", 2))
    size = max(0, n - 1) * width
    wide = np.zeros((max(0, n - 1), 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, size, 16).reshape(-1, width)
    keys = np.empty(n, U64)
    if n:
        keys[0] = U64(int.from_bytes(data[8:16], "little"))
        keys[1:] = wide.reshape(-1).view("<u8")
        np.cumsum(keys, out=keys)
    return keys, memoryview(data)[16 + size :]


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def shard_slices(keys: np.ndarray, shards: int):
    """The slices of sorted keys that belong to each shard; shards without a key are left out."""
    width = -(-(1 << 64) // shards)
    cuts = np.searchsorted(keys, np.array([min(width * s, (1 << 64) - 1) for s in range(1, shards)], U64))
    bounds = np.concatenate([[0], cuts, [len(keys)]]).astype(np.int64)
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), int(bounds[s]), int(bounds[s + 1])


class SortedHashes:
    """Looks up keys in a sorted array of hashes, by a table of where the hashes of each prefix begin."""

    def __init__(self, hashes: np.ndarray):
        bits = max(1, (2 * len(hashes)).bit_length())
        self.shift = U64(64 - bits)
        self.hashes = np.append(hashes, U64((1 << 64) - 1))
        self.starts = np.searchsorted(hashes, np.arange(1 << bits, dtype=U64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of every key; -1 for a key that is not there."""
        at = self.starts[(keys >> self.shift).astype(np.int64)]
        behind = np.flatnonzero(self.hashes[at] < keys)
        while len(behind):
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < keys[behind]]
        at[self.hashes[at] != keys] = -1
        at[at == len(self.hashes) - 1] = -1
        return at
