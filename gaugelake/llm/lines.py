"""Line dedup with two Bloom filters: one for line hashes seen once, one for those seen twice.

The filters are split by ranges of the hash, so each has a bounded size however large the corpus
is. Blocks send the hashes of their distinct lines; a hash that the first filter already holds
goes into the second. Only lines whose hash is in the second filter are suspects, and only those
are shuffled, with their text, to be confirmed exactly and to find the document that keeps them.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from gaugelake.llm import arrays, blocks

_SPACE = b" \t\n\r\x0b\x0c"
_NO_DOC = -(1 << 63)
_U64 = np.uint64


class Bloom:
    """A Bloom filter for 64-bit hashes; about one in 400 others is taken for a member."""

    PROBES, BITS_PER_KEY = 4, 14

    def __init__(self, keys: int):
        size = 1 << max(10, (keys * self.BITS_PER_KEY - 1).bit_length() if keys else 10)
        self.mask = _U64(size - 1)
        self.bits = np.zeros(size // 8, np.uint8)

    def _places(self, keys: np.ndarray):
        other = arrays.mix(keys) | _U64(1)
        for i in range(self.PROBES):
            at = (keys + _U64(i) * other) & self.mask
            yield (at >> _U64(3)).astype(np.int64), np.uint8(1) << (at & _U64(7)).astype(np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for byte, bit in self._places(keys):
            np.bitwise_or.at(self.bits, byte, bit)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for byte, bit in self._places(keys):
            out &= (self.bits[byte] & bit) > 0
        return out


def line_key(line: bytes) -> bytes:
    """The line without spaces at its ends and with A-Z in lower case."""
    return line.strip(_SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


class _Lines:
    """The distinct line keys of one block: documents they are in, and the largest doc_id."""

    def __init__(self, docs: pa.Table, least: int):
        self.docs, self.least = docs, least
        self.ids = docs.column("doc_id").to_pylist()
        self.keys: dict[bytes, list[int]] = {}
        order = sorted(range(len(self.ids)), key=lambda d: (self.ids[d] is not None, self.ids[d]))
        texts = docs.column("text")
        for d in order:  # rows of one doc_id follow each other
            doc = self.ids[d]
            for line in texts[d].as_py().encode().split(b"\n"):
                key = line_key(line)
                if not _long_enough(key, least):
                    continue
                if (seen := self.keys.get(key)) is None:
                    self.keys[key] = [0 if doc is None else 1, _NO_DOC if doc is None else doc]
                elif doc is not None and seen[1] != doc:
                    seen[0] += 1
                    seen[1] = doc

    def hashed(self) -> tuple[np.ndarray, list[bytes]]:
        """Sorted hashes, each with one of its keys; keys with equal hashes all follow."""
        pairs = sorted((xxhash.xxh3_64_intdigest(k), k) for k in self.keys)
        return np.array([h for h, _ in pairs], _U64), [k for _, k in pairs]

    def hash_requests(self, shards: int):
        hashes, keys = self.hashed()
        often = np.array([self.keys[k][0] > 1 for k in keys], bool)
        distinct, places, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        flags = counts > 1
        flags[places[often]] = True
        for s, a, b in arrays.shard_slices(distinct, shards):
            yield s, arrays.pack_keys(distinct[a:b]) + arrays.pack_bits(flags[a:b])

    def suspects(self, shards: int, parts: dict[int, bytes]) -> tuple[np.ndarray, list[bytes]]:
        hashes, keys = self.hashed()
        distinct, places = np.unique(hashes, return_inverse=True)
        hit = np.flatnonzero(blocks.answered_bits(distinct, shards, parts)[places]) if len(keys) else []
        return hashes[hit] if len(keys) else hashes, [keys[i] for i in hit]

    def text_requests(self, shards: int, parts: dict[int, bytes]):
        hashes, keys = self.suspects(shards, parts)
        for s, a, b in arrays.shard_slices(hashes, shards):
            own = keys[a:b]
            sizes = np.array([len(k) for k in own], "<u4")
            known = np.array([self.keys[k] for k in own], "<i8").T
            yield s, np.uint32(b - a).tobytes() + sizes.tobytes() + known.tobytes() + b"".join(own)


def _suspected(requests: list[bytes]) -> list[bytes]:
    """Both filters of one range of hashes; a bit per hash, set when it may occur twice."""
    read = []
    for data in requests:
        keys, rest = arrays.unpack_keys(data)
        read.append((keys, arrays.unpack_bits(rest, len(keys))))
    n = sum(len(keys) for keys, _ in read)
    once, twice = Bloom(n), Bloom(n)
    for keys, often in read:
        twice.add(keys[often | once.holds(keys)])
        once.add(keys)
    return [arrays.pack_bits(twice.holds(keys)) for keys, _ in read]


def _confirmed(requests: list[bytes], documents: int) -> list[bytes]:
    """For each suspected line text of a request, the doc_id that keeps it, or none."""
    total: dict[bytes, list[int]] = {}
    read = []
    for data in requests:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes = np.frombuffer(data, "<u4", n, 4)
        count, last = np.frombuffer(data, "<i8", 2 * n, 4 + 4 * n).reshape(2, n).tolist()
        at, own = 4 + 20 * n, []
        for i, size in enumerate(sizes.tolist()):
            key = data[at : at + size]
            at += size
            own.append(key)
            if (seen := total.get(key)) is None:
                total[key] = [count[i], last[i]]
            else:
                seen[0] += count[i]
                seen[1] = max(seen[1], last[i])
        read.append(own)
    return [
        np.array([total[k][1] if total[k][0] >= documents else _NO_DOC for k in own], "<i8").tobytes() for own in read
    ]


def drop_repeated_lines(
    docs: DataFrame, documents: int = 3, least: int = 20, block_bytes: int = blocks.BLOCK_BYTES
) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_lines, n_dropped, kept_text,
    kept_sha256.

    A line's key is the line without spaces at its ends and with A-Z lower-cased. Keys of at least
    ``least`` code points found in at least ``documents`` different doc_ids lose all their lines
    except in the largest of these doc_ids. A null or empty text is one empty line. Rows without
    doc_id count for no document and keep no common line; rows that share a doc_id count once
    and are treated alike. An empty table gives an empty result.
    """
    base, n = blocks.in_blocks(docs, block_bytes)

    def kept(table, got):
        x = _Lines(table, least)
        keeper: dict[bytes, int] = {}
        hashes, keys = x.suspects(n, got.get(1, {}))
        for s, a, b in arrays.shard_slices(hashes, n):
            for k, doc in zip(keys[a:b], np.frombuffer(got[2][s], "<i8").tolist(), strict=True):
                if doc != _NO_DOC:
                    keeper[k] = doc
        texts, n_lines, dropped, outs, digests = table.column("text"), [], [], [], []
        for d, doc in enumerate(x.ids):
            lines = texts[d].as_py().encode().split(b"\n")
            own = [y for y in lines if (to := keeper.get(line_key(y))) is None or to == doc]
            out = b"\n".join(own)
            n_lines.append(len(lines))
            dropped.append(len(lines) - len(own))
            outs.append(out.decode())
            digests.append(sha256(out).hexdigest())
        return pa.table(
            {
                "doc_id": pa.array(x.ids, pa.int64()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64()),
                "kept_text": pa.array(outs, pa.string()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    got = blocks.ask(base, lambda t, _: _Lines(t, least).hash_requests(n), _suspected, 1)
    got = blocks.ask(
        base,
        lambda t, g: _Lines(t, least).text_requests(n, g.get(1, {})),
        lambda r: _confirmed(r, documents),
        2,
        got,
    )
    return blocks.finish(
        base, got, kept, "doc_id long, n_lines long, n_dropped long, kept_text string, kept_sha256 string"
    )
