"""Suffix-array dedup of repeated byte strings by a distributed difference-cover algorithm.

A text is read as a string of chunks, cut wherever the eight bytes before a place hash to zero, so
equal stretches have equal chunks in every document. As in difference-cover suffix sorting, only
the suffixes at chunk numbers 1 and 2 modulo 3 are sampled:

1. the sampled triples of chunks of the whole corpus are sorted, range by range, and named by
   rank; triples that occur once get no name and are discarded;
2. the names of either residue form a shorter string, on which the same is done once more (a
   third level would span more than the match length);
3. the remaining suffixes are merged: for two equal stretches some residue is sampled in both, so
   a byte suffix whose prefix holds an unnamed triple for every residue is unique and falls out;
   all others are sorted by the 64-bit fingerprint of their prefix;
4. adjacent prefixes are compared; equal ones mark each byte they cover.

Copies of whole documents send their prefixes once, for all of them.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugelake.llm import arrays, blocks

_CONTEXT = 8
_CHUNK = 16  # mean bytes of a chunk
_STEP = 2 * 1024 * 1024
_DIGEST = 16
_U64 = np.uint64


class _Step:
    """Some texts of a block: their bytes, chunks and sampled triples."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        self.raw, self.off = raw, off
        v = raw.astype(_U64)
        for width in (1, 2, 4):
            if len(v) > width:
                v = v[:-width] | (v[width:] << _U64(8 * width))
            else:
                v = np.zeros(0, _U64)
        at = np.flatnonzero((arrays.mix(v) & _U64(_CHUNK - 1)) == 0) + _CONTEXT
        doc = np.searchsorted(off, at - _CONTEXT, "right") - 1
        inside = at <= off[doc + 1]
        self.at, self.doc = at[inside], doc[inside]
        n = len(self.at)
        first = np.searchsorted(self.doc, self.doc, "left")
        self.number = np.arange(n) - first
        chunks = arrays.slice_hashes(self._sums(), self.at[:-1], self.at[1:]) if n > 1 else np.zeros(0, _U64)
        whole = np.zeros(n, bool)
        if n > 3:
            whole[: n - 3] = self.doc[: n - 3] == self.doc[3:]
        self.sampled = np.flatnonzero(whole & (self.number % 3 > 0))
        i = self.sampled
        self.triples = arrays.mix(chunks[i] + arrays.mix(chunks[i + 1] + arrays.mix(chunks[i + 2])))

    def _sums(self) -> np.ndarray:
        """Prefix hashes of the bytes; eight times the text, so not kept."""
        return arrays.prefix_hashes(arrays.byte_codes(self.raw))

    def pairs_up(self, names: np.ndarray):
        """Sampled triples of the shorter strings of names: their first chunk and key.

        ``names`` belongs to the chunk numbers; 0 where there is none.
        """
        n = len(self.at)
        i = self.sampled
        i = i[(self.number[i] // 3) % 3 > 0]
        i = i[i + 9 < n]
        i = i[self.doc[i] == self.doc[i + 9]]
        i = i[(names[i] > 0) & (names[i + 3] > 0) & (names[i + 6] > 0)]
        return i, arrays.mix(names[i] + arrays.mix(names[i + 3] + arrays.mix(names[i + 6])))

    def possible(self, names: np.ndarray, second: np.ndarray, second_named: np.ndarray, width: int) -> np.ndarray:
        """Whether the prefix at each byte can repeat, by the names inside it."""
        n = max(0, len(self.raw) - width + 1)
        fits = np.zeros(n, bool)
        for a, b in zip(self.off[:-1].tolist(), self.off[1:].tolist(), strict=True):
            fits[a : max(a, b - width + 1)] = True
        out = np.zeros(n, bool)
        residue = self.number % 3
        for r in (1, 2):
            bad = self.sampled[(names[self.sampled] == 0) & (residue[self.sampled] == r)]
            dead = self._holds(bad, 3, width, n)
            for q in (1, 2):
                bad = second[~second_named & (residue[second] == r) & ((self.number[second] // 3) % 3 == q)]
                out |= ~(dead | self._holds(bad, 9, width, n))
        return out & fits

    def _holds(self, chunks: np.ndarray, span: int, width: int, n: int) -> np.ndarray:
        """The windows that hold one of the given runs of chunks, with the context before it."""
        low = np.maximum(self.at[chunks + span] - width, 0)
        high = np.minimum(self.at[chunks] - _CONTEXT + 1, n)
        some = low < high
        change = np.zeros(n + 1, np.int32)
        np.add.at(change, low[some], 1)
        np.add.at(change, high[some], -1)
        return np.cumsum(change[:-1]) > 0

    def prefixes(self, starts: np.ndarray, width: int) -> np.ndarray:
        return arrays.slice_hashes(self._sums(), starts, starts + width) if len(starts) else np.zeros(0, _U64)


class _Block:
    def __init__(self, docs: pa.Table, width: int, shards: int):
        self.width, self.shards = width, shards
        self.raw, self.off = arrays.text_buffer(docs.column("text"))
        self.steps = [
            (a, b, _Step(self.raw[self.off[a] : self.off[b]], self.off[a : b + 1] - self.off[a]))
            for a, b in arrays.steps(self.off, _STEP)
        ]
        self.digests = [
            blake2b(self.raw[a:b], digest_size=_DIGEST).digest() if b - a >= width else None
            for a, b in zip(self.off[:-1].tolist(), self.off[1:].tolist(), strict=True)
        ]

    # round 1: triples and whole texts

    def _copies(self):
        found: dict[bytes, int] = {}
        for x in self.digests:
            if x:
                found[x] = found.get(x, 0) + 1
        ordered = sorted(found)
        heads = np.array([int.from_bytes(x[:8], "big") for x in ordered], _U64)
        return ordered, heads, np.array([found[x] > 1 for x in ordered], bool)

    def triple_requests(self):
        keys = np.concatenate([np.zeros(0, _U64), *(s.triples for _, _, s in self.steps)])
        _, _, rows = blocks.count_requests(keys, self.shards)
        named = dict(rows)
        ordered, heads, often = self._copies()
        copies = {
            s: b"".join(ordered[a:b]) + arrays.pack_bits(often[a:b]) for s, a, b in arrays.shard_slices(heads, self.shards)
        }
        counts = {s: b - a for s, a, b in arrays.shard_slices(heads, self.shards)}
        for s in named.keys() | copies.keys():
            n = counts.get(s, 0)
            yield s, np.uint32(n).tobytes() + copies.get(s, b"") + (named.get(s) or arrays.pack_keys(np.zeros(0, _U64)))

    def learn_names(self, parts: dict[int, bytes]) -> None:
        """Names of the distinct triples, and the copied texts with whether this block stands for them."""
        keys = np.concatenate([np.zeros(0, _U64), *(s.triples for _, _, s in self.steps)])
        distinct = arrays.distinct(keys)
        names = np.zeros(len(distinct), _U64)
        ordered, heads, _ = self._copies()
        at = {s: (a, b) for s, a, b in arrays.shard_slices(heads, self.shards)}
        cuts = {s: (a, b) for s, a, b in arrays.shard_slices(distinct, self.shards)}
        self.copied: dict[bytes, bool] = {}
        for s, data in parts.items():
            a, b = at.get(s, (0, 0))
            size = -(-(b - a) // 8)
            many, mine = (arrays.unpack_bits(data[i * size : (i + 1) * size], b - a) for i in (0, 1))
            self.copied |= {ordered[a + i]: bool(mine[i]) for i in np.flatnonzero(many)}
            a, b = cuts.get(s, (0, 0))
            rest = memoryview(data)[2 * size :]
            named = arrays.unpack_bits(rest, b - a)
            ranks = np.frombuffer(rest[-(-(b - a) // 8) :], "<u4")
            names[a:b][named] = (_U64(s) << _U64(32)) | ranks.astype(_U64)
        self.distinct, self.names = distinct, names

    def _named(self, step: _Step) -> np.ndarray:
        out = np.zeros(len(step.at), _U64)
        if len(step.sampled):
            out[step.sampled] = self.names[np.searchsorted(self.distinct, step.triples)]
        return out

    # round 2: triples of names

    def _second(self):
        return np.concatenate([np.zeros(0, _U64), *(s.pairs_up(self._named(s))[1] for _, _, s in self.steps)])

    def name_requests(self):
        return blocks.count_requests(self._second(), self.shards)[2]

    def learn_second(self, parts: dict[int, bytes]) -> None:
        self.second = arrays.distinct(self._second())
        self.second_named = blocks.answered_bits(self.second, self.shards, parts)

    # round 3: the remaining suffixes

    def suffixes(self):
        """Per step: texts a to b, the step, the possible starts with their prefixes' fingerprints, and the
        fingerprints of copied texts that this block sends for all copies."""
        sent: set[bytes] = set()
        for a, b, step in self.steps:
            names = self._named(step)
            second, keys = step.pairs_up(names)
            named = self.second_named[np.searchsorted(self.second, keys)] if len(keys) else np.zeros(0, bool)
            may = step.possible(names, second, named, self.width)
            own = [np.zeros(0, np.int64)]
            for d in range(a, b):
                x = self.digests[d]
                if x in self.copied:
                    lo, hi = int(step.off[d - a]), int(step.off[d - a + 1]) - self.width + 1
                    may[lo:hi] = False
                    if self.copied[x] and x not in sent:
                        sent.add(x)
                        own.append(np.arange(lo, hi))
            starts = np.flatnonzero(may)
            keys = step.prefixes(np.concatenate([starts, *own]), self.width)
            yield a, b, step, starts, keys[: len(starts)], keys[len(starts) :]

    @staticmethod
    def _sent(suffixes):
        """All fingerprints the block sends; those of a copied text twice, as they stand for two copies at least."""
        return np.concatenate([np.zeros(0, _U64), *(k for *_, keys, own in suffixes for k in (keys, own, own))])

    def prefix_requests(self):
        return blocks.count_requests(self._sent(self.suffixes()), self.shards)[2]

    def removed(self, parts: dict[int, bytes]):
        """Flags of the removed bytes of each text, in order."""
        suffixes = list(self.suffixes())
        distinct = arrays.distinct(self._sent(suffixes))
        again = blocks.answered_bits(distinct, self.shards, parts)
        for a, b, step, starts, keys, _ in suffixes:
            hit = starts[again[np.searchsorted(distinct, keys)]] if len(starts) else starts
            gone = arrays.covered(hit, self.width, len(step.raw))
            for d in range(a, b):
                lo, hi = int(step.off[d - a]), int(step.off[d - a + 1])
                flags = gone[lo:hi]
                yield np.ones(hi - lo, bool) if self.digests[d] in self.copied else flags


def _name(requests: list[bytes]) -> list[bytes]:
    """Sorts the triples of one range and names those that repeat by rank; finds copied texts."""
    keys, often, copies = [], [], []
    for data in requests:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        size = 4 + n * _DIGEST
        ids = [data[4 + i * _DIGEST : 4 + (i + 1) * _DIGEST] for i in range(n)]
        twice = arrays.unpack_bits(data[size : size + -(-n // 8)], n)
        copies.append((ids, twice.tolist()))
        k, rest = arrays.unpack_keys(data[size + -(-n // 8) :])
        keys.append(k)
        often.append(arrays.unpack_bits(rest, len(k)))
    distinct, places, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    np.add.at(counts, places[np.concatenate(often)], 1)
    ranks = np.where(counts > 1, np.cumsum(counts > 1), 0).astype("<u4")[places]
    total: dict[bytes, int] = {}
    owner: dict[bytes, int] = {}
    for i, (ids, twice) in enumerate(copies):
        for x, t in zip(ids, twice, strict=True):
            total[x] = total.get(x, 0) + 1 + t
            owner.setdefault(x, i)
    out, end = [], 0
    for i, (k, (ids, _)) in enumerate(zip(keys, copies, strict=True)):
        own = ranks[end : end + len(k)]
        end += len(k)
        many = np.array([total[x] > 1 for x in ids], bool)
        mine = np.array([owner[x] == i for x in ids], bool)
        out.append(arrays.pack_bits(many) + arrays.pack_bits(mine) + arrays.pack_bits(own > 0) + own[own > 0].tobytes())
    return out


def remove_repeats(docs: DataFrame, width: int = 400, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_bytes, n_removed, n_spans,
    kept (binary), kept_sha256.

    Removed is each UTF-8 byte covered by a string of ``width`` bytes that also starts anywhere
    else; n_spans counts maximal removed runs. A null text is empty; rows are documents, so a
    repeated row of ``width`` bytes or more loses all; texts shorter than ``width`` stay; an empty
    table gives an empty result. A single text has to fit in a task's memory some thirty times.
    """
    base, n = blocks.in_blocks(docs, block_bytes)

    def known(table, got, rounds):
        b = _Block(table, width, n)
        if rounds > 0:
            b.learn_names(got.get(1, {}))
        if rounds > 1:
            b.learn_second(got.get(2, {}))
        return b

    def kept(table, got):
        b = known(table, got, 2)
        removed, spans, outs, digests = [], [], [], []
        for d, flags in enumerate(b.removed(got.get(3, {}))):
            removed.append(int(flags.sum()))
            spans.append(len(arrays.run_bounds(flags)[0]))
            out = b.raw[b.off[d] : b.off[d + 1]][~flags].tobytes()
            outs.append(out)
            digests.append(sha256(out).hexdigest())
        return pa.table(
            {
                "doc_id": table.column("doc_id").cast(pa.int64()),
                "n_bytes": pa.array(np.diff(b.off), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept": pa.array(outs, pa.binary()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    got = blocks.ask(base, lambda t, _: known(t, {}, 0).triple_requests(), _name, 1)
    got = blocks.ask(base, lambda t, g: known(t, g, 1).name_requests(), blocks.repeated, 2, got)
    got = blocks.ask(base, lambda t, g: known(t, g, 2).prefix_requests(), blocks.repeated, 3, got)
    return blocks.finish(
        base, got, kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
