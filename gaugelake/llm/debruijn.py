"""Substring dedup by compacting the de Bruijn graph of repeated token k-mers.

Every window of k words is an edge between its first and its last k-1 words. Round 1 counts the
edges of the whole corpus; edges seen once leave the graph. Round 2 joins the nodes of the
repeated edges: a node is inner when every place it stands at has the same edge before and the
same edge behind, else paths are cut there (branches, and places where a copy begins or ends).
Between cuts the edges of a document compact to one path, and every copy of one of its edges
runs through the whole path. Round 3 joins the paths of all documents: a path counts as a
repeat only when the words at two or more source coordinates have the same 128-bit digest, so
hash collisions of edges cannot remove anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugelake.llm import arrays, blocks

_DIGEST = 16


class _Graph:
    """The edges and nodes of one block, and what the rounds said of them."""

    def __init__(self, docs: pa.Table, k: int, shards: int):
        self.docs, self.k, self.shards = docs, k, shards
        self.hashes, self.bounds = arrays.word_hashes(docs.column("text"))
        n = len(self.hashes)
        doc = np.repeat(np.arange(docs.num_rows), np.diff(self.bounds))
        width = max(0, n - k + 1)
        self.whole = doc[:width] == doc[k - 1 :] if width else np.zeros(0, bool)
        self.doc = doc
        self.edges = arrays.window_hashes(self.hashes, k)

    def edge_requests(self) -> list[tuple[int, bytes]]:
        return self._edges()[2]

    def _edges(self):
        return blocks.count_requests(self.edges[self.whole], self.shards)

    def learn_edges(self, parts: dict[int, bytes]) -> None:
        distinct, places, _ = self._edges()
        self.kept = np.zeros(len(self.edges), bool)
        if len(places):
            self.kept[self.whole] = blocks.answered_bits(distinct, self.shards, parts)[places]

    def _nodes(self):
        """Distinct nodes beside a repeated edge, each with the labels of the edges before and behind it.

        A label is 0 where copies differ or one has no repeated edge.
        """
        n = len(self.edges) + 1
        label = (self.edges & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)
        before, behind = np.zeros(n, np.uint16), np.zeros(n, np.uint16)
        before[1:][self.kept] = label[self.kept]
        behind[:-1][self.kept] = label[self.kept]
        at = np.flatnonzero((before > 0) | (behind > 0))
        nodes = arrays.window_hashes(self.hashes, self.k - 1)[at] if len(at) else np.zeros(0, np.uint64)
        distinct, places = np.unique(nodes, return_inverse=True)
        return at, distinct, places, *_one_label(places, len(distinct), before[at], behind[at])

    def node_requests(self) -> Iterator[tuple[int, bytes]]:
        _, distinct, _, before, behind = self._nodes()
        for s, a, b in arrays.shard_slices(distinct, self.shards):
            yield s, arrays.pack_keys(distinct[a:b]) + before[a:b].tobytes() + behind[a:b].tobytes()

    def learn_cuts(self, parts: dict[int, bytes]) -> None:
        at, distinct, places, _, _ = self._nodes()
        self.cut = np.zeros(len(self.edges) + 1, bool)
        if len(at):
            self.cut[at] = blocks.answered_bits(distinct, self.shards, parts)[places]

    def paths(self) -> Iterator[tuple[int, int, int, bytes]]:
        """(document, first word, word after the last, digest) of each compacted path."""
        begin = self.kept.copy()
        begin[1:] &= ~self.kept[:-1] | self.cut[1:-1]
        starts = np.flatnonzero(begin)
        stop = self.kept.copy()
        stop[:-1] &= ~self.kept[1:] | self.cut[1:-1]
        ends = np.flatnonzero(stop)
        texts, words, last = self.docs.column("text"), [], -1
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            d = int(self.doc[a])
            if d != last:
                words, last = texts[d].as_py().encode().split(), d
            lo, hi = a - int(self.bounds[d]), b - int(self.bounds[d]) + self.k
            yield d, lo, hi, blake2b(b" ".join(words[lo:hi]), digest_size=_DIGEST).digest()

    def path_requests(self) -> list[tuple[int, bytes]]:
        found = [x[3] for x in self.paths()]
        return _path_keys(found, self.shards)[2]


def _one_label(places, n, before, behind):
    out = []
    for labels in (before, behind):
        low, high = np.full(n, 0xFFFF, np.uint16), np.zeros(n, np.uint16)
        np.minimum.at(low, places, labels)
        np.maximum.at(high, places, labels)
        out.append(np.where(low == high, low, 0).astype(np.uint16))
    return out


def _path_keys(digests: list[bytes], shards: int):
    """Distinct digests in order, the place of each, and the requests that count them."""
    every = np.array(digests, f"V{_DIGEST}")
    first = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    order = np.lexsort((first[:, 1], first[:, 0])) if len(digests) else np.zeros(0, np.int64)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = (first[order][1:] != first[order][:-1]).any(axis=1)
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(new) - 1
    counts = np.bincount(places) if len(places) else np.zeros(0, np.int64)
    keys = first[order][new][:, 0] if len(order) else np.zeros(0, np.uint64)
    distinct = every[order][new]
    rows = [
        (s, np.uint32(b - a).tobytes() + distinct[a:b].tobytes() + arrays.pack_bits(counts[a:b] > 1))
        for s, a, b in arrays.shard_slices(keys, shards)
    ]
    return keys, places, rows


def _inner(requests: list[bytes]) -> list[bytes]:
    """For each request, a bit per node: whether paths are cut there."""
    keys, before, behind = [], [], []
    for data in requests:
        k, rest = arrays.unpack_keys(data)
        labels = np.frombuffer(rest, np.uint16).reshape(2, -1)
        keys.append(k)
        before.append(labels[0])
        behind.append(labels[1])
    _, places = np.unique(np.concatenate(keys), return_inverse=True)
    n = int(places.max()) + 1 if len(places) else 0
    one = _one_label(places, n, np.concatenate(before), np.concatenate(behind))
    cut = ((one[0] == 0) | (one[1] == 0))[places]
    ends = np.cumsum([len(k) for k in keys])
    return [arrays.pack_bits(cut[e - len(k) : e]) for k, e in zip(keys, ends, strict=True)]


def _confirmed(requests: list[bytes]) -> list[bytes]:
    """For each request, a bit per path: whether two or more source coordinates hold the same words."""
    total: dict[bytes, int] = {}
    read = []
    for data in requests:
        n = int(np.frombuffer(data, np.uint32, 1)[0])
        digests = [data[4 + _DIGEST * i : 4 + _DIGEST * (i + 1)] for i in range(n)]
        often = arrays.unpack_bits(data[4 + _DIGEST * n :], n)
        read.append(digests)
        for d, twice in zip(digests, often.tolist(), strict=True):
            total[d] = total.get(d, 0) + 1 + twice
    return [arrays.pack_bits(np.array([total[d] > 1 for d in digests], bool)) for digests in read]


def remove_repeats(docs: DataFrame, k: int = 35, block_bytes: int = blocks.BLOCK_BYTES, spans: bool = False) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_words, n_removed, kept_text,
    kept_sha256.

    Removed are the words covered by a window of ``k`` words that also starts anywhere else. A null
    or empty text has no words; rows are documents, so repeated rows remove each other's windows;
    an empty table gives an empty result. With ``spans``: doc_id, first_word, end_word, path (hex
    digest) of every compacted repeated path instead.
    """
    base, n = blocks.in_blocks(docs, block_bytes)

    def edges(docs_, _):
        return _Graph(docs_, k, n).edge_requests()

    def nodes(docs_, got):
        g = _Graph(docs_, k, n)
        g.learn_edges(got.get(1, {}))
        return g.node_requests()

    def known(docs_, got):
        g = _Graph(docs_, k, n)
        g.learn_edges(got.get(1, {}))
        g.learn_cuts(got.get(2, {}))
        return g

    def paths(docs_, got):
        return known(docs_, got).path_requests()

    def confirmed(docs_, got):
        g = known(docs_, got)
        found = list(g.paths())
        keys, places, _ = _path_keys([x[3] for x in found], n)
        good = blocks.answered_bits(keys, n, got.get(3, {}))[places] if len(found) else []
        return g, [x for x, ok in zip(found, good, strict=True) if ok]

    def span_rows(docs_, got):
        _, found = confirmed(docs_, got)
        ids = docs_.column("doc_id").to_pylist()
        return pa.table(
            {
                "doc_id": pa.array([ids[d] for d, _, _, _ in found], pa.int64()),
                "first_word": pa.array([a for _, a, _, _ in found], pa.int64()),
                "end_word": pa.array([b for _, _, b, _ in found], pa.int64()),
                "path": pa.array([x.hex() for *_, x in found], pa.string()),
            }
        )

    def kept(docs_, got):
        g, found = confirmed(docs_, got)
        gone: dict[int, list[tuple[int, int]]] = {}
        for d, a, b, _ in found:
            gone.setdefault(d, []).append((a, b))
        texts = docs_.column("text")
        removed, outs, digests = [], [], []
        for d in range(docs_.num_rows):
            words, keep = texts[d].as_py().encode().split(), []
            at = 0
            for a, b in gone.get(d, ()):
                keep += words[at:a]
                at = max(at, b)
            keep += words[at:]
            removed.append(len(words) - len(keep))
            out = b" ".join(keep)
            outs.append(out.decode())
            digests.append(sha256(out).hexdigest())
        return pa.table(
            {
                "doc_id": docs_.column("doc_id").cast(pa.int64()),
                "n_words": pa.array(np.diff(g.bounds), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(outs, pa.string()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    got = blocks.ask(base, edges, blocks.repeated, 1)
    got = blocks.ask(base, nodes, _inner, 2, got)
    got = blocks.ask(base, paths, _confirmed, 3, got)
    if spans:
        return blocks.finish(base, got, span_rows, "doc_id long, first_word long, end_word long, path string")
    return blocks.finish(
        base, got, kept, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    )
