"""Exact n-gram Jaccard join with parity sketches.

Each distinct shingle set becomes one node. A shingle XORs its hash into one word of the node's
sketch and flips one bit of a narrow bit sketch, so neither the number of unequal words nor the
Hamming distance of the bits ever exceeds the size of two sets' symmetric difference. Two sets
of T elements together with a Jaccard similarity of p percent differ in at most
T * (100 - p) / (100 + p) elements. Sets are sketched per size band, with one word more than the
largest difference in the band; by the pigeonhole principle a linked pair then has an equal word.
Words found in one sketch only are dropped in a counting round; the others join the sketches.
Candidates are verified on the exact sets.

Words without a shingle are equal in sets that have nothing in common, so such a word is no
evidence by itself. It stands for a sketch of its own, salted by its place: a linked pair that
has the word empty in both sets also has an equal word there. After two such steps the word
stands for the set's prefix in the order of the hashes, of which a linked pair shares a shingle.
This is exact, and unrelated short sets meet about as rarely as long ones. Sketches of more than
32 words leave empty words out: a linked pair without another equal word would need every single
difference in a word of its own, and its hashes to leave the remaining word empty, which 32
random choices do with a probability below 1e-13, no more than what equal 64-bit hashes risk anyway.

Pairs are not spread within a group: each word's sketches are first compared with one hub, by the
Hamming distance of the bits, and near ones verified. The sketches of all words with one hub make a
group, in which those outside the hub's component are compared with all others, pair by pair, in
tiles of bounded size, and near ones of different components verified in turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import arrays, blocks
from gaugelake.llm.components import component_roots
from gaugelake.llm.shared import Scratch, small_batches

_U64 = np.uint64
_TILE = 2000
_PAIRS = 250_000  # pairs of rows a task holds at a time
_EVERY = 1 << 40
_NEAREST = 4  # pairs of a row in a tile that are verified first
_MORE = 64  # times as many the next time
_ALL_WORDS = 32
_EMPTY_STEPS = 2
_PIECE = 512 * 1024  # bytes of text hashed at a time
_BLOCK_SHINGLES = 500_000
#: Ids of this many documents (8 MB) may be broadcast; more are joined by a shuffle.
_BROADCAST_IDS = 1_000_000

_SKETCHED = "doc_id long, n_shingles long, node long, words array<long>, bits binary"


def bands_of(size: int, percent: int) -> Iterator[tuple[int, int]]:
    """The size bands a set takes part in, each with its largest set size.

    Bands grow by one third. A pair is found in the band of its larger set, so a set also enters
    the bands above that it can reach with the given similarity.
    """
    low, band = 1, 0
    while low * percent <= size * 100:
        above = max(low + 1, low * 4 // 3)
        if size < above:
            yield band, above - 1
        low, band = above, band + 1


def most_apart(together: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair whose sizes sum to ``together``."""
    return together * (100 - percent) // (100 + percent)


def words_of(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the sketch's words in each of its bands.

    Of a band's words the first few are enough: one more than any partner of this set can differ in.
    """
    out = [np.zeros(0, _U64)]
    own = len(shingles) * (100 - percent) // percent + 1
    prefix = shingles[: len(shingles) * (100 - percent) // 100 + 1]
    for band, largest in bands_of(len(shingles), percent):
        n = most_apart(2 * largest, percent) + 1
        out += _word_keys(shingles, n, own, arrays.mix(np.array([band + 1], _U64)), prefix, _EMPTY_STEPS)
    return np.concatenate(out)


def _word_keys(
    shingles: np.ndarray, n: int, own: int, salt: np.ndarray, prefix: np.ndarray, steps: int
) -> list[np.ndarray]:
    """Keys of the first ``own`` of ``n`` words; of empty ones the keys of the sketches they stand for."""
    hashes = arrays.mix(shingles + salt)
    at = (hashes % _U64(n)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    places, starts = np.unique(at[order], return_index=True)
    words = np.zeros(n, _U64)
    words[places] = np.bitwise_xor.reduceat(arrays.mix(hashes)[order], starts)
    keys = arrays.mix(words + arrays.mix(np.arange(n, dtype=_U64) + (salt << _U64(1))))[:own]
    used = np.zeros(n, bool)
    used[places] = True
    used = used[:own]
    out = [keys[used]]
    if n <= _ALL_WORDS:
        for place in np.flatnonzero(~used).tolist():
            again = keys[place : place + 1]
            out += _word_keys(shingles, n, own, again, prefix, steps - 1) if steps else [arrays.mix(prefix + again)]
    return out


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """The parity bits as 64-bit words: the next power of two above two bits a shingle."""
    n = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((arrays.mix(shingles) % _U64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of bit sketches, row by row; longer ones are folded, which keeps them parity sketches."""
    size = min(a.shape[1], b.shape[1])
    a, b = (np.bitwise_xor.reduce(x.reshape(len(x), -1, size), axis=1) for x in (a, b))
    return np.bitwise_count(a ^ b).sum(axis=1)


def shingle_sets(texts: pa.ChunkedArray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words is one shingle, without words none."""
    hashes, bounds = arrays.word_hashes(texts, lower=True)
    windows = arrays.window_hashes(hashes, words)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(windows[a : b - words + 1])
        elif b > a:
            yield arrays.window_hashes(hashes[a:b], b - a)
        else:
            yield np.zeros(0, _U64)


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch_rows(words: int, percent: int):
    def rows(batches):
        sent: set[int] = set()  # copies within a task are sketched once
        for batch in arrays.pieces(batches, _PIECE):
            nodes, sizes, keys, bits = [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                node = _node(s)
                fresh = len(s) > 0 and node not in sent
                sent.add(node)
                nodes.append(node)
                sizes.append(len(s))
                keys.append(words_of(s, percent).view(np.int64) if fresh else None)
                bits.append(bit_sketch(s).tobytes() if fresh else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "node", "words", "bits"],
            )

    return rows


class _Words:
    """The words of one block of nodes, copies from several tasks taken once."""

    def __init__(self, table: pa.Table):
        nodes = np.asarray(table.column("node").combine_chunks())
        _, first = np.unique(nodes, return_index=True)
        table = table.take(pa.array(first))
        self.nodes = np.asarray(table.column("node").combine_chunks())
        self.sizes = np.asarray(table.column("n_shingles").combine_chunks())
        lists = table.column("words").combine_chunks()
        self.keys = np.asarray(lists.flatten()).view(_U64)
        self.owners = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))


def _set_rows(words: int):
    def rows(batches):
        for batch in arrays.pieces(batches, _PIECE):
            sets = list(shingle_sets(batch.column("text"), words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["node", "shingles"],
            )

    return rows


def _linked(percent: int):
    def rows(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of nodes (a, b) whose sets are similar enough, by the sets themselves."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = members.join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = one.select("doc_id").distinct()
    if ids.count() <= _BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = (
        docs.join(ids.withColumnRenamed("doc_id", "wanted_id"), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
        .select("text")
        .mapInArrow(_set_rows(words), "node long, shingles binary")
        .join(wanted, "node", "left_semi")
        .dropDuplicates(["node"])
    )
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
        .mapInArrow(_linked(percent), "a long, b long")
    )


def _close(
    bits: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of rows have bit sketches no further apart than a linked pair's can be, and how far all are."""
    words = np.array([len(x) // 8 for x in bits])
    place, matrix = np.zeros(len(bits), np.int64), {}
    for w in np.unique(words).tolist():
        own = np.flatnonzero(words == w)
        matrix[w] = np.frombuffer(b"".join(bits[i] for i in own), "<u8").reshape(-1, w)
        place[own] = np.arange(len(own))
    far = np.zeros(len(left), np.int64)
    limit = (sizes[left] + sizes[right]) * (100 - percent) // (100 + percent)
    kinds = words[left] * (1 << 32) + words[right]
    for kind in np.unique(kinds).tolist():
        v, w = kind >> 32, kind & 0xFFFFFFFF
        at = np.flatnonzero(kinds == kind)
        for part in np.array_split(at, -(-len(at) * max(v, w) // 1_000_000)):
            far[part] = distances(matrix[v][place[left[part]]], matrix[w][place[right[part]]])
    return far <= limit, far


def _near_rows(percent: int):
    def rows(batches):
        for batch in batches:
            size = np.concatenate([np.asarray(batch.column(c)) for c in ("size_a", "size_b")])
            left = np.arange(batch.num_rows)
            bits = batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist()
            keep, _ = _close(bits, size, left, left + batch.num_rows, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return rows


def _near(stars: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a hub and a node that are close enough by size and sketch."""
    a, b = (
        sketches.select(F.col("node").alias(x), F.col("n_shingles").alias(f"size_{x}"), F.col("bits").alias(f"bits_{x}"))
        for x in ("a", "b")
    )
    sized = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    return (
        stars.select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .join(a, "a")
        .join(b, "b")
        .filter(sized)
        .mapInArrow(_near_rows(percent), "a long, b long")
    )


def _nearest(pairs: np.ndarray, each: int) -> tuple[np.ndarray, list[int]]:
    """Of pairs (node, node, distance, word) each once, the ``each`` closest of every first node; the words of the others."""
    low, high, far, _ = pairs
    pairs = pairs[:, np.lexsort((high, far, low))]
    one = np.ones(pairs.shape[1], bool)
    one[1:] = (pairs[:2, 1:] != pairs[:2, :-1]).any(axis=0)
    pairs = pairs[:, one]
    near = np.arange(pairs.shape[1]) - np.searchsorted(pairs[0], pairs[0]) < each
    return pairs[:, near], np.unique(pairs[3, ~near]).tolist()


def _tile_pairs(percent: int, across: bool, each: int):
    """Pairs within tiles: of different components if ``across``, close enough by size and sketch.

    Rows come sorted by tile; the last tile of a batch waits for the next batch. A tile on the
    diagonal pairs all its rows, another one those of its two sides. Tiles are paired some at a
    time, as many as have a bounded number of pairs. A row's ``each`` closest pairs are given; a pair
    of nulls tells that there are others, and rows without a name in b the words of their tiles.
    """

    def parts(rows: pa.Table, starts: np.ndarray):
        ends = np.append(starts[1:], rows.num_rows)
        upto = np.cumsum((ends - starts) * (ends - starts - 1) // 2)
        cuts = np.flatnonzero(np.diff(upto // _PAIRS, prepend=0))
        bounds = np.unique([0, *cuts, len(starts)]).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield found(rows.slice(int(starts[a]), int(ends[b - 1] - starts[a])), starts[a:b] - starts[a])

    def found(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        word, first, second, side, node, size, label = (
            np.asarray(rows.column(c).combine_chunks())
            for c in ("word", "first", "second", "side", "node", "n_shingles", "label")
        )
        ends = np.repeat(np.append(starts[1:], len(node)), np.diff(np.append(starts, len(node))))
        bits, steps = rows.column("bits").to_pylist(), int((ends - np.arange(len(node))).max(initial=0))
        lefts, rights, held, near, left_out = [], [], 0, np.zeros((4, 0), np.int64), set()
        for step in range(1, steps):
            i = np.flatnonzero(np.arange(len(node)) + step < ends)
            j = i + step
            fit = (first[i] == second[i]) | (side[i] != side[j])
            fit &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            fit &= (node[i] != node[j]) & ((label[i] != label[j]) | (not across))
            lefts.append(i[fit])
            rights.append(j[fit])
            held += len(lefts[-1])
            if held and (held > _PAIRS or step == steps - 1):
                i, j = np.concatenate(lefts), np.concatenate(rights)
                close, far = _close(bits, size, i, j, percent)
                i, j = i[close], j[close]
                pairs = np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), far[close], word[i]])
                near, others = _nearest(np.concatenate([near, pairs], axis=1), each)
                left_out.update(others)
                lefts, rights, held = [], [], 0
        others = [None, *sorted(left_out)] if left_out else []
        a = pa.array([*near[0].tolist(), *[None] * len(others)], pa.int64())
        b = pa.array([*near[1].tolist(), *others], pa.int64())
        return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def pairs(batches):
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            tile = [np.asarray(rows.column(c).combine_chunks()) for c in ("word", "first", "second")]
            new = np.ones(rows.num_rows, bool)
            new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in tile])
            starts = np.flatnonzero(new)
            if not len(starts):
                continue
            kept = rows.slice(int(starts[-1]))
            if len(starts) > 1:
                yield from parts(rows.slice(0, int(starts[-1])), starts[:-1])
        if kept is not None and kept.num_rows:
            yield from parts(kept, np.zeros(1, np.int64))

    return pairs


def _tiled(groups: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int, across: bool, each: int) -> DataFrame:
    """Pairs within each hub's sketches, compared in tiles of bounded size: of each row the closest; rows without a
    name in b the hubs that have others, and are nulls if there are any.

    If ``across``, sketches in the hub's component meet those outside it alone. Sides of those outside are
    numbered first. For the tiles the hub is the word that their sketches share.
    """
    labels = roots.select("node", F.col("root").alias("label"))
    members = (
        groups.join(labels, "node", "left")
        .join(labels.select(F.col("node").alias("hub"), F.col("label").alias("main")), "hub", "left")
        .select("hub", "node", F.coalesce("label", "node").alias("label"), F.coalesce("main", "hub").alias("main"))
        .select("hub", "node", "label", ((F.col("label") == F.col("main")) & F.lit(across)).alias("inside"))
    )
    sides = (
        members.groupBy("hub")
        .agg(F.count_if(~F.col("inside")).alias("out"), F.count_if("inside").alias("in"))
        .filter("out > 0")
        .select("hub", *[F.ceil(F.col(c) / _TILE).cast("int").alias(c) for c in ("out", "in")])
    )
    own = F.xxhash64("node")
    side = F.when(F.col("inside"), F.col("out") + F.pmod(own, F.col("in"))).otherwise(F.pmod(own, F.col("out")))
    others = F.when(F.col("inside"), F.col("out")).otherwise(F.col("out") + F.col("in"))
    tile = ["word", "first", "second"]
    spread = (
        members.join(sides, "hub")
        .select("hub", "node", "label", side.cast("int").alias("side"), others.alias("others"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        .select(
            F.col("hub").alias("word"),
            F.least("side", "other").alias("first"),
            F.greatest("side", "other").alias("second"),
            "side",
            "node",
            "label",
        )
        .join(sketches, "node")
    )
    return (
        spread.repartition(*tile)
        .sortWithinPartitions(*tile)
        .mapInArrow(_tile_pairs(percent, across, each), "a long, b long")
        .distinct()
    )


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, every_link: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The groups of documents linked by ``percent`` Jaccard similarity of their ``words``-word shingles.

    Returns (documents, links). Documents: doc_id, n_shingles, component_id, node, one row per row
    of ``docs`` (columns doc_id and text; others are ignored). Links: pairs of nodes a < b, a node
    standing for all documents with one shingle set; they connect every component, and with
    ``every_link`` they are all links between different sets.

    Words are runs outside [\\x20\\x09-\\x0D], A-Z lower-cased. A text with fewer words is one
    shingle; null, empty and wordless texts have an empty set and are linked with nothing.
    component_id is the smallest doc_id of the component, null where no document in it has one.
    Repeated rows are copies of each other. An empty table gives empty results.
    """
    scratch = Scratch(small_batches(docs.sparkSession), "parity")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sketched = scratch.save(docs.mapInArrow(_sketch_rows(words, percent), _SKETCHED))
    members = sketched.filter("n_shingles > 0").select("doc_id", "node")
    first = sketched.filter("words is not null")
    size = first.agg(F.sum("n_shingles")).first()[0] or 0
    n = max(1, -(-size // _BLOCK_SHINGLES))
    block = F.pmod(F.xxhash64("node"), F.lit(n)).cast("int").alias("block")
    base = first.select(block, "node", "n_shingles", "words").repartition(n, "block")

    def repeated_words(table, got):
        w = _Words(table)
        keys, places, _ = blocks.count_requests(w.keys, n)
        hit = blocks.answered_bits(keys, n, got.get(1, {}))[places] if len(places) else np.zeros(0, bool)
        own = w.owners[hit]
        return pa.table(
            {
                "word": pa.array(w.keys[hit].view(np.int64), pa.int64()),
                "node": pa.array(w.nodes[own], pa.int64()),
                "n_shingles": pa.array(w.sizes[own], pa.int64()),
            }
        )

    got = blocks.ask(base, lambda t, _: blocks.count_requests(_Words(t).keys, n)[2], blocks.repeated, 1)
    shared = scratch.save(blocks.finish(base, got, repeated_words, "word long, node long, n_shingles long"))

    # Words of one hub make one group: near copies share many words, and meet once.
    hubs = shared.groupBy("word").agg(F.min("node").alias("hub"))
    groups = scratch.save(shared.join(hubs, "word").select("hub", "node").distinct())
    sketches = first.select("node", "n_shingles", "bits").dropDuplicates(["node"])
    stars = scratch.save(_near(groups.filter("node <> hub"), sketches, percent))
    links = scratch.save(_verified(stars, docs, members, words, percent))
    roots = component_roots(links, scratch)

    # The closest pairs first: what they link needs no other pair. Groups with pairs left out are looked at again,
    # more of a row each time, until there is none.
    seen, each = stars, _EVERY if every_link else _NEAREST
    while True:
        tiled = _tiled(groups, roots, sketches, percent, not every_link, each)
        rest = scratch.save(tiled.join(seen, ["a", "b"], "left_anti"))
        pairs = rest.filter("a is not null")
        more = scratch.save(_verified(pairs, docs, members, words, percent))
        links = links.unionByName(more)
        roots = component_roots(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), scratch)
        if rest.filter("b is null").isEmpty():
            break
        left_out = rest.filter("a is null and b is not null").select(F.col("b").alias("hub"))
        groups, seen, each = groups.join(left_out, "hub", "left_semi"), seen.unionByName(pairs), _MORE * each

    nodes = sketched.select("doc_id", "n_shingles", "node").join(roots, "node", "left")
    nodes = nodes.withColumn("part", F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")))
    smallest = nodes.filter("part is not null").groupBy("part").agg(F.min("doc_id").alias("smallest"))
    out = nodes.join(smallest, "part", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        "node",
    )
    return out, links


def _node_rows(words: int):
    def rows(batches):
        for batch in arrays.pieces(batches, _PIECE):
            nodes = [(i, _node(s)) for i, s in enumerate(shingle_sets(batch.column("text"), words)) if len(s)]
            at, of = pa.array([i for i, _ in nodes], pa.int64()), pa.array([n for _, n in nodes], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("text_hash").take(at), of], names=["text_hash", "node"])

    return rows


def _one_without_id(docs: DataFrame, out: DataFrame, links: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """Of rows that all lack doc_id those that stay: texts without words, and one row of each group that has no
    document with an id, the one with the smallest hash of its text."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(text.alias("text"), F.xxhash64(text).alias("text_hash")).dropDuplicates(["text_hash"])
    own = scratch.save(texts.mapInArrow(_node_rows(words), "text_hash long, node long"))
    known = out.filter("n_shingles > 0 and component_id is not null").select("node").distinct()
    parts = own.join(known, "node", "left_anti").join(component_roots(links, scratch), "node", "left")
    first = parts.groupBy(F.coalesce("root", "node")).agg(F.min("text_hash").alias("__hash")).select("__hash")
    same = F.xxhash64(text) == F.col("__hash")
    wordless = docs.join(own.select(F.col("text_hash").alias("__hash")), same, "left_anti")
    return docs.join(first, same, "left_semi").dropDuplicates(["text"]).unionByName(wordless)


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but one document of each group: the one with the smallest doc_id.

    All columns stay. Of rows alike in doc_id and text one stays. Rows without doc_id come after all others,
    by the hash of their text. Texts without words belong to no group.
    """
    out, links = jaccard_components(docs, words, percent)
    scratch = Scratch(docs.sparkSession, "parity")
    out = scratch.save(out)
    gone = out.filter("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    if gone.count() <= _BROADCAST_IDS:
        gone = F.broadcast(gone)
    gone = gone.withColumnRenamed("doc_id", "__gone_id")
    number = F.col("doc_id").cast("long")
    kept = docs.join(gone, number == F.col("__gone_id"), "left_anti")
    again = out.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id", "node").count().filter("count > 1")
    repeated = not again.isEmpty()
    unnamed = not out.filter("doc_id is null and n_shingles > 0").isEmpty()
    if not repeated and not unnamed:
        return kept
    known, others = kept.filter(number.isNotNull()), docs.filter(number.isNull())
    if repeated:
        known = known.dropDuplicates(["doc_id", "text"])
    if unnamed:
        others = _one_without_id(others, out, links, words, scratch)
    return known.unionByName(others)
