"""Hard negatives by exact integer inner products, scored with subset-sum tables (the Four-Russians way).

Every row is quantised to integers and cut into bit-planes, eight dimensions to a byte. For each
group of eight dimensions an anchor has a table of the sums of all 256 subsets of its components.
A plane's share of an inner product is then the sum of one table entry per byte, and the shares of
the planes, highest first, are added up by shifting: the score is exact.

The rows are dealt into a grid of cells, blocks of anchors by blocks of candidates. A cell holds the
tables of its anchors, a bounded number of bytes, and lets its candidates stream by; per anchor it
returns a few rows only, so that what leaves the cells is in proportion to the anchors. One pass
over the grid finds the positives, a second one the negatives between the bounds that follow.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import Scratch

_TABLE_BYTES = 96 * 1024 * 1024  # of the tables that a cell may hold
_CANDIDATES = 1 << 22  # at most, on average, in a cell
_TILE = 256, 512  # candidates and anchors scored at a time
_LOW, _FAR = -(1 << 62), 1 << 4000  # beyond any score in 64 bits, and beyond any score

_PACKED = "vec_id long, label long, groups int, planes binary"
_HITS = "anchor long, wanted long, vec_id long, score long, copies long"


# --- bit-planes -----------------------------------------------------------------------


def _quantised(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles, as Python integers where 64 bits are not enough."""
    scaled = np.floor(scale * values.astype(np.float64))
    if scaled.size and np.abs(scaled).max() >= 2.0**61:
        return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)
    return scaled.astype(np.int64)


def _bits(q: np.ndarray) -> np.ndarray:
    """Planes each row needs, the sign's included."""
    low, high = q.min(axis=1), q.max(axis=1)
    most = [max(int(h), -int(l) - 1, 0).bit_length() + 1 for l, h in zip(low, high, strict=True)]
    return np.array(most, np.int64)


def pack_planes(q: np.ndarray) -> list[bytes]:
    """Bit-planes of rows of integers in two's complement, the sign's plane first, eight dimensions to a byte."""
    n, d = q.shape
    if not n or not d:
        return [b""] * n
    out: list[bytes] = [b""] * n
    need = _bits(q)
    for bits in np.unique(need).tolist():
        which = np.flatnonzero(need == bits)
        rows = q[which]
        planes = [np.packbits(((rows >> k) & 1).astype(bool), axis=1, bitorder="little") for k in range(bits - 1, -1, -1)]
        joined = np.stack(planes, axis=1)
        for i, row in zip(which.tolist(), joined, strict=True):
            out[i] = row.tobytes()
    return out


def stack_planes(groups: np.ndarray, planes: list[bytes]) -> np.ndarray:
    """Bytes by row, plane and group. A row with fewer planes repeats its sign, one with fewer groups has zeros."""
    groups = np.asarray(groups, np.int64)
    depth = np.array([len(p) for p in planes], np.int64) // np.maximum(groups, 1)
    deepest, widest = int(depth.max(initial=0)), int(groups.max(initial=0))
    out = np.zeros((len(planes), deepest, widest), np.uint8)
    shapes = np.unique(np.stack([groups, depth], axis=1), axis=0)
    for g, b in shapes.tolist():
        if g and b:
            which = np.flatnonzero((groups == g) & (depth == b))
            block = np.frombuffer(b"".join([planes[i] for i in which.tolist()]), np.uint8).reshape(-1, b, g)
            out[which, deepest - b :, :g] = block
            out[which, : deepest - b, :g] = block[:, :1]
    return out


def unpack_planes(stacked: np.ndarray) -> np.ndarray:
    """The rows of integers again, dimensions padded to whole groups."""
    n, depth, groups = stacked.shape
    bits = np.unpackbits(stacked, axis=2, bitorder="little").astype(np.int64 if depth <= 62 else object)
    q = np.zeros((n, groups * 8), bits.dtype)
    for k in range(depth):
        q = q + q + (bits[:, k] if k else -bits[:, k])
    return q


def _kind(bound: int, small: bool = False):
    """The narrowest type for values up to a bound."""
    if small and bound < 1 << 15:
        return np.int16
    return np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 61 else object


class SubsetSums:
    """Tables of some anchors: for each group of eight dimensions the sums of all subsets of their components."""

    def __init__(self, vectors: np.ndarray):
        n, d = vectors.shape
        if max(int(vectors.max(initial=0)), -int(vectors.min(initial=0))) * d >= 1 << 61:
            vectors = vectors.astype(object)
        self.reach = int(np.abs(vectors).sum(axis=1).max(initial=0))
        kind = _kind(self.reach, small=True)
        self.tables = np.zeros((d // 8, 256, n), kind)
        for g in range(d // 8):
            for j in range(8):
                has = self.tables[g, : 1 << j]
                self.tables[g, 1 << j : 2 << j] = has + vectors[:, 8 * g + j].astype(kind)

    def scores(self, stacked: np.ndarray, low: int, high: int) -> np.ndarray:
        """Inner products of stacked rows with the anchors low to high (exclusive)."""
        n, depth, groups = stacked.shape
        total = np.zeros((n, high - low), _kind(self.reach << max(depth - 1, 0)))
        plane = np.zeros((n, high - low), self.tables.dtype)
        part = np.empty_like(plane)
        for b in range(depth):
            plane[...] = 0
            for g in range(min(groups, len(self.tables))):
                np.take(self.tables[g, :, low:high], stacked[:, b, g], axis=0, out=part, mode="clip")
                plane += part
            if b:
                total += total
                total += plane
            else:
                total -= plane
        return total


# --- cells of the grid ----------------------------------------------------------------


class _Best:
    """The first few rows per anchor between two bounds, as candidates arrive by ascending id."""

    def __init__(self, low: list[int], high: list[int], keep: int):
        n, big = len(low), any(abs(x) >= 1 << 62 for x in (*low, *high))
        kind = object if big else np.int64
        self.none = -_FAR if big else _LOW
        self.low, self.high, self.keep = np.array(low, kind), np.array(high, kind), keep
        self.score = np.full((n, keep), self.none, kind)
        self.ids, self.known = np.zeros((n, keep), np.int64), np.zeros((n, keep), bool)
        self.copies = np.zeros((n, keep), np.int64)

    def _wide(self) -> None:
        """From 64 bits to any size."""
        if self.score.dtype != object:
            self.score = self.score.astype(object)
            self.none, self.low, self.high = -_FAR, self.low.astype(object), self.high.astype(object)
            for bound, old, new in ((self.score, _LOW, -_FAR), (self.low, _LOW + 1, 1 - _FAR), (self.high, -_LOW - 1, _FAR)):
                bound[bound == old] = new

    def offer(self, at: int, scores: np.ndarray, fits: np.ndarray, ids, known, copies) -> None:
        """Scores of candidates (rows) with the anchors from ``at`` on (columns), of which those that fit count."""
        if scores.dtype == object:
            self._wide()
        span = slice(at, at + scores.shape[1])
        last = self.score[span, -1]
        # A later candidate with the score of the last one has a larger id and stays out.
        floor, high = np.where(last == self.none, self.low[span] - 1, last), self.high[span]
        if scores.dtype == np.int32 and floor.dtype != object:
            most = np.iinfo(np.int32)
            floor, high = (np.clip(x, most.min, most.max).astype(np.int32) for x in (floor, high))
        row, column = np.nonzero(fits & (scores > floor) & (scores <= high))
        if not len(row):
            return
        score = scores[row, column].astype(self.score.dtype)
        if score.dtype == object:
            order = np.array(sorted(range(len(row)), key=lambda j: (column[j], -score[j], row[j])))
        else:
            order = np.lexsort((row, -score, column))
        row, column, score = row[order], column[order], score[order]
        first = np.flatnonzero(np.diff(column, prepend=-1))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        near = rank < self.keep
        row, column, score, rank = row[near], column[near], score[near], rank[near]
        which, place = np.unique(column, return_inverse=True)
        shape, which = (len(which), self.keep), which + at

        def joined(old, new, empty):
            fresh = np.full(shape, empty, old.dtype)
            fresh[place, rank] = new
            return np.concatenate([old[which], fresh], axis=1)

        both = joined(self.score, score, self.none)
        if both.dtype == object:
            best = np.array([sorted(range(2 * self.keep), key=lambda j: -r[j])[: self.keep] for r in both])
        else:
            best = np.argsort(-both, axis=1, kind="stable")[:, : self.keep]
        self.score[which] = np.take_along_axis(both, best, axis=1)
        self.ids[which] = np.take_along_axis(joined(self.ids, ids[row], 0), best, axis=1)
        self.known[which] = np.take_along_axis(joined(self.known, known[row], False), best, axis=1)
        self.copies[which] = np.take_along_axis(joined(self.copies, copies[row, column + at], 0), best, axis=1)


class _Copies:
    """Copies of a candidate as an anchor sees them: one fewer if it is the anchor's own row."""

    def __init__(self, copies: np.ndarray, own: dict[tuple[int, int], int]):
        self.copies, self.own = copies, own

    def __getitem__(self, at):
        rows, anchors = at
        out = self.copies[rows].copy()
        if self.own:
            for i, pair in enumerate(zip(rows.tolist(), anchors.tolist(), strict=True)):
                out[i] -= self.own.get(pair, 0)
        return out


class _Cell:
    """A block of anchors, and the best of the candidates seen so far."""

    def __init__(self, batches: list[pa.RecordBatch], bounds: tuple[int, int] | None, keep: int):
        anchors = pa.Table.from_batches(batches)
        self.rows = anchors.column("row").to_numpy()
        self.labels = anchors.column("label").to_numpy()
        self.order = np.argsort(self.rows)
        groups = anchors.column("groups").to_numpy()
        self.sums = SubsetSums(unpack_planes(stack_planes(groups, anchors.column("planes").to_pylist())))
        self.same, n = bounds is None, len(self.rows)
        if self.same:
            self.wanted: list[list[int | None]] = [[None] * n]
            self.best = [_Best([_LOW + 1] * n, [-_LOW - 1] * n, keep)]
            return
        lists = anchors.column("wanted").to_pylist()
        self.wanted, self.best = [], []
        for j in range(max(map(len, lists), default=0)):
            some = [w[j] if j < len(w) else None for w in lists]
            low = [0 if w is None else -(-bounds[0] * w // 100) for w in some]
            high = [-1 if w is None else bounds[1] * w // 100 for w in some]
            self.wanted.append(some)
            self.best.append(_Best(low, high, keep))

    def see(self, batch: pa.RecordBatch) -> None:
        rows, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        known = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("vec_id").fill_null(0).to_numpy()
        copies = batch.column("copies").to_numpy()
        groups, planes = batch.column("groups").to_numpy(), batch.column("planes").to_pylist()
        anchors, (tall, wide) = len(self.rows), _TILE
        sorted_rows = self.rows[self.order]
        for a in range(0, len(rows), tall):
            b = min(a + tall, len(rows))
            stacked = stack_planes(groups[a:b], planes[a:b])
            at = np.minimum(np.searchsorted(sorted_rows, rows[a:b]), anchors - 1)
            own = np.flatnonzero(sorted_rows[at] == rows[a:b])
            pairs = {(i, int(self.order[at[i]])): 1 for i in own.tolist()} if self.same else {}
            seen = _Copies(copies[a:b], pairs)
            for low in range(0, anchors, wide):
                high = min(low + wide, anchors)
                scores = self.sums.scores(stacked, low, high)
                fits = labels[a:b, None] == self.labels[None, low:high]
                if not self.same:
                    fits = ~fits
                for i, j in pairs:
                    if low <= j < high and copies[a + i] == 1:
                        fits[i, j - low] = False
                for best in self.best:
                    best.offer(low, scores, fits, ids[a:b], known[a:b], seen)

    def result(self) -> pa.RecordBatch:
        parts: list[list] = [[], [], [], [], []]
        for wanted, best in zip(self.wanted, self.best, strict=True):
            row, place = np.nonzero(best.score != best.none)
            scores = best.score[row, place]
            if scores.dtype == object:
                scores = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores]
            parts[0] += self.rows[row].tolist()
            parts[1] += [wanted[i] for i in row.tolist()]
            parts[2] += [i if k else None for i, k in zip(best.ids[row, place].tolist(), best.known[row, place].tolist(), strict=True)]
            parts[3] += [int(s) for s in scores]
            parts[4] += best.copies[row, place].tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int64()) for p in parts], names=["anchor", "wanted", "vec_id", "score", "copies"]
        )


def _cells(bounds: tuple[int, int] | None, keep: int):
    """Scores the cells of a partition, whose rows come by cell, the anchors first, candidates by ascending id."""

    def rows(batches):
        number, held, cell = None, [], None
        for batch in batches:
            cells, candidate = batch.column("cell").to_numpy(), batch.column("candidate").to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(candidate) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)], strict=True):
                if a == b:
                    continue
                if cells[a] != number:
                    if cell:
                        yield cell.result()
                    number, held, cell = cells[a], [], None
                if not candidate[a]:
                    held.append(batch.slice(a, b - a))
                elif held:
                    cell = cell or _Cell(held, bounds, keep)
                    cell.see(batch.slice(a, b - a))
        if cell:
            yield cell.result()

    return rows


# --- the operator ---------------------------------------------------------------------


def _packed(scale: int):
    def rows(batches):
        for batch in batches:
            lists = batch.column("embedding")
            size = lists.value_lengths().to_numpy()
            off = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            planes: list[bytes] = [b""] * len(size)
            for d in np.unique(size).tolist():
                which = np.flatnonzero(size == d)
                q = _quantised(flat[off[which][:, None] + np.arange(d)], scale)
                q = np.pad(q, ((0, 0), (0, -d % 8)))
                for i, p in zip(which.tolist(), pack_planes(q), strict=True):
                    planes[i] = p
            groups = pa.array(-(-size // 8), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), groups, pa.array(planes, pa.binary())],
                names=["vec_id", "label", "groups", "planes"],
            )

    return rows


def pack_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part: vec_id, label, groups, planes, copies; rows alike in all of these are one."""
    largest = F.lit(float(np.finfo(np.float64).max) / scale)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= largest))
    return (
        vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
        .mapInArrow(_packed(scale), _PACKED)
        .groupBy("vec_id", "label", "groups", "planes")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


class _Grid:
    """How many blocks the anchors and the candidates are cut into."""

    def __init__(self, rows: DataFrame):
        found = rows.agg(
            F.count_if("anchor").alias("anchors"), F.count(F.lit(1)).alias("rows"), F.max("groups").alias("groups")
        ).first()
        spark = rows.sparkSession
        self.down = max(1, math.ceil(found["anchors"] * 256 * 4 * max(found["groups"] or 0, 1) / _TABLE_BYTES))
        tasks = 2 * spark.sparkContext.defaultParallelism
        self.across = max(1, math.ceil(tasks / self.down), math.ceil(found["rows"] / _CANDIDATES))

    def passed(self, anchors: DataFrame, rows: DataFrame, bounds: tuple[int, int] | None, keep: int) -> DataFrame:
        """One pass over all cells: per anchor, wanted score and cell the best rows."""
        place = [F.pmod(F.xxhash64("row"), F.lit(n)) for n in (self.down, self.across)]
        to_all = F.transform(F.sequence(F.lit(0), F.lit(self.across - 1)), lambda c: (place[0] * self.across + c).cast("int"))
        to_each = F.transform(F.sequence(F.lit(0), F.lit(self.down - 1)), lambda r: (r * self.across + place[1]).cast("int"))
        columns = ("row", "vec_id", "label", "groups", "planes", "copies")
        down = anchors.select(F.explode(to_all).alias("cell"), F.lit(0).alias("candidate"), *columns, "wanted")
        none = F.lit(None).cast("array<long>").alias("wanted")
        across = rows.select(F.explode(to_each).alias("cell"), F.lit(1).alias("candidate"), *columns, none)
        return (
            down.unionByName(across)
            .repartitionById(self.down * self.across, F.col("cell"))
            .sortWithinPartitions("cell", "candidate", F.col("vec_id").asc_nulls_last(), "row")
            .mapInArrow(_cells(bounds, keep), _HITS)
        )


def _many(copies: Column, step: int = 10_000) -> Column:
    """An array to explode for so many copies, in two steps so that neither array is long."""
    return F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / step))


def _first(hits: DataFrame, keys: list[str], keep: int) -> DataFrame:
    """The first rows of each key with their rank, a row counting once per copy."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    before = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = hits.withColumn("before", before).filter(F.col("before") < keep)
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(keep) - F.col("before"))))
    return near.withColumn("copy", copy).select(
        *keys, "vec_id", "score", (F.col("before") + F.col("copy")).cast("int").alias("rank")
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive of ``vectors`` (columns vec_id, label, embedding; others are ignored) the first negatives:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the inner product of these integers. Anchors are
    the rows for which ``is_anchor``, an expression over vec_id and label, is true. The positives of
    an anchor are the first other rows of its label; the negatives of a positive the first rows of
    another label whose score lies between the two percentages of the positive's. Higher scores come
    first, ties by smaller vec_id, rows without one last.

    A row with a null label, a null vector, or a component that is null, not finite, or not finite
    once scaled, takes no part. A shorter vector counts as padded with zeros, an empty one as
    zeros. Repeated rows are rows of their own: a copy of an anchor is another row of its label, and
    an anchor that occurs twice is reported twice. Scores are exact at any size; those that do not fit
    into a long are written as its ends. An empty table, or one without anchors, gives an empty result.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    packed = pack_rows(vectors, scale)
    rows = scratch.save(
        packed.select(
            F.monotonically_increasing_id().alias("row"), "*", F.coalesce(is_anchor, F.lit(False)).alias("anchor")
        )
    )
    grid = _Grid(rows)
    anchors = rows.filter("anchor")
    blank = anchors.withColumn("wanted", F.lit(None).cast("array<long>"))
    near = _first(grid.passed(blank, rows, None, positives), ["anchor"], positives)
    near = scratch.save(near.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score", "rank": "place"}))
    wanted = near.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("wanted"))
    asked = anchors.join(wanted.withColumnRenamed("anchor", "row"), "row")
    far = grid.passed(asked, rows, (low_percent, high_percent), negatives)
    far = _first(far, ["anchor", "wanted"], negatives).withColumnsRenamed(
        {"wanted": "positive_score", "vec_id": "negative_id", "score": "negative_score"}
    )
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "copies")
    found = near.join(far, ["anchor", "positive_score"]).join(named, "anchor")
    step = 10_000
    left = F.least(F.lit(step).cast("long"), F.col("copies") - F.col("part") * step)
    return (
        found.withColumn("part", F.explode(_many(F.col("copies"), step)))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
