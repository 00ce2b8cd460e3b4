"""Resampling towards a target distribution by hashed n-gram importance weights, with segment deduplication.

Newlines separate words, so a text is its lines: the features of a text are those of its lines and
the word pairs that cross from one line to the next. The corpus is therefore counted as follows.
Spark groups equal lines; the features of each distinct line are counted once and multiplied by its
occurrences; pairs across lines are counted apart, from the first and last words of neighbouring
lines. Only counts per bucket leave the tasks.

A bucket is the crc32 of a feature. Checksums of words are computed for all words of a batch at a
time, and the checksum of a pair follows from those of its words, because crc32 is linear.
"""

from __future__ import annotations

import math
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm import arrays
from gaugelake.llm.shared import Scratch

_LONG = 48  # bytes of a word from which on it is checked on its own
_DIRECT = 64  # lengths with a table of their own

_COUNTS = "bucket int, n long"
_SCORED = "doc_id long, n_words long, n_features long, weight long"

#: Bytes between words: all but 0-9, A-Z, a-z and those of code points above ASCII.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- checksums ------------------------------------------------------------------------


@cache
def _bytes_table() -> np.ndarray:
    """What a crc32 register becomes by one zero byte, by its lowest byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _through(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by tables for each of their four bytes."""
    return (
        tables[0][register & 255]
        ^ tables[1][(register >> 8) & 255]
        ^ tables[2][(register >> 16) & 255]
        ^ tables[3][register >> 24]
    )


def _units() -> np.ndarray:
    return (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)


@cache
def _shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps by 0 .. 63 zero bytes, and by 64, 128, 256, ... zero bytes."""
    step = _bytes_table()
    short = [_units()]
    for _ in range(_DIRECT):
        last = short[-1]
        short.append(step[last & 255] ^ (last >> 8))
    powers = [short.pop()]
    for _ in range(34):
        powers.append(_through(powers[-1], powers[-1]))
    return np.stack(short), powers


def shifted(register: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums moved on by so many zero bytes each: the part they have in the checksum of a longer string."""
    short, powers = _shift_tables()
    low = lengths & (_DIRECT - 1)
    out = (
        short[low, 0, register & 255]
        ^ short[low, 1, (register >> 8) & 255]
        ^ short[low, 2, (register >> 16) & 255]
        ^ short[low, 3, register >> 24]
    )
    rest = lengths // _DIRECT
    for k in range(int(rest.max(initial=0)).bit_length()):
        which = np.flatnonzero((rest >> k) & 1)
        out[which] = _through(powers[k], out[which])
    return out


def word_checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each slice."""
    length = ends - starts
    out = np.zeros(len(starts), np.uint32)
    for i in np.flatnonzero(length > _LONG).tolist():
        out[i] = zlib.crc32(raw[starts[i] : ends[i]])
    some = np.flatnonzero(length <= _LONG)
    some = some[np.argsort(-length[some], kind="stable")]
    at, size, table = starts[some], length[some], _bytes_table()
    register = np.full(len(some), 0xFFFFFFFF, np.uint32)
    left = np.searchsorted(-size, -np.arange(_LONG), "left")  # words longer than 0, 1, 2, ... bytes
    for k, n in enumerate(left.tolist()):
        if not n:
            break
        head = register[:n]
        register[:n] = table[(head ^ raw[at[:n] + k]) & 255] ^ (head >> 8)
    out[some] = ~register
    return out


_SPACE = np.uint32(zlib.crc32(b" "))


def pair_checksums(first: np.ndarray, second: np.ndarray, second_length: np.ndarray) -> np.ndarray:
    """The crc32 of two words joined by a space, from those of the words."""
    spaced = shifted(first, np.ones(len(first), np.int64)) ^ _SPACE
    return shifted(spaced, second_length) ^ second


# --- lines ----------------------------------------------------------------------------


class Lines:
    """Features of lines: the bucket of each word and pair with its line, and what pairs across lines need."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, buckets: int):
        self.n = len(off) - 1
        raw = _LOWER[raw]
        starts, ends, bounds = arrays.word_bounds(raw, off, _BETWEEN)
        sums, size = word_checksums(raw, starts, ends), ends - starts
        self.words = np.diff(bounds)
        line = np.repeat(np.arange(self.n), self.words)
        within = np.flatnonzero(line[1:] == line[:-1])
        pairs = pair_checksums(sums[within], sums[within + 1], size[within + 1])
        self.line = np.concatenate([line, line[within]])
        self.bucket = np.concatenate([sums, pairs]) % np.uint32(buckets)
        some = np.flatnonzero(self.words)
        self.first, self.last = np.zeros(self.n, np.uint32), np.zeros(self.n, np.uint32)
        self.first_length = np.zeros(self.n, np.int64)
        self.first[some], self.last[some] = sums[bounds[some]], sums[bounds[some + 1] - 1]
        self.first_length[some] = size[bounds[some]]

    def counted(self, occurrences: np.ndarray, buckets: int) -> np.ndarray:
        """Features per bucket, each line so often."""
        return np.bincount(self.bucket, occurrences[self.line].astype(np.float64), buckets).astype(np.int64)


class Texts:
    """Texts as rows of distinct lines: each distinct line is looked at once."""

    def __init__(self, texts: pa.Array, buckets: int):
        raw, off = arrays.text_buffer(texts)
        # A line keeps its newline, so that the lines of a text lie one behind the other.
        breaks = np.flatnonzero(raw == 10) + 1
        edges = np.unique(np.concatenate([breaks, off]))
        held = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
        )
        coded = held.dictionary_encode()
        self.of = coded.indices.to_numpy()
        distinct = coded.dictionary
        ends = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
        body = distinct.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        self.lines = Lines(data[ends[0] : ends[-1]], ends - ends[0], buckets)
        self.text = np.searchsorted(off, edges[:-1], "right") - 1
        self.n = len(off) - 1
        # Neighbouring lines with words of one text.
        full = np.flatnonzero(self.lines.words[self.of] > 0)
        near = np.flatnonzero(self.text[full[1:]] == self.text[full[:-1]])
        self.crossing = self.text[full[near]]
        a, b = self.of[full[near]], self.of[full[near + 1]]
        self.across = pair_checksums(self.lines.last[a], self.lines.first[b], self.lines.first_length[b]) % np.uint32(buckets)


def _line_counts(buckets: int):
    def rows(batches):
        total = np.zeros(buckets, np.int64)
        for batch in arrays.pieces(batches):
            lines = Lines(*arrays.text_buffer(batch.column("text")), buckets)
            total += lines.counted(batch.column("n").to_numpy(), buckets)
        yield from _buckets(total)

    return rows


def _crossing_counts(buckets: int):
    def rows(batches):
        total = np.zeros(buckets, np.int64)
        for batch in arrays.pieces(batches):
            total += np.bincount(Texts(batch.column("text"), buckets).across, minlength=buckets)
        yield from _buckets(total)

    return rows


def _buckets(total: np.ndarray):
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"]
    )


def bucket_counts(texts: DataFrame, buckets: int = 10_000) -> DataFrame:
    """Features of all ``texts`` (column text; others are ignored) per bucket: bucket, n. Buckets without one are left out."""
    lines = (
        texts.filter(F.col("text") != "")
        .select(F.explode(F.split("text", "\n", -1)).alias("text"))
        .filter(F.col("text") != "")
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    within = lines.mapInArrow(_line_counts(buckets), _COUNTS)
    across = texts.select("text").mapInArrow(_crossing_counts(buckets), _COUNTS)
    return within.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


# --- weights and the draw -------------------------------------------------------------


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the target's share over the corpus' share), each count raised by one."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    share = [
        (t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in share], np.int64)


def _weights(gain: np.ndarray):
    buckets = len(gain)

    def rows(batches):
        for batch in arrays.pieces(batches):
            texts = Texts(batch.column("text"), buckets)
            lines = texts.lines
            per_line = np.zeros(lines.n, np.int64)
            np.add.at(per_line, lines.line, gain[lines.bucket])
            features = np.bincount(lines.line, minlength=lines.n)

            def summed(values, texts=texts, more=None):
                out = np.zeros(texts.n, np.int64)
                np.add.at(out, texts.text, values[texts.of])
                np.add.at(out, texts.crossing, 0 if more is None else more)
                return out

            n = summed(features, more=1)
            weight = np.where(n > 0, summed(per_line, more=gain[texts.across]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(summed(lines.words)), pa.array(n), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return rows


def _array(counts: DataFrame, buckets: int) -> np.ndarray:
    """At most one row per bucket: what the model is made of."""
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def weighted(docs: DataFrame, target: DataFrame, buckets: int = 10_000) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text): doc_id, n_words, n_features, weight."""
    gain = gains(_array(bucket_counts(docs, buckets), buckets), _array(bucket_counts(target, buckets), buckets))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_weights(gain), _SCORED)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = 10_000
) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_words, n_features, weight, score, rank.

    Features are the words (runs of a-z, 0-9 and code points above ASCII, A-Z in lower case) and pairs
    of consecutive words of whole texts, hashed into ``buckets``. The weight of a row is the floored mean
    gain of its features towards ``target`` (column text), 0 without features; its score adds Gumbel
    noise drawn from doc_id and ``seed``. Of the rows with ``least_words`` words, ``percent`` in a hundred are
    drawn by highest score, ties to the smaller doc_id, rows without one last; they carry their rank,
    others a null.

    A null text has no words. Rows of one doc_id have the same noise, rows without one share theirs;
    rows that tie in score and doc_id are ranked in any order. Repeated rows count as often as they occur. An
    empty table gives an empty result, an empty target leaves weights towards an even distribution.
    Ranks come from one range-partitioned sort and the sizes of its partitions; no task sees all rows.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    chance = (drawn.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln(chance)))
    scored = scratch.save(
        weighted(docs, target, buckets).withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id())
    )
    eligible = F.col("n_words") >= least_words
    place = [(~eligible).cast("int"), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ordered = scratch.save(
        scored.repartitionByRange(*place).sortWithinPartitions(*place).drop("row").withColumn("place", F.monotonically_increasing_id())
    )
    # The number of a partition, and the place within it.
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if(eligible).alias("able"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    able = F.sum("able").over(Window.partitionBy())
    starts = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), able.alias("able")))
    rank = F.col("start") + within + 1
    return (
        ordered.withColumn("part", part)
        .join(starts, "part")
        .select(
            "doc_id",
            "n_words",
            "n_features",
            "weight",
            "score",
            F.when(eligible & (rank * 100 <= F.col("able") * percent), rank).alias("rank"),
        )
    )
