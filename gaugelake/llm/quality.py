"""Quality rules: text statistics, and perplexity bands of a character n-gram model.

The n-grams of every document are counted by Spark, per language. The modified Kneser-Ney model
(three discounts per order from the counts of counts, lower orders from continuation counts) is
computed with joins and stored as sorted 64-bit hashes with their log probabilities. It is
held by every task while it has a bounded number of entries; a larger one is joined by a shuffle.
As the model has read every document it scores, no n-gram is missing from it. Documents whose
perplexity lies outside their language's band are rejected; a band reaches three interquartile
ranges beyond the quartiles of the documents that pass the other rules.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm import arrays
from gaugelake.llm.shared import Scratch, small_batches

_ORDER = 4
_PAD = "\x02"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 20  # characters counted or scored at a time
_BROADCAST_LANGUAGES = 100_000
#: Entries of a model that tasks may hold (16 bytes each); a larger model is joined by a shuffle.
_HELD_ENTRIES = 4_000_000
_BIN = 0.001  # of the logarithm of the perplexity, for the quartiles
_REACH = 3.0
_MIN_WORDS = 50
_MAX_REPEATED = 50  # percent

_COUNTS = "lang string, gram string, n long"
_STATS = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_chars long, text_hash long, log_probability double"
)


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(b"#*$%&|<>")] = True
    return table


# --- n-grams of characters -------------------------------------------------------------


def _padded(text: str) -> str:
    return _PAD * (_ORDER - 1) + text.lower().replace(_PAD, " ")


def _steps(texts: list[str]):
    """Code points of padded texts, some at a time, with the place where each text ends."""
    part, size, first = [], 0, 0
    for i, t in enumerate(texts):
        part.append(_padded(t))
        size += len(part[-1])
        if size >= _STEP or i == len(texts) - 1:
            points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), "<u4")
            yield first, points, np.cumsum([len(x) for x in part])
            part, size, first = [], 0, i + 1


class _Counter:
    """Counts the n-grams of one language within a task."""

    def __init__(self):
        self.code = np.zeros(0x110000, np.uint16)
        self.points = [0]
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def full(self, points: np.ndarray) -> bool:
        return len(self.points) + len(np.unique(points[self.code[points] == 0])) > 0xFFFF

    def add(self, points: np.ndarray) -> None:
        new = np.unique(points[self.code[points] == 0])
        self.code[new] = np.arange(len(self.points), len(self.points) + len(new))
        self.points += new.tolist()
        codes = self.code[points]
        wide = len(self.points) > 256
        codes = codes.astype(np.uint64 if wide else np.uint32)
        step = 16 if wide else 8
        n = len(codes) - _ORDER + 1
        key = codes[:n].copy()
        for i in range(1, _ORDER):
            key = (key << step) | codes[i : n + i]
        key = key[points[_ORDER - 1 :] != ord(_PAD)]
        grams, counts = np.unique(key, return_counts=True)
        out = np.zeros(len(grams), np.uint64)
        for i in range(_ORDER):  # always 16 bits a character from here on
            out |= ((grams.astype(np.uint64) >> np.uint64(step * i)) & np.uint64((1 << step) - 1)) << np.uint64(16 * i)
        self.parts.append((out, counts))
        if len(self.parts) >= 16:
            self._merge()

    def _merge(self) -> None:
        keys, places = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, places, np.concatenate([c for _, c in self.parts]))
        self.parts = [(keys, total)]

    def grams(self) -> tuple[list[str], np.ndarray]:
        if not self.parts:
            return [], np.zeros(0, np.int64)
        self._merge()
        keys, counts = self.parts[0]
        points = np.array(self.points, "<u4")
        columns = [points[((keys >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64)] for i in range(_ORDER)]
        text = np.stack(columns[::-1], axis=1).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [text[i : i + _ORDER] for i in range(0, len(text), _ORDER)], counts


def _by_language(batch) -> dict[str, list[int]]:
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(batch.column("lang").to_pylist()):
        rows.setdefault(lang, []).append(i)
    return rows


def _count_rows(batches):
    counters: dict[str, _Counter] = {}

    def out(lang):
        grams, counts = counters.pop(lang).grams()
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
            names=["lang", "gram", "n"],
        )

    for batch in arrays.pieces(batches):
        texts = batch.column("text").to_pylist()
        for lang, rows in _by_language(batch).items():
            for _, points, _ in _steps([texts[i] for i in rows]):
                if lang in counters and counters[lang].full(points):
                    yield from out(lang)
                counters.setdefault(lang, _Counter()).add(points)
    for lang in list(counters):
        yield from out(lang)


# --- the model ---------------------------------------------------------------------------


def _per_language(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A frame of one row per language, broadcast up to a number of languages: one may hold all documents."""
    saved = scratch.save(rows)
    return F.broadcast(saved) if saved.count() <= _BROADCAST_LANGUAGES else saved


def _discounted(grams: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """Adds to lang, gram, n of one order: own (the discounted share) and left (the mass for lower orders)."""
    of = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in range(1, 5)]
    d = grams.groupBy("lang").agg(*of)
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

    def discount(k: int) -> Column:
        more, have = F.col(f"n{k + 1}"), F.greatest(F.col(f"n{k}"), F.lit(1.0))
        return F.least(F.greatest(k - (k + 1) * y * more / have, F.lit(0.1)), F.lit(float(k)))

    d = _per_language(d.select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)]), scratch)
    context = F.substring("gram", 1, order - 1)
    own = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = grams.join(d, "lang").withColumn("context", context).withColumn("off", F.least(own, F.col("n").cast("double")))
    # Sums over at most as many rows as there are characters; in whole units, so that their order is nothing.
    kinds = [
        F.sum(F.when(test, 1).otherwise(0)).alias(c)
        for c, test in (("k1", F.col("n") == 1), ("k2", F.col("n") == 2), ("k3", F.col("n") > 2))
    ]
    totals = rows.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), *kinds, F.first("d1").alias("e1"), F.first("d2").alias("e2"), F.first("d3").alias("e3")
    )
    mass = (F.col("e1") * F.col("k1") + F.col("e2") * F.col("k2") + F.col("e3") * F.col("k3")) / F.col("total")
    totals = totals.select("lang", "context", "total", F.least(mass, F.lit(1.0)).alias("left"))
    return rows.join(totals, ["lang", "context"]).select(
        "lang", "gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("own"), "left"
    )


def kneser_ney(counts: DataFrame, scratch: Scratch, order: int = _ORDER) -> DataFrame:
    """Modified Kneser-Ney probabilities: lang, gram, p for every n-gram of ``counts`` (lang, gram, n)."""
    grams = [counts]
    for k in range(order - 1, 0, -1):
        shorter = grams[0].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        grams.insert(0, scratch.save(shorter))
    letters = _per_language(grams[0].groupBy("lang").agg(F.count("*").alias("letters")), scratch)
    first = _discounted(grams[0], 1, scratch).join(letters, "lang")
    p = first.select("lang", "gram", (F.col("own") + F.col("left") / (F.col("letters") + 1)).alias("p"))
    for k in range(2, order + 1):
        lower = p.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        higher = _discounted(grams[k - 1], k, scratch).withColumn("suffix", F.substring("gram", 2, k - 1))
        p = higher.join(lower, ["lang", "suffix"]).select(
            "lang", "gram", (F.col("own") + F.col("left") * F.col("lower")).alias("p")
        )
        p = scratch.save(p)
    return p


def _gram_hashes(points: np.ndarray, lang: str) -> np.ndarray:
    n = len(points) - _ORDER + 1
    wide = points.astype(np.uint64)
    key = wide[:n] + np.array([xxhash.xxh3_64_intdigest(lang.encode())], np.uint64)
    for i in range(1, _ORDER):
        key = key * _BASE + wide[i : n + i]
    return arrays.mix(key)


def _hash_rows(batches):
    for batch in batches:
        langs, grams = batch.column("lang").to_pylist(), batch.column("gram").to_pylist()
        hashes = np.zeros(len(grams), np.uint64)
        for lang in set(langs):
            at = [i for i, x in enumerate(langs) if x == lang]
            points = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), "<u4")
            hashes[at] = _gram_hashes(points, lang)[::_ORDER]
        logs = np.log(np.asarray(batch.column("p")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64), pa.int64()), pa.array(logs, pa.float64())], names=["hash", "log_p"]
        )


# --- statistics and scores ---------------------------------------------------------------


def _stats(batch) -> list[pa.Array]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the texts of a batch."""
    texts = batch.column("text")
    hashes, bounds = arrays.word_hashes(texts)
    words = np.diff(bounds)
    n_symbols, word_chars = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    raw, off = arrays.text_buffer(texts)
    symbols = _symbol_table()
    for a, b in arrays.steps(off):
        piece, at = raw[off[a] : off[b]], off[a : b + 1] - off[a]
        for out, flags in ((n_symbols, symbols[piece]), (word_chars, ((piece & 0xC0) != 0x80) & ~arrays.SPACES[piece])):
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            out[a:b] = sums[at[1:]] - sums[at[:-1]]
    text = np.repeat(np.arange(len(words)), words)
    windows = arrays.window_hashes(hashes, 3)
    same = text[: len(windows)] == text[2:] if len(windows) else np.zeros(0, bool)
    keys = arrays.mix(windows + text[: len(windows)].astype(np.uint64) * _BASE)
    keys = keys[same]
    _, places, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(same)[counts[places] > 1] if len(keys) else np.zeros(0, np.int64)
    repeated = arrays.covered(starts, 3, len(hashes))
    sums = np.concatenate([[0], np.cumsum(repeated, dtype=np.int64)])
    dup_lines = []
    for t in texts.to_pylist():
        lines = [x for x in t.encode().split(b"\n") if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    return [words, word_chars, n_symbols, dup_lines, sums[bounds[1:]] - sums[bounds[:-1]]]


def _scored_rows(model: tuple[np.ndarray, np.ndarray] | None):
    def rows(batches):
        held = (arrays.SortedHashes(model[0]), model[1]) if model else None
        for batch in arrays.pieces(batches):
            stats = _stats(batch)
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            sums = np.full(len(texts), np.nan)
            if held:
                for lang, own in _by_language(batch).items():
                    for first, points, ends in _steps([texts[i] for i in own]):
                        logs = np.zeros(len(points))
                        if len(points) >= _ORDER:
                            real = points[_ORDER - 1 :] != ord(_PAD)
                            at = held[0].find(_gram_hashes(points, lang)[real])
                            logs[_ORDER - 1 :][real] = held[1][at]
                        total = np.concatenate([[0.0], np.cumsum(logs)])[np.concatenate([[0], ends])]
                        sums[own[first : first + len(ends)]] = np.diff(total)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(langs, pa.string()),
                    *[pa.array(x, pa.int64()) for x in stats],
                    pa.array([len(t) for t in texts], pa.int64()),
                    batch.column("text_hash"),
                    pa.array(sums, pa.float64()),
                ],
                names=[x.split()[0] for x in _STATS.split(", ")],
            )

    return rows


def _gram_rows(batches):
    """The distinct n-grams of each text, hashed, with their counts. Rows alike in all but lang count apart."""
    for batch in arrays.pieces(batches):
        texts, ids, marks = (batch.column(c).to_pylist() for c in ("text", "doc_id", "text_hash"))
        for lang, own in _by_language(batch).items():
            for i in own:
                for _, points, _ in _steps([texts[i]]):
                    if len(points) < _ORDER:
                        continue
                    hashes, counts = np.unique(_gram_hashes(points, lang), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[i]] * len(hashes), pa.int64()),
                            pa.array([lang] * len(hashes), pa.string()),
                            pa.array([marks[i]] * len(hashes), pa.int64()),
                            pa.array(hashes.view(np.int64), pa.int64()),
                            pa.array(counts, pa.int64()),
                        ],
                        names=["doc_id", "lang", "text_hash", "hash", "n"],
                    )


def _scores(docs: DataFrame, model: DataFrame, scratch: Scratch, held_entries: int) -> DataFrame:
    """Statistics and log probability of every row."""
    entries = model.count()
    if entries <= held_entries:
        table = model.toArrow()
        hashes = np.asarray(table.column("hash").combine_chunks()).view(np.uint64) if entries else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        logs = np.asarray(table.column("log_p").combine_chunks()) if entries else np.zeros(0)
        return scratch.save(docs.mapInArrow(_scored_rows((hashes[order], logs[order])), _STATS))
    stats = docs.mapInArrow(_scored_rows(None), _STATS).drop("log_probability")
    sums = (
        docs.mapInArrow(_gram_rows, "doc_id long, lang string, text_hash long, hash long, n long")
        .distinct()  # a repeated row is scored once
        .join(model, "hash")
        .groupBy("doc_id", "lang", "text_hash")
        .agg(F.sum(F.col("n") * F.col("log_p")).alias("log_probability"))
        .withColumnsRenamed({"doc_id": "its_id", "lang": "its_lang", "text_hash": "its_hash"})
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("its_id"))
        & (F.col("lang") == F.col("its_lang"))
        & (F.col("text_hash") == F.col("its_hash"))
    )
    return scratch.save(stats.join(sums, same, "left").drop("its_id", "its_lang", "its_hash"))


def _bands(rows: DataFrame) -> DataFrame:
    """Per language the quartiles of the logarithm of the perplexity, to a thousandth, and the band."""
    bins = rows.groupBy("lang", F.floor(F.col("log_perplexity") / _BIN).alias("bin")).agg(F.count("*").alias("n"))
    run = Window.partitionBy("lang").orderBy("bin")
    ranked = bins.withColumn("upto", F.sum("n").over(run)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    at = [
        F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bin"))).alias(c) for k, c in ((1, "q1"), (3, "q3"))
    ]
    q = ranked.groupBy("lang").agg(*at)
    wide = (F.col("q3") + 1 - F.col("q1")) * _BIN * _REACH
    return q.select(
        "lang", (F.col("q1") * _BIN - wide).alias("low"), ((F.col("q3") + 1) * _BIN + wide).alias("high")
    )


def judge(docs: DataFrame, held_entries: int = _HELD_ENTRIES) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, text and lang; others are ignored): doc_id, lang, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, perplexity, low_band, high_band, base_failed, kept, text_hash.

    Words are runs outside [\\x20\\x09-\\x0D]. A null or empty text has no word, fails the base rules
    and has perplexity null; rows without lang form one language. Repeated rows are judged alike.
    An empty table gives an empty result.
    """
    scratch = Scratch(small_batches(docs.sparkSession), "quality")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    counts = docs.select("lang", "text").mapInArrow(_count_rows, _COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    model = scratch.save(kneser_ney(scratch.save(counts), scratch).mapInArrow(_hash_rows, "hash long, log_p double"))
    rows = _scores(docs, model, scratch, held_entries)
    failed = (F.col("n_words") < _MIN_WORDS) | (100 * F.col("n_repeat_words") > _MAX_REPEATED * F.col("n_words"))
    each = -F.round("log_probability", 6) / F.greatest("n_chars", F.lit(1))
    rows = rows.withColumn("base_failed", failed).withColumn(
        "log_perplexity", F.when(F.col("n_chars") > 0, F.round(each, 9))
    )
    out = rows.join(_per_language(_bands(rows.filter("not base_failed")), scratch), "lang", "left")
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    return out.select(
        "doc_id",
        "lang",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        F.exp("log_perplexity").alias("perplexity"),
        F.exp("low").alias("low_band"),
        F.exp("high").alias("high_band"),
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        "text_hash",
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    The judgements are joined by doc_id and text, so the texts are shuffled only where they are too
    many to broadcast the ids of the rejected ones.
    """
    judged = judge(docs)
    bad = Scratch(docs.sparkSession, "quality").save(judged.filter("not kept").select("doc_id", "text_hash").distinct())
    if bad.count() <= 1_000_000:
        bad = F.broadcast(bad)
    bad = bad.withColumnsRenamed({"doc_id": "__bad_id", "text_hash": "__bad_hash"})
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__bad_id")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__bad_hash")
    )
    return docs.join(bad, same, "left_anti")
