"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Targets: every source weighs 3, 1 or 2 in turn and gets its share of the wanted words, but no more
than twice what it has; what a full source leaves over goes to the others by weight. With the
sources in order of capacity by weight this has a closed form: the first sources are full, the
others share the rest.

Sampling: a target is some whole sizes of its source and a rest. Each document gets that many
certain whole copies. The rest is a sample with inclusion probabilities in proportion to size:
documents are ranked by random odds over inclusion odds, and the sample is the head of the ranking,
of a fixed size counted in words: it ends where its words come nearest to the rest. The end is
found digit by digit of the rank from sums of words per digit, so no source is ever sorted or
gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import Scratch

_WEIGHTS = (3, 1, 2)
_WORD = r"[^\x20\x09-\x0D]+"
_DIGIT = 1 << 12
_DIGITS = 4
_TOP = _DIGIT**_DIGITS  # ranks are integers below this
_BITS = 52
#: Parameters of this many sources (some MB) may be broadcast; more are joined by a shuffle.
_BROADCAST_SOURCES = 100_000


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_key(source: str | Column) -> Column:
    """A text that is equal for equal sources, null included."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def draw(doc_id: str | Column, text: str | Column) -> Column:
    """52 random bits of a row, fixed by its own values."""
    row = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(row.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, percent: int = 150, weights: tuple = _WEIGHTS, most: int = 2) -> DataFrame:
    """Adds ``target`` to a table of sources (source, source_size), one row each.

    Sources stand in code point order, null last, and take the weights in turn. The windows run
    over one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_level.rowsBetween(Window.unboundedPreceding, 0)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(Window.partitionBy()) * F.lit(percent) / F.lit(100)
    left = (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    # The first source that is not full at its turn sets the level of all behind it.
    level = F.first(F.when(F.col("left") * F.col("weight") <= F.col("cap"), F.col("left")), ignorenulls=True)
    return (
        sizes.withColumns({"weight": weight, "cap": F.col("source_size") * most})
        .withColumn("left", left)
        .withColumn("level", level.over(upto))
        .withColumn("target", F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")).cast("double"))
        .drop("weight", "cap", "left", "level")
    )


def _rank() -> Column:
    """The Pareto rank, random odds over inclusion odds, squeezed to an integer from 0 to _TOP - 1."""
    u = (F.col("bits") + 0.5) / float(1 << _BITS)
    p = F.least(F.col("size") * F.col("rest") / F.greatest("squares", F.lit(1.0)), F.lit(1 - 1e-9))
    p = F.greatest(p, F.lit(1e-300))
    q = (u / (1 - u)) * ((1 - p) / p)
    return F.least(F.floor(q / (1 + q) * float(_TOP)).cast("long"), F.lit(_TOP - 1))


def _last_ranks(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Adds ``last_rank`` to the sources: documents up to it are in the sample. ``rows``: key, rank, size."""
    state = sources.select("key", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken"))
    for level in range(_DIGITS):
        unit = _DIGIT ** (_DIGITS - 1 - level)
        at = state.select("key", "prefix")
        inside = rows.join(F.broadcast(at) if few else at, "key")
        inside = inside.filter(F.expr(f"rank div {unit * _DIGIT}") == F.col("prefix"))
        digits = inside.groupBy("key", F.expr(f"rank div {unit}").alias("digit")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("key").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        passing = (
            digits.withColumn("upto", F.sum("words").over(run))
            .join(state.select("key", "rest", "taken"), "key")
            .filter(F.col("taken") + F.col("upto") >= F.col("rest"))
            .groupBy("key")
            .agg(F.min(F.struct("digit", "upto", "words", "rest", "taken")).alias("m"))
        )
        state = passing.select(
            "key",
            F.col("m.rest").alias("rest"),
            F.col("m.digit").alias("prefix"),
            (F.col("m.taken") + F.col("m.upto") - F.col("m.words")).alias("taken"),
            F.col("m.words").alias("words"),
        )
    # The documents of the last rank belong to the sample if that brings its words nearer.
    near = F.abs(F.col("taken") + F.col("words") - F.col("rest")) < F.abs(F.col("taken") - F.col("rest"))
    ends = state.select("key", F.when(near, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("last_rank"))
    return sources.join(ends, "key", "left").withColumn("last_rank", F.coalesce("last_rank", F.lit(-1)))


def _plan(rows: DataFrame, scratch: Scratch, percent: int, weights: tuple, most: int) -> tuple[DataFrame, bool]:
    """What each source needs to decide on a document, and whether that is small. ``rows``: source, size, bits."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size").cast("decimal(38,0)") * F.col("size")).cast("double").alias("squares"),
    )
    targets = source_targets(sizes, percent, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).otherwise(0)
    sources = scratch.save(
        targets.withColumn("whole", whole.cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("key", source_key("source"))
    )
    few = sources.count() <= _BROADCAST_SOURCES
    ranked = _with_sources(rows.filter("size > 0"), sources, few).select("key", "size", _rank().alias("rank"))
    return scratch.save(_last_ranks(scratch.save(ranked), sources, few)), few


def _with_sources(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Joins on the source, nulls included."""
    sources = sources.drop("source")
    return rows.withColumn("key", source_key("source")).join(F.broadcast(sources) if few else sources, "key")


def _copies() -> Column:
    return F.col("whole") + F.when(_rank() <= F.col("last_rank"), 1).otherwise(0)


def _measured(docs: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"), draw("doc_id", "text").alias("bits")
        )
    )


def mixture(
    docs: DataFrame, percent: int = 150, weights: tuple = _WEIGHTS, most: int = 2
) -> DataFrame:
    """Per row of ``docs`` (columns doc_id, source and text; others are ignored): doc_id, size, source_size, target,
    taken, copies.

    A null or wordless text has size 0 and is taken with 0 words. Rows without a source form the
    last source. Rows alike in doc_id and text draw alike, so a repeated row stands or falls with
    its copies. An empty table gives an empty result. Reruns on the same rows agree.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = _measured(docs, scratch)
    sources, few = _plan(rows, scratch, percent, weights, most)
    return (
        _with_sources(rows, sources, few)
        .withColumn("copies", F.when(F.col("size") > 0, _copies()).otherwise(0).cast("long"))
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
    )


def mixed_documents(docs: DataFrame, percent: int = 150, weights: tuple = _WEIGHTS, most: int = 2) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, each as often as it is taken."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sources, few = _plan(_measured(docs, scratch), scratch, percent, weights, most)
    measured = docs.select(
        F.struct("*").alias("row"), "source", word_count("text").alias("size"), draw("doc_id", "text").alias("bits")
    )
    return (
        _with_sources(measured.filter("size > 0"), sources, few)
        .filter(_copies() > 0)
        .select("row", F.explode(F.sequence(F.lit(1), _copies().cast("int"))).alias("copy"))
        .select("row.*")
    )
