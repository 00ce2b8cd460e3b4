"""Secret scans in DataFrame expressions: three patterns, and the entropy of long strings.

A candidate is a run of 20 or more characters of keys and tokens, or such a part of one between
slashes and equals signs. A window of 20 characters slides over it; when a character enters or
leaves, its count changes by one and the sum of n * log2(n) over the counts changes by one term,
from which the Shannon entropy of the window follows. The highest entropy of any window is held
against a threshold for the character class of the string. Strings that match the allow list
are suppressed; a part that does not match is judged by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three kinds and the lengths they need.
_ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ASSIGN_VALUE = 6
_ACCESS, _ACCESS_LENGTH = r"AKIA[A-Z0-9]+", 20
_HEX, _HEX_LENGTH = r"[0-9a-f]+", 24

KINDS = ("assign", "access", "hex", "entropy")

_WINDOW = 20
_CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
_PART = r"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{20,}"
_MATCHES_AT_ONCE = 256
#: Character classes of candidates, the first that fits counts, and the bits a window has to reach.
CLASSES = (
    (r"^[0-9]+$", math.inf),
    (r"^[0-9a-fA-F]+$", 3.0),
    (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", 4.0),
    (r"^[^0-9]+$", math.inf),
    (r"^[A-Za-z0-9]+$", 3.7),
    (r"^.*$", 3.9),
)
#: Strings never reported by entropy: samples, runs of one character, data digests named as such, UUIDs.
ALLOW = (
    r"(?i)example|sample|placeholder|changeme|dummy|redacted|your[-_]",
    r"(.)\1{5,}",
    r"(?i)0123456789|abcdefghij",
    r"(?i)^sha(256|384|512)-",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), in code points, end exclusive.

    What stands between matches, and the matches, alternate; their lengths add up to the places.
    They are added up within blocks of matches and from block to block, so that no array grows by one element
    a match for longer than a block.
    """
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(between) - 1), F.length).alias("gap"),
        F.transform(_found(text, pattern), F.length).alias("width"),
        _found(text, pattern, group).alias("value"),
    )
    kind = "struct<start:int,end:int,value:string>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    n = _MATCHES_AT_ONCE

    def step(state, x):
        start = (state["at"] + x["gap"]).cast("int")
        end = (start + x["width"]).cast("int")
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")).cast(kind)
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def blocks(steps):
        numbers = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / n).cast("int"))
        return F.transform(numbers, lambda b: F.aggregate(F.slice(steps, b * n + 1, F.lit(n)), empty, step))

    def placed(found):
        ends = F.transform(found, lambda x: x["at"])
        zero = F.array(F.lit(0))
        firsts = F.aggregate(ends, zero, lambda sums, at: F.concat(sums, F.array(F.element_at(sums, -1) + at)))

        def moved(firsts):
            def block(x, i):
                by = F.get(firsts, i)
                return F.transform(
                    x["out"],
                    lambda y: F.struct(
                        (y["start"] + by).alias("start"), (y["end"] + by).alias("end"), y["value"].alias("value")
                    ).cast(kind),
                )

            return F.flatten(F.transform(found, block))

        return _bound(firsts, moved)

    def whole(steps):
        return F.when(F.size(steps) > 0, _bound(blocks(steps), placed)).otherwise(F.array().cast(f"array<{kind}>"))

    return _bound(steps, whole)


def window_entropy(value: Column, window: int = _WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any window of a string; of the whole of a shorter one.

    Per place the counts of two characters change, that of the one that leaves the window and that of
    the one that enters; both stand in the window itself, so the work is in proportion to the string.
    """
    log2 = [0.0, 0.0, *[n * math.log2(n) for n in range(2, window + 1)]]

    def best(codes):
        size = F.size(codes)
        width = F.least(size, F.lit(window))
        terms = F.array(*map(F.lit, log2))

        def count(low, n, code):
            """How often a character stands in the ``n`` places from ``low`` (from 1) on."""
            return F.size(F.filter(F.slice(codes, low, n), lambda x: x == code))

        # Places from 0. The character at i - width leaves before the one at i enters.
        def change(code, i):
            before = count(F.greatest(i - width + 2, F.lit(1)), F.least(i, width - 1), code)
            entering = F.get(terms, before + 1) - F.get(terms, before)
            gone = F.get(codes, i - width)
            held = count(F.greatest(i - width + 1, F.lit(1)), width, gone)
            leaving = F.get(terms, held - 1) - F.get(terms, held)
            return entering + F.when(i >= width, leaving).otherwise(F.lit(0.0))

        def step(state, x):
            total = state["total"] + x
            bits = F.log2(width) - total / width
            full = state["place"] >= width - 1
            return F.struct(
                (state["place"] + 1).alias("place"),
                total.alias("total"),
                F.when(full, F.greatest(state["best"], bits)).otherwise(state["best"]).alias("best"),
            )

        start = F.struct(F.lit(0).alias("place"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.transform(codes, change), start, step, lambda s: s["best"])

    return F.when(F.length(value) > 0, _bound(F.split(value, ""), best)).otherwise(F.lit(0.0))


def _as_spans(found: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end"))
    ).cast(_SPANS)


def _where(gate: Column, spans: Column) -> Column:
    """The spans of rows that can have any; the others skip the work."""
    return F.when(gate, spans).otherwise(F.array().cast(_SPANS))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (columns doc_id and text; others are ignored): doc_id, n_assign, n_access, n_hex,
    n_entropy, base_sha256, spans.

    A null text is empty; empty texts and texts without a secret have no span. An entropy span that
    lies within a span of the three patterns is not repeated; of a run and its part the run is reported. Rows are judged one by one, so repeated rows
    give repeated results and an empty table an empty one.
    """
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    assign = F.filter(located(text, _ASSIGN, 2), lambda x: F.length(x["value"]) >= _ASSIGN_VALUE)
    access = F.filter(located(text, _ACCESS), lambda x: x["end"] - x["start"] >= _ACCESS_LENGTH)
    # Long runs only; a run of [0-9a-f] that is found is maximal either way.
    hexes = located(text, f"(?<![0-9a-f])[0-9a-f]{{{_HEX_LENGTH},}}")
    value = "value"
    limit = F.lit(math.inf)
    for pattern, bits in reversed(CLASSES):
        limit_of = limit

        def limit_for(x, pattern=pattern, bits=bits, rest=limit_of):
            other = rest(x) if callable(rest) else rest
            return F.when(x[value].rlike(pattern), F.lit(bits)).otherwise(other)

        limit = limit_for
    allowed = [lambda x, p=p: x[value].rlike(p) for p in ALLOW]

    def high(x):
        kept = F.lit(True)
        for rule in allowed:
            kept = kept & ~rule(x)
        return kept & (window_entropy(x[value]) >= limit(x))

    def within(x, spans):
        return F.exists(spans, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"]))

    def with_parts(runs):
        return F.concat(runs, F.filter(F.filter(located(text, _PART), high), lambda x: ~within(x, runs)))

    entropy = _bound(F.filter(located(text, _CANDIDATE), high), with_parts)
    found = rows.select(
        "doc_id",
        _where(text.rlike(_ASSIGN), _as_spans(assign, "assign")).alias("assign"),
        _where(text.contains("AKIA"), _as_spans(access, "access")).alias("access"),
        _where(text.rlike(f"[0-9a-f]{{{_HEX_LENGTH}}}"), _as_spans(hexes, "hex")).alias("hex"),
        _where(text.rlike(_CANDIDATE), _as_spans(entropy, "entropy")).alias("entropy"),
    )
    base = F.concat("assign", "access", "hex")
    # Exploded from an array of one, so that the spans above are computed once.
    held = found.select("doc_id", "assign", "access", "hex", F.explode(F.array("entropy")).alias("entropy"))
    fresh = F.filter("entropy", lambda x: ~within(x, F.col("base")))
    return (
        held.withColumn("base", base)
        .withColumn("fresh", fresh)
        .select(
            "doc_id",
            *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
            F.size("fresh").cast("long").alias("n_entropy"),
            F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
            _written(F.concat("base", "fresh")).alias("spans"),
        )
    )
