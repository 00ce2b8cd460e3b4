"""Data-quality checks. A check is a frame of violating rows; no rows means it passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from fnmatch import fnmatch
from functools import reduce
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gaugelake.session import importable

VIOLATION_COLUMNS = ("test_name", "entity_id", "expected_value", "actual_value", "reason")
SAMPLES_PER_CHECK = 5

_DETAILS = VIOLATION_COLUMNS[1:]


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("NULL"))


def _entity(keys: Sequence[str]) -> Column:
    return F.concat_ws(":", *[_text(F.col(k)) for k in keys])


def _labelled(pairs: Sequence[tuple[str, Column]]) -> Column:
    return F.concat_ws(",", *[F.concat(F.lit(f"{name}:"), _text(value)) for name, value in pairs])


def violations(
    df: DataFrame, name: str, entity: Column, expected: Column, actual: Column, reason: str
) -> DataFrame:
    return df.select(
        F.lit(name).alias("test_name"),
        entity.cast("string").alias("entity_id"),
        expected.cast("string").alias("expected_value"),
        actual.cast("string").alias("actual_value"),
        F.lit(reason).alias("reason"),
    )


class RowCheck(NamedTuple):
    """A check that each row of a table passes or fails by itself."""

    name: str
    wrong: Column
    entity: Column
    expected: Column
    actual: Column
    reason: str


def row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Violations of several checks of one table, from one scan of it."""

    def violation(check: RowCheck) -> Column:
        details = (check.entity, check.expected, check.actual, F.lit(check.reason))
        values = [v.cast("string").alias(c) for c, v in zip(_DETAILS, details, strict=True)]
        return F.when(check.wrong, F.struct(F.lit(check.name).alias("test_name"), *values))

    some = df.filter(reduce(Column.__or__, [check.wrong for check in checks]))
    found = F.array(*map(violation, checks))
    return some.select(F.inline(F.filter(found, lambda x: x.isNotNull())))


def null_check(
    columns: Sequence[str],
    entity: Sequence[str],
    name: str,
    where: Column | None = None,
    reason: str = "Columns should be NULL",
) -> RowCheck:
    """Rows (of those ``where`` holds) in which one of ``columns`` has a value."""
    wrong = reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])
    return RowCheck(
        name,
        wrong if where is None else where & wrong,
        _entity(entity),
        F.lit(",".join(f"{c}=NULL" for c in columns)),
        _labelled([(c, F.col(c)) for c in columns]),
        reason,
    )


def not_null_check(
    columns: Sequence[str], keys: Sequence[str], name: str, reason: str = "Row should exist with non-NULL values"
) -> RowCheck:
    """Rows with a NULL in ``columns``."""
    wrong = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    return RowCheck(name, wrong, _entity(keys), F.lit("not NULL"), _labelled([(c, F.col(c)) for c in columns]), reason)


def no_rows_check(
    predicate: Column,
    entity: Sequence[str],
    name: str,
    expected: str = "no rows",
    actual: Column | None = None,
    reason: str = "Rows should not exist",
) -> RowCheck:
    """Rows the predicate holds for."""
    got = F.lit("present") if actual is None else actual
    return RowCheck(name, predicate, _entity(entity), F.lit(expected), got, reason)


def members_check(
    column: str, allowed: Sequence, name: str, entity: Sequence[str] | None = None, reason: str = "Value is not allowed"
) -> RowCheck:
    """Rows whose ``column`` is outside ``allowed``; a NULL is not a value."""
    wrong = ~F.col(column).isin(*allowed)
    return RowCheck(name, wrong, _entity(entity or [column]), F.lit(",".join(map(str, allowed))), F.col(column), reason)


def assert_row_count(
    df: DataFrame, keys: Sequence[str], rows: int, name: str, reason: str = "Unexpected number of rows"
) -> DataFrame:
    """Key values that do not occur exactly ``rows`` times."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") != rows)
    return violations(counted, name, _entity(keys), F.lit(rows), F.col("__rows"), reason)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str, reason: str = "Duplicate key") -> DataFrame:
    """Key values that occur more than once."""
    return assert_row_count(df, keys, 1, name, reason)


def assert_expected(
    df: DataFrame,
    expected: DataFrame,
    keys: Sequence[str],
    name: str,
    tolerance: float | None = None,
    reason: str = "Values do not match expected",
) -> DataFrame:
    """Expected rows that are missing or differ; numbers may differ by ``tolerance``."""
    values = [c for c in expected.columns if c not in keys]
    actual = df.select(*keys, *[F.col(v).alias(f"__actual_{v}") for v in values])

    def differs(column: str) -> Column:
        want, got = F.col(column), F.col(f"__actual_{column}")
        if tolerance is None or not isinstance(expected.schema[column].dataType, NumericType):
            return ~want.eqNullSafe(got)
        return (want.isNull() != got.isNull()) | F.coalesce(F.abs(got - want) > tolerance, F.lit(False))

    wanted = _labelled([(v, F.col(v)) for v in values])
    got = _labelled([(v, F.col(f"__actual_{v}")) for v in values])
    both = expected.join(actual.withColumn("__present", F.lit(True)), list(keys), "left")
    present = F.col("__present").isNotNull()
    wrong = ~present | reduce(Column.__or__, map(differs, values), F.lit(False))
    return violations(
        both.filter(wrong), name, _entity(keys), wanted, F.when(present, got).otherwise("missing"), reason
    )


def _without_row(entities: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entities that ``df`` has no row for. Its keys are made distinct before they move."""
    return entities.join(df.select(*keys).distinct(), list(keys), "left_anti")


def assert_null(
    df: DataFrame,
    columns: Sequence[str],
    entity: Sequence[str],
    name: str,
    where: Column | None = None,
    reason: str = "Columns should be NULL",
) -> DataFrame:
    """Rows (of those ``where`` holds) in which one of ``columns`` has a value."""
    return row_checks(df, [null_check(columns, entity, name, where, reason)])


def assert_not_null(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    name: str,
    entities: DataFrame | None = None,
    reason: str = "Row should exist with non-NULL values",
) -> DataFrame:
    """Entities without a row, or with a NULL in ``columns``."""
    wrong = df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns])).select(*keys, *columns)
    if entities is not None:
        wrong = wrong.join(entities.select(*keys).distinct(), list(keys), "left_semi")
    found = violations(
        wrong, name, _entity(keys), F.lit("not NULL"), _labelled([(c, F.col(c)) for c in columns]), reason
    )
    if entities is None:
        return found
    absent = _without_row(entities.select(*keys), df, keys)
    return found.unionByName(
        violations(absent, name, _entity(keys), F.lit("not NULL"), F.lit("missing"), reason)
    )


def assert_no_rows(
    df: DataFrame,
    predicate: Column,
    entity: Sequence[str],
    name: str,
    expected: str = "no rows",
    actual: Column | None = None,
    reason: str = "Rows should not exist",
) -> DataFrame:
    """Rows the predicate holds for."""
    return row_checks(df, [no_rows_check(predicate, entity, name, expected, actual, reason)])


def assert_members(
    df: DataFrame,
    column: str,
    allowed: Sequence,
    name: str,
    entity: Sequence[str] | None = None,
    reason: str = "Value is not allowed",
) -> DataFrame:
    """Rows whose ``column`` is outside ``allowed``."""
    return row_checks(df, [members_check(column, allowed, name, entity, reason)])


_FOUND = "test_name string, violations long, samples array<struct<" + ",".join(f"{c}:string" for c in _DETAILS) + ">>"


def _counted(batches):
    """Per check the number of its violations in a task and the first few of them; a task holds no more."""
    import heapq

    import pyarrow as pa

    def order(row):
        return [(value is not None, value or "") for value in row]

    counts: dict[str, int] = {}
    first: dict[str, list] = {}
    for batch in batches:
        rows: dict[str, list] = {}
        names, *details = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for name, *row in zip(names, *details, strict=True):
            rows.setdefault(name, []).append(row)
        for name, found in rows.items():
            counts[name] = counts.get(name, 0) + len(found)
            first[name] = heapq.nsmallest(SAMPLES_PER_CHECK, [*first.get(name, []), *found], key=order)
    samples = [[dict(zip(_DETAILS, row, strict=True)) for row in first[name]] for name in counts]
    shape = pa.list_(pa.struct([(c, pa.string()) for c in _DETAILS]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()), pa.array(samples, shape)],
        names=["test_name", "violations", "samples"],
    )


def dq_report(
    spark: SparkSession,
    checks: Mapping[str, DataFrame | Callable[[], DataFrame]],
    only: str | None = None,
    tables: Sequence[tuple[DataFrame | Callable[[], DataFrame], Sequence[RowCheck]]] = (),
) -> DataFrame:
    """One row per check: ``test_name, status, violations, samples, error_message``.

    All checks run as one Spark job. ``tables`` lists tables with checks of their rows: all checks of
    one table are answered by one scan of it. ``checks`` are frames of violations, each computed once.
    ``samples`` are a check's first five violations in the order of their columns, equal
    ones included. Spark has no aggregate that keeps the first few rows, so the map tasks reduce
    violations, and only these, in Python to a count and five rows per check; a check may
    have any number of violations. A check that cannot be planned is an ``error``.
    """

    def wanted(name: str) -> bool:
        return only is None or fnmatch(name, only)

    frames, errors, names_ = [], {}, []
    for name, check in sorted(checks.items()):
        if wanted(name):
            names_.append(name)
            try:
                frame = check() if callable(check) else check
                frames.append(frame.select(F.lit(name).alias("test_name"), *_DETAILS))
            except PySparkException as problem:
                errors[name] = str(problem)
    for table, listed in tables:
        kept = [check for check in listed if wanted(check.name)]
        names_ += [check.name for check in kept]
        planned = []
        for check in kept:
            try:
                df = table() if callable(table) else table
                row_checks(df, [check])
                planned.append(check)
            except PySparkException as problem:
                errors[check.name] = str(problem)
        if planned:
            frames.append(row_checks(df, planned))
    if len(set(names_)) < len(names_):
        raise ValueError("two checks have one name")
    names = spark.createDataFrame(
        [(name, errors.get(name)) for name in sorted(names_)], "test_name string, error_message string"
    )
    if not frames:
        counted = spark.createDataFrame([], _FOUND)
    else:
        importable(spark)
        every = reduce(DataFrame.unionByName, frames).mapInArrow(_counted, _FOUND)
        counted = every.groupBy("test_name").agg(
            F.sum("violations").alias("violations"),
            F.slice(F.sort_array(F.flatten(F.collect_list("samples"))), 1, SAMPLES_PER_CHECK).alias("samples"),
        )
    return (
        names.join(counted, "test_name", "left")
        .select(
            "test_name",
            F.when(F.col("error_message").isNotNull(), "error")
            .when(F.col("violations") > 0, "failed")
            .otherwise("passed")
            .alias("status"),
            F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"),
            "samples",
            "error_message",
        )
        .orderBy("test_name")
    )


def dq_totals(report: DataFrame) -> DataFrame:
    """Totals over the checks, and ``passed`` only if none failed or broke."""
    bad = F.count_if(F.col("status") != "passed")
    return report.agg(
        F.count(F.lit(1)).alias("tests_total"),
        F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.when(bad > 0, "failed").otherwise("passed").alias("status"),
    )


def run_checks(
    spark: SparkSession,
    checks: Mapping[str, DataFrame | Callable[[], DataFrame]],
    only: str | None = None,
    stop_on_first_failure: bool = False,
) -> list[dict]:
    """Run the checks and fetch the report (a row per check, at most five samples each).

    All run in one job. If that job breaks, or a stop at the first failure is asked
    for, the checks run one by one, so the error lands on the check that caused it.
    """
    if not stop_on_first_failure:
        try:
            return [row.asDict(recursive=True) for row in dq_report(spark, checks, only).toLocalIterator()]
        except PySparkException:
            pass
    results = []
    for name, check in sorted(checks.items()):
        if only is not None and not fnmatch(name, only):
            continue
        try:
            result = dq_report(spark, {name: check}).first().asDict(recursive=True)
        except PySparkException as problem:
            result = {
                "test_name": name,
                "status": "error",
                "violations": 0,
                "samples": None,
                "error_message": str(problem),
            }
        results.append(result)
        if stop_on_first_failure and result["status"] != "passed":
            break
    return results
