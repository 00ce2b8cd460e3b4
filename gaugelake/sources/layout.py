"""Layout of files along a curve through several columns, so that a filter on any of them skips files.

Each column is cut into ranges of about equal weight. A row's place on the curve interleaves the
bits of its range numbers (a Z-order): rows near each other on the curve are near in every
column, and a file, which holds a stretch of the curve, has narrow limits in all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from gaugelake.sources.tables import PARTITION, TableSpec

_PREFIX = 7  # bytes of a string that order it; they fit into a long


def ordered_number(df: DataFrame, column: str) -> Column:
    """A number that orders a column as its values do; strings by their first bytes, NULL as NULL."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        padded = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, _PREFIX)), 2 * _PREFIX, "0")
        return F.conv(padded, 16, 10).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, NumericType):
        return value.cast("double")
    raise TypeError(f"{column} has no order to lay out by: {kind.simpleString()}")


def range_limits(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[float]]:
    """Ascending limits between the ranges of each column, at most 2 ** bits - 1: one bounded row, from one pass."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(ordered_number(df, c), shares, 10_000).alias(f"limits_{i}") for i, c in enumerate(columns)]).first()
    # A value as frequent as several ranges is the limit of all of them; it gets one of its own.
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(columns)}


def _range_number(number: Column, limits: list[float]) -> Column:
    """How many limits are below a number."""
    if not limits:
        return F.lit(0)
    return F.when(number.isNotNull(), F.size(F.filter(F.array(*map(F.lit, limits)), lambda v: v < number)))


def z_place(df: DataFrame, limits: dict[str, list[float]], bits: int) -> Column:
    """A row's place on the curve; a NULL is in the first range of its column."""
    place = F.lit(0).cast("bigint")
    for at, (column, values) in enumerate(limits.items()):
        number = ordered_number(df, column)
        held = F.coalesce(_range_number(number, values), F.lit(0)).cast("bigint")
        for bit in range(bits):
            taken = F.shiftright(held, bit).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(taken, bit * len(limits) + at))
    return place


def along_curve(df: DataFrame, columns: Sequence[str], bits: int = 5, partitions: int | None = None) -> DataFrame:
    """The rows dealt and sorted by their place on the curve through ``columns``.

    The limits of the ranges are found in a pass of their own over these columns. By default the
    number of partitions is that of the session's shuffles, merged by adaptive execution.
    """
    if len(columns) * bits > 62:
        raise ValueError("the places do not fit into 62 bits")
    placed = df.withColumn("__place", z_place(df, range_limits(df, columns, bits), bits))
    dealt = placed.repartitionByRange("__place") if partitions is None else placed.repartitionByRange(partitions, "__place")
    return dealt.sortWithinPartitions("__place").drop("__place")


def rewrite_along_curve(
    rows: DataFrame, table: TableSpec, columns: Sequence[str], bits: int = 5, rows_per_file: int = 0, row_group_bytes: int | None = None
) -> None:
    """Write rows under their dates, along the curve within each date; for a compaction of a date or a whole table.

    Dates of the table that the rows have are replaced, others stay. The rows must not come from the files of those dates.
    """
    dated = rows.withColumn(PARTITION, F.to_date(table.time_column))
    placed = dated.withColumn("__place", z_place(dated, range_limits(dated, columns, bits), bits))
    writer = (
        placed.repartitionByRange(PARTITION, "__place")
        .sortWithinPartitions(PARTITION, "__place")
        .drop("__place")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(PARTITION).parquet(table.path)
