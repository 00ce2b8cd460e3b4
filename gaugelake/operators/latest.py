"""Newest-version selection, the core of append-only tables with repeated deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

_RANK = "__latest_rank"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the one that sorts last by ``newest_by``; all columns are kept.

    Ties are settled by ``tie_break``, by default all remaining columns, so the
    result does not depend on the order of the input.

    Spark plans this as a group limit before and after the shuffle, so a key with
    any number of copies ships at most one row per map task. List a time column
    first in ``keys`` where there is one: it is the fastest sort prefix.
    """
    if tie_break is None:
        taken = {*keys, *newest_by}
        tie_break = [
            f.name
            for f in df.schema.fields
            if f.name not in taken and not isinstance(f.dataType, (MapType, VariantType))
        ]
    order = [F.desc_nulls_last(c) for c in (*newest_by, *tie_break)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).drop(_RANK)


def newest(order: Sequence[str], when: Column | None = None) -> Column:
    """Aggregate: the struct of ``order`` columns that sorts last, NULLs lowest.

    As an aggregate it is combined on the map side and needs no window, and several
    of them (one per pollutant, say) share a single shuffle.
    """
    row = F.struct(*order)
    return F.max(row if when is None else F.when(when, row))
