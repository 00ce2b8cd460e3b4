"""Tables that the session catalogue knows: date partitions dropped by name, and tables that switch together.

Everything is a SQL statement or a DataFrame write, so it also works through Spark Connect. Managed
tables own their files: dropping a partition deletes it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import UTC, date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from gaugelake.schemas import conform, enforce_not_null
from gaugelake.sources.tables import PARTITION, RETENTION_DAYS

_DROPPED_AT_ONCE = 500
_NAME = re.compile(r"\w+(\.\w+)*")


def quoted(name: str) -> str:
    """A table's name, possibly with its database, for a SQL statement."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not the name of a table: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def open_database(spark: SparkSession, name: str, location: str) -> None:
    """A database whose managed tables lie under ``location``."""
    path = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)} LOCATION '{path}'")


def create_table(spark: SparkSession, name: str, schema: StructType) -> None:
    """An empty table of this schema, partitioned by date, unless there is one."""
    columns = StructType([*schema.fields]).add(PARTITION, DateType())
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({listed}) USING parquet PARTITIONED BY ({PARTITION})")


def insert(df: DataFrame, name: str, schema: StructType, time_column: str) -> None:
    """Append rows under their dates; a row without a required value fails the insert."""
    rows = enforce_not_null(conform(df, schema), schema).withColumn(PARTITION, F.to_date(time_column))
    rows.hint("rebalance", F.col(PARTITION)).write.mode("append").insertInto(quoted(name))


def table_dates(spark: SparkSession, name: str) -> list[date]:
    """The dates a table has partitions for, ascending, as the catalogue lists them; no data is read."""
    listed = (row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {quoted(name)}").toLocalIterator())
    return sorted(date.fromisoformat(day) for day in listed if not day.startswith("__"))


def drop_dates(spark: SparkSession, name: str, days: list[date]) -> None:
    """Drop these partitions and their files; those that are gone already are passed over."""
    for at in range(0, len(days), _DROPPED_AT_ONCE):
        parts = ", ".join(f"PARTITION ({PARTITION} = DATE '{day}')" for day in days[at : at + _DROPPED_AT_ONCE])
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {parts}")


def expire_dates(
    spark: SparkSession, name: str, days: int = RETENTION_DAYS, as_of: datetime | None = None
) -> list[date]:
    """Drop the partitions whose date is ``days`` or more before ``as_of`` (UTC, default now); returns them.

    Rows without a time are in a partition of their own, which never expires.
    """
    last = (as_of or datetime.now(UTC).replace(tzinfo=None)) - timedelta(days=days)
    old = [day for day in table_dates(spark, name) if datetime.combine(day, datetime.min.time()) <= last]
    drop_dates(spark, name, old)
    return old


class SwitchedTables:
    """Tables that are refreshed in full and change together.

    Each name is a view of the rows of one load, and a single view names that load. A load
    first writes all tables beside the rows in use; then one statement replaces the view that
    names the load. Readers see all tables of one load or of the next, and a load that fails
    half-way changes nothing. Rows of earlier loads go with the next switch but one, so that a
    query under way keeps its files.
    """

    def __init__(self, spark: SparkSession, database: str, names: tuple[str, ...], location: str):
        self.spark, self.database, self.names = spark, database, names
        open_database(spark, database, location)

    def _stored(self, name: str) -> str:
        return f"{self.database}.{name}_loads"

    @property
    def _pointer(self) -> str:
        return quoted(f"{self.database}.current_load")

    def current(self) -> str | None:
        """The load in use, None before the first."""
        if not self.spark.catalog.tableExists(f"{self.database}.current_load"):
            return None
        return self.spark.table(f"{self.database}.current_load").first()[0]

    def _write(self, frames: Mapping[str, DataFrame], load: str) -> None:
        for name in self.names:
            rows = frames[name].withColumn("load_id", F.lit(load))
            if self.spark.catalog.tableExists(self._stored(name)):
                # By name, so that a load may list its columns in another order.
                columns = self.spark.table(self._stored(name)).columns
                rows.select(*columns).write.mode("append").insertInto(quoted(self._stored(name)))
            else:
                rows.write.format("parquet").partitionBy("load_id").saveAsTable(quoted(self._stored(name)))

    def _drop(self, loads: set[str]) -> None:
        for name in self.names:
            if loads and self.spark.catalog.tableExists(self._stored(name)):
                parts = ", ".join(f"PARTITION (load_id = '{load}')" for load in sorted(loads))
                self.spark.sql(f"ALTER TABLE {quoted(self._stored(name))} DROP IF EXISTS {parts}")

    def _loads(self) -> set[str]:
        """Loads of which a table has rows; the names of partitions, of which there are a few."""
        found = set()
        for name in self.names:
            if self.spark.catalog.tableExists(self._stored(name)):
                for row in self.spark.sql(f"SHOW PARTITIONS {quoted(self._stored(name))}").toLocalIterator():
                    found.add(row[0].partition("=")[2])
        return found

    def load(self, frames: Mapping[str, DataFrame]) -> str:
        """Replace the rows of all tables; returns the name of the load."""
        before, load = self.current(), uuid4().hex
        # What an interrupted load left, and the load before the one in use.
        self._drop(self._loads() - {before})
        try:
            self._write(frames, load)
        except Exception:
            self._drop({load})
            raise
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._pointer} AS SELECT '{load}' AS load_id")
        for name in self.names:
            self.spark.sql(
                f"CREATE VIEW IF NOT EXISTS {quoted(f'{self.database}.{name}')} AS SELECT * EXCEPT (load_id) "
                f"FROM {quoted(self._stored(name))} WHERE load_id = (SELECT load_id FROM {self._pointer})"
            )
        return load

    def table(self, name: str) -> DataFrame:
        """The rows of the load in use."""
        if name not in self.names:
            raise KeyError(name)
        return self.spark.table(f"{self.database}.{name}")
