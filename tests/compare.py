"""Order-insensitive comparison of a Spark frame with a DuckDB result, names, types and values."""

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return repr(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """Empty list when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    for name, kind in df.dtypes:
        if _KINDS.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} / {kinds[name]}")
    want = canonical(names, cursor.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        problems.append(f"rows {len(got)} / {len(want)}")
    if want != got:
        a, b = set(got), set(want)
        problems.append(f"only Spark: {sorted(a - b)[:2]}; only SQL: {sorted(b - a)[:2]}")
    return problems if problems else ([] if got else ["no rows on either side"])
