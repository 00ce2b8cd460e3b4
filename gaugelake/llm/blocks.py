"""Asking the whole corpus about the keys of one block of documents.

Documents are shuffled once into blocks of bounded size. A round then goes
``block -> shard -> block``: each block sends its sorted distinct keys to the shards that own
their ranges, a shard sees every block's keys of its range and answers each block. A key that
fills a third of the corpus travels once per block, so no shard meets a hot key. All rounds of
an operator form one Spark plan, in which the block shuffle is computed once and reused; lost
executors only cost the recomputation of lost shuffle files, as every step is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import arrays

BLOCK_BYTES = 8 * 1024 * 1024

_REQUEST = "shard int, block int, round int, part int, data binary"
_REQUEST_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("round", pa.int32()), ("part", pa.int32()), ("data", pa.binary())]
)

#: What a block has been told: {round: {shard: answer}}.
Answers = dict[int, dict[int, bytes]]
Send = Callable[[pa.Table, Answers], Iterable[tuple[int, bytes]]]
Reduce = Callable[[list[bytes]], list[bytes]]


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Columns block, doc_id, text (null: empty), clustered by block, and the number of blocks.

    All rows of a doc_id share a block; rows without one are spread by their text.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    base = docs.select(
        F.pmod(spread, F.lit(n)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return base.repartition(n, "block"), n


def _rows(rows: Iterable[tuple]) -> pa.Table:
    rows = list(rows)
    columns = list(zip(*rows, strict=True)) or [[]] * len(_REQUEST_ARROW)
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _REQUEST_ARROW, strict=True)], schema=_REQUEST_ARROW
    )


def told(answers: pa.Table) -> Answers:
    out: Answers = {}
    for r, p, data in zip(*(answers.column(c).to_pylist() for c in ("round", "part", "data")), strict=True):
        out.setdefault(r, {})[p] = data
    return out


def ask(base: DataFrame, send: Send, reduce: Reduce, round_no: int, got: DataFrame | None = None) -> DataFrame:
    """One round. Returns the answers of this and earlier rounds, rows of (block, round, part, data).

    ``send`` yields (shard, request) for a block; ``reduce`` answers a shard's requests, one
    answer each. Earlier answers ride along, so that the plan stays a chain.
    """

    def requests(block: int, docs: pa.Table, answers: Answers) -> pa.Table:
        def every() -> Iterator[tuple]:
            for r, parts in answers.items():
                for p, data in parts.items():
                    yield -1 - block, block, r, p, data
            for shard, data in send(docs, answers):
                yield shard, block, round_no, shard, data

        return _rows(every())

    def first(docs: pa.Table) -> pa.Table:
        return requests(docs.column("block")[0].as_py(), docs, {})

    def later(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _rows([])
        return requests(docs.column("block")[0].as_py(), docs, told(answers))

    def answer(rows: pa.Table) -> pa.Table:
        if rows.column("shard")[0].as_py() < 0:
            return rows.select(_REQUEST_ARROW.names).cast(_REQUEST_ARROW)
        rows = rows.sort_by("block")
        replies = reduce(rows.column("data").to_pylist())
        return rows.set_column(rows.schema.get_field_index("data"), "data", pa.array(replies, pa.binary())).select(
            _REQUEST_ARROW.names
        ).cast(_REQUEST_ARROW)

    if got is None:
        sent = base.groupBy("block").applyInArrow(first, _REQUEST)
    else:
        sent = base.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(later, _REQUEST)
    return sent.groupBy("shard").applyInArrow(answer, _REQUEST)


def finish(base: DataFrame, got: DataFrame, make: Callable[[pa.Table, Answers], pa.Table], schema: str) -> DataFrame:
    """Applies ``make`` to each block and all its answers."""

    def last(docs: pa.Table, answers: pa.Table) -> pa.Table:
        return make(docs, told(answers))

    return base.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(last, schema)


# --- counting keys ---------------------------------------------------------------------


def count_requests(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, bytes]]]:
    """Distinct keys, the place of each key among them, and the requests that tell which occur twice or more."""
    distinct, places, counts = np.unique(keys, return_inverse=True, return_counts=True)
    rows = [
        (s, arrays.pack_keys(distinct[a:b]) + arrays.pack_bits(counts[a:b] > 1))
        for s, a, b in arrays.shard_slices(distinct, shards)
    ]
    return distinct, places, rows


def repeated(requests: list[bytes]) -> list[bytes]:
    """For each request, a bit per key: whether the key occurs twice or more in all requests."""
    keys, often = [], []
    for data in requests:
        k, rest = arrays.unpack_keys(data)
        keys.append(k)
        often.append(arrays.unpack_bits(rest, len(k)))
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.concatenate(often)[order]
    twice[1:] |= same
    twice[:-1] |= same
    # A key sent once per block and more than once within one block: every copy must hear of it.
    group = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(ordered) else np.zeros(0, np.int64)
    hit = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    hit[group[twice]] = True
    flags = np.empty(len(every), bool)
    flags[order] = hit[group]
    ends = np.cumsum([len(k) for k in keys])
    return [arrays.pack_bits(flags[e - len(k) : e]) for k, e in zip(keys, ends, strict=True)]


def answered_bits(distinct: np.ndarray, shards: int, parts: dict[int, bytes]) -> np.ndarray:
    """The bits answered for the distinct keys of a block, in their order."""
    out = np.zeros(len(distinct), bool)
    for s, a, b in arrays.shard_slices(distinct, shards):
        out[a:b] = arrays.unpack_bits(parts[s], b - a)
    return out
