"""Payloads as VARIANT: parsed once, read by path, with what no schema names still at hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugelake.schemas import CATALOGUE_ITEM


def page_items(pages: DataFrame, payload: str = "payload", path: str = "$.results") -> DataFrame:
    """One row per element of the array at ``path``: ``item``. A page that is no JSON, or has no array there, has none."""
    parsed = pages.select(F.try_parse_json(payload).alias("page"))
    return parsed.select(F.explode(F.try_variant_get("page", path, "array<variant>")).alias("item"))


def typed(item: Column, schema: StructType) -> Column:
    """The fields of a schema; a field that is absent or of another type is NULL, without harm to the others."""
    return F.struct(*[F.try_variant_get(item, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def unknown_fields(item: Column, schema: StructType) -> Column:
    """The names at the top of an item that the schema does not have, sorted; NULL for what is no object."""
    names = F.map_keys(F.try_variant_get(item, "$", "map<string,variant>"))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    return F.array_sort(F.filter(names, lambda name: ~F.array_contains(known, name)))


def canonical_json(item: Column) -> Column:
    """The item as JSON text that depends on its content alone: keys in order, no white space, numbers in one form."""
    return F.to_json(item)


def parse_catalogue_variants(pages: DataFrame) -> DataFrame:
    """Catalogue pages (``payload``) to one typed row per item, as ``parse_catalogue`` gives them.

    ``raw_json`` is the canonical text of the source object, so equal objects have equal texts however
    they were written, and ``unknown_fields`` names what the schema does not know. Each payload
    is parsed once.
    """
    item = F.col("item")
    return (
        page_items(pages)
        .select(
            typed(item, CATALOGUE_ITEM).alias("fields"),
            canonical_json(item).alias("raw_json"),
            unknown_fields(item, CATALOGUE_ITEM).alias("unknown_fields"),
        )
        .select("fields.*", "raw_json", "unknown_fields")
    )
