"""Catalogue pages as VARIANT."""

import json

from pyspark.sql import functions as F

from gaugelake.schemas import CATALOGUE_ITEM
from gaugelake.sources import payloads, variants

ITEM = {"id": 7, "name": "Quay", "isMobile": False, "coordinates": {"latitude": 44.25, "longitude": 5.0}, "country": {"code": "DE", "name": "Germany"},
        "datetimeFirst": {"utc": "2020-01-01T00:00:00Z"}, "sensors": [{"id": 1, "parameter": {"id": 2, "name": "pm25", "displayName": "PM", "units": "ppm"}}]}


def _pages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_items_are_those_of_the_schema(spark):
    pages = _pages(spark, json.dumps({"results": [ITEM, {"id": 8}]}), "[broken", None, "{}", '{"results": 5}', '{"results": []}')
    got = variants.parse_catalogue_variants(pages)
    assert got.columns == [*CATALOGUE_ITEM.fieldNames(), "raw_json", "unknown_fields"]
    names = CATALOGUE_ITEM.fieldNames()
    want = payloads.parse_catalogue(_pages(spark, json.dumps({"results": [ITEM, {"id": 8}]})))
    assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, want.select(*names).collect()))
    assert [r.unknown_fields for r in got.collect()] == [[], []]


def test_raw_json_depends_on_content_alone(spark):
    backwards = dict(reversed(list(ITEM.items())))
    texts = [json.dumps({"results": [ITEM]}), json.dumps({"results": [backwards]}, indent=3), json.dumps({"results": [{**ITEM, "id": 9}]})]
    raw = [r.raw_json for r in variants.parse_catalogue_variants(_pages(spark, *texts)).collect()]
    assert raw[0] == raw[1] != raw[2]
    assert json.loads(raw[0]) == ITEM


def test_unknown_fields_and_wrong_types(spark):
    odd = {**ITEM, "zeta": [1], "alpha": None, "id": "x", "sensors": "none", "coordinates": {"latitude": "far"}}
    [row] = variants.parse_catalogue_variants(_pages(spark, json.dumps({"results": [odd]}))).collect()
    assert row.unknown_fields == ["alpha", "zeta"] and row.id is None and row.name == "Quay" and row.sensors is None
    assert json.loads(row.raw_json)["zeta"] == [1]
    [number] = variants.parse_catalogue_variants(_pages(spark, '{"results": [5]}')).collect()
    assert number.unknown_fields is None and number.id is None and number.raw_json == "5"


def test_a_payload_is_parsed_once(spark):
    rows = variants.parse_catalogue_variants(_pages(spark, json.dumps({"results": [ITEM]})).repartition(2).filter(F.length("payload") > 1))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") == 1
