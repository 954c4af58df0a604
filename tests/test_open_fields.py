"""Records as VARIANT beside the fixed columns."""

import json
import os

import pytest

from pluvia.sources import open_fields as OF


def test_unknown_fields_survive_a_round_trip(spark, tmp):
    rows = [(1, '{"a": 1, "new": {"deep": [1, "x"]}, "flag": true}'), (2, '{"a": "text", "new": null}'), (3, None), (4, "{}")]
    df = OF.with_record(spark.createDataFrame(rows, "id int, j string"), "j").drop("j")
    path = os.path.join(tmp, "t")
    df.write.parquet(path)
    got = spark.read.parquet(path).select("id", *OF.fields({
        "a": ("$.a", "int"), "deep": ("$.new.deep[1]", "string"), "flag": ("$.flag", "boolean"), "no": ("$.x.y", "double")}))
    assert sorted(tuple(r) for r in got.collect()) == [
        (1, 1, "x", True, None), (2, None, None, None, None), (3, None, None, None, None), (4, None, None, None, None)]
    with pytest.raises(Exception):
        spark.read.parquet(path).select(*OF.fields({"a": ("$.a", "int")}, strict=True)).collect()
    unknown = {(r.field, r.kind): r.n for r in OF.unknown_fields(spark.read.parquet(path), ["a"]).collect()}
    assert unknown == {("flag", "BOOLEAN"): 1, ("new", "OBJECT<deep: ARRAY<VARIANT>>"): 1, ("new", "VOID"): 1}
    assert "flag" in OF.schema_of(spark.read.parquet(path))


def test_text_that_is_no_json_raises(spark):
    with pytest.raises(Exception):
        OF.with_record(spark.createDataFrame([("{bad",)], "j string"), "j").collect()


def test_open_responses(spark, tmp):
    path = os.path.join(tmp, "p.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"data": [{"daily": {"time": ["2024-01-01"], "soil_moisture": [0.5]}, "_city_meta": {"name": "A"}, "api": 2}, None]}, f)
    got = OF.read_open_responses(spark, path, range_bytes=20)
    assert got.columns == ["daily", "_city_meta", "record"]
    rows = got.select("_city_meta.name", *OF.fields({"soil": ("$.daily.soil_moisture[0]", "double"), "api": ("$.api", "int")})).collect()
    assert sorted(map(tuple, rows), key=str) == [("A", 0.5, 2), (None, None, None)]
