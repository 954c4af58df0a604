"""Raw payload scan and flattening of parallel arrays (generated files)."""

import json
import os

from pluvia.operators.flatten import flatten_payload, safe_get
from pluvia.plans import catalog
from pluvia.sources import files as FS


def city(name, daily):
    meta = {"name": name, "country": "X", "country_code": "XX", "region": "R",
            "latitude": 1.0, "longitude": 2.0, "timezone": "UTC"}
    out = {"_city_meta": meta}
    if daily is not None:
        out["daily"] = daily
    return out


def payload():
    return {
        "extraction_timestamp": "2024-01-17T00:00:00+00:00",
        "total_cities_requested": 6, "total_cities_successful": 5, "total_cities_failed": 1,
        "failed_cities": ["Gone"],
        "data": [
            city("Equal", {"time": ["2024-01-15", "2024-01-16"], "temperature_2m_max": [20.0, 21.0],
                           "weather_code": [0, 61]}),
            city("Short", {"time": ["2024-01-15", "2024-01-16"], "temperature_2m_max": [20.0]}),
            city("Long", {"time": ["2024-01-15"], "temperature_2m_max": [20.0, 99.0, 98.0]}),
            city("NoDaily", None),
            city("NoTime", {"temperature_2m_max": [1.0]}),
        ],
    }


def write_payload(tmp, day="2024/01/17"):
    d = os.path.join(tmp, "raw", day)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "weather_raw.json"), "w", encoding="utf-8") as f:
        json.dump(payload(), f, ensure_ascii=False, indent=2)
    return os.path.join(tmp, "raw")


def test_read_and_flatten(spark, tmp):
    root = write_payload(tmp)
    raw = FS.read_raw(spark, root + "/*/*/*/weather_raw.json", run_date=True)
    head = raw.select("total_cities_failed", "failed_cities", "run_date").first()
    assert head["total_cities_failed"] == 1 and head["failed_cities"] == ["Gone"]
    assert str(head["run_date"]) == "2024-01-17"
    rows = flatten_payload(FS.city_responses(raw)).orderBy("city_name", "date").collect()
    got = [(r["city_name"], r["date"], r["temperature_max"], r["weather_code"]) for r in rows]
    assert got == [
        ("Equal", "2024-01-15", 20.0, 0), ("Equal", "2024-01-16", 21.0, 61),
        ("Long", "2024-01-15", 20.0, None),
        ("Short", "2024-01-15", 20.0, None), ("Short", "2024-01-16", None, None),
    ]
    assert len(rows[0].asDict()) == 21


def test_run_partition_path(spark, tmp):
    import datetime as dt
    import pytest
    root = write_payload(tmp)
    assert FS.run_partition_path(spark, root, dt.date(2024, 1, 17)).endswith("2024/01/17/weather_raw.json")
    assert FS.run_partition_path(spark, "file://" + root, dt.date(2024, 1, 17)).startswith("file://")
    with pytest.raises(FileNotFoundError):
        FS.run_partition_path(spark, root, dt.date(2024, 1, 1))


def test_truncated_document_raises(spark, tmp):
    import pytest
    root = write_payload(tmp)
    path = os.path.join(root, "2024/01/17/weather_raw.json")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    with open(path.replace("weather_raw", "cut"), "w", encoding="utf-8") as f:
        f.write(text[:len(text) // 2])
    with pytest.raises(Exception):
        FS.read_raw(spark, root + "/*/*/*/*.json").collect()


def one_city(spark, tmp, **arrays):
    path = os.path.join(tmp, "one.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"data": [city("Odd", {"time": ["2024-01-15", "2024-01-16"], **arrays})]}, f)
    return flatten_payload(FS.city_responses(FS.read_raw(spark, path))).orderBy("date")


def test_one_odd_cell_is_one_missing_cell(spark, tmp):
    got = one_city(spark, tmp, temperature_2m_max=["bad", 20.5], precipitation_sum=[None, "1.5"],
                   weather_code=[3.0, "61"]).collect()
    assert [(r.temperature_max, r.precipitation_sum, r.weather_code) for r in got] == [(None, None, 3), (20.5, 1.5, 61)]


def test_code_that_is_no_integer_raises(spark, tmp):
    import pytest
    with pytest.raises(Exception):
        one_city(spark, tmp, weather_code=[3.0, 3.5]).collect()


def test_safe_get_past_end(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "a array<double>")
    r = df.select(safe_get("a", 0), safe_get("a", 1), safe_get("a", 2)).first()
    assert list(r) == [1.0, 2.0, None]


def test_land_then_flatten_equals_direct(spark, tmp):
    import datetime as dt
    root = write_payload(tmp)
    raw = FS.read_raw(spark, root + "/2024/01/17/weather_raw.json")
    responses = FS.city_responses(raw)
    failed = raw.selectExpr("explode(failed_cities) AS name")
    out = FS.land_raw(responses, failed, os.path.join(tmp, "landed"), dt.date(2024, 1, 17),
                      dt.datetime(2024, 1, 17, 5))
    landed = FS.read_landed(spark, out["data"], dt.date(2024, 1, 17))
    direct = flatten_payload(responses).collect()
    again = flatten_payload(landed.drop(FS.RUN_DATE)).collect()
    assert sorted(map(tuple, direct), key=str) == sorted(map(tuple, again), key=str)
    assert spark.read.json(out["failed"]).first()["name"] == "Gone"


def test_a_response_holds_many_rows_of_its_entity(spark):
    sf = "/root/testdata/sf0.001"
    got = catalog.payload_responses(spark, sf)
    assert got.count() == got.select("month", "bucket", "_city_meta").distinct().count()
    assert got.selectExpr("sum(size(daily.time))").first()[0] == catalog.X.obs(spark, sf).count()


def test_staged_parts_are_read_by_themselves(spark, tmp):
    df = spark.createDataFrame([("1999", 1), ("2000", 2), ("2000", 3)], "year string, n int")
    kept = FS.stage(df, tmp, ("year",))[0]
    part = kept.where("year = '2000'")
    assert dict(kept.dtypes) == dict(df.dtypes) and sorted(r.n for r in part.collect()) == [2, 3]
    assert all("year=2000" in f for f in part.select("_metadata.file_path").distinct().toPandas()["file_path"])


def test_payload_documents_are_bounded(spark):
    sf, ids = "/root/testdata/sf0.001", 1024
    docs = catalog.payload_documents(spark, sf, ids)
    rows = docs.selectExpr("month", "bucket", "aggregate(data, 0, (n, r) -> n + size(r.daily.time)) as n").collect()
    assert len({(r.month, r.bucket) for r in rows}) == len(rows) > len({r.month for r in rows})
    assert max(r.n for r in rows) <= ids
    assert sum(r.n for r in rows) == catalog.X.obs(spark, sf).count()
