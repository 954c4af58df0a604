"""The split payload reader against the whole-document reader and the json library."""

import json
import os
import random

import pytest

from pluvia.sources import files as FS
from pluvia.sources import payload as PL


def response(rng, i):
    odd = ["plain", 'quote " inside', "brackets ]}{[ ,", "back\\slash\\", 'both \\" ,', "é日\U0001f600", "", "a" * 50]
    n = rng.randint(0, 4)
    return {"daily": {"time": [f"2024-01-{j + 1:02d}" for j in range(n)],
                      "temperature_2m_max": [rng.choice([1.0, 1e3, -0.5, None, 12]) for _ in range(n)]},
            "_city_meta": {"name": f"{rng.choice(odd)} {i}", "country": rng.choice(odd)}}


def document(seed, n, **more):
    rng = random.Random(seed)
    head = {"extraction_timestamp": 'x "data": [1, 2] y', "failed_cities": ["a", "data", "]"], "total_cities_failed": 2}
    data = {"data": [response(rng, i) for i in range(n)]}
    return {**data, **head, **more} if seed % 2 else {**head, **more, **data}


def write(tmp, name, text):
    path = os.path.join(tmp, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def rows_of(df):
    return sorted((repr(r) for r in df.collect()))


@pytest.mark.parametrize("size,block", [(1 << 20, 1 << 20), (701, 64), (97, 1000), (13, 5)])
def test_equals_the_whole_document_reader(spark, tmp, size, block):
    for i, (seed, n, indent) in enumerate([(1, 12, None), (2, 9, 2), (3, 0, None), (4, 1, 1)]):
        write(tmp, f"raw/2024/01/{i + 10}/weather_raw.json", json.dumps(document(seed, n), indent=indent, ensure_ascii=seed == 1))
    path = tmp + "/raw/*/*/*/*.json"
    whole = FS.city_responses(FS.read_raw(spark, path, run_date=True), keep=(FS.RUN_DATE,))
    split = PL.read_responses(spark, path, run_date=True, range_bytes=size, block=block)
    assert split.columns == whole.columns and split.count() == 22
    assert rows_of(split) == rows_of(whole)


def test_one_document_is_read_by_many_tasks(spark, tmp):
    path = write(tmp, "one.json", json.dumps(document(5, 300)))
    split = PL.read_responses(spark, path, range_bytes=2000)
    assert split.rdd.getNumPartitions() == pytest.approx(os.path.getsize(path) / 2000, abs=2)
    assert split.count() == 300


def test_a_task_reads_ranges_of_many_small_documents(spark, tmp):
    for i in range(20):
        write(tmp, f"many/{i}.json", json.dumps(document(i, 12)))
    one = PL.read_responses(spark, tmp + "/many", range_bytes=1000)
    many = PL.read_responses(spark, tmp + "/many", range_bytes=1000, task_bytes=10_000)
    total = sum(os.path.getsize(f"{tmp}/many/{i}.json") for i in range(20))
    assert many.rdd.getNumPartitions() <= total / 9000 + 1 < one.rdd.getNumPartitions() / 5
    assert rows_of(many) == rows_of(one) and many.count() == 240


def test_dealt_keeps_every_range_and_parts_documents():
    ranges = [(f"p{i}", at, at + 10) for i in range(50) for at in (0, 10, 20)]
    tasks = PL.dealt(ranges, 100)
    assert sorted(r for t in tasks for r in t) == sorted(ranges) and len(tasks) == 15
    assert all(len({r[0] for r in t}) == len(t) for t in tasks)
    assert PL.dealt(ranges, 0) == [[r] for r in sorted(ranges)] and PL.dealt([], 100) == []


def test_a_range_reads_little_beyond_its_end(tmp, monkeypatch):
    text = json.dumps(document(1, 4000))
    path, read = write(tmp, "far.json", text), []
    blocks = PL._blocks

    def counted(*args):
        for at, data in blocks(*args):
            read.append(len(data))
            yield at, data

    monkeypatch.setattr(PL, "_blocks", counted)
    low = text.index("[")
    assert list(PL.records(path, 0, 2000, False, 0, low, text.rindex("]", 0, text.index('"extraction_timestamp"'))))
    assert sum(read) <= 2000 + PL._TAIL < len(text) / 2


def test_headers(spark, tmp):
    for i in (6, 7):
        write(tmp, f"h/{i}.json", json.dumps(document(i, 40), indent=1))
    got = PL.read_headers(spark, tmp + "/h", range_bytes=100)
    want = FS.read_raw(spark, tmp + "/h").drop("data")
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_documents_without_rows(spark, tmp):
    for i, text in enumerate(['{"data": []}', '{"data": [ \n ]}', '{"data": null}', '{"failed_cities": ["x"]}', " \n ",
                              '{"x": {"data": [{"daily": null}]}}', '{"x\\"data": [1]}', '{"data": {"data": [1]}}'][:7]):
        write(tmp, f"none/{i}.json", text)
    assert PL.read_responses(spark, tmp + "/none", range_bytes=4).count() == 0


def test_null_elements_are_rows_of_nulls(spark, tmp):
    path = write(tmp, "n.json", '{"data": [null, {"_city_meta": {"name": "A"}} , null]}')
    whole = FS.city_responses(FS.read_raw(spark, path))
    assert rows_of(PL.read_responses(spark, path, range_bytes=3)) == rows_of(whole)


TEXT = json.dumps(document(8, 6))


@pytest.mark.parametrize("text", [
    TEXT[:len(TEXT) // 2], TEXT[:-1], TEXT.replace('"data": [', '"data": [,', 1), '{"data": [{"daily": 1,}]}', '{"data": [{}, ]}',
    '{"data": [{"daily": {"time": [1, 2}}]}', '{"data": [1, 2]}', '{"data": []} , "x": "', '{"data": [], "data": []}',
    '[{"data": []}]', '{"x" 1, "data": [{}]}'])
def test_malformed_documents_raise(spark, tmp, text):
    path = write(tmp, "bad.json", text)
    with pytest.raises(Exception):
        PL.read_responses(spark, path, range_bytes=50).collect()


def test_marks_know_escapes_across_blocks():
    text = json.dumps({"a": ['\\', '\\\\"', '"\\', "[", {"b,": ["]", "\\\\\\"]}], "c": "\\" * 9}).encode()
    whole = PL.Marks(text, False)
    for size in (1, 2, 3, 7):
        quoted, escaped, depth, got = False, False, 0, []
        for at in range(0, len(text), size):
            marks = PL.Marks(text[at:at + size], escaped)
            place, byte, after = marks.outside(quoted, depth)
            got += [(int(p) + at, int(b), int(d)) for p, b, d in zip(place, byte, after)]
            depth = int(after[-1]) if len(after) else depth
            quoted, escaped = quoted ^ bool(marks.quotes & 1), marks.escaped
        assert got == [tuple(map(int, x)) for x in zip(*whole.outside(False, 0))] and depth == 0 and not quoted
