import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.llm import langid as L
from pluvia.llm.queries import QUERIES, fold
from tests.llm.cases import awkward_rows, empty, frame

SF = "/root/testdata/sf0.01"


def naive_grams(text):
    """Every 3- and 4-gram over letters and word ends, with no word end inside."""
    s = [c if c.isalpha() else " " for c in text.lower()]
    s = [" ", *s, " "]
    return sum(1 for n in (3, 4) for i in range(len(s) - n + 1) if all(c != " " for c in s[i + 1:i + n - 1]))


def test_grams_match_a_plain_count():
    texts = ["Hello, big WORLD", "", "a", "ab 12 cd!", "İß ñandú"]
    hashes, owner = L.grams(texts)
    assert len(hashes) == len(owner)
    assert np.bincount(owner, minlength=5).tolist() == [naive_grams(t) for t in texts]
    alone = [np.sort(L.grams([t])[0]) for t in texts]
    assert all(np.array_equal(np.sort(hashes[owner == i]), alone[i]) for i in range(5))


def test_cut_texts_give_the_same_grams(monkeypatch):
    texts = ["Añb cd.e日本 " * 40, "", "İΣ" * 30, "x", " ", "abc" * 100]
    whole = [sorted(L.grams([t])[0].tolist()) for t in texts]
    for size in (5, 16, 101):
        monkeypatch.setattr(L, "STRETCH", size)
        hashes, owner = L.grams(texts)
        assert [sorted(hashes[owner == i].tolist()) for i in range(len(texts))] == whole


def test_memory_does_not_grow_with_a_text():
    def peak(text):
        tracemalloc.start()
        for _ in L.gram_blocks([text]):
            pass
        return tracemalloc.get_traced_memory()[1], tracemalloc.stop()

    L._letters()
    small, large = peak("some words " * 50_000)[0], peak("some words " * 1_000_000)[0]
    assert large - small < 5 * 11 * 950_000  # the text's own copies, no arrays


def test_more_languages_than_a_mask_has_bits(spark):
    rows = [(10 * i + j, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26)}qz"] * 5)) for i in range(70) for j in range(3)]
    docs = spark.createDataFrame([(i, t, f"l{i // 10:02d}") for i, t in rows], "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True))
    assert len(model.languages) == 70 and model.table.shape == (2, L.SLOTS)
    got = L.predict(docs, model).collect()
    assert all(r.lang_pred == f"l{r.doc_id // 10:02d}" for r in got)


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    return QUERIES["op4_langid"](spark, SF).join(docs, "doc_id").collect()


def test_held_out_accuracy(predicted):
    held = [r for r in predicted if r.held_out]
    assert len(held) > 200 and len(predicted) == 1000
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in predicted)


def test_awkward_rows_and_unknown(spark):
    train = frame(spark, [(i, "the cat and the dog went over the river bank") for i in range(9)]).unionByName(
        frame(spark, [(i + 20, "der hund und die katze gingen durch das wasser") for i in range(9)], "de")).unionByName(
        frame(spark, [(77, None)], None)).unionByName(frame(spark, [(78, "zzz")], None))
    model = L.fit(train, fold() != 1)
    assert model.languages == ["de", "en"]
    docs = frame(spark, awkward_rows() + [(30, "The dog and the cat")])
    got = L.predict(docs, model).collect()
    assert len(got) == len(awkward_rows()) + 1
    by = {r.doc_id: r for r in got}
    assert by[30].lang_pred == "en" and by[30].score > 0.5
    for i in (3, 4, 5, 13):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    kept = L.accepted(docs, model, 0.1)
    assert kept.columns == docs.columns
    assert 30 in {r.doc_id for r in kept.collect()} and not {3, 4, 5, 13} & {r.doc_id for r in kept.collect()}


def test_empty_tables(spark):
    model = L.fit(empty(spark), F.lit(True))
    assert model.languages == []
    assert L.predict(empty(spark), model).count() == 0
    assert {r.lang_pred for r in L.predict(frame(spark, [(1, "abc")]), model).collect()} == {"und"}


def test_false_positives_are_corrected():
    model = L.LanguageModel(["a", "b"], np.full(L.SLOTS, 2, np.uint8), np.array([0.0, 1.0]))
    names, _, coverage = L.score_texts(["nothing is known here"], model)
    assert names == ["a"] and coverage[0] == 0  # a filter that holds everything tells nothing
