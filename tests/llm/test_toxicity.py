import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.llm import toxicity as T
from pluvia.llm.queries import QUERIES, fold
from tests.llm.cases import SYLLABLES, awkward_rows, empty, frame, words


def corpus(n=600, seed=1):
    """Documents; a sixth hold some of four invented insults with changing endings."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        text = words(seed * 1000 + i, rng.randint(40, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["zzgrok", "wexpuv", "yuvvik", "dwodze"]) + rng.choice(SYLLABLES))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def fit(spark, rows, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    return T.fit(frame(spark, rows), table, fold() != 1, fold() / 2)


def test_backoff_sums_to_one():
    grams = {g for w in words(1, 200) for g in T.word_grams(w)}
    lower = T.shared_backoff(grams)
    letters = {g[-1] for g in lower}
    for h in ("", "a", "o"):
        seen = {g[:-1] for g in lower if len(g) == len(h) + 1}
        if h in seen:
            # Unseen letters share the rest, so the seen ones stay below one.
            assert 0.5 < sum(lower.get(h + x, 0) for x in letters) <= 1 + 1e-9


def test_ratio_matches_the_definition():
    counts = {"^a": (3, 1), "^b": (0, 2), "^ab": (2, 1), "^a$": (1, 0)}
    ratio, backoff = T.log_ratios(counts)
    p = T.shared_backoff(counts)["a"]
    toxic = (3 - 0.75 + 0.75 * 1 * p) / 3
    ordinary = (1 - 0.75 + 0.75 * 2 * p) / 3
    assert ratio["^a"] == pytest.approx(math.log(toxic / ordinary))
    assert backoff["^"] == pytest.approx(math.log((0.75 * 1 / 3) / (0.75 * 2 / 3)))


def test_shared_counts_scale_with_the_toxic_ones():
    assert T.with_shared({"^a": (3, 1), "^b": (0, 2)}) == {"^a": (13, 1), "^b": (20, 2)}
    assert T.with_shared({"^a": (3, 0)}) == {"^a": (3, 0)}


def test_held_out_accuracy_with_unseen_endings(spark):
    rows, labels = corpus()
    got = T.score(frame(spark, rows), fit(spark, rows, labels)).withColumn("held", fold() == 1).collect()
    toxic = dict(labels)
    held = [r for r in got if r.held]
    hit = [r.score >= 0.7 for r in held if toxic[r.doc_id]]
    false = [r.score >= 0.7 for r in held if not toxic[r.doc_id]]
    assert sum(hit) / len(hit) > 0.8 and sum(false) / len(false) < 0.02


def test_scores_equal_the_plain_sum(spark):
    rows, labels = corpus(120, 3)
    model = fit(spark, rows, labels)
    docs = awkward_rows() + [(1000 + i, t) for i, t in rows[:20]]
    got = {r.doc_id: r for r in T.score(frame(spark, docs), model).collect()}
    for i, text in docs:
        found = T._WORD.findall((text or "").lower())
        total = sum(T.word_ratio(w, model.ratio, model.backoff) for w in found)
        if i is not None:
            assert got[i].n_words == len(found)
            assert got[i].log_ratio == pytest.approx(total / max(1, len(found)), abs=1e-9)
        assert 0 <= got[i].score <= 1


def test_whole_table_query(spark):
    got = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01")
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 1000 and all((r.score >= 0.7) == (r.predicted == 1) for r in rows)


def test_held_out_recall_and_precision_of_the_whole_table(spark):
    """The labelled held-out documents of all four languages."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = QUERIES["op5_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted == 1 == r.toxic for r in held)
    assert hits / sum(r.toxic == 1 for r in held) > 0.85
    assert hits / sum(r.predicted == 1 for r in held) > 0.93


def test_the_models_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_GRAMS", 50)
    rows, labels = corpus(200, 5)
    model = fit(spark, rows, labels)
    assert 0 < sum(len(g) > T.SHORT for g in model.ratio) <= 50


@pytest.mark.parametrize("labels,score", [([], 0), ([(1, 0), (2, 0)], 0), ([(1, 1), (2, 1)], 1)])
def test_labels_of_one_class_or_none(spark, labels, score):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, [(1, "some text"), (2, None)])
    got = T.score(docs, T.fit(docs, table, F.lit(True), fold() / 2)).collect()
    assert np.allclose([r.score for r in got], score, atol=1e-6)


def test_null_labels_and_empty_table(spark):
    table = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0), (4, 1)], "doc_id long, toxic int")
    docs = frame(spark, awkward_rows())
    model = T.fit(docs, table, F.lit(True), fold() / 2)
    assert T.score(docs, model).count() == len(awkward_rows())
    assert T.score(empty(spark), model).count() == 0
