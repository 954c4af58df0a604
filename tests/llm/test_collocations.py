import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pluvia.llm import collocations as C
from pluvia.llm.queries import q_collocations
from tests.llm.cases import awkward_rows, empty, frame, prose

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        rows, longer = [], Counter()  # the largest count of a longer candidate around each phrase
        for q, b in found.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    longer[q[i:i + k]] = max(longer[q[i:i + k]], b)
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(df, **kw):
    got = C.collocations(df, **kw)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def sentences(seed, n):
    rng = random.Random(seed)
    words = ["the", "Of", "and", "x", "été", "日本", "a\x01", "a", "b", "|"]
    out = []
    for _ in range(n):
        parts = [rng.choice(words) if rng.random() < 0.6 else "fixed phrase of five words" for _ in range(rng.randint(1, 30))]
        out.append("".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!? "]) for p in parts))
    return out


@pytest.mark.parametrize("budget,block", [(500_000, 4 << 20), (40, 300), (300, 1000), (5, 64)])
def test_equals_brute_force_for_groups_of_all_three_kinds(spark, budget, block):
    rows = [(("en", "fr", None)[i % 3], t) for i, t in enumerate(sentences(budget, 120))]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert mined(df, min_count=6, budget=budget, block_bytes=block) == brute(rows, 6)


def test_one_phrase_for_a_third_of_all_words(spark):
    rows = [("en", "hot words here again now " * 40 if i % 3 else prose(i, 100)) for i in range(60)]
    assert mined(spark.createDataFrame(rows, "lang string, text string").repartition(4), min_count=5, budget=50,
                 block_bytes=500) == brute(rows, 5)


def test_awkward_texts_and_columns(spark):
    rows = [("en", t) for _, t in awkward_rows()] * 2
    df = frame(spark, [(i, t) for i, (_, t) in enumerate(rows)]).withColumns(
        {c: F.lit(1) for c in ("grp", "whole", "phrase", "n", "f", "a", "rank", "word", "h")})
    assert mined(df, min_count=2) == brute(rows, 2)


def test_top_and_ties_by_bytes(spark):
    rows = [("en", f"{w} zz,") for w in ("é", "e", "z", "Z", "日", "\x7f", "€") for _ in range(4)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df, min_count=4, top=3) == brute(rows, 4, top=3)


def test_products_past_64_bits(spark, monkeypatch):
    big = 4_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a b", big), ("en", "a", big), ("en", "b", big + 1)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 10 * big)], "lang string, n long")
    monkeypatch.setattr(C, "phrase_counts", lambda *a: (counts, totals))
    got = C.collocations(empty(spark)).collect()[0]
    assert got.score == 1000 * big * 10 * big // (big * (big + 1))


def test_empty_table(spark):
    assert C.collocations(empty(spark)).count() == 0


def test_bit_map_has_every_hash(spark):
    hashes = [random.Random(i).getrandbits(63) - (1 << 62) for i in range(500)]
    df = spark.createDataFrame([(h,) for h in hashes], "h long")
    m = C.BitMap(C.bit_map(df, C.map_bits(500)))
    assert all(h % (1 << 64) in m for h in hashes)
    assert sum(random.Random(10_000 + i).getrandbits(64) in m for i in range(2000)) < 100


def test_blocks_cover_a_text_once_with_context():
    text = ("A bC  d, e\tf " * 50 + "\n" + "x" * 400 + " y z").encode()
    for limit in (1, 10, 97, 10_000):
        parts = list(C.blocks([text, b"", b"last one"], limit))
        whole = b"\n".join([text, b"", b"last one"]).translate(C._TABLE)
        assert b"".join(b[:own] for b, own in parts) == whole


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in q_collocations(spark, sf).collect()) == brute(rows, 100)
