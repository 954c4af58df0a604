"""Small documents with the awkward cases every operator must take."""

import random

from pyspark.sql import functions as F

SYLLABLES = "an ber cor dal esh fin gor hul ith jan kel lor mun nar oth pel qui ras sol tur".split()
EXTRA = ["fp", "key", "tile", "digest", "start", "stop", "words", "id", "window", "slots", "task",
         "n_tokens", "n_bytes", "score", "label", "half", "node", "root", "first_id", "__spans"]


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    """Sentences of made-up words, different for each seed."""
    out = words(seed, n)
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(out))


def awkward_rows() -> list[tuple]:
    """(doc_id, text): nulls, blanks, repeats, ties, very long texts, odd characters."""
    return [
        (1, prose(1, 60)), (2, prose(2, 80)), (3, None), (4, ""), (5, " \n\t "), (6, prose(1, 60)),
        (6, prose(1, 60)), (None, prose(3, 40)), (None, None), (7, "x" * 50_000), (8, prose(4, 12_000)),
        (9, "one"), (10, "a b"), (11, "日本語の文章です。" * 40), (12, "é́ Σς İ     <|endoftext|> a\x1cb"),
        (13, "12 34 !! ?? --"), (14, prose(5, 30) + "  \n\n " + prose(6, 30)), (2**62, prose(7, 20)), (-5, "neg id"),
    ]


def frame(spark, rows, lang="en"):
    """documents with further columns whose names operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({
        "lang": F.lit(lang), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(None).cast("string") for c in EXTRA}).repartition(3)


def empty(spark):
    return frame(spark, [])
