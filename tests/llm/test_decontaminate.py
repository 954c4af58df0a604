import re

import pytest

from pluvia.llm import decontaminate as D
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose

SF = "/root/testdata/sf0.01"


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_words_are_typed():
    kinds = {w: D.classify(w)[:2] for w in ("Apples,", "3,400.5", "kg", "$5", "twelve", "--", "12%", "Don't")}
    assert kinds == {"Apples,": ("apples", 0), "3,400.5": ("3,400.5", 1), "kg": ("kg", 2), "$5": ("$5", 1),
                     "twelve": ("twelve", 1), "--": ("", 9), "12%": ("12%", 1), "Don't": ("don't", 0)}


def test_names_only_inside_sentences():
    _, kind, _, _ = D.canonical("Then Anna gave Bob three apples. Bob thanked her\nAnna left")
    assert kind.tolist() == [0, 3, 0, 3, 1, 0, 0, 0, 0, 0, 0]


QUESTION = "If Anna buys 12 apples and gives Bob 5 of them, how many apples does Anna still have in her basket today?"


@pytest.mark.parametrize("text,leak,verbatim", [
    (QUESTION, True, True),
    (QUESTION.upper().replace("ANNA", "Anna").replace("BOB", "Bob"), True, True),
    (QUESTION.replace("Anna", "Clara").replace("Bob", "Otto").replace("12", "31").replace(" 5 ", " 7 "), True, False),
    # Anna is two people here: the slots are not consistent.
    (QUESTION.replace("Anna", "Clara", 1).replace("12", "9"), False, None),
    ("If Anna buys 12 pears then the whole story goes on in a wholly different way", False, None),
])
def test_reparameterised_questions(spark, text, leak, verbatim):
    rows = [(1, f"{prose(1, 50)} {text} {prose(2, 50)}"), (2, prose(3, 100))]
    got = D.leaks(frame(spark, rows), bench(spark, [QUESTION, prose(9, 40)])).collect()
    assert [(r.doc_id, r.item_id) for r in got] == ([(1, 0)] if leak else [])
    assert not leak or got[0].verbatim is verbatim


def test_whole_documents_table_equals_brute_force(spark):
    def plain(text):
        return re.findall(r"\w+", (text or "").lower())

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = plain(r.text)
        for k in range(len(w) - 7):
            items.setdefault(tuple(w[k:k + 8]), set()).add((r.item_id, len(w) - 7))
    want = set()
    for r in docs:
        w, hit = plain(r.text), {}
        for k in range(len(w) - 7):
            for item in items.get(tuple(w[k:k + 8]), ()):
                hit.setdefault(item, set()).add(tuple(w[k:k + 8]))
        want |= {(r.doc_id, i) for (i, n), found in hit.items() if len(found) >= 0.5 * n}
    got = QUERIES["op3_decontaminate"](spark, SF).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)


def test_awkward_rows_and_short_items(spark):
    items = ["a b", None, "", "!!", "four words only here", prose(1, 60)]
    docs = frame(spark, awkward_rows() + [(70, "xx four words only here yy"), (71, "three words only")])
    got = D.leaks(docs, bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 5), (6, 5), (70, 4)} and len(got) == 3


def test_items_without_template_windows(spark):
    items = ["12 kg + 30 kg = 42 kg or 7 % of 600 kg", "roll Anna Bob Clara Dora Emil Fritz Greta Hugo Ida", "中国的首都是哪一座城市",
             "which\tplanet\tis\tthe\tlargest\tone\tof\tall\tplanets"]
    rows = [(i, f"{prose(20 + i, 30)} {text} {prose(40 + i, 30)}") for i, text in enumerate(items)]
    rows += [(12, f"文章{items[2]}吗，是的"), (13, rows[3][1].replace("\t", " ")), (14, rows[0][1].replace("30 kg", "31 kg")),
             (15, "城市的中国是哪一座首都")]
    got = D.leaks(frame(spark, rows), bench(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 0), (1, 1), (2, 2), (3, 3), (12, 2), (13, 3)} and len(got) == 6
    assert all(r.verbatim and r.occurrences == 1 for r in got)


@pytest.mark.parametrize("item,texts", [
    ("What is the capital of France?", ["1) What is the capital of France?", "asked What is the capital of France?",
                                        "what is the capital of france", "WHAT IS THE CAPITAL OF FRANCE?",
                                        "What is the capital of\nFrance?"]),
    ("How far is Bonn from Cologne?", ["how far is bonn from cologne?", "HOW FAR IS BONN FROM COLOGNE?"]),
    (QUESTION, [QUESTION.lower(), QUESTION.upper(), f"12. {QUESTION}", QUESTION.replace(" ", "\n"),
                QUESTION.replace(" ", "\t")]),
])
def test_copies_match_whatever_their_capitals(spark, item, texts):
    rows = [(i, f"{prose(60 + i, 20)} {text} {prose(80 + i, 20)}") for i, text in enumerate(texts)]
    got = D.leaks(frame(spark, rows), bench(spark, [item])).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    assert all(r.verbatim and r.coverage >= 0.99 for r in got)


def test_excerpts_of_long_items(spark):
    item = prose(9, 400).split(" ")
    rows = [(i, f"{prose(100 + i, 30)} {' '.join(item[50:50 + n])} {prose(200 + i, 30)}")
            for i, n in enumerate([12, 13, 20, 190])]
    # Two runs of 10 words are no run of 13.
    rows += [(9, f"{' '.join(item[:10])} {prose(300, 9)} {' '.join(item[30:40])}")]
    got = D.leaks(frame(spark, rows), bench(spark, [" ".join(item)])).collect()
    assert {r.doc_id: round(r.coverage * 393) for r in got} == {1: 6, 2: 13, 3: 183}
    assert all(r.verbatim for r in got)


def test_empty_tables(spark):
    assert D.leaks(empty(spark), bench(spark, [QUESTION])).count() == 0
    none = D.leaks(frame(spark, [(1, QUESTION)]), bench(spark, []))
    assert none.count() == 0 and none.columns == ["doc_id", "item_id", "coverage", "occurrences", "verbatim"]
