import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from pluvia.llm import simhash
from pluvia.llm.common import staged
from tests.llm.cases import awkward_rows, frame
from tests.llm.test_simhash import plain_components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns over the whole documents table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        out.append((docs, staged(stage(spark, docs, SF), name)))
        docs = out[-1][1]
    return out


def test_stages_are_registered():
    assert len(C.STAGES) == 5 and E.queries()["pipeline"] is C.run
    assert all(f"op{n}_" in "".join(E.queries()) for n in range(1, 11))


def test_language_stage_keeps_clean_documents(kept):
    docs, out = kept[0]
    assert out.columns == docs.columns and out.count() == docs.count()


def test_one_document_of_each_group_stays(kept):
    docs, out = kept[1]
    fps = {r.doc_id: simhash.fingerprint(r.text.encode()) for r in docs.collect()}
    roots = plain_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    assert sorted(r.doc_id for r in out.collect()) == sorted(least.values()) and out.columns == docs.columns


def test_repeated_passages_are_gone(kept):
    docs, out = kept[2]
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in (docs, out))
    assert out.columns == docs.columns

    def repeats(texts):
        """Pairs of (window of 70 words, document) beyond the first document with it."""
        seen, n = {}, 0
        for i in sorted(texts):
            w = texts[i].split()
            for k in range(len(w) - 69):
                n += seen.setdefault(tuple(w[k:k + 70]), i) != i
        return n

    assert repeats(before) > 0 and repeats(after) == 0
    changed = [i for i in after if after[i] != before[i]]
    assert changed and len(after) >= len(before) - len(changed) - 60


def test_no_benchmark_item_is_left(kept):
    docs, out = kept[3]

    def plain(text):
        return " ".join(re.findall(r"\w+", text.lower()))

    items = [plain(r.text) for r in docs.sparkSession.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: plain(r.text) for r in docs.collect()}
    leaked = {i for i, t in texts.items() if any(q in t for q in items)}
    left = {r.doc_id for r in out.collect()}
    assert leaked and not leaked & left
    assert len(texts) - len(left) <= len(leaked) + 2  # clean documents stay


def test_packing_round_trip(kept):
    docs, out = kept[4]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    want = {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    got = {i: np.frombuffer(b"".join(x for _, x in sorted(p)), "<u4").tolist() for i, p in pieces.items()}
    assert got == want


def test_awkward_and_empty_documents_pass_all_stages(spark):
    for docs in (frame(spark, awkward_rows()), frame(spark, [])):
        columns = docs.columns
        for k, (_, stage) in enumerate(C.STAGES):
            docs = staged(stage(spark, docs, SF), "stage")
            assert k == 4 or docs.columns == columns
            docs.count()
