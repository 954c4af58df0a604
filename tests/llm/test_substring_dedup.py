from collections import Counter

import numpy as np
import pytest

from pluvia.llm import substring_dedup as D
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose


def slow_gear(codes, window):
    one = D.gear(np.array(codes, np.uint32), 1)
    return [sum(int(one[i - j]) << j for j in range(min(window, i + 1))) % 2**32 for i in range(len(codes))]


def test_gear_hash_matches_the_definition():
    codes = D.codes_of(prose(3, 20) + "日本語é")
    assert D.gear(codes, 16).tolist() == slow_gear(codes.tolist(), 16)


def test_chunks_cover_the_text_and_resist_insertions():
    text = prose(4, 3000)
    ends = D.chunk_ends(D.codes_of(text)).tolist()
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    assert 20 < len(text) / len(ends) < 50
    moved = {e - 7 for e in D.chunk_ends(D.codes_of("inserte" + text)).tolist()}
    assert all(e in moved for e in ends if e > 64)


def test_passages_shared_by_otherwise_different_documents(spark):
    rows, passage = [], {}
    for k in range(12):
        passage[k] = prose(900 + k, 60)
        for copy in range(3):
            i = 10 * k + copy
            rows.append((i, f"{prose(i, 70 + copy)} {passage[k]} {prose(500 + i, 40)}"))
    rows += [(1000 + i, prose(3000 + i, 150)) for i in range(40)]
    texts = dict(rows)
    spans = D.repeated_spans(frame(spark, rows)).collect()
    caught = {r.doc_id for r in spans}
    assert caught == {10 * k + c for k in range(12) for c in (1, 2)}  # the first keeps it
    for r in spans:
        assert r.kept_id == r.doc_id // 10 * 10
        assert texts[r.doc_id][r.start:r.stop] in passage[r.doc_id // 10] or \
            texts[r.doc_id][r.start:r.stop] in f" {passage[r.doc_id // 10]} "
    kept = {r.doc_id: r.text for r in D.cut_spans(frame(spark, rows), D.repeated_spans(frame(spark, rows))).collect()}
    for i, text in texts.items():
        want = text
        for r in sorted((r for r in spans if r.doc_id == i), key=lambda r: -r.start):
            want = want[:r.start] + want[r.stop:]
        assert kept[i] == want


def test_repeats_inside_one_document_and_whole_copies(spark):
    block = prose(42, 80)
    rows = [(1, block + " middle " + block), (2, prose(8, 100)), (3, prose(8, 100)), (4, "short line")]
    spans = D.repeated_spans(frame(spark, rows)).collect()
    assert {r.doc_id for r in spans} == {1, 3}
    assert all(r.start >= len(block) for r in spans if r.doc_id == 1)
    left = {r.doc_id for r in D.cut_spans(frame(spark, rows), D.repeated_spans(frame(spark, rows))).collect()}
    assert left == {1, 2, 4}  # nothing is left of the whole copy


def test_awkward_rows_keep_their_columns(spark):
    docs = frame(spark, awkward_rows())
    spans = D.repeated_spans(docs)
    # 7 and 11 repeat themselves, if their pattern is cut at all.
    assert {6} <= {r.doc_id for r in spans.collect()} <= {6, 7, 11}
    out = D.cut_spans(docs, spans)
    assert out.columns == docs.columns
    by = [r for r in out.collect()]
    assert sum(r.doc_id is None for r in by) == 2
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in by)
    assert 6 not in {r.doc_id for r in by}


def test_scripts_without_spaces(spark):
    rng = np.random.default_rng(1)
    text = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 600))) for _ in range(3)]
    spans = D.repeated_spans(frame(spark, [(1, text[0] + text[1]), (2, text[2] + text[1]), (3, text[2][:100])])).collect()
    assert [(r.doc_id, r.kept_id) for r in spans] == [(2, 1)] and spans[0].stop - spans[0].start > 450


def test_passages_of_a_short_period(spark):
    rows = []
    for k, slogan in enumerate(["ab ", "buy now ", "| --- ", "la la lu ", "one more slogan of ours ", "x"]):
        passage = slogan * (500 // len(slogan))
        assert max(np.diff(D.chunk_ends(D.codes_of(passage)), prepend=0)) <= D.MAX_CHUNK
        rows += [(10 * k, f"{prose(700 + k, 31)} {passage} {prose(800 + k, 30)}"),
                 (10 * k + 1, f"{prose(720 + k, 30)} {passage[2:]} {prose(820 + k, 30)}")]
    spans = D.repeated_spans(frame(spark, rows)).collect()
    assert {10 * k + 1 for k in range(6)} <= {r.doc_id for r in spans}
    texts = dict(rows)
    for r in spans:
        if r.doc_id % 10:
            assert r.stop - r.start > 300 and texts[r.doc_id][r.start:r.stop] in texts[r.doc_id - 1]


def test_shorter_passages_of_scripts_without_spaces(spark):
    rng = np.random.default_rng(5)
    text = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 220))) for _ in range(3)]
    spans = D.repeated_spans(frame(spark, [(1, text[0] + text[1]), (2, text[2] + text[1])])).collect()
    assert [(r.doc_id, r.kept_id) for r in spans] == [(2, 1)] and 100 <= spans[0].stop - spans[0].start < 300


def plain_spans(rows):
    """All spans by a dictionary of chunk texts, one document after the other."""
    first, count, cut = {}, Counter(), {}
    for i, text in sorted(dict(rows).items()):
        ends = D.chunk_ends(D.codes_of(text)).tolist() if text else []
        cut[i] = [(a, b, text[a:b]) for a, b in zip([0, *ends], ends)]
        for _, _, chunk in cut[i]:
            first.setdefault(chunk, i)
            count[chunk] += 1
    out = []
    for i, found in cut.items():
        seen, spans = set(), []
        for a, b, chunk in found:
            later = first[chunk] != i or chunk in seen
            seen.add(chunk)
            if later and spans and spans[-1][1] == a:
                spans[-1][1] = b
            elif later:
                spans.append([a, b, first[chunk]])
        blank = [c in " \n\t\r" for c in dict(rows)[i]] if found else []
        for a, b, kept in spans:
            ends = sum(blank[j] and not blank[j - 1] for j in range(max(a, 1), b))
            if ends >= D.MIN_WORDS or b - a >= D.MIN_CHARS:
                out.append((i, a, b, kept))
    return sorted(out)


@pytest.mark.parametrize("times", [D.HOT_TIMES, 2])
def test_registered_query_equals_the_plain_way(spark, monkeypatch, times):
    """On a whole table, with and without digests that count as common."""
    monkeypatch.setattr(D, "HOT_TIMES", times)
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.start, r.stop, r.kept_id) for r in QUERIES["op8_substring_dedup"](spark, sf).collect())
    assert got == plain_spans(rows) and len(got) > 10


def test_common_digests_are_bounded_and_not_joined(spark):
    counted = spark.createDataFrame([(i, 2, i) for i in range(500)] + [(1000, 5000, 7), (-3, 2000, 1)], "digest long, n long, first_id long")
    digests, firsts = D.hot_digests(counted)
    assert digests.tolist() == [-3, 1000] and firsts.tolist() == [1, 7]
    assert D.hot_digests(counted, most=2)[0].tolist() == [1000]
    assert len(D.hot_digests(counted.where("false"))[0]) == 0


def test_empty_table(spark):
    assert D.repeated_spans(empty(spark)).count() == 0
    assert D.cut_spans(empty(spark), D.repeated_spans(empty(spark))).count() == 0
