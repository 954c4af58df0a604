import hashlib

import numpy as np
import pytest

from pluvia.llm import lz_fingerprint as Z
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose

SF = "/root/testdata/sf0.01"


def plain_phrases(text):
    out, rest = [], Z._SYMBOL.findall(text)
    assert "".join(rest) == text  # the symbols are the whole text
    while rest:
        for n in range(1, len(rest) + 1):
            if "".join(rest[:n]) not in out:
                break
        out.append("".join(rest[:n]))
        rest = rest[n:]
    return set(out)


def test_parse_matches_the_definition():
    for _, text in awkward_rows():
        if text and len(text) < 3000:
            assert Z.phrases(text) == plain_phrases(text)


def test_likeness_estimates_the_overlap():
    sign = Z.signer()
    a = prose(1, 600)
    for keep in (0, 150, 300, 450, 600):
        b = " ".join(a.split()[:keep]) + " " + prose(2, 600 - keep)
        x, y = Z.phrases(a), Z.phrases(b)
        assert Z.likeness(sign(a), sign(b)) == pytest.approx(len(x & y) / len(x | y), abs=0.15)
    assert Z.likeness(sign(a), sign(a)) == 1.0 and Z.likeness(b"", b"") == 1.0 and Z.likeness(b"", sign(a)) == 0.0


def check(rows, got):
    """Every row against its next in id order, worked out on the driver."""
    sign = Z.signer()
    order = sorted(rows, key=lambda r: r[0])
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        q = len(text) // 4
        changed = text[:len(text) - q] + following[:q]
        r, x, y, z = by[i], sign(text), sign(changed), sign(following)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (x.hex(), y.hex())
        assert (r.near_edited, r.near_next) == (Z.likeness(x, y), Z.likeness(x, z))


def test_neighbours_over_many_ranges(spark):
    rows = [(i * i, prose(i, i % 50)) for i in range(120)]
    check(rows, Z.compare_next(frame(spark, rows)).collect())


def test_awkward_rows(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 6] + [(6, "once")]
    check(rows, Z.compare_next(frame(spark, rows)).collect())
    every = Z.compare_next(frame(spark, awkward_rows())).collect()
    assert len(every) == len(awkward_rows())
    same = [r for r in every if r.doc_id == 6]
    assert len({r.fingerprint for r in same}) == 1 and max(r.near_next for r in same) == 1.0


def test_one_row_is_its_own_next_and_empty_table(spark):
    text = prose(1, 40)
    check([(5, text)], Z.compare_next(frame(spark, [(5, text)])).collect())
    assert Z.compare_next(empty(spark)).count() == 0 and Z.fingerprints(empty(spark)).count() == 0


def test_whole_table_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op10_lz_fingerprint"](spark, SF).collect()
    check(docs, got)
    assert np.median([r.near_edited for r in got]) > 0.5 > np.median([r.near_next for r in got])
