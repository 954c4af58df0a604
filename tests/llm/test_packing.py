import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pluvia.llm import packing as P
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_fast_ids_equal_the_library_for_every_latin_code_point():
    fast, slow = P.encoder(PATH, RANKS), P.encoder(PATH, None)
    for c in range(1, 0x260):
        ch = chr(c)
        for text in (ch, f"a{ch}", f" {ch} b", f"{ch}{ch}1{ch}!{ch}  {ch}\n{ch}a\t{ch} ", f"'s{ch}'ll <|endoftext|>{ch}"):
            assert fast(text).tolist() == slow(text).tolist(), repr(text)


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", "x" * 300_000, " \t" * 700_000, "=-" * 200_000])
def test_very_long_runs_equal_the_library(text):
    fast, slow = P.encoder(PATH, RANKS), P.encoder(PATH, None)
    assert np.array_equal(fast(text), slow(text))


def test_cut_covers_the_document_with_pieces_of_their_class():
    for length in [*range(1, 2100), 4096, 5000, 10_001]:
        pieces = P.cut(length, 2048, P.SLACK)
        assert sum(n for n, _ in pieces) == length
        assert all(2048 // (k + 1) < n <= 2048 // k for n, k in pieces)


def check_packing(rows, got):
    tok = Tokenizer.from_file(PATH)
    want = sorted((i, tuple(tok.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in rows)
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) and r.length > 0
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    back = []
    for i, pieces in docs.items():
        at, ids = 0, []
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
            ids += np.frombuffer(r.ids, "<u4").tolist()
        assert at == pieces[0].doc_tokens
        back.append((i, tuple(ids)))
    assert sorted(back) == want
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / sum(len(ids) for _, ids in want)


def test_round_trip_and_little_padding(spark):
    rows = [(i, prose(i, 5 + i * 37 % 900)) for i in range(200)] + [(900, prose(9, 9000))]
    assert check_packing(rows, P.pack(frame(spark, rows), PATH, RANKS).collect()) < 0.01


def test_awkward_texts(spark):
    rows = [(i if i is not None else 10**6 + n, t) for n, (i, t) in enumerate(awkward_rows()) if i != 6]
    check_packing(rows, P.pack(frame(spark, rows), PATH, RANKS).collect())
    repeated = P.pack(frame(spark, [(6, "ab cd")] * 3 + [(None, None)]), PATH, RANKS).collect()
    assert sum(r.length for r in repeated if r.doc_id == 6) == 3 * repeated[0].doc_tokens or len(repeated) >= 4
    assert [r.length for r in repeated if r.doc_id is None] == [1]


def test_registered_query_on_a_whole_table(spark):
    sf, tok = "/root/testdata/sf0.001", Tokenizer.from_file(PATH)
    want = {r.doc_id: np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
            for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got, covered, filled = QUERIES["op9_packing"](spark, sf).collect(), defaultdict(int), defaultdict(list)
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
        filled[r.sequence_id].append((r.offset, r.length))
    assert covered == {i: len(ids) for i, ids in want.items()}
    for pieces in filled.values():
        ends = [a + n for a, n in sorted(pieces)]
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_empty_table(spark):
    assert P.pack(empty(spark), PATH, RANKS).count() == 0
