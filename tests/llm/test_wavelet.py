import io
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pluvia.llm import wavelet as W
from pluvia.llm.queries import q_wavelet
from tests.llm.cases import awkward_rows, empty, frame, prose

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def matrix(ids, lengths=None, doc_ids=None):
    ids = np.array(ids, np.uint32)
    lengths = lengths or [len(ids)]
    return W.WaveletMatrix(io.BytesIO(W.to_bytes(doc_ids or list(range(len(lengths))), lengths, ids)))


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 2), (1000, 50257), (5000, 3), (3000, 1 << 31), (2000, 1)])
def test_access_rank_select_equal_the_plain_array(n, top, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BITS", 512)
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    m = matrix(ids)
    assert (m.ids() == ids).all() and m.n == n
    for lo, hi in [(0, n), (n // 3, n // 2), (n // 2, n // 2)]:
        assert (m.access(lo, hi) == ids[lo:hi]).all()
        for token in {*ids[:5].tolist(), 0, 1, top, 1 << 30, 1 << 40, -1}:
            assert m.count(token, lo, hi) == int((ids[lo:hi] == token).sum())
            assert m.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()
    if n:
        token = int(ids[n // 2])
        assert m.occurrences(token, 1, 2).tolist() == np.flatnonzero(ids == token)[1:3].tolist()


def test_a_foreign_file_is_refused():
    with pytest.raises(ValueError):
        W.WaveletMatrix(io.BytesIO(b"PAR1 something else"))


def test_look_ups_do_not_read_the_whole_file():
    class Counted(io.BytesIO):
        got = 0

        def read(self, size=-1):
            Counted.got += size
            return super().read(size)

    ids = np.random.default_rng(0).integers(0, 50257, 1 << 21).astype(np.uint32)
    data = W.to_bytes([1], [len(ids)], ids)
    m = W.WaveletMatrix(Counted(data))
    Counted.got = 0
    assert m.access(1000, 1001)[0] == ids[1000]
    assert Counted.got < len(data) / 4


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_awkward_texts_over_many_shards(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 6] + [(100 + i, prose(i, 50)) for i in range(40)]
    shards = W.write_shards(frame(spark, rows), tempfile.mkdtemp(), PATH, RANKS, shard_ids=500)
    assert shards.count() > 5
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in W.read_documents(shards).collect()]
    assert sorted(got) == sorted(expected(rows))


def test_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, None), (6, "same"), (6, "same"), (6, "other text"), (2, None)]
    got = W.read_documents(W.write_shards(frame(spark, rows), tempfile.mkdtemp(), PATH, RANKS, shard_ids=2)).collect()
    assert sorted((r.n_tokens for r in got)) == sorted(e[2] for e in expected(rows))
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == [None, None, 2, 6, 6, 6]
    assert [r.start for r in order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in order])[:-1]]).tolist()


def test_counts_and_places_from_the_files(spark):
    rows = [(i, prose(i % 7, 60)) for i in range(60)]
    path = tempfile.mkdtemp()
    W.write_shards(frame(spark, rows), path, PATH, RANKS, shard_ids=700)
    shards = W.manifest(spark, path)
    tok = Tokenizer.from_file(PATH)
    want = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    tokens = [0, want[0][3], want[5][0], 50000]
    got = {r.token: r.n for r in W.token_counts(shards, tokens).collect()}
    assert got == {t: sum(ids.count(t) for ids in want.values()) for t in tokens}
    places = sorted((r.doc_id, r["at"]) for r in W.token_places(shards, tokens[1], run_length=3).collect())
    assert places == sorted((i, j) for i, ids in want.items() for j, t in enumerate(ids) if t == tokens[1])


def test_empty_table(spark):
    assert W.read_documents(W.write_shards(empty(spark), tempfile.mkdtemp(), PATH, RANKS)).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in q_wavelet(spark, sf).collect()) == sorted(expected(rows))
