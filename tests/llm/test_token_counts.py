import public_tokenizers
from tokenizers import Tokenizer

from pluvia.llm import token_counts as T
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    return sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids))
                   for i, t in rows), key=repr)


def test_counts_equal_the_library_on_awkward_texts(spark):
    rows = awkward_rows() + [(50, "don't we'll 'tis <|startoftext|>x<|endoftext|> ́ é\r\n\x0b tab\tend "),
                             (51, "a\n\nb  c   d\u0085e")]
    got = T.token_counts(frame(spark, rows), PATH).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_beyond_the_remembered_words_nothing_changes(spark):
    rows = [(i, f"w{i} same words here w{i * 7}") for i in range(300)]
    got = T.token_counts(frame(spark, rows), PATH, known_words=5, encode_bytes=16).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_encode_batches_are_balanced_by_bytes():
    runs = list(T.by_bytes(["aaaa", "bbbb", "c" * 50, "d"], 8))
    assert runs == [["aaaa", "bbbb"], ["c" * 50], ["d"]]
    assert list(T.by_bytes(["日本", "語", "ab"], 6)) == [["日本"], ["語", "ab"]]


def test_long_texts_without_spaces_are_not_remembered(spark):
    rows = [(i, chr(0x4E00 + i) * 5000) for i in range(20)] * 2
    got = T.token_counts(frame(spark, rows), PATH, encode_bytes=20_000).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_registered_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op1_token_counts"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == expected(rows)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)


def test_empty_table(spark):
    assert T.token_counts(empty(spark), PATH).columns == ["doc_id", "n_bytes", "n_tokens"]
    assert T.token_counts(empty(spark), PATH).count() == 0
