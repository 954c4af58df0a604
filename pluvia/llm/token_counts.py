"""Token counts: lengths only, by batch encoding inside Arrow functions.

White space ends every pre-token of the word vocabularies served here, so a text
may be cut at every space or line feed without changing its token count.  Each
text becomes its white-space-delimited words; words not yet known to the worker
are encoded by the tokenizer's library in batches balanced by bytes, and a text's
count is the sum over its words.  A worker remembers a bounded number of words of a
bounded length; all others are encoded anew in each slice, never skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices, text_rows, texts_of, worker_state

# Words a worker keeps, characters of one it keeps, and bytes in one call of the tokenizer.
KNOWN_WORDS, KEPT_LENGTH = 1 << 20, 64
ENCODE_BYTES = 1 << 18


def _tokenizer(path: str):
    def build():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    return worker_state(("token counts", "tokenizer", path), build)


def by_bytes(words: list[str], limit: int) -> Iterator[list[str]]:
    """Runs of words of about ``limit`` UTF-8 bytes each."""
    run, size = [], 0
    for word in words:
        n = len(word) if word.isascii() else len(word.encode("utf-8", "surrogatepass"))
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(word)
        size += n
    if run:
        yield run


def count_words(words, path: str, encode_bytes: int) -> dict[str, int]:
    """Token count of each distinct word, without special tokens around it."""
    tok, out = _tokenizer(path), {}
    for run in by_bytes(list(words), encode_bytes):
        for word, enc in zip(run, tok.encode_batch_fast(run, add_special_tokens=False)):
            out[word] = len(enc)
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", known_words: int = KNOWN_WORDS,
                 encode_bytes: int = ENCODE_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens`` of the whole text.

    The vocabulary at ``tokenizer_path`` must drop white space (its pre-tokens never
    hold any).  Null text counts as empty (0, 0); a null id stays null; repeated rows
    give repeated results; an empty table gives an empty one.  No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_state(("token counts", "words", tokenizer_path), dict)
        for part in slices(batches, "text"):
            words = [t.replace("\n", " ").split(" ") for t in texts_of(part)]
            new = set().union(*words).difference(known)
            fresh = count_words(new, tokenizer_path, encode_bytes)
            once = {}
            for word, n in fresh.items():
                if len(word) <= KEPT_LENGTH and len(known) < known_words:
                    known[word] = n
                else:
                    once[word] = n
            if once:
                counts = [sum(known[x] if x in known else once[x] for x in w) for w in words]
            else:
                counts = [sum(map(known.__getitem__, w)) for w in words]
            yield pa.record_batch([part.column("doc_id"), part.column("n_bytes"),
                                   pa.array(counts, pa.int64())],
                                  names=["doc_id", "n_bytes", "n_tokens"])

    rows = text_rows(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
        .alias("n_bytes"), "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
