"""Lempel-Ziv phrase fingerprints.

A text is parsed into the phrases of an incremental (LZ78) dictionary over its words
and marks: each phrase is the shortest continuation not yet in the dictionary.  The set
of phrases is hashed and kept as a minimum-hash signature, one byte a permutation; the
share of equal bytes, corrected for chance, estimates how much of two dictionaries is
shared, as joint compression would.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import slices, staged, text_rows, texts_of

PERMUTATIONS = 128
# Symbols of the parse: words (long runs in parts) with the space before, marks, spaces.
_SYMBOL = re.compile(r"\s?\w{1,16}|\s?[^\w\s]|\s")


def phrases(text: str) -> set[str]:
    """The LZ78 dictionary of a text."""
    found: set[str] = set()
    add, phrase = found.add, ""
    for symbol in _SYMBOL.findall(text):
        phrase += symbol
        if phrase not in found:
            add(phrase)
            phrase = ""
    return found


def _permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    ab = np.array([[xxhash.xxh64_intdigest(f"{name}{i}") for i in range(k)] for name in "ab"], np.uint64)
    return ab[0] | np.uint64(1), ab[1]


def signer(permutations: int = PERMUTATIONS):
    a, b = _permutations(permutations)
    digest = xxhash.xxh64_intdigest

    def sign(text: str) -> bytes:
        """Signature of a text's phrase set; empty for a text without any."""
        found = phrases(text)
        if not found:
            return b""
        h = np.fromiter(map(digest, found), np.uint64, len(found))
        least = np.full(permutations, np.uint64(0xFFFFFFFFFFFFFFFF))
        for i in range(0, len(h), 4096):
            least = np.minimum(least, (h[i:i + 4096, None] * a + b).min(0))
        return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()

    return sign


def likeness(x: bytes, y: bytes) -> float:
    """Estimated Jaccard likeness of two phrase sets, 0 to 1; two empty sets are equal."""
    if not x or not y:
        return float(x == y)
    same = np.mean(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8))
    return float(max(0.0, (same - 1 / 256) / (1 - 1 / 256)))


def fingerprints(docs: DataFrame, permutations: int = PERMUTATIONS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): lower-case hex, empty for null or empty texts.  One row
    per input row, repeated rows repeat, an empty table gives no rows.  No shuffle."""
    def run(batches):
        sign = signer(permutations)
        for part in slices(batches, "text"):
            yield pa.record_batch([part.column("doc_id"), pa.array([sign(t).hex() for t in texts_of(part)],
                                                                   pa.string())],
                                  names=["doc_id", "fingerprint"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


# Signatures stay bytes while they are staged; the result has them as hex.
_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
           "edited_fingerprint binary, near_edited double, near_next double")
_STAGED = _RESULT + ", task int, place string, text string"
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
          pa.int32(), pa.string(), pa.string()]
_NAMES = [f.split()[0] for f in _STAGED.split(", ")]


def _compare(sign, doc_id, text, signature, following, following_signature) -> tuple:
    changed = edited(text, following)
    other = signature if changed == text else sign(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            signature, other, likeness(signature, other),
            likeness(signature, following_signature))


def compare_next(docs: DataFrame, permutations: int = PERMUTATIONS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next document's (ascending id; the
    last one's next is the first): ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    Null texts are empty.  Null ids come first; rows of one id are ordered by their
    text's hash, so repeated rows follow each other.  A table of one row is its own next.

    The texts are shuffled once, into ranges of ids.  Within a range a document's next is
    the row after it; only each range's first and last texts are staged and joined with
    the neighbouring range, so no task sees more than its range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, sign, last = TaskContext.get().partitionId(), signer(permutations), None
        for part in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                signature = sign(text)
                if last is None:
                    rows.append((doc_id, None, None, signature, None, None, None, task, "first", text))
                else:
                    rows.append((*_compare(sign, *last, text, signature), task, "whole", None))
                last = doc_id, text, signature
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
        if last is not None:
            doc_id, text, signature = last
            row = (doc_id, None, None, signature, None, None, None, task, "last", text)
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = signer(permutations)
        for part in slices(batches, "text"):
            rows = [_compare(sign, r["doc_id"], r["text"], r["fingerprint"], r["next_text"],
                             r["next_fingerprint"]) for r in part.to_pylist()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES[:7])

    # Ranges of (id, text hash): many rows of one id, or without one, are no single task's.
    ranges = (text_rows(docs, id_col, text_col).repartitionByRange("doc_id", F.xxhash64("text"))
              .sortWithinPartitions("doc_id", F.xxhash64("text")))
    found = staged(ranges.mapInArrow(run, _STAGED), "lz-ranges")
    first, last = found.where("place = 'first'"), found.where("place = 'last'")
    # One number for each range that has rows: small however large the ranges are.
    order = Window.orderBy("task")
    following = first.select("task", F.coalesce(
        F.lead("task").over(order), F.min("task").over(Window.partitionBy(F.lit(0)))).alias("next_task"))
    closing = (last.join(following, "task")
               .join(first.select(F.col("task").alias("next_task"), F.col("text").alias("next_text"),
                                  F.col("fingerprint").alias("next_fingerprint")), "next_task")
               .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint"))
    every = found.where("place = 'whole'").select(*_NAMES[:7]).unionAll(closing.mapInArrow(close, _RESULT))
    return every.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
