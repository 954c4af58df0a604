"""Language identification by language-bitmask n-gram filters.

Training finds, for every language, the letter n-grams whose share in that language's
texts reaches a threshold.  Each language has a Bloom filter over its n-grams; the
filters are stored bit-sliced: slot s of one table holds bit s of every language's
filter, so k look-ups and an AND return the set of all languages holding an n-gram.
A text's popcount per language, corrected for that filter's false-positive rate,
decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices, text_rows, texts_of, worker_state

UNKNOWN = "und"
ORDERS = (3, 4)
# An n-gram belongs to a language from this share of the language's n-grams on, so
# a language has at most 1 / MIN_SHARE of them for each order, however large the corpus.
MIN_SHARE = 1e-5
# Expected number of labelled documents fitted for each language.
FIT_DOCS = 4000
SLOTS, HASHES = 1 << 20, 3
# Text bytes, and characters of it, worked on at a time.
SLICE, STRETCH = 1 << 18, 1 << 17
# Distinct values that a language column may have (the bitmasks take SLOTS * 8 bytes for 64).
MAX_LANGUAGES = 4096


class LanguageModel(NamedTuple):
    languages: list[str]
    table: np.ndarray       # SLOTS bitmasks, bit i of each for languages[i]; over 64 languages: rows of them
    false_rate: np.ndarray  # false-positive rate of each language's filter


def _letters() -> np.ndarray:
    return worker_state(("language", "letters"), lambda: np.array(
        [chr(i).isalpha() for i in range(0x110000)]))


def stretches(texts: list[str]) -> Iterator[tuple[str, np.ndarray, int]]:
    """(letters and ends, text of each place, places an n-gram may begin at): the texts in
    lower case between word ends, cut after STRETCH characters, so that the arrays made of
    them stay small; a cut text's stretch holds the characters its last n-grams need."""
    held, owner, size = [], [], 0
    for i, text in enumerate(texts):
        low = f"{text.lower()}\0"
        if len(low) <= STRETCH:
            held.append(low)
            owner.append(i)
            size += len(low)
            if size < STRETCH:
                continue
        if held:
            yield "\0" + "".join(held), np.repeat(owner, [len(h) for h in held]), size
            held, owner, size = [], [], 0
        if len(low) > STRETCH:
            low = "\0" + low
            for at in range(0, len(low), STRETCH):
                part = low[at:at + STRETCH + ORDERS[-1] - 1]
                yield part, np.full(len(part) - 1, i), STRETCH
    if held:
        yield "\0" + "".join(held), np.repeat(owner, [len(h) for h in held]), size


def gram_blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all letter n-grams of the texts and the text each belongs to, in blocks.

    Lower case; runs of other characters are one word end.  An n-gram may begin or
    end with a word end but holds none inside.
    """
    letters = _letters()
    for part, owner, own in stretches(texts):
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = letters[codes]
        codes = np.where(inside, codes, np.uint32(0)).astype(np.uint64)
        for n in ORDERS:
            m = min(own, len(codes) - n + 1)
            if m <= 0:
                continue
            keep = inside[1:1 + m].copy()
            for j in range(2, n - 1):
                keep &= inside[j:j + m]
            at = np.flatnonzero(keep)
            h = np.full(len(at), n, np.uint64)
            for j in range(n):
                h *= np.uint64(0x100000001B3)
                h += codes[at + j]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            yield h, owner[at]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All blocks of :func:`gram_blocks` together."""
    found = list(gram_blocks(texts)) or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


def slots_of(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The filter slots of each n-gram: double hashing of its 64 bits."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((hashes + np.uint64(i) * step) & np.uint64(SLOTS - 1)).astype(np.int64)


def gram_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, gram, n) over all texts of ``docs``."""
    def run(batches):
        for part in slices(batches, "text"):
            langs, texts = np.array(part.column("lang").to_pylist(), dtype=object), texts_of(part)
            for lang in sorted(set(langs)):
                gram = n = np.zeros(0, np.uint64)
                for hashes, _ in gram_blocks([texts[i] for i in np.flatnonzero(langs == lang)]):
                    new, times = np.unique(hashes, return_counts=True)
                    gram, where = np.unique(np.concatenate([gram, new]), return_inverse=True)
                    n = np.bincount(where, weights=np.concatenate([n, times]), minlength=len(gram))
                yield pa.record_batch([pa.array([lang] * len(gram), pa.string()),
                                       pa.array(gram.view(np.int64)),
                                       pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", fit_docs: int = FIT_DOCS,
        min_share: float = MIN_SHARE) -> LanguageModel:
    """Learn the filters from rows with a language where ``learnable`` holds.

    ``fit_docs`` bounds the expected number of documents fitted per language: each
    language's documents are thinned by a hash of their id to that number.  Every 64
    languages take one bitmask more a slot; over MAX_LANGUAGES distinct values raise, since
    the column holds something else.  No labelled row at all gives a model that only says
    ``und``.
    """
    labelled = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 32))
    share = F.lit(False)
    for lang, n in sizes.items():
        share = share | ((F.col(lang_col) == lang) & (draw < F.lit(int((1 << 32) * min(1, fit_docs / n)))))
    counts = gram_counts(labelled.where(share), lang_col, text_col)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    member = (counts.join(totals, "lang").where(F.col("n") >= min_share * F.col("total"))
              .select("lang", "gram"))
    number = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((max(1, -(-len(languages) // 64)), SLOTS), np.uint8 if len(languages) <= 8 else np.uint64)
    for lang, gram in member.toLocalIterator():
        word, bit = divmod(number[lang], 64)
        for slot in slots_of(np.array([gram], np.int64).view(np.uint64)):
            table[word, slot] |= table.dtype.type(1 << bit)
    fill = [np.count_nonzero(table[i // 64] & table.dtype.type(1 << i % 64)) / SLOTS for i in range(len(languages))]
    return LanguageModel(languages, table if len(table) > 1 else table[0], np.array(fill) ** HASHES)


def score_texts(texts: list[str], model: LanguageModel) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, score, coverage) of each text.

    Coverage is the corrected share of the text's n-grams in the winning filter; the
    score is the winner's weight among exp(corrected count) of all languages.
    """
    n, langs = len(texts), len(model.languages)
    table = np.atleast_2d(model.table)
    total, raw = np.zeros(n), np.zeros((n, max(langs, 1)))
    for hashes, owner in gram_blocks(texts):
        total += np.bincount(owner, minlength=n)
        slots = list(slots_of(hashes))
        for word, row in enumerate(table):
            mask = row[slots[0]]
            for slot in slots[1:]:
                mask &= row[slot]
            for i in range(64 * word, min(64 * word + 64, langs)):
                held = owner[(mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1) == 1]
                raw[:, i] += np.bincount(held, minlength=n)
    fp = np.append(model.false_rate, 0.0)[:raw.shape[1]]
    hits = np.maximum(0, (raw - fp * total[:, None]) / np.maximum(1e-9, 1 - fp))
    best = hits.argmax(1)
    top = hits[np.arange(n), best]
    score = 1 / np.exp(hits - top[:, None]).sum(1)
    some = (total > 0) & (langs > 0)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, some)]
    return names, np.where(some, score, 0.0), np.where(some, top / np.maximum(total, 1), 0.0)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, coverage``, from the whole text.

    ``und`` with score 0 if the text is null or has no letter.  A text none of whose
    n-grams is known gets the first language with an even score and coverage 0.
    Repeated rows repeat; null ids stay null; an empty table gives no rows.  No shuffle;
    the broadcast table has a fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        model = LanguageModel(*shared.value)
        for part in slices(batches, "text", SLICE):
            names, score, coverage = score_texts(texts_of(part), model)
            yield pa.record_batch([part.column("doc_id"), pa.array(names, pa.string()),
                                   pa.array(score), pa.array(coverage)],
                                  names=["doc_id", "lang_pred", "score", "coverage"])

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, lang_pred string, score double, coverage double")


def accepted(docs: DataFrame, model: LanguageModel, min_coverage: float,
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: not ``und``, and at
    least ``min_coverage`` of its n-grams in the winning filter.  No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        model = LanguageModel(*shared.value)
        for part in slices(batches, text_col, SLICE):
            names, _, coverage = score_texts(texts_of(part, text_col), model)
            yield part.filter(pa.array((np.array(names) != UNKNOWN) & (coverage >= min_coverage)))

    return docs.mapInArrow(run, docs.schema)
