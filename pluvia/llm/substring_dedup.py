"""Exact substring dedup by content-defined chunks.

A gear rolling hash over the last WINDOW code points ends a chunk wherever it falls
under a threshold, and at its smallest value where it does not for long, so equal
passages are cut alike wherever they stand, up to the window at their start.  Chunks are compared by a 64-bit digest over the whole corpus;
the first document with a digest (smallest id, first place) keeps the chunk.  Every run
of adjacent later chunks with at least ``min_words`` words (or, without spaces, ``min_chars`` code points) is a repeated span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices, staged, text_rows, texts_of

# The rolling window, the mean chunk length, both in code points.
WINDOW, MEAN_CHUNK = 16, 32
# Where no end falls within MAX_CHUNK code points, as in words repeated over and over, the
# smallest hash after MIN_CHUNK of them is one.
MIN_CHUNK, MAX_CHUNK = 32, 96
# A passage of over 50 words keeps at least this many in whole chunks: it loses the
# window and part of a chunk at its start, and part of a chunk at its end.
MIN_WORDS = 20
# A span of so many code points counts as well, and so many letters of a script without
# spaces count as a word.
MIN_CHARS, DENSE_WORD = 300, 5
# A digest with over HOT_TIMES chunks, and over one in MOST_HOT of all repeated ones, is
# looked up in the tasks that make the chunks instead of being joined.
HOT_TIMES, MOST_HOT = 1000, 1 << 16
_DENSE = np.array([0xE00, 0xF00, 0x1000, 0x10A0, 0x1780, 0x1800, 0x3040, 0x3130, 0x3400, 0xA000,
                   0xF900, 0xFB00, 0x20000, 0x40000], np.uint32)  # from, to, from, to ...


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gear(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rolling hash ending at each code point: sum of g(c[i - j]) << j, j < window.

    Window doubling: the hash of 2w is that of w plus the one w places before,
    shifted by w.  ``window`` is a power of two below 32.
    """
    h = codes.astype(np.uint64)
    h = (h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    h = (h >> np.uint64(32)).astype(np.uint32)
    w = 1
    while w < window:
        h[w:] += h[:-w] << np.uint32(w)
        w *= 2
    return h


def chunk_ends(codes: np.ndarray, window: int = WINDOW, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text; the last one is its length."""
    mixed = gear(codes, window) * np.uint32(0x9E3779B1)
    h = mixed >> np.uint32(8)
    cut = h < np.uint32((1 << 24) // mean)
    cut[:window - 1] = False
    cut[-1:] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - starts > MAX_CHUNK)
    if not len(long):
        return ends
    more = []
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        while end - start > MAX_CHUNK:
            start += MIN_CHUNK + int(mixed[start + MIN_CHUNK - 1:start + MAX_CHUNK - 1].argmin())
            more.append(start)
    return np.sort(np.concatenate([ends, more]))


def chunks(docs: DataFrame, window: int, mean: int, hot=None) -> DataFrame:
    """(digest, doc_id, start, stop, words, hot_first) of every chunk; ``words`` counts word
    ends, and a word for every DENSE_WORD letters of a script without spaces.  ``hot``: a
    broadcast of (ascending digests, their first documents), which fill ``hot_first``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        hot_digests, hot_firsts = (np.zeros(0, np.int64),) * 2 if hot is None else hot.value
        for part in slices(batches, "text"):
            out = [[], [], [], [], []]
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                if not text:
                    continue
                codes = codes_of(text)
                ends = chunk_ends(codes, window, mean)
                starts = np.concatenate([[0], ends[:-1]])
                view = memoryview(codes).cast("B")
                out[0].append(np.fromiter(map(digest, (view[4 * a:4 * b] for a, b in
                                                       zip(starts.tolist(), ends.tolist()))),
                                          np.uint64, len(ends)))
                blank = (codes == 32) | (codes == 10) | (codes == 9) | (codes == 13)
                word_end = np.concatenate([[0], np.cumsum(blank[1:] & ~blank[:-1]),
                                           [0]])[:len(codes)]
                if int(codes.max()) >= _DENSE[0]:
                    dense = np.cumsum(np.searchsorted(_DENSE, codes, side="right") % 2)
                    word_end = word_end + dense // DENSE_WORD
                out[1].append(np.full(len(ends), doc_id))
                out[2].append(starts)
                out[3].append(ends)
                out[4].append(word_end[ends - 1] - word_end[np.maximum(starts - 1, 0)])
            if out[0]:
                cols = [np.concatenate(c) for c in out]
                found = cols[0].view(np.int64)
                first, cold = np.zeros(len(found), np.int64), np.ones(len(found), bool)
                if len(hot_digests):
                    at = np.minimum(np.searchsorted(hot_digests, found), len(hot_digests) - 1)
                    first, cold = hot_firsts[at], hot_digests[at] != found
                yield pa.record_batch(
                    [pa.array(found), pa.array(cols[1].astype(np.int64)),
                     *(pa.array(c.astype(np.int32)) for c in cols[2:]), pa.array(first, mask=cold)],
                    names=["digest", "doc_id", "start", "stop", "words", "hot_first"])

    return docs.where("doc_id is not null and text is not null").mapInArrow(
        run, "digest long, doc_id long, start int, stop int, words int, hot_first long")


def hot_digests(counted: DataFrame, most: int = MOST_HOT) -> tuple[np.ndarray, np.ndarray]:
    """(digests, first documents) of the digests with over one in ``most`` of all repeated
    chunks of ``counted(digest, n, first_id)``: so there are fewer than ``most``."""
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counted.where(F.col("n") > max(HOT_TIMES, total // most + 1)).orderBy("digest").collect()
    return np.array([r.digest for r in rows], np.int64), np.array([r.first_id for r in rows], np.int64)


def _runs(min_words: int, min_chars: int):
    """Rows sorted by (doc_id, start) -> spans of adjacent repeated chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, seen, last_start, span = None, set(), -1, None
        out = []

        def close():
            if span and (span[3] >= min_words or span[2] - span[1] >= min_chars):
                out.append(tuple(span))

        for batch in batches:
            for doc_id, start, stop, words, digest, first_id in zip(
                    *(batch.column(c).to_pylist() for c in
                      ("doc_id", "start", "stop", "words", "digest", "first_id"))):
                if doc_id != doc:
                    close()
                    doc, seen, last_start, span = doc_id, set(), -1, None
                if start == last_start:  # a repeated row of the same document
                    continue
                last_start = start
                later = first_id != doc_id or digest in seen
                seen.add(digest)
                if later and span and span[2] == start:
                    span[2], span[3] = stop, span[3] + words
                else:
                    close()
                    span = [doc_id, start, stop, words, first_id] if later else None
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)],
                                      names=["doc_id", "start", "stop", "words", "kept_id"])
                out = []
        close()
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)],
                                  names=["doc_id", "start", "stop", "words", "kept_id"])

    return run


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW,
                   mean: int = MEAN_CHUNK, id_col: str = "doc_id",
                   text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per repeated span: ``doc_id, start, stop`` (code points), ``words`` (word
    ends inside, and one for every DENSE_WORD letters of scripts without spaces) and ``kept_id``, the document that keeps the span's first chunk.

    Ids are taken as unique for each text: rows that repeat one count once.  Rows with a
    null id or text have no spans and keep nothing.  Digests are counted with
    map-side combining and joined back; the most common ones, a bounded number, are sent to
    the tasks that make the chunks and are spread over the join instead of meeting in one
    of its tasks.  Only chunks that occur more than once are regrouped by document.
    """
    rows = text_rows(docs, id_col, text_col)
    counted = staged(chunks(rows, window, mean).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1"), "digests")
    hot = docs.sparkSession.sparkContext.broadcast(hot_digests(counted))
    pieces = chunks(rows, window, mean, hot)
    # Common chunks go anywhere: they know their first document already.
    key = F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(F.xxhash64("doc_id", "start"))
    joined = pieces.join(counted.select(F.col("digest").alias("met"), F.col("first_id").alias("met_first")),
                         key == F.col("met"), "left")
    first = F.coalesce("hot_first", "met_first")
    repeated = joined.where(first.isNotNull()).withColumn("first_id", first)
    return (repeated.repartition("doc_id").sortWithinPartitions("doc_id", "start")
            .select("doc_id", "start", "stop", "words", "digest", "first_id")
            .mapInArrow(_runs(min_words, min_chars),
                        "doc_id long, start long, stop long, words long, kept_id long"))


def cut_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut out of their texts; other columns as they are.

    A document of which no word remains goes.  A document's spans are gathered beside its
    text, so they are as bounded as it is.
    """
    per_doc = spans.groupBy(F.col("doc_id").alias("id")).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    # The row travels whole, so its columns may have any names.
    joined = docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row")).join(per_doc, "id", "left")
    text = F.col("row")[text_col]
    # What stands between the spans: from each stop (0 at first) to the next start.
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["stop"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.char_length(text).cast("long")))
    kept = F.array_join(F.zip_with(begins, ends, lambda a, b: F.substring(
        text, (a + 1).cast("int"), (b - a).cast("int"))), "")
    cut = joined.select("row", "spans", kept.alias("kept")).where("spans is null or kept rlike '\\\\S'")
    changed = F.col("row").withField(text_col, F.col("kept"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return cut.select(F.when(F.col("spans").isNull(), F.col("row")).otherwise(changed).alias("row")).select("row.*")
