"""Helpers shared by the operators: table access, Arrow batches, staged tables."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.session import work_dir

# Rows a task works on at a time: whole rows, closed at this many text bytes.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (cuts lineage; a
    lost executor loses nothing of it)."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state(key: tuple, build: Callable):
    """A value kept by a (reused) Python worker between tasks, built on first use.

    ``key[0]`` names the operator: a worker keeps one operator's values at a time, so a
    pipeline's stages do not add up in its memory.
    """
    box = sys.modules.setdefault("pluvia_worker_state", types.ModuleType("pluvia_worker_state"))
    slots = box.__dict__.setdefault("slots", {})
    if slots and next(iter(slots))[0] != key[0]:
        slots.clear()
    if key not in slots:
        slots[key] = build()
    return slots[key]


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of whole rows of about ``limit`` bytes of
    ``column``; a row larger than that is a run of its own."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) alone, under fixed names, whatever other columns there are."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def word_codes(texts: list[bytes]) -> tuple:
    """(code, unique, counts): the words of UTF-8 texts, cut at spaces and line feeds, as
    numbers into the block's distinct words (an Arrow binary array), and the words of
    each text.  Works on a few arrays of a block, not on word objects."""
    import numpy as np

    data = b"\n".join(texts)
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], (raw != 32) & (raw != 10), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32)
    # Words and what lies between them are the entries of one array.
    spans = pa.Array.from_buffers(pa.binary(), max(0, len(edges) - 1),
                                  [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data)])
    words = spans.take(pa.array(np.arange(0, len(edges), 2))).dictionary_encode()
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(edges[::2], ends), prepend=0)
    return words.indices.to_numpy(), words.dictionary, counts


def pieces(texts: list[bytes], limit: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """(numbers of texts, texts) in order, in blocks of about ``limit`` bytes; a longer text
    comes in pieces cut at white space, each a block of its own."""
    numbers, held, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > limit:
            if held:
                yield numbers, held
                numbers, held, size = [], [], 0
            at = 0
            while at < len(text):
                ends = [e for e in (text.find(b" ", at + limit), text.find(b"\n", at + limit)) if e >= 0]
                end = min(ends) if ends else len(text)
                yield [i], [text[at:end]]
                at = end
            continue
        numbers.append(i)
        held.append(text)
        size += len(text)
        if size >= limit:
            yield numbers, held
            numbers, held, size = [], [], 0
    if held:
        yield numbers, held
