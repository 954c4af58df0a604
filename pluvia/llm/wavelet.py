"""Token ids in wavelet matrix files: one compressed, indexed file a shard.

The ids of a shard's documents, in order, are stored as bit planes from the highest bit
down; each plane is in the order that the planes above leave after moving zeros before
ones.  With the number of ones before every block of a plane, an id's place in one plane
gives its place in the next, so the same file answers: the ids of any range (access),
how often an id occurs in a range (rank), and where its k-th occurrence is (select).
Blocks are compressed on their own; a look-up reads and unpacks those it touches.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvia.llm.common import slices, text_rows, texts_of
from pluvia.llm.packing import encoder

MAGIC = b"WVMX"
# Ids of a shard (a document more closes it) and bits of a plane's block.
SHARD_IDS, BLOCK_BITS = 1 << 22, 1 << 18
_CACHED_BLOCKS = 256
# Tasks that read shards, at most; beyond, a task reads several one after the other.
READ_TASKS = 20_000
MANIFEST = "task int, place int, path string, n_docs long, n_ids long, n_bytes long"
_NAMES = [c.split()[0] for c in MANIFEST.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def planes_of(ids: np.ndarray) -> Iterator[np.ndarray]:
    """The packed bit planes (little bit order), highest bit first; at least one."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    order = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for level in range(bits - 1, -1, -1):
        bit = order & order.dtype.type(1 << level) != 0
        yield np.packbits(bit, bitorder="little")
        if level:
            ones = order[bit]
            order = np.concatenate([order[np.logical_not(bit, out=bit)], ones])


def to_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray, start: int = 0) -> bytes:
    """One shard's file: header (JSON), then its sections, each compressed.

    ``start``: ids that the same task has written before this shard.
    """
    pack = zstandard.ZstdCompressor(level=1).compress
    sections = [pack(json.dumps([i is None for i in doc_ids]).encode()) if None in doc_ids else b"",
                pack(np.array([i or 0 for i in doc_ids], "<i8").tobytes()), pack(np.array(lengths, "<i8").tobytes())]
    blocks, sizes, ones, bits = [], [], [], 0
    for plane in planes_of(ids):
        bits += 1
        before = 0
        for at in range(0, len(plane), BLOCK_BITS // 8):
            part = plane[at:at + BLOCK_BITS // 8]
            blocks.append(pack(part.tobytes()))
            sizes.append(len(blocks[-1]))
            ones.append(before)
            before += int(np.bitwise_count(part).sum(dtype=np.int64))
        ones.append(before)
    sections.append(pack(np.array(sizes, "<i8").tobytes() + np.array(ones, "<i8").tobytes()))
    header = json.dumps({"n": len(ids), "bits": bits, "docs": len(doc_ids), "start": start, "block_bits": BLOCK_BITS,
                         "sections": [len(s) for s in sections]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *sections, *blocks])


class WaveletMatrix:
    """A shard's file, read where it is asked.  ``source``: a seekable binary file."""

    def __init__(self, source):
        self._source = source
        if self._read(0, 4) != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size = int.from_bytes(self._read(4, 4), "little")
        head = json.loads(self._read(8, size))
        self.n, self.bits, self.start = head["n"], head["bits"], head["start"]
        self._block_bits = head["block_bits"]
        parts, at = [], 8 + size
        for length in head["sections"]:
            raw = self._read(at, length)
            parts.append(zstandard.ZstdDecompressor().decompress(raw) if raw else b"")
            at += length
        missing = json.loads(parts[0]) if parts[0] else [False] * head["docs"]
        self.doc_ids = [None if gone else int(i) for gone, i in zip(missing, np.frombuffer(parts[1], "<i8"))]
        self.lengths = np.frombuffer(parts[2], "<i8")
        self.doc_starts = np.concatenate([[0], np.cumsum(self.lengths)])
        per = -(-self.n // self._block_bits)
        directory = np.frombuffer(parts[3], "<i8")
        sizes = directory[:per * self.bits]
        self._ones = directory[per * self.bits:].reshape(self.bits, per + 1)
        ends = at + np.cumsum(sizes)
        self._sizes, self._places = sizes.reshape(self.bits, per), (ends - sizes).reshape(self.bits, per)
        self._cache: dict[tuple[int, int], np.ndarray] = {}

    def _read(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return self._source.read(size)

    def _block(self, plane: int, block: int) -> np.ndarray:
        """The bits of one block, unpacked."""
        key = plane, block
        if key not in self._cache:
            if len(self._cache) >= _CACHED_BLOCKS:
                self._cache.pop(next(iter(self._cache)))
            raw = zstandard.ZstdDecompressor().decompress(
                self._read(int(self._places[key]), int(self._sizes[key])))
            count = min(self._block_bits, self.n - block * self._block_bits)
            self._cache[key] = np.unpackbits(np.frombuffer(raw, np.uint8), count=count, bitorder="little")
        return self._cache[key]

    def zeros(self, plane: int) -> int:
        return self.n - int(self._ones[plane, -1])

    def bits_and_ranks(self, plane: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The plane's bit at each place and the ones before it."""
        bit, rank = np.zeros(len(at), np.uint8), np.zeros(len(at), np.int64)
        block = at // self._block_bits
        for b in np.unique(block):
            mine = np.flatnonzero(block == b)
            bits, inside = self._block(plane, int(b)), at[mine] - b * self._block_bits
            bit[mine] = bits[inside]
            before = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            rank[mine] = self._ones[plane, b] + before[inside]
        return bit, rank

    def rank1(self, plane: int, at: int) -> int:
        """Ones of the plane before place ``at``, 0 to n."""
        if at >= self.n:
            return int(self._ones[plane, -1])
        block, inside = divmod(at, self._block_bits)
        return int(self._ones[plane, block]) + int(np.count_nonzero(self._block(plane, block)[:inside]))

    def select(self, plane: int, bit: int, order: np.ndarray) -> np.ndarray:
        """Places of the plane's ones (or zeros) number ``order``, counted from 0."""
        before = self._ones[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * self._block_bits, self.n) - before
        block = np.searchsorted(before, order, side="right") - 1
        out = np.zeros(len(order), np.int64)
        for b in np.unique(block):
            mine = np.flatnonzero(block == b)
            places = np.flatnonzero(self._block(plane, int(b)) == bit)
            out[mine] = b * self._block_bits + places[order[mine] - before[b]]
        return out

    def access(self, lo: int, hi: int) -> np.ndarray:
        """The ids at places lo to hi (exclusive)."""
        at, out = np.arange(lo, hi), np.zeros(hi - lo, np.uint32)
        for plane in range(self.bits):
            bit, rank = self.bits_and_ranks(plane, at)
            out = out << np.uint32(1) | bit
            at = np.where(bit == 1, self.zeros(plane) + rank, at - rank)
        return out

    def _down(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the token's occurrences among places lo to hi lie below all planes."""
        if token < 0 or token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            a, b = self.rank1(plane, lo), self.rank1(plane, hi)
            one = token >> (self.bits - 1 - plane) & 1
            lo, hi = (self.zeros(plane) + a, self.zeros(plane) + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token among places lo to hi."""
        a, b = self._down(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, token: int, first: int = 0, most: int | None = None) -> np.ndarray:
        """Ascending places of a token's occurrences, from number ``first`` on."""
        lo, hi = self._down(token, 0, self.n)
        at = np.arange(lo + first, hi if most is None else min(hi, lo + first + most))
        for plane in range(self.bits - 1, -1, -1):
            if token >> (self.bits - 1 - plane) & 1:
                at = self.select(plane, 1, at - self.zeros(plane))
            else:
                at = self.select(plane, 0, at)
        return at

    def ids(self) -> np.ndarray:
        """All ids: the planes from the lowest up, each undoing its move of zeros before ones."""
        out = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        per = self._sizes.shape[1]
        unpack = zstandard.ZstdDecompressor().decompress
        for plane in range(self.bits - 1, -1, -1):
            first = int(self._places[plane, 0]) if per else 0
            raw = self._read(first, int(self._sizes[plane].sum())) if per else b""
            at = np.concatenate([[0], np.cumsum(self._sizes[plane])])
            packed = b"".join(unpack(raw[a:b]) for a, b in zip(at[:-1], at[1:]))
            bit = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n, bitorder="little").astype(bool)
            if plane < self.bits - 1:
                zeros, moved = self.zeros(plane), np.empty_like(out)
                moved[~bit] = out[:zeros]
                moved[bit] = out[zeros:]
                out = moved
            out |= bit.astype(out.dtype) << out.dtype.type(self.bits - 1 - plane)
        return out.astype(np.uint32)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that driver and executors share, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, ranks_path: str | None = None, end_id: int = 0,
                 shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents' ids, ascending by doc_id, as shard files under ``path``;
    returns the manifest ``task, place, path, n_docs, n_ids, n_bytes``, kept there as well.

    A document is its ids and ``end_id`` (null or empty text: ``end_id`` alone).  Null ids
    come first; rows of one id stay in the order of the input and may lie in several
    shards, so no id is too frequent for a task.  A shard holds whole documents, closed at
    ``shard_ids`` ids.  Each attempt of a task writes files of its own name, and the
    manifest, committed by Spark, names those of the one that counted; files of lost
    attempts are never read.  An empty table gives an empty manifest.
    """
    folder = os.path.join(path, "shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task = encoder(tokenizer_path, ranks_path), TaskContext.get().partitionId()
        store, inside = _store(folder)
        store.create_dir(inside, recursive=True)
        attempt, end = uuid.uuid4().hex, np.array([end_id], np.uint32)
        doc_ids, held, size, place, start = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            name = f"{task:06d}-{place:06d}-{attempt}.wvm"
            data = to_bytes(doc_ids, [len(h) for h in held], np.concatenate(held), start)
            with store.open_output_stream(f"{inside}/{name}") as out:
                out.write(data)
            row = (task, place, f"{folder}/{name}", len(doc_ids), size, len(data))
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, _TYPES)], names=_NAMES)

        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                ids = np.append(encode(text), end) if text else end
                doc_ids.append(doc_id)
                held.append(ids.astype(np.uint16) if end_id < 1 << 16 and int(ids.max()) < 1 << 16 else ids)
                size += len(ids)
                if size >= shard_ids:
                    yield close()
                    start, place = start + size, place + 1
                    doc_ids, held, size = [], [], 0
        if doc_ids:
            yield close()

    rows = text_rows(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ordered.select("doc_id", "text").mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(
        os.path.join(path, "manifest"))
    return manifest(docs.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(os.path.join(path, "manifest"))


def _placed(shards: DataFrame) -> DataFrame:
    """(path, base) of every shard, dealt evenly over tasks; ``base``: the ids of all
    earlier tasks.  The running sum is over one row a task, not over shards."""
    tasks = shards.groupBy("task").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    based = tasks.select("task", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return shards.join(based, "task").select("path", "base").repartition(max(1, min(shards.count(), READ_TASKS)))


def _open(path: str):
    store, inside = _store(path)
    return store.open_input_file(inside)


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the shards, read from their
    files: ``start`` is the number of ids of all documents before it, ``ids``
    little-endian uint32.  A task holds one shard at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in _rows(batches):
            with _open(path) as source:
                shard = WaveletMatrix(source)
                ids, at = shard.ids(), shard.doc_starts
            for lo in range(0, len(shard.doc_ids), 1024):
                hi = min(lo + 1024, len(shard.doc_ids))
                part, ends = ids[at[lo]:at[hi]].astype("<u4"), 4 * (at[lo:hi + 1] - at[lo])
                yield pa.record_batch(
                    [pa.array(shard.doc_ids[lo:hi], pa.int64()), pa.array(base + shard.start + at[lo:hi]),
                     pa.array(shard.lengths[lo:hi]),
                     pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends.tobytes()),
                                                                        pa.py_buffer(part.tobytes())]).cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return _placed(shards).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    for batch in batches:
        yield from zip(batch.column("path").to_pylist(), batch.column("base").to_pylist())


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of ``tokens`` occurs in all shards.  Two ranks a plane
    and token, so only the blocks at the ends of a token's ranges are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, _ in _rows(batches):
            with _open(path) as source:
                shard = WaveletMatrix(source)
                found = [shard.count(t) for t in tokens]
            yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array(found, pa.int64())], names=["token", "n"])

    return _placed(shards).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def token_places(shards: DataFrame, token: int, run_length: int = 1 << 16) -> DataFrame:
    """(doc_id, start, at) of every occurrence of a token: ``start`` of its document, ``at``
    its place in the document.  Occurrences are selected in runs, so a very frequent token
    takes no more memory than a rare one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in _rows(batches):
            with _open(path) as source:
                shard = WaveletMatrix(source)
                for first in range(0, shard.count(token), run_length):
                    at = shard.occurrences(token, first, run_length)
                    doc = np.searchsorted(shard.doc_starts, at, side="right") - 1
                    yield pa.record_batch(
                        [pa.array([shard.doc_ids[i] for i in doc], pa.int64()),
                         pa.array(base + shard.start + shard.doc_starts[doc]), pa.array(at - shard.doc_starts[doc])],
                        names=["doc_id", "start", "at"])

    return _placed(shards).mapInArrow(run, "doc_id long, start long, at long")

