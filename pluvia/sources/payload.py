"""One raw payload document read by many tasks.

A multi-line JSON document cannot be split at line ends, and from a place inside it no one
knows whether that place lies in a string or how deep it is nested.  A light scan finds
out in parallel: every byte range of the document tells, for both cases (its start lies in
a string, or not), how much it changes the depth and whether it ends in a string; composed
in order, these summaries give each range its exact state.  A second scan finds where the
``data`` array begins and ends.  The reader is a Spark data source whose partitions are the
ranges inside that array: each one returns the records that begin in it, as text, which
Spark parses with the fixed schema.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pluvia import schemas as SC
from pluvia.session import work_dir

# The tasks carry this module's code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 64 << 20
_BLOCK = 8 << 20  # bytes held at a time
_TAIL = 64 << 10  # and beyond a range's end, where its last element ends
_QUOTE, _BACKSLASH, _COMMA = 34, 92, 44
_STEP = np.zeros(256, np.int8)  # what a bracket adds to the depth
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_SPECIAL = _STEP != 0
_SPECIAL[[_QUOTE, _COMMA]] = True


def open_file(path: str):
    """A file that driver and executors share, in the file system its scheme names."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _blocks(file, start: int, end: int, block: int) -> Iterator[tuple[int, bytes]]:
    while start < end:
        data = file.read_at(min(block, end - start), start)
        if not data:
            raise ValueError("the document became shorter while it was read")
        yield start, data
        start += len(data)


def _escaped(file, at: int) -> bool:
    """Does an odd run of backslashes end right before ``at``?"""
    run, step = 0, 256
    while at > 0:
        part = file.read_at(min(step, at), at - min(step, at))
        tail = len(part) - len(part.rstrip(b"\\"))
        run += tail
        if tail < len(part):
            break
        at, step = at - len(part), step * 4
    return run % 2 == 1


class Marks:
    """The brackets and commas of a block of JSON text, by place.

    ``odd``: is the number of quotes before it in the block odd; ``step``: +1, -1 or 0.
    """

    def __init__(self, data: bytes, escaped: bool):
        raw = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(_SPECIAL[raw])
        quote = raw[at] == _QUOTE
        slashes = np.flatnonzero(raw == _BACKSLASH) if b"\\" in data else np.zeros(0, np.int64)
        self.escaped = escaped and not len(data)
        if len(slashes) or escaped:
            # The length of the run of backslashes that ends at each one; one more came before.
            first = np.append(True, np.diff(slashes) > 1) if len(slashes) else np.zeros(0, bool)
            number = np.arange(len(slashes))
            begin = np.maximum.accumulate(np.where(first, number, 0)) if len(slashes) else number
            length = number - begin + 1 + ((slashes[begin] == 0) & escaped if len(slashes) else 0)
            odd_run = slashes[length % 2 == 1] + 1
            if escaped and not (len(slashes) and slashes[0] == 0):
                odd_run = np.append(odd_run, 0)
            quote &= ~np.isin(at, odd_run)
            self.escaped = bool(np.isin(len(data), odd_run))
        before = np.cumsum(quote) - quote
        rest = raw[at] != _QUOTE
        self.at, self.byte = at[rest], raw[at][rest]
        self.odd = before[rest] % 2 == 1
        self.step = _STEP[self.byte].astype(np.int64)
        self.quotes = int(quote.sum())

    def outside(self, in_string: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, bytes, depth after each) of those outside strings."""
        real = self.odd == in_string
        return self.at[real], self.byte[real], depth + np.cumsum(self.step[real])


def _summaries(block: int):
    """(path, length, start, stop) -> also (flips, plain, quoted): does the range change
    from text to string, and its change of depth if it begins outside or inside a string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                odd, change = 0, [0, 0]
                with open_file(r["path"]) as file:
                    escaped = _escaped(file, r["start"])
                    for _, data in _blocks(file, r["start"], r["stop"], block):
                        marks = Marks(data, escaped)
                        for begins in (0, 1):
                            change[begins] += int(marks.step[marks.odd == bool(begins ^ odd)].sum())
                        odd, escaped = odd ^ (marks.quotes & 1), marks.escaped
                out.append((*r.values(), bool(odd), *change))
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)],
                                      names=["path", "length", "start", "stop", "flips", "plain", "quoted"])

    return run


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries sorted by (path, start) -> every range's state at its start."""
    path, quoted, depth = None, False, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["path"] != path:
                path, quoted, depth = r["path"], False, 0
            out.append((path, r["length"], r["start"], r["stop"], quoted, depth))
            depth += r["quoted"] if quoted else r["plain"]
            quoted ^= r["flips"]
            if r["stop"] == r["length"] and (quoted or depth):
                raise ValueError(f"truncated or malformed document: {path}")
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)],
                                  names=["path", "length", "start", "stop", "quoted", "depth"])


def _is_key(file, at: int, key: str) -> bool:
    """Is the value that begins at ``at`` that of ``key``?"""
    size = 256
    while True:
        low = max(0, at - size)
        before = file.read_at(at - low, low).rstrip()
        if before.endswith(b":"):
            before = before[:-1].rstrip()
            if len(before) > len(key) + 2 or not low:
                return before.endswith(f'"{key}"'.encode()) and before[-len(key) - 3:-len(key) - 2] != b"\\"
        elif before or not low:
            return False
        size *= 16


def _edges(key: str, block: int):
    """Ranges with their states -> (path, at, opens): where the array under the top-level
    ``key`` opens, and where each value directly under the root closes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                quoted, depth = r["quoted"], r["depth"]
                with open_file(r["path"]) as file:
                    escaped = _escaped(file, r["start"])
                    for start, data in _blocks(file, r["start"], r["stop"], block):
                        marks = Marks(data, escaped)
                        at, byte, after = marks.outside(quoted, depth)
                        opens = (after == 2) & (byte == ord("["))
                        closes = (after == 1) & (_STEP[byte] < 0)
                        out += [(r["path"], start + int(x), True) for x in at[opens] if _is_key(file, start + int(x), key)]
                        out += [(r["path"], start + int(x), False) for x in at[closes]]
                        depth = int(after[-1]) if len(after) else depth
                        quoted, escaped = quoted ^ bool(marks.quotes & 1), marks.escaped
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["path", "at", "opens"])

    return run


def records(path: str, start: int, stop: int, quoted: bool, depth: int, low: int, high: int,
            block: int = _BLOCK) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the elements that begin in a range of the array whose brackets
    stand at ``low`` and ``high``; the last one is read to its end."""
    pieces, element = None, -1  # the element that is being read and where it begins
    with open_file(path) as file:
        escaped = _escaped(file, start)
        end = min(stop, high + 1)
        for at, data in chain(_blocks(file, start, end, block), _blocks(file, end, high + 1, min(block, _TAIL))):
            marks = Marks(data, escaped)
            place, byte, after = marks.outside(quoted, depth)
            cut = (byte == _COMMA) & (after == 2) | (place + at == low) | (place + at == high)
            cut &= (place + at >= low) & (place + at <= high)
            begin = 0
            for x in place[cut].tolist():
                if pieces is not None:
                    text = b"".join([*pieces, data[begin:x]]).strip()
                    if text:
                        yield element, text
                    elif not (element == low + 1 and at + x == high):
                        raise ValueError(f"an element is missing at {at + x} of {path}")
                pieces, element, begin = [], at + x + 1, x + 1
                if at + x >= stop or at + x == high:
                    return
            if pieces is not None:
                pieces.append(data[begin:])
            depth = int(after[-1]) if len(after) else depth
            quoted, escaped = quoted ^ bool(marks.quotes & 1), marks.escaped
            if pieces is None and at + len(data) >= stop:
                return  # one element covers the whole range


class RecordRange(InputPartition):
    def __init__(self, values: list[tuple]):
        super().__init__(values)


def dealt(ranges: list[tuple], task_bytes: int) -> list[list[tuple]]:
    """Ranges (path, start, stop, ...) in lists of ``task_bytes`` at most, or of one range.
    Ranges at the same place of all documents lie together, those of one document apart."""
    out, size = [], 0
    for r in sorted(ranges, key=lambda r: (r[1], r[0]) if task_bytes else r[:2]):
        size += r[2] - r[1]
        if not out or size > task_bytes:
            out.append([])
            size = r[2] - r[1]
        out[-1].append(r)
    return out


class PayloadReader(DataSourceReader):
    """Reads the ranges that a scan has written to the folder ``ranges``."""

    def __init__(self, options):
        self.folder, self.block = options["ranges"], int(options.get("block", _BLOCK))
        self.task_bytes = int(options.get("task_bytes", 0))

    def partitions(self) -> list[InputPartition]:
        import pyarrow.parquet as pq

        folder = self.folder
        if folder.startswith("file:"):
            folder = "/" + folder[5:].lstrip("/")
        store, inside = fs.FileSystem.from_uri(folder)
        rows = pq.read_table(inside, filesystem=store).to_pylist()
        names = ("path", "start", "stop", "quoted", "depth", "low", "high")
        return [RecordRange(x) for x in dealt([tuple(r[n] for n in names) for r in rows], self.task_bytes)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a table without ranges
            return
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array([p for p, _, _ in held]), pa.array([p for _, p, _ in held], pa.int64()),
                                    pa.array([t.decode("utf-8") for _, _, t in held], pa.string())],
                                   names=["path", "at", "record"])

        for values in partition.value:
            for place, text in records(*values, self.block):
                held.append((values[0], place, text))
                size += len(text)
                if size >= 4 << 20:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()


class PayloadSource(DataSource):
    """``path, at, record``: the elements of documents' data arrays, as JSON text."""

    @classmethod
    def name(cls) -> str:
        return "payload_records"

    def schema(self) -> str:
        return "path string, at long, record string"

    def reader(self, schema) -> PayloadReader:
        return PayloadReader(self.options)


def _ranges(spark: SparkSession, path, range_bytes: int) -> DataFrame:
    """(path, length, start, stop) of all files under ``path``, dealt over tasks."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    cut = files.where("length > 0").select("path", "length", starts.alias("start"))
    cut = cut.select("*", F.least(F.col("start") + range_bytes, "length").alias("stop"))
    most = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut.repartition(max(1, min(cut.count(), most)), "path", "start")


def scan(spark: SparkSession, path: str | list[str], key: str = "data", range_bytes: int = RANGE_BYTES,
         block: int = _BLOCK) -> tuple[str, DataFrame]:
    """(folder of the ranges inside the ``key`` arrays, (path, low, high) of the arrays).

    A document whose strings or brackets do not end raises, as does one with two such
    arrays.  Documents without one have no row.
    """
    root = work_dir(spark, "payload-ranges")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(os.path.join(root, name))
        return spark.read.schema(df.schema).parquet(os.path.join(root, name))

    state = "path string, length long, start long, stop long, "
    summed = _ranges(spark, path, range_bytes).mapInArrow(_summaries(block), state + "flips boolean, plain long, quoted long")
    states = kept(summed.repartition("path").sortWithinPartitions("path", "start")
                  .mapInArrow(_compose, state + "quoted boolean, depth long"), "states")
    most = max(1, min(states.count(), 4 * spark.sparkContext.defaultParallelism))
    edges = kept(states.repartition(most, "path", "start").mapInArrow(
        _edges(key, block), "path string, at long, opens boolean"), "edges")
    opened = edges.where("opens").groupBy("path").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("times"))
    low = F.when(F.col("times") > 1, F.raise_error(F.concat(F.lit(f"more than one {key} in "), "path"))
                 .cast("long")).otherwise(F.col("low"))
    arrays = kept(opened.select("path", low.alias("low")).join(edges.where("not opens"), "path")
                  .where("at > low").groupBy("path", "low").agg(F.min("at").alias("high")), "arrays")
    folder = os.path.join(root, f"ranges-{uuid.uuid4().hex[:8]}")
    (states.join(arrays, "path").where("start <= high and stop > low")
     .select("path", "start", "stop", "quoted", "depth", "low", "high").write.parquet(folder))
    return folder, arrays


def read_responses(spark: SparkSession, path: str | list[str], run_date: bool = False,
                   range_bytes: int = RANGE_BYTES, schema=SC.CITY_RESPONSE, block: int = _BLOCK,
                   task_bytes: int = 0) -> DataFrame:
    """The responses in the payloads' ``data`` arrays, one row each: what
    ``city_responses(read_raw(...))`` gives, but a document is read by as many tasks as it
    has ranges of ``range_bytes``; a task reads one range, or ranges of ``task_bytes`` in all.

    UTF-8 documents of one JSON object each.  A truncated document, a missing element or a
    malformed response raises; a ``null`` element is a row of nulls; a document without the
    array, or a blank file, has no rows.  What stands beside the array is checked as well.
    ``run_date`` adds the date of the file's folder.
    """
    from pluvia.sources.files import RUN_DATE, run_date_of

    rows = record_texts(spark, path, range_bytes, block, task_bytes)
    parsed = F.when(F.col("record") != "null", F.from_json("record", schema, {"mode": "FAILFAST"}))
    extra = [RUN_DATE] if run_date else []
    if run_date:
        rows = rows.withColumn(RUN_DATE, run_date_of(F.col("path")))
    return rows.select(*extra, parsed.alias("r")).select(*extra, "r.*")


def record_texts(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES,
                 block: int = _BLOCK, task_bytes: int = 0) -> DataFrame:
    """(path, at, record): the text of every response and the byte it begins at."""
    folder, arrays = scan(spark, path, range_bytes=range_bytes, block=block)
    headers(spark, path, arrays).write.format("noop").mode("overwrite").save()  # raises where they are no JSON
    spark.dataSource.register(PayloadSource)
    return (spark.read.format(PayloadSource.name()).option("ranges", folder).option("block", str(block))
            .option("task_bytes", str(task_bytes)).load())


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            with open_file(r["path"]) as file:
                if r["low"] is None:
                    text = file.read()
                else:
                    text = file.read_at(r["low"] + 1, 0) + file.read_at(r["length"] - r["high"], r["high"])
            if text.strip():
                document = json.loads(text)
                if not isinstance(document, dict):
                    raise ValueError(f"the document is no object: {r['path']}")
                out.append((r["path"], text.decode("utf-8-sig")))
        if out:
            yield pa.record_batch([pa.array(c) for c in zip(*out)], names=["path", "header"])


def headers(spark: SparkSession, path: str | list[str], arrays: DataFrame) -> DataFrame:
    """(path, header): every document without its array's elements, which must be JSON."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    return files.join(arrays, "path", "left").select("path", "length", "low", "high").mapInArrow(
        _outside, "path string, header string")


def read_headers(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The payloads' own fields (all but ``data``), one row a document."""
    _, arrays = scan(spark, path, range_bytes=range_bytes)
    own = [f for f in SC.RAW_PAYLOAD.fields if f.name != "data"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
    return headers(spark, path, arrays).select(
        F.from_json("header", schema, {"mode": "FAILFAST"}).alias("h")).select("h.*")
