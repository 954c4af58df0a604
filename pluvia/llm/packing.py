"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A piece of length in (C/(k+1), C/k] belongs to class k, whose sequences hold exactly
k pieces.  Documents may be cut, so a document gives its full sequences (class 1) and
its rest is cut at the reciprocal-capacity sizes C // k: a rest close enough below a
size stays whole, otherwise the next smaller size is cut off and the rest goes on.
The rest shrinks about quadratically, so a document has few pieces.  Each task fills
its classes on its own: no shuffle, no counts shared between workers.  The classes'
last, unfilled sequences of a task are joined, cut at the capacity, and the last
stretch of those at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pluvia.llm.common import slices, text_rows, texts_of, worker_state

CAPACITY = 2048
# A piece may fall short of its class's size by this share before it is cut.
SLACK = 1 / 128
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
_FLUSH_BYTES = 4 << 20


def encoder(tokenizer_path: str, ranks_path: str | None):
    """text -> array of uint32 ids, as the tokenizers library gives them.

    With ``ranks_path`` (the same vocabulary as merge ranks), texts of Latin code
    points, where both libraries split alike (tested for every one of them), go
    through the faster merge loop; all other texts through the library itself.
    """
    def build():
        import json
        import os
        import re

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = []  # the library's tokenizer, once a text needs it

        def slow(text):
            if not held:
                from tokenizers import Tokenizer

                tok = Tokenizer.from_file(tokenizer_path)
                tok.no_truncation()
                tok.no_padding()
                held.append(tok)
            return np.array(held[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

        if ranks_path is None:
            return slow
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(tokenizer_path, encoding="utf-8") as file:
            special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks=ranks, special_tokens=special)
        del ranks
        other = re.compile(r"[^\u0000-ɏ]")
        allowed = set(special)

        def fast(text):
            if not text.isascii() and other.search(text):
                return slow(text)
            try:
                return np.array(enc.encode(text, allowed_special=allowed), dtype="<u4")
            except ValueError:  # its pattern cannot split runs of about a million blanks
                return slow(text)

        return fast

    return worker_state(("packing", tokenizer_path, ranks_path), build)


def cut(length: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(piece length, class) of the pieces of a document of ``length`` ids, in order."""
    out = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        k = capacity // rest
        size = capacity // k
        if size - rest <= slack * size:
            out.append((rest, k))
            break
        size = capacity // (k + 1)
        out.append((size, capacity // size))
        rest -= size
    return out


class _Packer:
    """One task's open sequences and its finished rows."""

    def __init__(self, first_sequence: int, capacity: int, slack: float):
        self.next_sequence, self.capacity, self.slack = first_sequence, capacity, slack
        self.open: dict[int, list] = {}
        self.rows, self.bytes = [], 0

    def add(self, doc_id, ids) -> None:
        start, total = 0, len(ids)
        for length, k in cut(total, self.capacity, self.slack):
            piece = (doc_id, start, ids[start:start + length].tobytes(), total)
            start += length
            filled = self.open.setdefault(k, [])
            filled.append(piece)
            if len(filled) == k:
                self.close(filled)
                self.open[k] = []

    def close(self, pieces) -> None:
        offset = 0
        for doc_id, start, data, total in pieces:
            n = len(data) // 4
            self.rows.append((doc_id, start, n, data, total, self.next_sequence, offset))
            self.bytes += len(data)
            offset += n
        self.next_sequence += 1

    def finish(self) -> None:
        """Join what the unfilled sequences hold and cut it without padding."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        tokens = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (tokens // self.capacity)
        rest = tokens % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        left.reverse()
        for size in sizes:
            taken, room = [], size
            while room:
                doc_id, start, data, total = left.pop()
                n = min(room, len(data) // 4)
                taken.append((doc_id, start, data[:4 * n], total))
                if 4 * n < len(data):
                    left.append((doc_id, start + n, data[4 * n:], total))
                room -= n
            self.close(taken)
        self.open = {}

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(_NAMES)
        self.rows, self.bytes = [], 0
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None,
         end_id: int = 1, capacity: int = CAPACITY, slack: float = SLACK,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian uint32),
    ``doc_tokens, sequence_id, offset``.

    A document is its ids followed by ``end_id`` (null or empty text: ``end_id`` alone).
    Every id lies in exactly one piece; pieces lie gapless from offset 0 in their
    sequence.  Sequence ids hold the task's number in the upper bits, so they are unique
    without coordination and a repeated task gives the same ones.  Repeated rows are
    packed as often as they occur; null ids stay null; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        encode = encoder(tokenizer_path, ranks_path)
        end = np.array([end_id], dtype="<u4")
        packer = _Packer(TaskContext.get().partitionId() << 33, capacity, slack)
        for part in slices(batches, "text"):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                packer.add(doc_id, np.concatenate([encode(text), end]) if text else end)
                if packer.bytes >= _FLUSH_BYTES:
                    yield packer.flush()
        packer.finish()
        yield packer.flush()

    return text_rows(docs, id_col, text_col).mapInArrow(run, SCHEMA)
