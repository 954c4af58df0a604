"""The prefix trie of conversations, by adaptive radix trees.

A turn becomes a fixed-width id (the first bytes, big-endian, of a digest of role and
text), a conversation the concatenation of its turns' ids.  The keys are sorted into
ranges over the cluster; each task builds radix trees (:mod:`pluvia.llm.radix`) over
stretches of its range and walks them once from below, where only byte depths that are
whole turns give nodes.  All nodes off the first and last key of a stretch are complete.
The others may go on in the neighbouring stretch: they are summed by a digest of their
path, with one correction for each border between two stretches, so a first turn that a
third of all conversations share is no group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import staged
from pluvia.llm.radix import RadixTree

# Bytes of a turn's id: of a SHA-256, so different turns have different ids.
WIDTH = 16
# A stretch: the conversations and key bytes of one tree.
STRETCH_KEYS, STRETCH_BYTES = 1 << 15, 16 << 20
WORD = r"[^\x20\x09-\x0D]+"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_OUT = ("kind string, id binary, parent_id binary, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
        "task int, place long, piece string, first_key binary, last_key binary, last_words binary")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = [{"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}[c.split()[1]]
          for c in _OUT.split(", ")]


def turn_sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, each (id, words).

    Turns are ordered by ``turn``, null first; rows of one turn by their id.  Null role
    or text is empty.  Rows without a conv_id belong to no conversation and go.  No text
    is shuffled.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.unhex(F.substring(digest, 1, 2 * WIDTH)).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(sequences: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % group
    (all if it has fewer, none if it is absent), h = crc32(decimal c) % ``most``."""
    c = F.col("conv_id")
    own = sequences.select("conv_id", "turns", (c - c % group).alias("base"),
                           (F.crc32(c.cast("string").cast("binary")) % most).cast("int").alias("h"))
    heads = sequences.where(c % group == 0).select(
        c.alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    head = F.coalesce("head", F.slice("turns", 1, 0))
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.slice(head, 1, F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


class _Stretch:
    """The trie nodes of one tree, as rows."""

    def __init__(self, width: int):
        self.width, self.tree = width, RadixTree()
        self.n, self.bytes = 0, 0
        self.first = self.last = None  # (key, words)

    def add(self, key: bytes, words, conv_id: int) -> None:
        self.tree.insert(key, (conv_id, words))
        self.first = self.first or (key, words)
        self.last = key, words
        self.n, self.bytes = self.n + 1, self.bytes + len(key)

    def rows(self, task: int, place: int) -> Iterator[tuple]:
        """Complete nodes, open ones (on the first or last key) and the ends of those."""
        first, last = path_ids(self.first[0], self.width), path_ids(self.last[0], self.width)
        w = self.width
        # What the walk has seen below each tree node: [least member, members, childless
        # trie nodes, saved tokens, trie children with their rows that wait for a parent].
        done: list[list] = []
        on_first, on_last = [True], [True]  # is the path so far the first, last key's?
        for node, above, depth, leaving in self.tree.walk():
            if not leaving:
                on_first.append(on_first[-1] and self.first[0][above:depth] == node.path)
                on_last.append(on_last[-1] and self.last[0][above:depth] == node.path)
                done.append([None, 0, 0, 0, []])
                continue
            on_first.pop()
            on_last.pop()
            least, members, leaves, saved, waiting = done.pop()
            if node.ends:
                # Ends come in ascending order.
                least = node.ends[0][0] if least is None else min(least, node.ends[0][0])
                members += len(node.ends)
            words = node.sample[1]
            # Turn-aligned depths of this node's path, the deepest first; the root is one.
            low = above // w + 1 if above or node.path else 0
            ends = [v[0] for v in node.ends]
            for d in range(depth // w, low - 1, -1):
                children = len(waiting)
                leaves = leaves or (1 if not children else 0)
                if d:
                    saved += (members - 1) * int(words[d - 1])
                listed = ends if d * w == depth else []
                is_open = None
                if self._shares(on_first, node, self.first[0], above, d):
                    is_open = first[d]
                elif self._shares(on_last, node, self.last[0], above, d):
                    is_open = last[d]
                for child in waiting:
                    yield self._row(*child, parent=(is_open, least))
                waiting = [(is_open, least, d, members, children, leaves, saved,
                            None if is_open is not None else sha256_of(listed))]
                if is_open is not None and listed:
                    yield from self._pieces(is_open, listed, task, place)
            if done:
                up = done[-1]
                up[0] = least if up[0] is None else min(up[0], least)
                up[1] += members
                up[2] += leaves
                up[3] += saved
                up[4] += waiting
            else:
                for root in waiting:
                    yield self._row(*root, parent=(None, None))

    def _shares(self, on: list[bool], node, key: bytes, above: int, d: int) -> bool:
        """Is the trie node at depth d of the node's path a prefix of the key?"""
        end = d * self.width
        return on[-1] and len(key) >= end and key[above:end] == node.path[:end - above]

    @staticmethod
    def _row(id_, least, depth, members, children, leaves, saved, ends, parent) -> tuple:
        parent_id, parent_conv = parent
        return ("open" if id_ is not None else "node", id_, parent_id, least, depth,
                None if parent_id is not None else parent_conv, members, children, leaves, saved, ends,
                None, None, None, None, None, None)

    @staticmethod
    def _pieces(id_, ids, task, place) -> Iterator[tuple]:
        for i in range(0, len(ids), 4096):
            yield ("ends", id_, *[None] * 9, task, place << 32 | i, ",".join(map(str, ids[i:i + 4096])), None, None, None)


def sha256_of(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else EMPTY_SHA256


def path_ids(key: bytes, width: int) -> list[bytes]:
    """Digest of every turn-aligned prefix of a key, from the root on."""
    out = [b"root"]
    for i in range(0, len(key), width):
        out.append(hashlib.sha256(out[-1] + key[i:i + width]).digest()[:16])
    return out


def border(last: bytes, first: bytes, words, width: int) -> Iterator[tuple]:
    """Corrections where ``last`` ends one stretch and ``first`` begins the next: the
    nodes on both keys were counted in both.

    Of a node at depth d, the child on both keys was counted twice; each repeated node
    at or below d took its tokens off twice; the last key's end was counted childless,
    which it is not, or not only there, if it lies on the first key.
    """
    common = 0
    while (common + 1) * width <= min(len(last), len(first)) and \
            last[common * width:(common + 1) * width] == first[common * width:(common + 1) * width]:
        common += 1
    ended = common * width == len(last)
    ids, again = path_ids(first[:common * width], width), 0
    for d in range(common, -1, -1):
        again += int(words[d - 1]) if d else 0
        yield ("open", ids[d], ids[d - 1] if d else None, None, d, None, 0, -1 if d < common else 0,
               -1 if ended else 0, again, *[None] * 7)


def _trees(width: int, stretch_keys: int, stretch_bytes: int):
    """Sorted (key, words, conv_id) -> rows of ``_OUT``; one "task" row holds the
    task's first and last key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        task, place, rows = TaskContext.get().partitionId(), 0, []
        stretch = first = last = None

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)

        for part in batches:
            for key, words, conv_id in zip(*(part.column(c).to_pylist() for c in ("key", "words", "conv_id"))):
                if stretch is not None and (stretch.n >= stretch_keys or stretch.bytes >= stretch_bytes):
                    for row in stretch.rows(task, place):
                        rows.append(row)
                        if len(rows) >= 1 << 14:
                            yield batch()
                    rows.extend(border(last[0], key, np.frombuffer(last[1], ">u4"), width))
                    stretch, place = None, place + 1
                if stretch is None:
                    stretch = _Stretch(width)
                stretch.add(key, np.frombuffer(words, ">u4"), conv_id)
                first, last = first or key, (key, words)
        if stretch is None:
            return
        for row in stretch.rows(task, place):
            rows.append(row)
            if len(rows) >= 1 << 14:
                yield batch()
        rows.append(("task", *[None] * 10, task, None, None, first, last[0], last[1]))
        yield batch()

    return run


def _borders(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for part in batches:
            rows = [row for r in part.to_pylist() for row in
                    border(r["last_key"], r["next_key"], np.frombuffer(r["last_words"], ">u4"), width)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (id, task, place) -> SHA-256 of each id's joined pieces, as a stream."""
    open_id, state, out = None, None, []
    for part in batches:
        for id_, piece in zip(part.column("id").to_pylist(), part.column("piece").to_pylist()):
            if id_ != open_id:
                if state is not None:
                    out.append((open_id, state.hexdigest()))
                open_id, state = id_, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))],
                                  names=["id", "ends"])
            out = []
    if state is not None:
        yield pa.record_batch([pa.array([open_id], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends"])


def trie_nodes(sequences: DataFrame, stretch_keys: int = STRETCH_KEYS, stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """The trie of ``sequences(conv_id, turns)``: one row a node, ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (each node's (members - 1) x words of its last turn,
    summed over its subtree) and ``ends_sha256`` (of the comma-joined ascending ids of
    the conversations that end there).

    Sequences without turns end at the root; an empty table has no root.  A sequence, its
    ids and word numbers, must fit one row.  Equal sequences are ordered by conv_id and
    spread over tasks like any others; the ids of one node's ends reach one task only as
    a stream of packed pieces, since SHA-256 has to read them in order.
    """
    keys = sequences.select(
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.unhex(F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(t["words"].cast("long")), 8, "0")),
                             "")).alias("words"),
        "conv_id")
    ordered = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = staged(ordered.mapInArrow(_trees(WIDTH, stretch_keys, stretch_bytes), _OUT), "trie")
    # The tasks that have rows, one number each, know the next one; keys are joined after.
    tasks = found.where("kind = 'task'")
    following = tasks.select("task", F.lead("task").over(Window.orderBy("task")).alias("next_task"))
    tasks = (tasks.select("task", "last_key", "last_words").join(following.where("next_task is not null"), "task")
             .join(tasks.select(F.col("task").alias("next_task"), F.col("first_key").alias("next_key")), "next_task"))
    between = tasks.mapInArrow(_borders(WIDTH), _OUT)
    pieces = (found.where("kind = 'ends'").select("id", "task", "place", "piece")
              .repartition("id").sortWithinPartitions("id", "task", "place").select("id", "piece"))
    ends = pieces.mapInArrow(_digests, "id binary, ends string")
    merged = found.where("kind = 'open'").unionAll(between).groupBy("id").agg(
        F.min("parent_id").alias("parent_id"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in _COUNTS))
    opened = staged(merged.join(ends, "id", "left").withColumn(
        "ends_sha256", F.coalesce("ends", F.lit(EMPTY_SHA256))).drop("ends"), "trie-open")
    parents = opened.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent"))
    columns = ["conv_id", "depth", "parent_conv_id", *_COUNTS, "ends_sha256"]
    nodes = found.where("kind = 'node'")
    waiting = nodes.where("parent_id is not null").select("parent_id", *columns).unionAll(
        opened.where("parent_id is not null").withColumn("parent_conv_id", F.lit(None).cast("long"))
        .select("parent_id", *columns))
    named = waiting.join(parents, "parent_id").withColumn("parent_conv_id", F.col("parent")).select(*columns)
    root = opened.where("parent_id is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return nodes.where("parent_id is null").select(*columns).unionAll(named).unionAll(root.select(*columns))
