"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most r of 64 bits agree wholly in at least m - r of m
bit blocks, so every choice of m - r blocks gives a key under which such pairs meet.
Rows of a key lie together, sorted; their bits are stored vertically, as 64 planes.
For one shift d the distances of all pairs (i, i + d) grow together: each plane is
compared with itself shifted by d, and carry-save counters add the difference bits of
64 pairs a word.  A word whose pairs all exceed the radius is abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices, staged, text_rows
from pluvia.llm.components import components

SHINGLE, RADIUS, BLOCKS = 3, 3, 5
# Fingerprints compared at once; a key with more is split into tiles of twice as many.
TILE = 1024
SEED = 42
_RUN = 1 << 16
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the text's word shingles (see :func:`fingerprints`)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(p, SEED) for p in parts), np.uint64)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row: A-Z lower-cased, words split at ASCII white space,
    word shingles with repeats (a shorter text: its whole word sequence), XXH64; a bit is
    set if it is in over half the hashes.  No words (or null): 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw = part.column("text").cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t, shingle) for t in raw), np.uint64, len(raw))
            yield pa.record_batch([part.column("doc_id"), pa.array(fps.view(np.int64))],
                                  names=["doc_id", "fp"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def block_masks(blocks: int) -> list[int]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def meeting_keys(fp: Column, radius: int, blocks: int) -> Column:
    """Array of keys, one for each choice of blocks that must agree."""
    masks = block_masks(blocks)
    keys = [F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(_signed(sum(masks[j] for j in chosen)))))
            for i, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    return F.array(*keys)


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 bit planes; bit i of plane b is bit b of fingerprint i.  One spare word."""
    words = -(-len(fps) // 64) + 1
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((64, words * 64), np.uint8)
    out[:, :len(fps)] = bits.T
    return np.packbits(out, axis=1, bitorder="little").view("<u8")


def close_at_shift(planes: np.ndarray, wanted: np.ndarray, d: int, radius: int) -> np.ndarray:
    """Positions i with ``wanted[i]`` whose fingerprint is within the radius of i + d's."""
    words = planes.shape[1] - 1
    flags = np.zeros(words * 64, np.uint8)
    flags[:len(wanted)] = wanted
    live = np.packbits(flags, bitorder="little").view("<u8")
    at = np.flatnonzero(live)
    if not len(at):
        return at
    hop, rest = d >> 6, np.uint64(d & 63)
    # Counters start so that one more than the radius carries out of the top.
    width = radius.bit_length()
    first = (1 << width) - 1 - radius
    counter = [np.full(len(at), _ONES if first >> j & 1 else 0, np.uint64) for j in range(width)]
    over = ~live[at]
    far = min(words, planes.shape[1] - 1)
    for b in range(64):
        lo = planes[b, np.minimum(at + hop, far)]
        if rest:
            hi = planes[b, np.minimum(at + hop + 1, far)]
            lo = (lo >> rest) | (hi << (np.uint64(64) - rest))
        carry = planes[b, at] ^ lo
        for j in range(width):
            counter[j], carry = counter[j] ^ carry, counter[j] & carry
        over |= carry
        if b % 8 == 7:
            stay = over != _ONES
            if not stay.all():
                at, over = at[stay], over[stay]
                counter = [c[stay] for c in counter]
                if not len(at):
                    return at
    near = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little").astype(bool)
    row, bit = np.nonzero(near)
    return at[row] * 64 + bit


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def link_sorted(group: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For every row the first row of its group that it reaches by links within the group.

    ``group`` numbers the rows' groups, equal ones adjacent.  Pairs that earlier shifts
    have already connected need no distance.
    """
    n = len(fps)
    label = np.arange(n)
    planes = planes_of(fps)
    d = 1
    while d < n:
        together = group[:n - d] == group[d:]
        if not together.any():
            break
        i = close_at_shift(planes, together & (label[:n - d] != label[d:]), d, radius)
        while len(i):
            x, y = label[i], label[i + d]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            label = _roots(label)
            i = i[label[i] != label[i + d]]
        d += 1
    return label


def _local_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tile, fp = (np.zeros(0, np.int64) for _ in range(3))

        def links(n: int) -> pa.RecordBatch:
            change = np.concatenate([[0], (key[1:n] != key[:n - 1]) | (tile[1:n] != tile[:n - 1])])
            label = link_sorted(np.cumsum(change), fp[:n].view(np.uint64), radius)
            moved = np.flatnonzero(label != np.arange(n))
            return pa.record_batch([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["a", "b"])

        for batch in batches:
            key, tile, fp = (np.concatenate([old, batch.column(c).to_numpy()])
                             for old, c in ((key, "key"), (tile, "tile"), (fp, "fp")))
            if len(key) >= _RUN:
                last = np.flatnonzero((key != key[-1]) | (tile != tile[-1]))
                if len(last):
                    n = int(last[-1]) + 1
                    yield links(n)
                    key, tile, fp = key[n:], tile[n:], fp[n:]
        if len(key):
            yield links(len(key))

    return run


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                      tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct(fp)`` within ``radius`` bits: of each
    key's rows a forest, so as many rows as there are fingerprints at most, not all pairs.

    A key with more than ``tile`` rows is cut into parts by a hash; each pair of parts
    is a tile of its own, so no task holds an unbounded key.
    """
    keyed = distinct.select("fp", F.explode(meeting_keys(F.col("fp"), radius, blocks)).alias("key"))
    heavy = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
             .select("key", F.ceil(F.col("n") / tile).cast("long").alias("parts")))
    placed = keyed.join(heavy, "key", "left")
    part = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    light = placed.where("parts is null").select("key", F.lit(-1).cast("long").alias("tile"), "fp")
    split = (placed.where("parts is not null").select("key", "fp", "parts", part.alias("i"))
             .select("*", other.alias("j"))
             .select("key", (F.least("i", "j") * F.col("parts") + F.greatest("i", "j")).alias("tile"), "fp"))
    met = light.unionAll(split).repartition("key", "tile").sortWithinPartitions("key", "tile", "fp")
    return met.mapInArrow(_local_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    blocks: int = BLOCKS, tile: int = TILE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fp`` (signed long) and ``component_id``, the
    smallest id reachable over fingerprints at most ``radius`` bits apart.

    Copies share a fingerprint and are compared once.  Texts without words share
    fingerprint 0.  A null id keeps its row but names no component (a component of null
    ids only has a null id).  Repeated rows repeat; an empty table gives no rows.
    """
    fps = staged(fingerprints(docs, shingle, id_col, text_col), "simhash")
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    linked = components(fingerprint_links(firsts.select("fp"), radius, blocks, tile))
    member = firsts.join(linked, firsts.fp == linked.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
