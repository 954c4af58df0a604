"""Phrase collocations by vertically partitioned suffix trees.

Every place of a text begins a suffix, cut after ``DEPTH`` words.  Suffixes are divided
vertically, by their first words: hashed first words are groups; a group with more
suffixes than the memory budget is divided by its first two words, and what is still too
large by the whole cut suffix.  Each group is built by itself in one task: its suffixes
sorted, their common prefixes are the inner nodes of a depth-truncated suffix tree, and
a phrase's count is the total of the leaves below its node.

Words, then pairs, that are too rare to be part of a frequent phrase end a suffix before
any of that; bit maps of a bounded size tell the tasks which (a false one costs work only).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.llm.common import slices, staged

DEPTH, MIN_COUNT, TOP = 5, 100, 2000
TOP_PARTS = 64  # a language's phrases are ranked in so many parts first
# Suffixes a group may hold, and the text bytes a task works on at a time.
GROUP_BUDGET, BLOCK_BYTES = 500_000, 4 << 20
# Bits of the maps for each frequent word or pair, and of a map at most (32 MB).
MAP_BITS_EACH, MAP_BITS_MOST = 16, 1 << 28
_PAGE = 1 << 15  # bits of one bitmap_construct_agg

# A-Z to lower case, marks and line ends to one piece end, tab to space.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\x09",
                         b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_CONTEXT = re.compile(rb"(?: *[^ \n]+){0,%d}" % (DEPTH - 1))
_BREAK = re.compile(rb"[ \n]")


def blocks(texts: list[bytes], limit: int) -> Iterator[tuple[bytes, int]]:
    """(block, own): texts normalised, joined and cut at white space after ``limit`` bytes;
    what follows the first ``own`` bytes is the next block's start, as context."""
    data, at = b"\n".join(texts).translate(_TABLE), 0
    while at < len(data):
        found = _BREAK.search(data, at + limit)
        end = found.start() if found else len(data)
        stop = _CONTEXT.match(data, end).end() if end < len(data) else end
        yield data[at:stop], end - at
        at = end


class Words:
    """The words of a block: ``code`` of each one in ``unique``, where it ``starts``, and
    whether the next one follows it in the same piece (``chain``)."""

    def __init__(self, block: bytes):
        raw = np.frombuffer(block, np.uint8)
        inside = np.concatenate([[False], (raw != 32) & (raw != 10), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32)
        self.starts = edges[::2]
        # Words and what lies between them are the entries of one Arrow array.
        spans = pa.Array.from_buffers(pa.binary(), max(0, len(edges) - 1),
                                      [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(block)])
        words = spans.take(pa.array(np.arange(0, len(edges), 2))).dictionary_encode()
        self.code, self.unique = words.indices.to_numpy(), words.dictionary
        ends = np.flatnonzero(raw == 10)
        piece = np.searchsorted(ends, self.starts)
        self.chain = np.append(piece[1:] == piece[:-1], False)[:len(self.starts)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(unique: pa.Array, lang: str) -> np.ndarray:
    """64 bits for each (language, word)."""
    digest, seed = xxhash.xxh64_intdigest, xxhash.xxh64_intdigest(lang)
    return np.fromiter((digest(w, seed) for w in unique.to_pylist()), np.uint64, len(unique))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * np.uint64(0x9E3779B97F4A7C15) + _mix(second))


class BitMap:
    """A hashed set: no false negatives."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def __contains__(self, value) -> bool:
        return bool(self.has(np.array([value], np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """The lowest bits of column ``h`` as a map of ``bits`` (a power of two) bits, set on
    the executors; pages of 4 KB come to the driver, ``bits`` / 32768 at most."""
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    pages = hashes.groupBy(F.shiftright(slot, 15).alias("page")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit(_PAGE - 1))).alias("map"))
    out = np.zeros(max(1, bits // _PAGE) * (_PAGE // 8), np.uint8)
    for r in pages.toLocalIterator():
        out[r["page"] * (_PAGE // 8):(r["page"] + 1) * (_PAGE // 8)] = np.frombuffer(r["map"], np.uint8)
    return out


def map_bits(entries: int) -> int:
    return min(MAP_BITS_MOST, max(_PAGE, 1 << (max(1, entries) * MAP_BITS_EACH - 1).bit_length()))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def _by_language(batches, block_bytes: int) -> Iterator[tuple[str, Words, int]]:
    """(language, words of a block, bytes of it that are its own)."""
    for part in slices(batches, "text", block_bytes):
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            texts = part.column("text").filter(pa.array(langs == lang)).to_pylist()
            for block, own in blocks(texts, block_bytes):
                yield lang, Words(block), own


def word_counts(texts: DataFrame, block_bytes: int) -> DataFrame:
    """(lang, word, n) of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, own in _by_language(batches, block_bytes):
            n = np.bincount(words.code[words.starts < own], minlength=len(words.unique))
            some = np.flatnonzero(n)
            unique = words.unique.take(pa.array(some))
            yield pa.record_batch([pa.array([lang] * len(some), pa.string()), unique.view(pa.string()),
                                   pa.array(word_hashes(unique, lang).view(np.int64)),
                                   pa.array(n[some].astype(np.int64))], names=["lang", "word", "h", "n"])

    return (texts.mapInArrow(run, "lang string, word string, h long, n long")
            .groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("n").alias("n")))


def pair_counts(texts: DataFrame, frequent, block_bytes: int) -> DataFrame:
    """(h, first, n): hash of each pair of words in the map, hash of its first word, places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = BitMap(frequent.value)
        for lang, words, own in _by_language(batches, block_bytes):
            h = word_hashes(words.unique, lang)
            ok = allowed.has(h)[words.code]
            at = np.flatnonzero(words.chain & ok & np.append(ok[1:], False) & (words.starts < own))
            first = h[words.code[at]]
            pair, where, n = np.unique(pair_hashes(first, h[words.code[at + 1]]), return_index=True, return_counts=True)
            yield pa.record_batch([pa.array(pair.view(np.int64)), pa.array(first[where].view(np.int64)),
                                   pa.array(n.astype(np.int64))], names=["h", "first", "n"])

    return (texts.mapInArrow(run, "h long, first long, n long")
            .groupBy("h").agg(F.min("first").alias("first"), F.sum("n").alias("n")))


def suffixes(texts: DataFrame, pairs, heavy, groups: int, block_bytes: int) -> DataFrame:
    """(grp, whole, lang, phrase, n): the cut suffixes of two words and more, each
    distinct one of a block once, with the group that builds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed, (over1, over2) = BitMap(pairs.value), (BitMap(m) for m in heavy.value)
        for lang, words, own in _by_language(batches, block_bytes):
            h = word_hashes(words.unique, lang)[words.code]
            pair = np.zeros(len(h), np.uint64)
            pair[:-1] = pair_hashes(h[:-1], h[1:])
            ok = words.chain & allowed.has(pair)
            # Words of the suffix at each place: the pairs that hold in a row, and one.
            length, still = np.ones(len(h), np.int8), ok.copy()
            for j in range(1, DEPTH):
                length[:len(h) - j + 1] += still[:len(h) - j + 1]
                still[:-j] &= ok[j:]
                still[-j:] = False
            at = np.flatnonzero(ok & (words.starts < own))
            if not len(at):
                continue
            codes = np.full((len(at), DEPTH), -1, np.int64)
            for j in range(DEPTH):
                has = length[at] > j
                codes[has, j] = words.code[at[has] + j]
            # A block holds under 2**21 words, or is one text's without white space.
            order = np.lexsort(codes.T[::-1])
            codes, at = codes[order], at[order]
            new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]).any(1)))
            n = np.diff(np.append(new, len(at)))
            codes, at = codes[new], at[new]
            whole = np.zeros(len(at), np.uint64)
            for j in range(DEPTH):
                whole = _mix(whole * np.uint64(31) + codes_hash(h, at, j, codes[:, j]))
            mask = np.uint64(groups - 1)
            one, two = h[at] & mask, pair[at] & mask
            level = over1.has(one).astype(np.int64)
            level += (level == 1) & over2.has(two)
            group = np.select([level == 0, level == 1], [one, two], whole & mask).astype(np.int64) + level * groups
            columns = [words.unique.take(pa.array(codes[:, j], mask=codes[:, j] < 0)) for j in range(DEPTH)]
            phrase = pc.binary_join_element_wise(*columns, pa.scalar(b" "), null_handling="skip")
            yield pa.record_batch([pa.array(group), pa.array(level == 2), pa.array([lang] * len(at), pa.string()),
                                   phrase.view(pa.string()), pa.array(n.astype(np.int64))],
                                  names=["grp", "whole", "lang", "phrase", "n"])

    return texts.mapInArrow(run, "grp long, whole boolean, lang string, phrase string, n long")


def codes_hash(h: np.ndarray, at: np.ndarray, j: int, code: np.ndarray) -> np.ndarray:
    """Hash of each suffix's word j, 0 where it has none."""
    return np.where(code >= 0, h[np.minimum(at + j, len(h) - 1)], np.uint64(0))


def _merge(lang: pa.Array, phrase: pa.Array, n: np.ndarray):
    """Rows sorted as suffixes, equal ones added: (codes, words, languages, n)."""
    parts = pc.split_pattern(phrase, " ")
    sizes = np.diff(parts.offsets.to_numpy())
    flat = parts.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(phrase)), sizes)
    codes = np.full((len(phrase), DEPTH), -1, np.int32)
    codes[owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat.indices.to_numpy()
    tongue = lang.dictionary_encode()
    table = np.column_stack([tongue.indices.to_numpy(), codes])
    order = np.lexsort(table.T[::-1])
    table, n = table[order], n[order]
    new = np.flatnonzero(np.append(True, (table[1:] != table[:-1]).any(1)))
    return table[new], flat.dictionary, tongue.dictionary, np.add.reduceat(n, new)


def subtree_counts(lang, phrase, n, whole: bool, min_count: int) -> pa.RecordBatch:
    """(lang, phrase, n) of the nodes of one group's subtree, from their leaf totals.

    A group of first words or first pairs holds all suffixes of its nodes, so rare nodes
    go at once.  Of a group of whole suffixes only the deepest nodes are complete.
    """
    table, words, names, n = _merge(lang, phrase, n)
    out = []
    change = np.zeros(len(table), bool)
    change[:1] = True
    change[1:] |= table[1:, 0] != table[:-1, 0]
    for depth in range(1, DEPTH + 1):
        change[1:] |= table[1:, depth] != table[:-1, depth]
        if depth == 1:
            continue
        node = np.flatnonzero(change)
        total = np.add.reduceat(n, node)
        keep = table[node, depth] >= 0
        if not whole or depth == DEPTH:
            keep &= total >= min_count
        node, total = node[keep], total[keep]
        columns = [words.take(pa.array(table[node, j])) for j in range(1, depth + 1)]
        out.append((names.take(pa.array(table[node, 0])), pc.binary_join_element_wise(*columns, " "), total))
    return pa.record_batch([pa.concat_arrays([o[0] for o in out]), pa.concat_arrays([o[1] for o in out]),
                            pa.array(np.concatenate([o[2] for o in out]))], names=["lang", "phrase", "n"])


def _subtrees(min_count: int, budget: int):
    """Rows with equal groups adjacent -> the counts of each group's subtree.

    Many small groups are built together, up to the budget; a group's rows beyond it are
    added up first, so what is held is its distinct suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def build(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for whole in (False, True):
                some = rows.filter(pc.equal(rows["whole"], whole)).combine_chunks()
                if some.num_rows:
                    yield subtree_counts(some["lang"].combine_chunks(), some["phrase"].combine_chunks(),
                                         some["n"].to_numpy(), whole, min_count)

        size = added = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < added + budget:
                continue
            rows = pa.Table.from_batches(held)
            group = rows["grp"].to_numpy()
            done = int(np.searchsorted(group, group[-1]))
            if done:
                yield from build(rows.slice(0, done))
            # The last group may go on: keep it, its equal suffixes added up.
            rest = rows.slice(done).group_by(["grp", "whole", "lang", "phrase"]).aggregate([("n", "sum")])
            rest = rest.rename_columns([c.removesuffix("_sum") for c in rest.column_names]).select(rows.column_names)
            held = rest.combine_chunks().to_batches()
            size = added = rest.num_rows
        if held:
            yield from build(pa.Table.from_batches(held))

    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, budget: int = GROUP_BUDGET,
                  block_bytes: int = BLOCK_BYTES, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, f) of all phrases of 1 to DEPTH words with f >= min_count,
    (lang, n) of all word occurrences), over whole texts."""
    sc, texts = docs.sparkSession.sparkContext, _texts(docs, text_col, lang_col)
    counted = staged(word_counts(texts, block_bytes), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counted.where(F.col("n") >= min_count)
    frequent = sc.broadcast(bit_map(words.select("h"), map_bits(words.count())))
    pairs = staged(pair_counts(texts, frequent, block_bytes).where(F.col("n") >= min_count), "pairs")
    number, places = pairs.agg(F.count("h"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = min(MAP_BITS_MOST, max(64, 1 << (2 * places // budget).bit_length()))
    heavy = [bit_map(pairs.groupBy(F.col(c).bitwiseAND(F.lit(groups - 1)).alias("h")).agg(F.sum("n").alias("n"))
                     .where(F.col("n") > budget).select("h"), max(groups, _PAGE)) for c in ("first", "h")]
    routed = suffixes(texts, sc.broadcast(bit_map(pairs.select("h"), map_bits(number))), sc.broadcast(heavy),
                      groups, block_bytes)
    built = (routed.repartition("grp").sortWithinPartitions("grp")
             .mapInArrow(_subtrees(min_count, budget), "lang string, phrase string, n long"))
    counts = built.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return counts.unionAll(words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))), totals


def _big(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, contained: int = 100,
                 budget: int = GROUP_BUDGET, block_bytes: int = BLOCK_BYTES, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to 5 words of each language: ``lang, rank, phrase, a, l, r,
    n, score``.

    ``a`` is the phrase's count, at least ``min_count``; of its cuts into a first part
    (count l) and a rest (r) the one with the lowest floor(1000 * a * n / (l * r)) counts,
    ties to the shortest first part.  A phrase inside a longer one that has at least
    ``contained`` percent of its count is dropped.  Order: score, a, both descending,
    phrase.  Null lang is ``und``; null, empty and blank texts have no words; repeated rows
    count as often as they occur; an empty table gives no rows.
    """
    counts, totals = phrase_counts(docs, min_count, budget, block_bytes, text_col, lang_col)
    counts = staged(counts, "phrases")
    parts = F.split("phrase", " ")
    size = F.size(parts)
    found = counts.where(F.col("phrase").contains(" "))
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice(parts, F.col("k") + 1, size), " ").alias("rest"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # Exact: products are decimals of 38 digits, which raise where they do not suffice.
    score = F.expr("cast((1000 * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) "
                   "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as long)")
    scored = (cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
              .select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut")))
    # A longer phrase of any length has no more places than the one a word longer inside it.
    shorter = F.explode(F.array(F.array_join(F.slice(parts, F.lit(1), size - 1), " "),
                                F.array_join(F.slice(parts, F.lit(2), size - 1), " ")))
    inside = (found.where(size > 2).select("lang", "f", shorter.alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_big(F.col("longer")) * 100 < _big(F.col("a")) * contained))
    order = [F.col("cut.score").desc(), F.col("a").desc(), "phrase"]
    # The first ``top`` of each of TOP_PARTS parts of a language, then those of all parts.
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    near = Window.partitionBy("lang", "part").orderBy(*order)
    best = kept.withColumn("part", part).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
                    F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
