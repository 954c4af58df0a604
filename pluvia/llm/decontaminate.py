"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical tokens: punctuation around words is dropped, case is
folded, and numbers, units and names (capitalised inside a sentence) become typed
placeholders whose words are the template's slots.  Windows of canonical tokens are
hash-joined with the benchmark's.  Matches along one diagonal (document place minus item
place) are one occurrence; it counts only if its slots are consistent: each slot
word of the item always stands for the same word of the document.  Beside the template
there is an exact path through the same join: windows of the bare words, names and numbers
as they are.  Scripts without spaces are cut into characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import slices, worker_state

WINDOW = 8
# Share of the words of a window that must not be placeholders, share of an item's
# windows that make a leak, and the fewest tokens of an item that can be looked for.
MIN_LITERAL, MIN_COVERAGE, MIN_TOKENS = 0.5, 0.5, 4
# So many consecutive windows (13 words) of one occurrence make a leak as well, whatever
# share of the item they are.
MIN_RUN = 6
# The benchmark's windows as a bit map of fixed size, sent to the tasks that scan
# documents: what passes is joined by hash.
FILTER_BITS = 1 << 22
# Words a worker remembers, and characters of all of them.
KNOWN_WORDS, KNOWN_CHARS = 1 << 18, 1 << 23
# Sets the hashes of exact windows apart; their ``size`` is negative.
EXACT = 1 << 20

# Words taken as units of measure.
UNITS = frozenset(
    "% ° °c °f $ € £ ¥ cent cents centimeter centimeters centimetre centimetres cm cup cups day "
    "days degree degrees dollar dollars euro euros feet foot ft g gallon gallons gram grams h "
    "hour hours hr hrs hz inch inches joule joules kb kg kilogram kilograms kilometer kilometers "
    "kilometre kilometres km kph l lb lbs liter liters litre litres m mb meter meters metre "
    "metres mg mile miles min mins minute minutes ml mm month months mph newton newtons ounce "
    "ounces oz percent pound pounds s sec second seconds ton tonne tonnes tons volt volts watt "
    "watts week weeks yard yards year years".split())
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion".split())

# Scripts without spaces: each of their letters is a word.
_DENSE = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u3190-\u9fff"
                    "\uf900-\ufaff\U00020000-\U0003ffff])")
_LINE_FEED = "\0"
_EDGES = re.compile(r"^[^\w%°$€£¥]+|[^\w%°$€£¥]+$|_")
_BARE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[-+]?[$€£¥]?\d[\d.,:/]*(?:st|nd|rd|th|e[-+]?\d+)?[%°$€£¥]?\Z")
_STOPS, _ENDS = frozenset(".,;:!?"), frozenset(".!?:|")
NUMBER, UNIT, NAME, LITERAL, NOTHING = 1, 2, 3, 0, 9


def classify(word: str) -> tuple[str, int, bool, bool]:
    """(bare word, kind, may be a name, ends a sentence) of a white-space-delimited word.
    A line feed, which stands as a word of its own, ends a sentence as well."""
    if word in ("\n", _LINE_FEED):
        return "", NOTHING, False, True
    last = word[-1:]
    plain = word[:-1] if last in _STOPS else word
    if plain.isalpha():  # most words: letters and at most one mark after them
        low = plain.lower()
        kind = NUMBER if low in NUMBER_WORDS else UNIT if low in UNITS else LITERAL
        return low, kind, kind == LITERAL and plain[0].isupper() and plain[1:].islower(), last in _ENDS
    ends = word.rstrip("\"')]}»”’")[-1:] in _ENDS
    core = _EDGES.sub("", word)
    low = core.lower()
    if _NUMBER.match(low) or low in NUMBER_WORDS:
        return low, NUMBER, False, ends
    if low in UNITS:
        return low, UNIT, False, ends
    core = _BARE.sub("", core)
    if not core:
        return "", NOTHING, False, ends
    return core.lower(), LITERAL, core[0].isupper() and core[1:].islower(), ends


class _Lexicon:
    """Canonical forms of the words a worker has met, as arrays by word number."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.chars = 0
        self.bare: list[str] = []
        self.table = np.zeros((4, 1024), np.uint64)  # hash, kind, flags, hash of the bare word

    def shrink(self) -> None:
        """Forget the words met last, once there are half as many again as are kept; the
        ones met first hold the frequent ones."""
        if self.chars > KNOWN_CHARS:
            self.__init__()
        if len(self.bare) > KNOWN_WORDS * 3 // 2:
            self.number = dict(islice(self.number.items(), KNOWN_WORDS))
            del self.bare[KNOWN_WORDS:]

    def numbers(self, words: list[str]) -> np.ndarray:
        known, first = self.number, len(self.bare)
        new = set(words).difference(known)
        if new:
            rows = []
            self.chars += sum(map(len, new))
            for word in new:
                low, kind, name, ends = classify(word)
                known[word] = len(self.bare)
                self.bare.append(low)
                bare = xxhash.xxh64_intdigest(low)
                rows.append((bare if kind == LITERAL else kind, kind, name | ends << 1, bare))
            while len(self.bare) > self.table.shape[1]:
                self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
            self.table[:, first:len(self.bare)] = np.array(rows, np.uint64).T
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def canonical(text: str) -> tuple[np.ndarray, np.ndarray, list[int], _Lexicon]:
    """(token hashes, kinds, word numbers, lexicon) of a text's canonical tokens."""
    lexicon = worker_state(("decontaminate",), _Lexicon)
    lexicon.shrink()
    if not text.isascii() and _DENSE.search(text):
        text = _DENSE.sub(r" \1 ", text)
    words = text.replace("\n", f" {_LINE_FEED} ").split()
    at = lexicon.numbers(words)
    h, kind, flags = lexicon.table[:3, at]
    # A line feed or a sentence's end before a word means that a capital is no name;
    # pieces without a word (runs of spaces, lone marks) pass the state on.
    ends = (flags >> np.uint64(1)).astype(bool)
    real = kind != NOTHING
    told = np.flatnonzero(real | ends)
    before = np.searchsorted(told, np.arange(len(at)), side="left") - 1
    fresh = np.where(before >= 0, ends[told[np.maximum(before, 0)]], True) if len(told) else np.ones(len(at), bool)
    name = (flags & np.uint64(1)).astype(bool) & ~fresh
    h, kind = np.where(name, np.uint64(NAME), h), np.where(name, np.uint64(NAME), kind)
    return h[real], kind[real], at[real], lexicon


def window_hashes(h: np.ndarray, kind: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the windows of ``size`` tokens with enough literal words; without
    kinds, of all windows, hashed as exact ones."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.full(n, size if kind is not None else size + EXACT, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
        out ^= out >> np.uint64(31)
    if kind is None:
        return np.arange(n), out
    literal = np.concatenate([[0], np.cumsum(kind == LITERAL)])
    at = np.flatnonzero(literal[size:] - literal[:n] >= MIN_LITERAL * size)
    return at, out[at]


_SCHEMA = ("id long, place long, n_windows long, n_all long, eligible boolean, size int, "
           "window long, slots array<string>")
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.list_(pa.string())]
_NAMES = ["id", "place", "n_windows", "n_all", "eligible", "size", "window", "slots"]


def windows(texts: DataFrame, sizes: tuple[int, ...] | None, bits: np.ndarray | None) -> DataFrame:
    """Template windows and exact windows of ``texts(id, text)``: of the given sizes, or
    (None) of the one size that suits each text; only those the bit map lets through, if
    there is one.  ``eligible`` is a place that has a template window, ``n_windows`` and
    ``n_all`` count those and all places.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = shared.value
        for part in slices(batches, "text"):
            rows = []
            for ident, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                if not text:
                    continue
                h, kind, at, lexicon = canonical(text)
                bare = lexicon.table[3, at]
                for size in sizes or ((min(WINDOW, len(h)),) if len(h) >= MIN_TOKENS else ()):
                    eligible = np.zeros(max(0, len(h) - size + 1), bool)
                    total = 0
                    for exact in (False, True):
                        places, hashes = window_hashes(bare if exact else h, None if exact else kind, size)
                        if not exact:
                            eligible[places], total = True, len(places)
                        if passing is not None:
                            slot = hashes & np.uint64(FILTER_BITS - 1)
                            hit = passing[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))
                            hit = (hit & np.uint64(1)).astype(bool)
                            places, hashes = places[hit], hashes[hit]
                        for place, window in zip(places.tolist(), hashes.view(np.int64).tolist()):
                            slots = [] if exact else [lexicon.bare[at[i]] for i in range(place, place + size)
                                                      if kind[i] != LITERAL]
                            rows.append((ident, place, total, len(eligible), bool(eligible[place]),
                                         -size if exact else size, window, slots))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    return texts.mapInArrow(run, _SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE,
          id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """One row per leaked item of a document: ``doc_id, item_id, coverage`` (share of the
    item's windows found in consistent occurrences: of the places with a template window,
    or of all places found by exact windows, whichever is more), ``occurrences`` and
    ``verbatim`` (all slots as in the item).  An item leaks from a coverage of
    ``min_coverage`` on, or from ``min_run`` consecutive windows on one diagonal on.  Documents and items without a leak have no row.

    Items under four tokens (words, or letters of scripts without spaces), null texts and null ids are not looked for; repeated rows
    of an id count as one document; an empty table on either side gives no rows.
    The benchmark may be of any size: only a bit map of fixed size is broadcast, and the
    windows that pass it are joined by hash (the planner chooses how).
    """
    spark = docs.sparkSession
    items = windows(benchmark.select(F.col(item_id_col).cast("long").alias("id"),
                                     F.col(item_text_col).alias("text")).where("id is not null"),
                    None, None).distinct()
    # At most FILTER_BITS / 64 words reach the driver.
    slot = F.col("window").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (items.select(F.shiftright(slot, 6).alias("word"),
                          F.expr(f"shiftleft(1L, cast(window & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for word, mask in words:
        bits[word] = mask & 0xFFFFFFFFFFFFFFFF
    sizes = tuple(sorted(r[0] for r in items.select(F.abs("size").alias("size")).distinct().collect()))
    if not sizes:
        return spark.createDataFrame([], "doc_id long, item_id long, coverage double, "
                                         "occurrences long, verbatim boolean")
    found = windows(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                    .where("id is not null"), sizes, bits)
    met = found.alias("d").join(items.alias("b"), ["window", "size"]).select(
        F.col("d.id").alias("doc_id"), F.col("b.id").alias("item_id"),
        (F.col("d.place") - F.col("b.place")).alias("diagonal"), F.col("b.place").alias("place"),
        F.col("b.n_windows").alias("n_windows"), F.col("b.n_all").alias("n_all"),
        F.col("b.eligible").alias("eligible"), (F.col("size") < 0).alias("exact"),
        F.arrays_zip(F.col("b.slots").alias("item"), F.col("d.slots").alias("doc")).alias("slots"))
    # A diagonal has one row for each place of the item at most.
    item = ["doc_id", "item_id", "n_windows", "n_all"]
    once = met.groupBy(*item, "diagonal", "place", "eligible").agg(
        F.max("exact").alias("exact"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots")
    ).groupBy(*item, "diagonal").agg(
        F.collect_list(F.struct("place", "eligible", "exact")).alias("places"),
        F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"))
    named = F.array_distinct(F.transform("slots", lambda s: s["item"]))
    consistent = once.where(F.size("slots") == F.size(named))
    # Places in order: MIN_RUN of them are consecutive if the last is MIN_RUN - 1 after the first.
    at = F.array_sort(F.transform("places", lambda p: p["place"]))
    step = F.zip_with(F.slice(at, min_run, F.greatest(F.size(at), F.lit(1))), at, lambda last, first: last - first)
    long_run = F.coalesce(F.exists(step, lambda d: d == min_run - 1), F.lit(False))
    same = F.forall("slots", lambda s: s["item"] == s["doc"])
    places = consistent.select(*item, "diagonal", same.alias("same"),
                               long_run.alias("run"), F.explode("places").alias("p"))
    return (places.groupBy(*item, "p.place", "p.eligible")
            .agg(F.min("same").alias("same"), F.count(F.lit(1)).alias("times"), F.max("p.exact").alias("exact"),
                 F.max("run").alias("run"))
            .groupBy(*item)
            .agg(F.count_if("eligible").alias("hit"), F.count_if("exact").alias("exact"),
                 F.max("times").alias("occurrences"), F.min("same").alias("verbatim"), F.max("run").alias("run"))
            .withColumn("coverage", F.greatest(F.expr("hit / nullif(n_windows, 0)"), F.col("exact") / F.col("n_all")))
            .where((F.col("coverage") >= min_coverage) | F.col("run"))
            .select("doc_id", "item_id", "coverage", "occurrences", "verbatim"))
