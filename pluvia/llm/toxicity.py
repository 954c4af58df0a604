"""Toxicity by class-conditional Kneser-Ney models.

Two models, toxic and ordinary, give every letter of a word its probability after the
(at most CONTEXT) letters before it in the word, so a stem is known under endings it never had.  Toxic texts are mostly ordinary language
and far fewer, so ordinary counts are shared: the toxic model adds its own counts to
them, scaled to SHARED times its own size, and only what toxic texts use more stands
out.  Each model discounts its counts and backs off to one Kneser-Ney model of
continuation counts over both classes, which smooths expressions rare in either.  A text's score
compares the two log-likelihoods, normalised by its number of words, over all of them and
over the most toxic fiftieth (a long text is mostly ordinary whatever it says); a logistic
curve fitted out of fold turns both into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import pieces, slices, staged, text_rows, texts_of, word_codes

CONTEXT, DISCOUNT = 7, 0.75
# N-grams of over SHORT letters seen less often are left to the backoff; the bound rises
# until the models have at most MOST_GRAMS n-grams.
SHORT, MIN_TIMES, MOST_GRAMS = 3, 3, 400_000
# One word in so many counts for the most toxic ones.
TOP_SHARE = 50
SHARED = 10
# Expected number of labelled documents fitted for each class, at most.
FIT_DOCS = 30_000
# Words a worker remembers, bytes of all of them, and text bytes worked on at a time.
KNOWN_WORDS, KNOWN_CHARS, BLOCK_BYTES = 1 << 20, 1 << 24, 4 << 20
_WORD = re.compile(r"[^\W\d_]+")


class ToxicityModel(NamedTuple):
    ratio: dict[str, float]    # log ratio of the classes for each n-gram seen
    backoff: dict[str, float]  # the same for an unseen letter after each context seen
    weights: np.ndarray        # logistic curve over (mean ratio, log words, product, top ratio, 1)


def word_grams(word: str) -> Iterator[str]:
    """Each letter of ``^word$`` with its context before it."""
    marked = f"^{word}$"
    for i in range(1, len(marked)):
        yield marked[max(0, i - CONTEXT):i + 1]


def shared_backoff(grams) -> dict[str, float]:
    """Kneser-Ney probability of each shorter n-gram's last letter: continuation counts
    (distinct letters before it, over both classes), down to an even distribution."""
    continuation: Counter = Counter()
    level = set(grams)
    while level:
        shorter = Counter(g[1:] for g in level if len(g) > 1)
        continuation.update(shorter)
        level = set(shorter)
    total, kinds = Counter(), Counter()
    for gram, n in continuation.items():
        total[gram[:-1]] += n
        kinds[gram[:-1]] += 1
    out: dict[str, float] = {}
    even = 1 / (kinds[""] + 1)
    for gram in sorted(continuation, key=len):
        lower = out.get(gram[1:], even) if len(gram) > 1 else even
        h = gram[:-1]
        out[gram] = (max(continuation[gram] - DISCOUNT, 0) + DISCOUNT * kinds[h] * lower) / total[h]
    return out


def with_shared(counts: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    """Toxic counts on top of the ordinary ones, scaled to SHARED times their size."""
    toxic, ordinary = (sum(p[c] for p in counts.values()) for c in (0, 1))
    scale = SHARED * toxic / max(1, ordinary)
    return {g: (p[0] + scale * p[1], p[1]) for g, p in counts.items()}


def log_ratios(counts: dict[str, tuple[int, int]]) -> tuple[dict, dict]:
    """(ratio, backoff) from n-gram -> (toxic count, ordinary count)."""
    lower = shared_backoff(counts)
    even = 1 / (len({g[-1] for g in counts}) + 1)
    total, kinds = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for gram, pair in counts.items():
        for c in (0, 1):
            total[gram[:-1]][c] += pair[c]
            kinds[gram[:-1]][c] += pair[c] > 0
    ratio, backoff = {}, {}
    for h, t in total.items():
        left = [DISCOUNT * kinds[h][c] / t[c] if t[c] else 1.0 for c in (0, 1)]
        backoff[h] = math.log(left[0] / left[1])
    for gram, pair in counts.items():
        h = gram[:-1]
        p = lower.get(gram[1:], even)
        q = [(max(pair[c] - DISCOUNT, 0) + DISCOUNT * kinds[h][c] * p) / total[h][c]
             if total[h][c] else p for c in (0, 1)]
        ratio[gram] = math.log(q[0] / q[1])
    return ratio, backoff


def word_ratio(word: str, ratio: dict, backoff: dict) -> float:
    """Log-likelihood ratio of one word; letters after unseen contexts say nothing."""
    marked, out = f"^{word}$", 0.0
    for i in range(1, len(marked)):
        gram = marked[max(0, i - CONTEXT):i + 1]
        found = ratio.get(gram)
        out += backoff.get(gram[:-1], 0.0) if found is None else found
    return out


class _Scorer:
    """(sum of ratios, number of words, mean ratio of the most toxic words) of texts;
    remembers a bounded number of words."""

    def __init__(self, ratio: dict, backoff: dict):
        self.ratio, self.backoff = ratio, backoff
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.chars = 0
        # Sum of ratios and number of words of each known white-space-delimited word.
        self.value = np.zeros((2, 1 << 12))

    def numbers(self, unique: list[bytes]) -> np.ndarray:
        """Places in ``value`` of a block's distinct words."""
        if len(self.known) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self.clear()
        known = self.known
        for raw in unique:
            if raw not in known:
                i = known[raw] = len(known)
                self.chars += len(raw)
                if i >= self.value.shape[1]:
                    self.value = np.concatenate([self.value, np.zeros_like(self.value)], axis=1)
                words = _WORD.findall(raw.decode("utf-8", "surrogatepass").lower())
                self.value[:, i] = sum(word_ratio(w, self.ratio, self.backoff) for w in words), len(words)
        return np.fromiter(map(known.__getitem__, unique), np.int64, len(unique))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, sizes = [np.zeros((2, 0))], np.zeros(len(texts), np.int64)
        for numbers, block in pieces([t.encode("utf-8", "surrogatepass") for t in texts], BLOCK_BYTES):
            code, unique, counts = word_codes(block)
            at = self.numbers(unique.to_pylist())
            values.append(self.value[:, at][:, code])
            np.add.at(sizes, numbers, counts)
        value, ends = np.concatenate(values, axis=1), np.cumsum(sizes)
        (total, count), top = np.zeros((2, len(texts))), np.zeros(len(texts))
        some = np.flatnonzero(sizes)
        if len(some):
            total[some], count[some] = np.add.reduceat(value, (ends - sizes)[some], axis=1)
        real = value[1] > 0
        for i, (end, n) in enumerate(zip(ends.tolist(), sizes.tolist())):
            own = value[0, end - n:end][real[end - n:end]]
            if len(own):
                k = max(1, len(own) // TOP_SHARE)
                top[i] = np.partition(own, len(own) - k)[len(own) - k:].mean()
        return total, count, top


def features(total: np.ndarray, count: np.ndarray, top: np.ndarray) -> np.ndarray:
    mean, size = total / np.maximum(count, 1), np.log1p(count)
    return np.stack([mean, size, mean * size, top, np.ones(len(mean))], axis=1)


def frequent(counts: dict[str, tuple[int, int]], least: int) -> dict[str, tuple[int, int]]:
    """The n-grams the models keep: short ones, and those seen ``least`` times."""
    return {g: pair for g, pair in counts.items() if len(g) <= SHORT or sum(pair) >= least}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression on standardised features (the last one is the constant) by
    Newton steps, each halved until it lowers the penalised loss."""
    centre, scale = x[:, :-1].mean(0), x[:, :-1].std(0) + 1e-9
    z = np.column_stack([(x[:, :-1] - centre) / scale, np.ones(len(x))])
    penalty = np.append(np.full(z.shape[1] - 1, ridge), 1e-6)

    def loss(w):
        return np.logaddexp(0, z @ w).sum() - y @ (z @ w) + 0.5 * penalty @ (w * w)

    w, best = np.zeros(z.shape[1]), np.inf
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty),
                               z.T @ (p - y) + penalty * w)
        now = loss(w)
        while loss(w - step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if best - now < 1e-9:
            break
        best = now
    out = w[:-1] / scale
    return np.append(out, w[-1] - out @ centre)


def _counted(rows: DataFrame) -> DataFrame:
    """(gram, toxic0, ordinary0, toxic1, ordinary1) over ``rows(text, label, half)``."""
    names = ["toxic0", "ordinary0", "toxic1", "ordinary1"]

    def run(batches):
        words: dict[tuple, Counter] = defaultdict(Counter)
        for part in slices(batches, "text"):
            for text, label, half in zip(texts_of(part), part.column("label").to_pylist(),
                                         part.column("half").to_pylist()):
                words[half, label].update(text.replace("\n", " ").split(" "))
        grams: dict[str, list] = defaultdict(lambda: [0, 0, 0, 0])
        for (half, label), counter in words.items():
            for raw, n in counter.items():
                for word in _WORD.findall(raw.lower()):
                    for gram in word_grams(word):
                        grams[gram][2 * half + 1 - label] += n
        if grams:
            columns = zip(*grams.values())
            yield pa.record_batch([pa.array(list(grams)), *(pa.array(c, pa.int64()) for c in columns)],
                                  names=["gram", *names])

    return (rows.mapInArrow(run, "gram string, " + ", ".join(f"{n} long" for n in names))
            .groupBy("gram").agg(*[F.sum(n).alias(n) for n in names]))


def _kept_counts(counted: DataFrame) -> tuple[int, list[dict]]:
    """(times an n-gram must be seen, counts of either half): of a bounded number of n-grams."""
    total = F.col("toxic0") + F.col("ordinary0") + F.col("toxic1") + F.col("ordinary1")
    grams = staged(counted.withColumn("times", total), "toxicity")
    sizes = (grams.where(F.char_length("gram") > SHORT).groupBy(F.least("times", F.lit(1 << 14)).alias("times"))
             .count().collect())
    least = MIN_TIMES
    left = sum(r["count"] for r in sizes if r.times >= least)
    for r in sorted(sizes, key=lambda r: r.times):
        if left <= MOST_GRAMS:
            break
        if r.times >= least:
            left, least = left - r["count"], r.times + 1
    halves: list[dict] = [{}, {}]
    for r in grams.where((F.char_length("gram") <= SHORT) | (F.col("times") >= least)).toLocalIterator():
        for half, pair in ((0, (r.toxic0, r.ordinary0)), (1, (r.toxic1, r.ordinary1))):
            if sum(pair):
                halves[half][r.gram] = pair
    return least, halves


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, half: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", fit_docs: int = FIT_DOCS) -> ToxicityModel:
    """Learn from the labels where ``learnable`` (over their id) holds.

    ``fit_docs`` bounds the expected number of labelled documents of each class, thinned
    by a hash of the id, so the labels sent to the scan and the counted n-grams are
    bounded too.  ``half`` (0 or 1) splits them: each half is scored by the other's
    model to fit the curve.  Without labels of both classes the score is the share of
    toxic labels (0 if there are none).
    """
    spark = docs.sparkSession
    known = (labels.where(learnable & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("label"),
                     half.cast("int").alias("half")).distinct())
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        share = 30.0 if 1 in sizes else -30.0
        return ToxicityModel({}, {}, np.array([0, 0, 0, 0, share]))
    draw = F.pmod(F.xxhash64("__id", F.lit("toxicity")), F.lit(1 << 32))
    taken = [int((1 << 32) * min(1, fit_docs / sizes[c])) for c in (0, 1)]
    known = known.where(draw < F.when(F.col("label") == 1, F.lit(taken[1])).otherwise(F.lit(taken[0])))
    # Bounded by 2 * fit_docs rows.
    rows = text_rows(docs, id_col, text_col).join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select(
        "text", "label", "half")
    least, halves = _kept_counts(_counted(rows))
    both = dict(halves[0])
    for gram, pair in halves[1].items():
        a, b = both.get(gram, (0, 0))
        both[gram] = (a + pair[0], b + pair[1])
    shared = spark.sparkContext.broadcast([log_ratios(with_shared(frequent(c or both, least))) for c in halves])

    def run(batches):
        scorers = [_Scorer(*m) for m in shared.value]
        for part in slices(batches, "text"):
            texts, half_of = texts_of(part), np.array(part.column("half").to_pylist())
            found = np.zeros((3, len(texts)))
            for h in (0, 1):
                at = np.flatnonzero(half_of == h)
                if len(at):
                    found[:, at] = scorers[1 - h]([texts[i] for i in at])
            yield pa.record_batch([*map(pa.array, found), part.column("label")], names=["total", "count", "top", "label"])

    out = np.array([tuple(r) for r in rows.mapInArrow(
        run, "total double, count double, top double, label int").collect()], dtype=float).reshape(-1, 4)
    ratio, backoff = log_ratios(with_shared(frequent(both, least)))
    if len(set(out[:, 3])) < 2:
        return ToxicityModel(ratio, backoff, np.array([1.0, 0, 0, 0, 0]))
    return ToxicityModel(ratio, backoff, fit_logistic(features(*out[:, :3].T), out[:, 3]))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, log_ratio`` (mean over the words), ``n_words`` and
    ``score`` (0 to 1).  Null or wordless texts have ratio 0 and the curve's score for
    that; null ids stay null; repeated rows repeat; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        model = ToxicityModel(*shared.value)
        scorer = _Scorer(model.ratio, model.backoff)
        for part in slices(batches, "text"):
            x = features(*(both := scorer(texts_of(part))))
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
            yield pa.record_batch([part.column("doc_id"), pa.array(x[:, 0]),
                                   pa.array(both[1].astype(np.int64)), pa.array(p)],
                                  names=["doc_id", "log_ratio", "n_words", "score"])

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, log_ratio double, n_words long, score double")
