"""Masked pseudo-likelihood by a bidirectional window network.

Tokens are word units: short words whole, longer ones' endings; the units with a fixed share
of the whole corpus form the vocabulary.  All else is spelled in full, the stem before a
known ending too, digits and marks as well: by pairs of characters, characters, or as a last
resort the bytes of one, so that every character of the corpus but white space (and case) is
in a token.  A network predicts every token
from the SIDE tokens before and after it: position-wise embeddings, one hidden layer, a
softmax.  It is trained in numpy by synchronous local steps: every task fits its own
documents from the shared weights, and Spark averages the weights by task size.  A
document's score is the sum of log P(token | both sides), also given per token.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.llm.common import pieces, slices, staged, text_rows, texts_of, word_codes, worker_state

# VOCABULARY is the size of a network of which no vocabulary is known.
VOCABULARY, SIDE, EMBED, HIDDEN = 256, 2, 16, 32
# Each training round takes every ROUNDS-th position of every document, another one each
# round, so that after all rounds every position has been fitted once.
ROUNDS = 2
BATCH, RATE = 512, 0.01
OTHER, EDGE = 0, 1
UNIT, PAIR, LETTER = 0, 1, 2
# A unit (a pair, a letter) is in the vocabulary from one in SHARE of all units (pairs,
# letters) of the corpus on, so at most SHARE of each are, however large the corpus.
SHARE = 1024
# Words a worker remembers, and characters of all of them.
KNOWN_WORDS, KNOWN_CHARS = 1 << 19, 1 << 23
# Text bytes whose words are looked up together, token bytes that a network works on.
BLOCK_BYTES, TOKEN_BYTES = 4 << 20, 1 << 20
# Under this, exponentials are subnormal in float32; products with those take many times as long.
LEAST = np.float32(-87)
# Columns of logits that are raised one by one at most.
RAISED = 16
# Sums of weights that come to the driver after a round.
SUMS = 32
# Scripts without spaces: two of their letters are a run of their own.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u3190-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_RUNS = re.compile(rf"[{_DENSE}]{{1,2}}|(?:(?![{_DENSE}])[^\W\d_])+|\d+|(?:[^\w\s]|_)+")


def runs_of(word: str) -> list[str]:
    """A white-space-delimited word in runs of letters, of digits and of marks; in order, they
    hold all its characters but white space."""
    word = word.lower()
    if word.isalpha() and (word.isascii() or max(word) < _DENSE[0]):
        return [word]
    return _RUNS.findall(word)


def unit(run: str) -> str:
    """The unit of a run: up to three letters whole, a longer one's ending; ``#`` opens a
    number, marks have none."""
    first = run[0]
    if first.isdecimal():
        return "#"
    if not first.isalnum():
        return ""
    return run if len(run) <= 3 else "-" + run[-3:]


def stem(run: str) -> str:
    """What a run's unit does not tell of it: what stands before the ending, or the number."""
    return run if run[0].isdecimal() else run[:-3] if len(run) > 3 else ""


def pairs(run: str) -> list[str]:
    """A run in pairs of characters from its end; the first may be one character."""
    odd = len(run) % 2
    return ([run[0]] if odd else []) + [run[i:i + 2] for i in range(odd, len(run), 2)]


class _Units:
    """Numbers of words' units under a vocabulary, remembered for a bounded number of words."""

    def __init__(self, vocabulary: list[str]):
        self.number = {u: i + 2 for i, u in enumerate(vocabulary)}
        self.known: dict[bytes, tuple[int, ...]] = {}
        # The same for stems and runs without a unit, of which words share many.
        self.parts: dict[str, tuple[int, ...]] = {}
        self.chars = 0

    def spell(self, word: str) -> list[int]:
        """The token numbers of a word; letters the corpus lacks altogether are one OTHER."""
        number, out = self.number, []
        for run in runs_of(word):
            name = unit(run)
            whole = number.get(name) if name else None
            if whole is not None and name == "#":
                out.append(whole)
            part = run if whole is None else stem(run)
            if part:
                spelled = self.parts.get(part) or self.remember_part(part)
                out += spelled[1:] if spelled[0] == OTHER and out[-1:] == [OTHER] else spelled
            if whole is not None and name != "#":
                out.append(whole)
        return out

    def remember_part(self, part: str) -> tuple[int, ...]:
        """The token numbers of a part of a run, by pairs, characters or bytes."""
        number, out = self.number, []
        for pair in pairs(part):
            found = number.get("~" + pair) if len(pair) > 1 else None
            if found is not None:
                out.append(found)
                continue
            for letter in pair:
                found = number.get("~" + letter)
                for n in ([found] if found is not None else
                          [number.get(b, OTHER) for b in bytes_of(letter)]):
                    if n != OTHER or out[-1:] != [OTHER]:
                        out.append(n)
        spelled = self.parts[part] = tuple(out)
        self.chars += len(part)
        return spelled

    def remember(self, word: bytes) -> tuple[int, ...]:
        if max(len(self.known), len(self.parts)) >= KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self.known, self.parts, self.chars = {}, {}, 0
        spelled = self.known[word] = tuple(self.spell(word.decode("utf-8", "surrogatepass")))
        self.chars += len(word)
        return spelled

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token numbers, tokens of each text) of the texts, empty pieces left out.

        A block's distinct words are looked up once; a long text is several blocks."""
        out, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        for numbers, block in pieces([t.encode("utf-8", "surrogatepass") for t in texts], BLOCK_BYTES):
            code, unique, words = word_codes(block)
            found = self.known.get
            spelled = [found(w) or self.remember(w) for w in unique.to_pylist()]
            size = np.fromiter(map(len, spelled), np.int64, len(spelled))
            flat = np.fromiter(chain.from_iterable(spelled), np.int32, int(size.sum()))
            first, size = (np.cumsum(size) - size)[code], size[code]
            ends = np.cumsum(size)
            place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)
            out.append(flat[place])
            stops = np.concatenate([[0], ends])[np.cumsum(words)]
            np.add.at(counts, numbers, np.diff(stops, prepend=0))
        return np.concatenate(out), counts


def bytes_of(letter: str) -> list[str]:
    return [f"~0x{b:02x}" for b in letter.encode("utf-8", "surrogatepass")]


def _reader(vocabulary: list[str]) -> _Units:
    """The worker's own reader for a vocabulary, kept between tasks."""
    return worker_state(("masked lm", *vocabulary), lambda: _Units(vocabulary))


class Network(NamedTuple):
    embed: np.ndarray   # (units, EMBED)
    inward: np.ndarray  # (2 * SIDE * EMBED, HIDDEN)
    hidden: np.ndarray  # (HIDDEN,)
    outward: np.ndarray  # (HIDDEN, units)
    bias: np.ndarray    # (units,)


def shapes(units: int) -> list[tuple[int, ...]]:
    return [(units, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, units), (units,)]


def weights(units: int) -> int:
    return sum(int(np.prod(s)) for s in shapes(units))


SIZE = weights(VOCABULARY)


def unpack(flat: np.ndarray) -> Network:
    out, at = [], 0
    for shape in shapes((len(flat) - weights(0)) // (weights(1) - weights(0))):
        n = int(np.prod(shape))
        out.append(flat[at:at + n].reshape(shape))
        at += n
    return Network(*out)


def initial(seed: int = 7, units: int = VOCABULARY) -> np.ndarray:
    rng = np.random.default_rng(seed)
    scale = np.concatenate([np.full(int(np.prod(s)), 0 if len(s) == 1 else 0.3 if i == 0 else 1 / np.sqrt(s[0]))
                            for i, s in enumerate(shapes(units))])
    return (rng.standard_normal(len(scale)) * scale).astype(np.float32)


def sides(ids: np.ndarray, counts: np.ndarray, at: np.ndarray | None = None) -> list[np.ndarray]:
    """The tokens at each of the 2 * SIDE places before and after every token (or the
    positions ``at``), EDGE beyond its text's ends."""
    # SIDE edges between texts stand for whatever lies beyond an end.
    gap = np.arange(len(counts)) * SIDE + SIDE
    place = np.arange(len(ids)) + np.repeat(gap, counts)
    spread = np.full(len(ids) + SIDE * (len(counts) + 1), EDGE, np.int32)
    spread[place] = ids
    if at is not None:
        place = place[at]
    shifts = [-d for d in range(SIDE, 0, -1)] + list(range(1, SIDE + 1))
    return [spread.take(place + d) for d in shifts]


def contexts(ids: np.ndarray, counts: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """(tokens, 2 * SIDE): :func:`sides` of each token as a row."""
    return np.stack(sides(ids, counts, at), axis=1)


def summed_rows(index: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """``out[i]``: the sum of the rows with that index (zero without any)."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    ordered = index[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out[:] = 0
    out[ordered[first]] = np.add.reduceat(rows.take(order, axis=0, mode="clip"), first, axis=0)


def raised(logits: np.ndarray) -> None:
    """Raises logits under LEAST to it, in rows whose maximum is 0: a row's sum of
    exponentials stays the same to the last bit.  Mostly only a few tokens' columns have any."""
    low = np.flatnonzero(logits.min(0) < LEAST)
    if len(low) > RAISED:
        np.maximum(logits, LEAST, out=logits)
        return
    for i in low:
        np.maximum(logits[:, i], LEAST, out=logits[:, i])


def steps(flat: np.ndarray, context: np.ndarray, target: np.ndarray, state: dict) -> np.ndarray:
    """Adam steps over minibatches in order; returns the new weights.

    The softmax is never divided out: with e the exponentials of a row and s their sum, the
    gradient is (e - s at the target) / s, whose factor goes into the narrow matrices.
    The arrays of a step are made once.
    """
    flat = flat.astype(np.float32)  # a copy, updated in place
    net, slope = unpack(flat), np.empty_like(flat)
    grad, units = unpack(slope), len(net.bias)
    m, v = state["m"], state["v"] = tuple(np.asarray(state[k], np.float32) for k in "mv")
    first, second = np.empty_like(flat), np.empty_like(flat)
    ones, top = np.ones(units, np.float32), np.empty((HIDDEN + 1, units), np.float32)
    widest = min(BATCH, len(target))
    hidden, logits = np.ones((widest, HIDDEN + 1), np.float32), np.empty((widest, units), np.float32)
    inputs, back = (np.empty((widest, 2 * SIDE, EMBED), np.float32) for _ in range(2))
    sums, slopes = (np.empty((widest, HIDDEN), np.float32) for _ in range(2))
    parts, both = np.empty((widest, HIDDEN + 1), np.float32), np.empty_like(top)
    for start in range(0, len(target), BATCH):
        c, y = context[start:start + BATCH], target[start:start + BATCH]
        n, at = len(y), np.arange(len(y))
        top[:-1], top[-1] = net.outward, net.bias
        x = net.embed.take(c, axis=0, out=inputs[:n], mode="clip").reshape(n, -1)
        a = np.matmul(x, net.inward, out=sums[:n])
        a += net.hidden
        h = hidden[:n]
        np.maximum(a, 0, out=h[:, :-1])
        e = np.matmul(h, top, out=logits[:n])
        if np.sqrt(np.einsum("ij,ij->j", top, top).max() * np.einsum("ij,ij->i", h, h).max()) > 60:
            e -= e.max(1, keepdims=True)  # exp could overflow
            raised(e)
        np.exp(e, out=e)
        s = e @ ones
        e[at, y] -= s
        share = (1 / (s * n))[:, None]
        np.matmul(np.multiply(h, share, out=parts[:n]).T, e, out=both)
        grad.outward[:], grad.bias[:] = both[:-1], both[-1]
        dh = np.matmul(e, net.outward.T, out=slopes[:n])
        dh *= share
        dh *= a > 0
        np.matmul(x.T, dh, out=grad.inward)
        np.sum(dh, 0, out=grad.hidden)
        dx = np.matmul(dh, net.inward.T, out=back.reshape(widest, -1)[:n])
        summed_rows(c.ravel(), dx.reshape(n * 2 * SIDE, EMBED), grad.embed)
        state["n"] += 1
        m *= 0.9
        m += np.multiply(slope, 0.1, out=first)
        v *= 0.999
        np.multiply(slope, slope, out=first)
        v += np.multiply(first, 0.001, out=first)
        # RATE * (m / c1) / (sqrt(v / c2) + 1e-8)
        np.sqrt(np.multiply(v, 1 / (1 - 0.999 ** state["n"]), out=second), out=second)
        second += 1e-8
        np.multiply(m, RATE / (1 - 0.9 ** state["n"]), out=first)
        flat -= np.divide(first, second, out=first)
    return flat


def log_probabilities(net: Network, ids: np.ndarray, counts: np.ndarray,
                      block: int = 512) -> np.ndarray:
    """log P(token | both sides) of every token."""
    # Each side position's share of the hidden layer, by token; the bias as one more row.
    parts = [net.embed @ net.inward[i * EMBED:(i + 1) * EMBED] for i in range(2 * SIDE)]
    parts[0] = parts[0] + net.hidden
    outward = np.vstack([net.outward, net.bias])
    steepest = np.sqrt((outward ** 2).sum(0)).max()
    ones = np.ones(len(net.bias), np.float32)
    hidden, sums = np.ones((block, HIDDEN + 1), np.float32), np.empty((2, block, HIDDEN), np.float32)
    logits = np.empty((block, len(net.bias)), np.float32)
    context, out = sides(ids, counts), np.empty(len(ids), np.float64)
    for start in range(0, len(ids), block):
        y = ids[start:start + block]
        a, more = sums[:, :len(y)]
        parts[0].take(context[0][start:start + block], axis=0, out=a, mode="clip")
        for i in range(1, 2 * SIDE):
            a += parts[i].take(context[i][start:start + block], axis=0, out=more, mode="clip")
        h = hidden[:len(y)]
        np.maximum(a, 0, out=h[:, :HIDDEN])
        z = np.matmul(h, outward, out=logits[:len(y)])
        if wide := steepest * np.sqrt((h * h).sum(1).max()) > 80:  # exp could overflow
            z -= z.max(1, keepdims=True)
        own = z[np.arange(len(y)), y].astype(np.float64)
        if wide:
            raised(z)
        out[start:start + block] = own - np.log(np.exp(z, out=z) @ ones)
    return out


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of all white-space-delimited words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for _, block in pieces(texts, BLOCK_BYTES):
                code, unique, _ = word_codes(block)
                yield pa.record_batch([unique, pa.array(np.bincount(code, minlength=len(unique)).astype(np.int64))],
                                      names=["word", "n"])

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(rows: DataFrame, size: int | None = None) -> list[str]:
    """The units, pairs and characters (these two after ``~``) with one in SHARE of all of
    their kind over all texts, counted in full, numbers if there are any, and the bytes of all
    other characters; or the ``size`` most frequent units alone.

    Words are counted first, then their runs, so each distinct one is taken apart once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: defaultdict[str, int] = defaultdict(int)
        chars = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for kind, n in kinds(found).items():
                yield pa.record_batch([pa.array([kind] * len(n), pa.int32()), pa.array(list(n), pa.string()),
                                       pa.array(list(n.values()), pa.int64())], names=["kind", "unit", "n"])

        for part in batches:
            for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                for x in runs_of(word.decode("utf-8", "surrogatepass")):
                    found[x] += n
                chars += len(word)
            if len(found) > KNOWN_WORDS or chars > KNOWN_CHARS:
                yield from counted()
                found.clear()
                chars = 0
        yield from counted()

    counts = staged(word_counts(rows).mapInArrow(run, "kind int, unit string, n long")
                    .groupBy("kind", "unit").agg(F.sum("n").alias("n")), "units")
    units = counts.where(F.col("kind") == UNIT)
    if size is not None:
        return [r.unit for r in units.orderBy(F.desc("n"), "unit").limit(size).collect()]
    out, letters = [], []
    for kind, total in sorted(map(tuple, counts.groupBy("kind").agg(F.sum("n")).collect())):
        # There are no more letters than code points.
        mine = counts.where((F.col("kind") == kind) & (F.lit(kind == LETTER) | (F.col("unit") == "#")
                                                       | (F.col("n") * SHARE >= total)))
        got = sorted((-r.n, r.unit) for r in mine.collect())
        out += [u for n, u in got if -n * SHARE >= total or u == "#"]
        letters = got if kind == LETTER else letters
    kept = set(out)
    return out + sorted({b for _, u in letters if u not in kept for b in bytes_of(u[1:])})


def kinds(runs: dict[str, int]) -> dict[int, dict[str, int]]:
    """What counted runs add to the counts, by kind: their units, and the pairs and characters of
    the runs (of their stems too, whose pairs may lie otherwise)."""
    units, twos, ones = (defaultdict(int) for _ in range(3))
    for run, n in runs.items():
        name, rest = unit(run), stem(run)
        if name:
            units[name] += n
        for part in (run, rest) if rest != run else (run,):
            for i in range(len(part) % 2, len(part), 2):
                twos[part[i:i + 2]] += n
        for x in run:
            ones[x] += n
    marked = [{"~" + x: n for x, n in counts.items()} for counts in (twos, ones)]
    return dict(zip((UNIT, PAIR, LETTER), [units, *marked]))


class LanguageModel(NamedTuple):
    vocabulary: list[str]
    weights: np.ndarray


def fitted(counts: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The positions of texts of ``counts`` tokens that a round fits: every position is in
    exactly one of ``rounds`` rounds."""
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    # The first position of a text shifts with its length, so short texts count in all rounds.
    phase = np.repeat(counts, counts) + turn
    return np.flatnonzero((np.arange(len(starts)) - starts + phase) % rounds == 0)


def tokenised(rows: DataFrame, units: list[str]) -> DataFrame:
    """(doc_id, ids): the token numbers of every text, little-endian uint16 (a vocabulary has
    3 * SHARE + 256 entries at most)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(units)
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, counts = reader.tokens(texts_of(part))
            data, ends = ids.astype("<u2").tobytes(), np.concatenate([[0], 2 * np.cumsum(counts)])
            yield pa.record_batch([part.column("doc_id"), pa.Array.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                 pa.py_buffer(data)]).cast(pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids binary")


def token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, token numbers, tokens of each row) of bounded blocks of rows."""
    for part in slices(batches, "ids", TOKEN_BYTES):
        texts = part.column("ids").to_pylist()
        ids = np.frombuffer(b"".join(texts), "<u2").astype(np.int32)
        yield part, ids, np.array([len(t) // 2 for t in texts], np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all rows (n, weights times n) of a task."""
    seen, total = 0, None
    for batch in batches:
        for n, w in zip(batch.column("n").to_pylist(), batch.column("w").to_pylist()):
            seen, total = seen + n, np.frombuffer(w, "<f8") + (0 if total is None else total)
    if seen:
        yield pa.record_batch([pa.array([seen]), pa.array([total.tobytes()], pa.binary())], names=["n", "w"])


def trained(tokens: DataFrame, units: int, rounds: int) -> np.ndarray:
    """``rounds`` of local training and averaging over ``tokens(doc_id, ids)``."""
    flat = initial(units=units)
    for turn in range(rounds):
        shared = tokens.sparkSession.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            own, seen = shared.value, 0
            state = {"n": 0, "m": np.zeros(len(own), np.float32), "v": np.zeros(len(own), np.float32)}
            for _, ids, counts in token_blocks(batches):
                taken = fitted(counts, turn, rounds)
                taken = taken[np.random.default_rng(turn).permutation(len(taken))]
                own = steps(own, contexts(ids, counts, taken), ids[taken], state)
                seen += len(taken)
            if seen:
                yield pa.record_batch([pa.array([seen]), pa.array([(own.astype("<f8") * seen).tobytes()], pa.binary())],
                                      names=["n", "w"])

        # Two levels: each of SUMS tasks adds the weights of its share of tasks.
        sums = (tokens.select("ids").mapInArrow(run, "n long, w binary").repartition(SUMS)
                .mapInArrow(_added, "n long, w binary").collect())
        if not sums:
            break
        flat = (sum(np.frombuffer(r.w, "<f8") for r in sums) / sum(r.n for r in sums)).astype(np.float32)
    return flat


def fit(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id",
        text_col: str = "text") -> LanguageModel:
    """Vocabulary over all texts, then ``rounds`` of local training and averaging.

    Every position of every document is fitted in one of the rounds.  Texts are turned into
    tokens once and kept in the shared folder; a task sends one packed row of weights, and
    the driver sees SUMS sums of them a round.
    """
    rows = text_rows(docs, id_col, text_col)
    units = vocabulary(rows)
    tokens = staged(tokenised(rows, units), "tokens")
    return LanguageModel(units, trained(tokens, len(units) + 2, rounds))


def score(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, pseudo_log_likelihood`` (sum over all
    tokens) and ``per_token`` (its mean).  Null, empty or blank texts: 0 tokens, sum 0, a
    null mean.  Null ids stay null; repeated rows repeat; an empty table gives no rows."""
    return score_tokens(tokenised(text_rows(docs, id_col, text_col), model.vocabulary), model)


def fit_and_score(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scores of the documents that the model is fitted on, as :func:`fit` and
    :func:`score` give them, with the texts turned into tokens only once."""
    rows = text_rows(docs, id_col, text_col)
    units = vocabulary(rows)
    tokens = staged(tokenised(rows, units), "tokens")
    return score_tokens(tokens, LanguageModel(units, trained(tokens, len(units) + 2, rounds)))


def score_tokens(tokens: DataFrame, model: LanguageModel) -> DataFrame:
    """:func:`score` over ``tokens(doc_id, ids)``."""
    shared = tokens.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = unpack(shared.value)
        for part, ids, counts in token_blocks(batches):
            owner = np.repeat(np.arange(len(counts)), counts)
            total = np.bincount(owner, weights=log_probabilities(net, ids, counts), minlength=len(counts))
            mean = total / np.maximum(counts, 1)
            yield pa.record_batch([part.column("doc_id"), pa.array(counts), pa.array(total),
                                   pa.array(mean, mask=counts == 0)],
                                  names=["doc_id", "n_tokens", "pseudo_log_likelihood", "per_token"])

    return tokens.mapInArrow(run, "doc_id long, n_tokens long, pseudo_log_likelihood double, per_token double")
