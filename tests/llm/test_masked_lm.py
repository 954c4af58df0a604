from collections import Counter

import numpy as np
import pytest

from pluvia.llm import masked_lm as M
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose

SF = "/root/testdata/sf0.01"


def plain_scores(net, ids):
    """log P of each token of one text, one token at a time."""
    out = []
    for i, y in enumerate(ids):
        around = [ids[i + d] if 0 <= i + d < len(ids) else M.EDGE for d in (-2, -1, 1, 2)]
        h = np.maximum(np.concatenate([net.embed[c] for c in around]) @ net.inward + net.hidden, 0)
        z = h @ net.outward + net.bias
        out.append(z[y] - np.log(np.exp(z - z.max()).sum()) - z.max())
    return out


def test_scores_equal_a_token_at_a_time(spark):
    rows = awkward_rows()
    model = M.fit(frame(spark, rows))
    got = M.score(frame(spark, rows), model).collect()
    assert len(got) == len(rows)
    net, reader = M.unpack(model.weights), M._Units(model.vocabulary)
    by = {r.doc_id: r for r in got}
    for i, text in rows:
        if i is None or len(text or "") > 5000:
            continue
        ids, _ = reader.tokens([text or ""])
        assert by[i].n_tokens == len(ids)
        assert by[i].pseudo_log_likelihood == pytest.approx(sum(plain_scores(net, ids.tolist())), abs=1e-3)
        assert (by[i].per_token is None) == (len(ids) == 0)


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(0)
    ids = np.tile(np.arange(2, 12), 400).astype(np.int32)
    counts = np.array([len(ids)])
    context, flat = M.contexts(ids, counts), M.initial()
    state = {"n": 0, "m": np.zeros(M.SIZE, np.float32), "v": np.zeros(M.SIZE, np.float32)}
    before = M.log_probabilities(M.unpack(flat), ids, counts).mean()
    order = rng.permutation(len(ids))
    for _ in range(10):
        flat = M.steps(flat, context[order], ids[order], state)
    after = M.log_probabilities(M.unpack(flat), ids, counts).mean()
    assert after > -0.5 > before  # the pattern is certain from both sides


def test_no_subnormal_exponentials(monkeypatch):
    """Products with subnormal numbers take many times as long; weights and scores without them are
    the same to the last bit."""
    rng = np.random.default_rng(1)
    ids, counts = rng.integers(2, M.VOCABULARY, 1300).astype(np.int32), np.array([1000, 0, 300])
    context, flat, found = M.contexts(ids, counts), M.initial() * 8, []
    real, tiny = np.exp, np.finfo(np.float32).tiny

    def exp(x, out=None):
        got = real(x, out=out)
        found.append(((got > 0) & (got < tiny)).sum())
        return got

    def both():
        found.clear()
        state = {"n": 0, "m": np.zeros(M.SIZE, np.float32), "v": np.zeros(M.SIZE, np.float32)}
        return M.steps(flat, context, ids, state), M.log_probabilities(M.unpack(flat), ids, counts)

    monkeypatch.setattr(np, "exp", exp)
    weights, scores = both()
    assert len(found) == 6 and sum(found) == 0
    net, apart = M.unpack(flat), np.split(ids, np.cumsum(counts)[:-1])
    assert scores == pytest.approx(sum((plain_scores(net, part.tolist()) for part in apart), []), rel=1e-4, abs=1e-3)
    assert scores.min() < M.LEAST  # tokens below it keep their own score
    monkeypatch.setattr(M, "LEAST", np.float32(-np.inf))
    plain = both()
    assert sum(found) > 0 and np.array_equal(weights, plain[0]) and np.array_equal(scores, plain[1])


@pytest.mark.parametrize("columns", [0, 2, 40])
def test_only_columns_with_low_logits_are_raised(monkeypatch, columns):
    logits = np.random.default_rng(2).normal(-20, 3, (64, 50)).astype(np.float32)
    logits[::3, :columns] = -95
    want, seen, real = np.maximum(logits, M.LEAST), [], np.maximum
    monkeypatch.setattr(np, "maximum", lambda x, *a, **b: seen.append(x.size) or real(x, *a, **b))
    M.raised(logits)
    assert np.array_equal(logits, want)
    assert seen == ([64] * columns if columns <= M.RAISED else [logits.size])


def test_a_part_that_words_share_is_spelled_once(monkeypatch):
    taken, real = [], M.pairs
    monkeypatch.setattr(M, "pairs", lambda run: taken.append(run) or real(run))
    units = ["-ing", "~wa", "~lk", "~,", "~(", "~)"]
    ids, _ = M._Units(units).tokens(["walking Walking, (walking) talking walking-talking"])
    assert sorted(taken) == sorted(["walk", "talk", ",", "(", ")", "-"])
    at = {u: i + 2 for i, u in enumerate(units)}
    walk, talk = [at["~wa"], at["~lk"], at["-ing"]], [M.OTHER, at["~lk"], at["-ing"]]
    assert ids.tolist() == [*walk, *walk, at["~,"], at["~("], *walk, at["~)"], *talk, *walk, *talk]


def test_unknown_letters_of_neighbouring_parts_are_one_token():
    reader = M._Units(["~a"])
    for _ in range(2):  # the second time from memory
        assert reader.spell("xy--12a") == [M.OTHER, 2] and reader.spell("--x") == [M.OTHER]


def test_runs_are_those_of_the_pattern():
    words = [f"{x}{chr(c)}{y}" for c in [*range(33, 0xd800, 7), 0x130, 0x1e9e, 0xd800, 0x20000, 0x1f600]
             for x, y in (("", ""), ("Ab", "c"), ("é", "ß"), ("1", "_"))]
    assert [M.runs_of(w) for w in words] == [M._RUNS.findall(w.lower()) for w in words]


def test_counts_of_units_pairs_and_letters(spark):
    """By a plain count of every run of every word, however often words and runs repeat."""
    rows = awkward_rows() + [(50, "walking Walking, (walking) walking-talking 12 345,12")] * 2
    want = [Counter(), Counter(), Counter()]
    for run in (run for _, text in rows for word in (text or "").split() for run in M.runs_of(word)):
        name, rest = M.unit(run), M.stem(run)
        want[M.UNIT].update([name] if name else [])
        want[M.PAIR].update("~" + x for part in {run, rest} for x in M.pairs(part or "x") if len(x) > 1)
        want[M.LETTER].update("~" + x for x in run)
    got = M.vocabulary(M.text_rows(frame(spark, rows), "doc_id", "text"))
    kept = [u for n in want for u in sorted(n, key=lambda u: (-n[u], u)) if n[u] * M.SHARE >= n.total() or u == "#"]
    assert got[:len(kept)] == kept and all(u.startswith("~0x") for u in got[len(kept):])


def test_vocabulary_counts_all_texts(spark):
    rows = [(1, "the the of walking talking"), (2, "the 12 -- sulking"), (3, None)]
    docs = M.text_rows(frame(spark, rows), "doc_id", "text")
    assert M.vocabulary(docs, 3) == ["-ing", "the", "#"]


def test_every_word_of_the_corpus_has_tokens(spark):
    rows = awkward_rows() + [(50, "don't well-known αβγδε xqz walk2go")]
    docs = M.text_rows(frame(spark, rows), "doc_id", "text")
    reader = M._Units(M.vocabulary(docs))
    names = {n: u for u, n in reader.number.items()}
    ids, counts = reader.tokens([text or "" for _, text in rows])
    assert counts.sum() == len(ids) and M.OTHER not in ids.tolist()
    # Rare words are spelled in full, and all runs of a word count.
    assert len(reader.spell("日本語の文章です。")) >= 4 and len(reader.spell("xqzxqzxqz")) >= 5
    assert len(reader.spell("abc-12-xyz")) >= 3 and names[reader.spell("walk2go")[-1]] != "#"
    assert reader.spell("αβγδε") != reader.spell("γδεαβ")
    sf = spark.read.parquet(f"{SF}/documents.parquet")
    full = M.vocabulary(M.text_rows(sf, "doc_id", "text"))
    assert M.OTHER not in M._Units(full).tokens([r.text or "" for r in sf.collect()])[0].tolist()
    assert len(full) <= 3 * M.SHARE + 256


def test_tokens_hold_every_character(spark):
    """Stems before known endings, digits and marks are spelled: the tokens of a word give it back."""
    texts = ["walking talking, don't (sulking)", "12-34-56 and walk2go", "का १२ -- well-known日本語です", "Thinking _x² 50% é́"] * 3
    docs = M.text_rows(frame(spark, list(enumerate(texts))), "doc_id", "text")
    reader = M._Units(M.vocabulary(docs))
    names = {n: u for u, n in reader.number.items()}
    assert "-ing" in reader.number and "#" in reader.number
    for word in " ".join(texts).split(" "):
        named = [names[n] for n in reader.spell(word)]
        assert "".join(u[1:] if u[0] in "~-" else u for u in named if u != "#") == word.lower(), word
    assert [names[n] for n in reader.spell("walking")][-1] == "-ing"
    assert reader.spell("walking") != reader.spell("talking") and reader.spell("12") != reader.spell("34")


def test_letters_without_a_unit_are_one_token():
    ids, counts = M._Units([]).tokens(["gibberish text", "", "a  b"])
    assert ids.tolist() == [M.OTHER] * 4 and counts.tolist() == [2, 0, 2]


@pytest.mark.parametrize("rounds", [1, M.ROUNDS, 3])
def test_every_position_is_fitted_once(rounds):
    counts = np.array([1, 0, 2, 7, 8, 16, 1])
    taken = [M.fitted(counts, turn, rounds) for turn in range(rounds)]
    assert sorted(np.concatenate(taken).tolist()) == list(range(counts.sum()))


def test_whole_table_beats_unit_frequencies(spark):
    got = QUERIES["op2_masked_lm"](spark, SF).collect()
    assert len(got) == 1000
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.text_rows(docs, "doc_id", "text")
    ids, _ = M._Units(M.vocabulary(rows)).tokens([r.text for r in rows.collect()])
    share = np.bincount(ids, minlength=M.VOCABULARY) / len(ids)
    assert sum(r.n_tokens for r in got) == len(ids)
    assert sum(r.pseudo_log_likelihood for r in got) / len(ids) > np.log(share[ids]).mean() + 0.2


def test_empty_table(spark):
    model = M.fit(empty(spark))
    assert M.score(empty(spark), model).count() == 0
    assert M.score(frame(spark, [(1, prose(1, 5))]), model).first().n_tokens == 5


def test_long_texts_between_short_ones_keep_their_order(monkeypatch):
    texts = ["one two", "the of and " * 40, "three", "", "of the " * 30, "x"]
    reader = M._Units(["the", "of", "and", "one", "two"])
    whole = [reader.tokens([t])[0].tolist() for t in texts]
    monkeypatch.setattr(M, "BLOCK_BYTES", 50)
    ids, counts = reader.tokens(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole
