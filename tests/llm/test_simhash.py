import random
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pluvia.llm import simhash as S
from pluvia.llm.components import components
from pluvia.llm.queries import QUERIES
from tests.llm.cases import awkward_rows, empty, frame, prose

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """fp -> smallest fp reachable, by comparing all pairs."""
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprints_match_the_definition():
    for _, text in awkward_rows():
        if text is None or len(text) < 20_000:
            assert S.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 200), st.integers(1, 4))
def test_bit_sliced_links_equal_all_pairs(seed, n, groups):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(6)]
    rows = sorted({(rng.randrange(groups), rng.choice(base) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1))
                   for _ in range(n)})
    label = S.link_sorted(np.array([g for g, _ in rows]), np.array([f for _, f in rows], np.uint64))
    for g in range(groups):
        at = [i for i, r in enumerate(rows) if r[0] == g]
        want = plain_components([rows[i][1] for i in at])
        for i in at:
            for j in at:
                assert (label[i] == label[j]) == (want[rows[i][1]] == want[rows[j][1]])


def test_pairs_within_the_radius_always_meet():
    rng = random.Random(3)
    masks = S.block_masks(S.BLOCKS)
    assert sum(masks) == 2**64 - 1 and sum(m.bit_count() for m in masks) == 64
    for flips in combinations(range(0, 64, 5), S.RADIUS):
        x = sum(1 << f for f in flips)
        assert any(all(x & masks[j] == 0 for j in c) for c in combinations(range(S.BLOCKS), S.BLOCKS - S.RADIUS))
    assert rng


def check(rows, got):
    fps = {f: None for _, f in rows}
    roots = plain_components([f for f in fps])
    least = {}
    for i, f in rows:
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    want = sorted(((i, f, least.get(roots[f])) for i, f in rows), key=repr)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=repr) == want


def test_components_on_awkward_rows(spark):
    rows = awkward_rows()
    got = S.near_duplicates(frame(spark, rows)).collect()
    check([(i, S.fingerprint(None if t is None else t.encode())) for i, t in rows], got)


def test_split_keys_lose_no_link(spark):
    rng = random.Random(5)
    base = prose(1, 400).split()
    rows = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(400)] = f"edit{i}"
        rows.append((i, " ".join(text)))
    rows += [(500 + i, prose(100 + i, 50)) for i in range(30)]
    got = S.near_duplicates(frame(spark, rows), tile=16).collect()
    check([(i, S.fingerprint(t.encode())) for i, t in rows], got)


def test_whole_documents_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op6_simhash"](spark, SF).collect()
    fps = {r.doc_id: S.fingerprint(r.text.encode()) for r in docs}
    assert all(r.fingerprint == f"{fps[r.doc_id]:016x}" for r in got) and len(got) == len(docs)
    roots = plain_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[roots[f]] = min(i, least.get(roots[f], i))
    assert all(r.component_id == least[roots[fps[r.doc_id]]] for r in got)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {300: 299}
    assert got == want


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
