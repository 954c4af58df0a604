import hashlib
import random
import re
import zlib
from collections import defaultdict

from pluvia.llm import prefix_trie as T
from pluvia.llm.queries import q_prefix_trie
from pluvia.llm.radix import Full, Indexed, RadixTree, Small
from tests.llm.cases import EXTRA
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """All nodes by the contract's words, from a dictionary of whole prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[:d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(ids) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if full[c] == node)
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None).cast("string") for c in EXTRA}).repartition(3)
    got = T.trie_nodes(T.rebuilt(T.turn_sequences(df)), **kw)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversations(seed, n, hot=0.35):
    """Shared first turns, whole copies, prefixes of others, some conversations absent."""
    rng, rows = random.Random(seed), []
    common = [("user", f"hot turn {i} of all") for i in range(5)]
    for c in range(n):
        if rng.random() < 0.1:
            continue
        turns = common[:rng.randint(1, 5)] if rng.random() < hot else []
        if rng.random() < 0.6:
            turns = turns + [(rng.choice(["user", "assistant"]), f"t {rng.randint(0, 3)}  x\ty") for _ in range(rng.randint(0, 4))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


def test_equals_brute_force_over_many_stretches_and_tasks(spark):
    for seed, stretch in ((1, 1), (2, 2), (3, 7), (4, 1 << 15)):
        rows = conversations(seed, 300)
        assert trie(spark, rows, stretch_keys=stretch) == brute(rows)


def test_one_sequence_for_most_conversations_spreads_over_stretches(spark):
    rows = [(c, 0, "user", "same") for c in range(400)] + [(c, 0, "user", f"own {c}") for c in range(400, 500)]
    assert trie(spark, rows, stretch_keys=5, stretch_bytes=100) == brute(rows)


def test_long_conversations(spark):
    long = [(0, i, "user", f"w {i}") for i in range(400)]
    rows = long + [(20, i, r, t) for _, i, r, t in long[:300]] + [(40, i, "user", "w 0") for i in range(3)]
    assert trie(spark, rows, stretch_keys=2) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (1, -3, "", "second"), (None, 0, "user", "x"),
            (2, 0, "user", "a"), (2, 1, "user", "b"), (3, 0, "use", "ra"), (2**62, 5, "user", "\x1c \n"), (-5, 0, "user", "a")]
    assert trie(spark, rows) == brute(rows)
    twice = trie(spark, [(7, 0, "user", "a"), (7, 0, "user", "a"), (7, 0, "user", "b")])
    assert twice == trie(spark, [(7, 0, "user", "b"), (7, 0, "user", "a"), (7, 0, "user", "a")])
    assert max(r[1] for r in twice) <= 3


def test_empty_table_has_no_root(spark):
    assert trie(spark, []) == []


def test_turnless_conversations_end_at_the_root(spark):
    # Conversations whose first h turns are replaced by those of one that is absent.
    rows = [(c, 0, "user", "only") for c in range(21, 40)]
    got = trie(spark, rows)
    assert got == brute(rows)
    root = next(r for r in got if r[1] == 0)
    assert root[7] != T.EMPTY_SHA256 and root[2] is None


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = q_prefix_trie(spark, sf)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == brute(rows)


def test_layouts_grow_and_keep_their_children():
    below, kinds = Small(), []
    for b in random.Random(0).sample(range(256), 256):
        below = below.put(b, b)
        kinds.append((type(below), getattr(below, "room", 0)))
        assert all(below.get(x) == x for x in below.children())
        below = below.put(b, b)  # put again: replaced, not added
    assert kinds[3] == (Small, 4) and kinds[4] == (Small, 16) and kinds[15] == (Small, 16)
    assert kinds[16][0] is Indexed and kinds[47][0] is Indexed and kinds[48][0] is Full
    assert below.children() == list(range(256))


def test_paths_are_compressed_and_cut():
    tree = RadixTree()
    for key in (b"abcdef", b"abcxyz", b"abc", b"abcdef", b""):
        tree.insert(key, key)
    paths = [(n.path, len(n.ends)) for n, _, _, leaving in tree.walk() if not leaving]
    assert paths == [(b"", 1), (b"abc", 1), (b"def", 2), (b"xyz", 1)]
