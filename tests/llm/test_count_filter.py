"""The count filters: pairs that meet, the tally that drops some of them, and large postings."""

import random
from itertools import combinations

import numpy as np

from pelagia.llm import near_dedup, simhash
from pelagia.llm.common import Hasher


def test_every_pair_of_spoilt_positions_leaves_a_posting():
    for bits in range(7):
        postings = simhash.posting_positions(bits)
        for spoilt in combinations(range(8), bits):
            assert any(not set(p) & set(spoilt) for p in postings)
    assert len(simhash.posting_positions(2)) == 6 and {len(p) for p in simhash.posting_positions(2)} == {4}


def test_tally_drops_pairs_and_large_postings_are_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    rng = random.Random(8)
    held = sum(255 << (8 * i) for i in simhash.posting_positions(2)[0])
    fps = {rng.getrandbits(64) for _ in range(3)} | {rng.getrandbits(64) & ~held for _ in range(300)}  # a posting of 300
    for f in list(fps)[:60]:
        fps.add(f ^ sum(1 << k for k in rng.sample(range(64), 2)))
    signed = {f - (f >> 63 << 64): f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    share = lambda a, b: sum(x == y for x, y in zip(a.to_bytes(8, "big"), b.to_bytes(8, "big")))
    got = {(r["a"], r["b"]): r["tally"] for r in simhash.met(df).collect()}
    groups = [[s for s in p] for p in simhash.posting_positions(2)]
    byte = lambda f, i: f >> (8 * i) & 255
    want = {(a, b) for a in signed for b in signed if a < b and any(all(byte(signed[a], i) == byte(signed[b], i) for i in g) for g in groups)}
    assert got.keys() == want and all(t == share(signed[a], signed[b]) for (a, b), t in got.items())
    below = [p for p, t in got.items() if t < 6]
    assert len(below) > 1000 and not any((signed[a] ^ signed[b]).bit_count() <= 2 for a, b in below)
    assert {tuple(r) for r in simhash.links(df).collect()} == {(a, b) for a in signed for b in signed if a < b and (signed[a] ^ signed[b]).bit_count() <= 2}


def test_near_groups_of_a_hot_passage_and_a_hot_group(spark, monkeypatch):
    """A passage in all texts, a large group of near copies and a chain of them, against all pairs."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    rows = [(k, " ".join(passage + [word() for _ in range(90)])) for k in range(80)]
    base = [word() for _ in range(120)]
    for k in range(80, 200):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(120)] = word()
        rows.append((k, " ".join(copy)))
    for k in range(200, 230):
        base[rng.randrange(120)] = word()
        rows.append((k, " ".join(base)))
    rows += [(300, "a b c"), (301, "A  b\tc"), (302, ""), (303, None), (304, " \n ")]
    hasher = Hasher()
    sets = {i: set(near_dedup.shingles(t or "", 5, hasher).tolist()) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = set()
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            linked |= {a, b}
            x, y = sorted((top(a), top(b)))
            root[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["root"] for r in near_dedup.near_groups(df).collect()} == {i: top(i) for i in linked} and len(linked) > 100


def test_indexed_shingles_guarantee_a_shared_one():
    for n in range(1, 80):
        for m in range(n, 100):
            least = -(-(n + m) * 4 // 9)  # of a pair at 0.8
            if n >= 0.8 * m and least <= n:
                # What both leave out can hold less than the overlap.
                assert min(n - near_dedup.indexed(n, 0.8), m - near_dedup.indexed(m, 0.8)) < least


def test_parities_never_differ_more_than_the_sets(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < rng.random()], rng.integers(0, 1 << 63, rng.integers(0, 60), dtype=np.uint64)])
        rows.append((near_dedup.parities(a).tolist(), near_dedup.parities(b).tolist(), len(np.setxor1d(a, b))))
    got = spark.createDataFrame(rows, "a array<long>, b array<long>, apart int").select(near_dedup.differing("a", "b").alias("bits"), "apart").collect()
    assert all(r["bits"] <= r["apart"] and (r["apart"] - r["bits"]) % 2 == 0 for r in got)
    assert any(r["bits"] == r["apart"] > 20 for r in got)
    assert near_dedup.parities(np.zeros(0, np.uint64)).tolist() == [0] * near_dedup.PARITIES
