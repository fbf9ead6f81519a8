"""Repeated passages against brute force: periodic texts, repeated rows, many shards."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.llm import substrings as S
from pelagia.llm.common import mix64

SCHEMA = "doc_id long, text string, key string, spans int"


def brute(rows, window):
    words = [re.findall("[^\x20\x09-\x0d]+", r[1] or "") for r in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, words):
        gone = {p for at in range(len(w) - window + 1) if starts[tuple(w[at : at + window])] > 1 for p in range(at, at + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def rows_of(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "A", "é", "\x85", "c\x1cd", "中", "e"])
    shared = [[word() for _ in range(r.randint(4, 14))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [r.choice(shared) if r.random() < 0.4 else [word() + str(r.randint(0, 40)) for _ in range(r.randint(0, 9))] for _ in range(r.randint(0, 6))]
        rows.append((i, r.choice([" ", "\n", " \t", "\x0b"]).join(x for p in parts for x in p), "k", 1))
    rows += [(100, None, "k", 1), (101, "", "k", 1), (102, " \n ", "k", 1), (103, "x " * 30, "k", 1), (104, "p q " * 20, "k", 1), (None, " ".join(shared[0] + ["alone"]), "k", 1)]
    return rows + [rows[3]] * 3 + [(200, "u1 u2 u3 u4 u5 u6 u7 u8", "k", 1)] * 2


@pytest.mark.parametrize("window, seed, small", [(5, 2, False), (5, 5, True), (7, 3, True), (2, 1, True)])
def test_kept_words_equal_brute_force(spark, monkeypatch, window, seed, small):
    if small:
        monkeypatch.setattr(S, "SHARD_WINDOWS", 2)
        monkeypatch.setattr(S, "SHARD_PIECES", 3)
    rows = rows_of(window)
    got = S.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(4), window, seed).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, window)


def test_hashes_that_collide_remove_nothing(spark, monkeypatch):
    rows = [(i, f"s t u{i} v w x{i} y z", "k", 1) for i in range(5)] + [(9, "s t u1 v w", "k", 1)]
    every = lambda pieces, window: pieces.select("base", F.explode(F.sequence("base", F.col("base") + F.size(F.split(F.decode("text", "UTF-8"), " ")) - window)).alias("place"))
    monkeypatch.setattr(S, "_recurring", every)  # as if all windows had the hash of another
    got = S.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA), 5, 1).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 5)


def test_equal_windows_have_equal_seeds():
    r = np.random.default_rng(3)
    h = mix64(r.integers(0, 4, 3000).astype(np.uint64))
    first, last, value, places = S.pieces_of(h, np.array([0, 1200, 3, 1797]), 9, 3)
    seeds, seen = {}, Counter()
    w = S.runs_of(h, 9)
    for a, b, v, n in zip(first, last, value, places):
        for k in range(a, b + 1):
            assert seeds.setdefault(w[k], v) == v
        seen[v] += n
    starts = Counter(tuple(h[k : k + 9]) for a, b in zip(first, last) for k in range(a, b + 1))
    assert sum(b - a + 1 for a, b in zip(first, last)) == 1192 + 1789
    for k in (k for a, b in zip(first, last) for k in range(a, b + 1)):
        assert starts[tuple(h[k : k + 9])] == 1 or seen[seeds[w[k]]] > 1


def test_long_text_and_empty_table(spark):
    rows = [(1, "once " + "again and " * 100_000, "k", 1), (2, " ".join(f"w{k}" for k in range(50_000)), "k", 1)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in S.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (200_001, 200_000), 2: (50_000, 0)}
    assert S.drop_repeated_passages(spark.createDataFrame([], SCHEMA)).collect() == []
