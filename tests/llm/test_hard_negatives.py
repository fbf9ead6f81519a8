"""Hard negatives against brute force, on awkward rows and across many cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pelagia.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, id string, slot int"


def brute(rows, k, m, low, high, anchor):
    good = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[2])]
    q = lambda v: [math.floor(256 * x) for x in v]
    asked = {}
    for i, label, v, *_ in sorted((r for r in good if anchor(r[0])), key=lambda r: (r[0], r[1], r[2])):
        asked.setdefault(i, (label, q(v)))
    out = []
    for i, (label, v) in asked.items():
        scored = {(-sum(a * b for a, b in zip(v, q(w))), j, other == label) for j, other, w, *_ in good if j != i and len(w) == len(v)}
        same = sorted((s, j) for s, j, e in scored if e)[:k]
        for s, j in same:
            found = sorted((t, n) for t, n, e in scored if not e and low * -s <= 100 * -t <= high * -s)[:m]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(found, 1)]
    return sorted(out)


def rows_of(seed, n, dims=(3,), values=(-1.0, -0.5, 0.0, 0.25, 0.5, 1.0)):
    r = random.Random(seed)
    return [(i, r.choice([0, 0, 0, 1, 2]), [r.choice(values) for _ in range(r.choice(dims))], "x", 7) for i in range(n)]


@pytest.mark.parametrize("low, high", [(80, 100), (50, 95), (0, 130)])
def test_windows_equal_brute_force(spark, monkeypatch, low, high):
    monkeypatch.setattr(H, "BLOCK_ROWS", 16)
    rows = rows_of(1, 150, dims=(3, 5, 0)) + rows_of(2, 40)  # the second part repeats ids with other vectors
    rows += rows[:30] + [rows[0]] * 20  # repeated rows, one of them often
    rows += [(None, 1, [1.0] * 3, "x", 1), (7, None, [1.0] * 3, "x", 1), (8, 1, None, "x", 1), (9, 1, [None, 1.0, 1.0], "x", 1), (10, 1, [math.nan, 1.0, 1.0], "x", 1), (20, 2, [math.inf, 0.0, 0.0], "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0, 4, 3, low, high).collect())
    assert got == brute(rows, 4, 3, low, high, lambda i: i % 10 == 0) and got


def test_small_cells_give_the_same(spark, monkeypatch):
    rows = rows_of(3, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    for name, value in (("BLOCK_ROWS", 8), ("CELL_ROWS", 90), ("CELL_ANCHORS", 30), ("SCORES", 64)):
        monkeypatch.setattr(H, name, value)
    got = sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute(rows, 5, 5, 80, 100, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rows = rows_of(4, 60, values=(3e4 + 1 / 256, 1e5 + 3 / 256, -7e4, 12.0))
    got = sorted(tuple(r) for r in H.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0).collect())
    rows = [(i, label, [float(x) for x in spark.createDataFrame([(v,)], "v array<float>").first()["v"]], a, b) for i, label, v, a, b in rows]
    assert got == brute(rows, 5, 5, 80, 100, lambda i: i % 5 == 0)


def test_empty_table_and_scores_too_large(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).collect() == []
    with pytest.raises(Exception, match="2\\^56"):
        H.hard_negatives(spark.createDataFrame([(i, i % 2, [1e30], "x", 1) for i in range(4)], SCHEMA), F.lit(True)).collect()
