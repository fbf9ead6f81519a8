"""Forms that hold no group in one task, against plain ones: rolling medians, kept files, ragged arrays, grids."""

import math
import random
from datetime import datetime, timedelta, timezone
from statistics import median

from pyspark.sql import functions as F

from pelagia.operators import cube, prefix, reshape, windows

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_running_median_equals_sorting():
    r, held, live = random.Random(1), windows.RunningMedian(), {}
    for k in range(4000):
        if live and r.random() < 0.48:
            held.remove(gone := r.choice(list(live)))
            del live[gone]
        else:
            held.add(k, live.setdefault(k, r.choice([-1.5, 0.0, 2.0, r.random()])))
        if live:
            assert held.median() == median(live.values())


def test_rolling_median_equals_brute_force(spark):
    r = random.Random(2)
    rows = [(r.randint(1, 2), T0 + timedelta(seconds=r.randint(0, 5000)), r.choice([None, math.nan, 1.0, 2.0, r.random()]), k) for k in range(600)] + [(1, None, 3.0, 600)]
    df = spark.createDataFrame(rows, "p int, t timestamp, v double, id int").repartition(5)
    for width, least in ((90, 1), (41, 3), (1200, 1)):
        half, want = width // 2, {}
        for p, t, _, k in rows:
            near = [v for q, s, v, _ in rows if t and s and q == p and v is not None and not math.isnan(v) and -half < (s - t).total_seconds() <= half]
            want[k] = median(near) if len(near) >= least else None
        out = windows.rolling_median(df, ["p"], "t", "v", width, least)
        assert {x["id"]: x["median"] for x in out.collect()} == want
        assert out.columns == ["p", "t", "v", "id", "median"]
    assert windows.rolling_median(df.limit(0), [], "t", "v", 60).collect() == []


def test_a_month_of_seconds(spark):
    n, half = 30 * 86_400, 1800
    df = spark.range(n).select((F.lit(1_704_067_200) + F.col("id")).cast("timestamp").alias("t"), F.col("id").cast("double").alias("v"))
    out = windows.rolling_median(df, [], "t", "v", 2 * half)
    plan = out._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "MapInArrow" in plan
    inner = F.col("v").between(half, n - half - 1)
    got = out.agg(F.count(F.lit(1)), F.count_if(inner & (F.col("median") != F.col("v") + 0.5)), F.max("median")).first()
    assert tuple(got) == (n, 0, n - 1 - (half - 1) / 2)


def kept_by_fold(ranges):
    end, out = None, set()
    for low, name, high in sorted(ranges):
        if end is not None and low <= end:
            out.add(name)
        else:
            end = high
    return out


def test_overlapping_files_equal_a_fold(spark):
    r = random.Random(3)
    for n, span, longest in ((40, 60, 9), (60, 15, 3), (3000, 40_000, 12)):
        ranges = [(low := r.randint(0, span), f"f{k:05}", low + r.randint(0, longest)) for k in range(n)]
        df = spark.createDataFrame([(f, t) for low, f, high in ranges for t in (low, high)] + [("none", None)], "file string, t long")
        got = [x["file"] for x in cube.overlapping_files(df, "file", "t").collect()]
        assert len(got) == len(set(got)) and set(got) == kept_by_fold(ranges)
    assert cube.overlapping_files(spark.createDataFrame([], "file string, t long"), "file", "t").collect() == []


def test_running_totals_and_ragged_arrays(spark, monkeypatch):
    monkeypatch.setattr(reshape, "BUCKET", 4)
    r = random.Random(4)
    sizes = {f: [(k, r.choice([0, 0, 1, 2, 9, 30])) for k in range(40)] for f in ("a", "b", None)}
    profiles = spark.createDataFrame([(f, k, n, f"p{k}") for f, ps in sizes.items() for k, n in ps], "file string, profile int, row_size int, note string").repartition(3)
    sums = prefix.running(profiles, ["profile"], F.col("row_size"), ["file"]).collect()
    for f, ps in sizes.items():
        mine = sorted((x["profile"], x["__sum"], x["__last"]) for x in sums if x["file"] == f)
        assert mine == [(k, sum(n for _, n in ps[: k + 1]), k == 39) for k, _ in ps]
    one = spark.createDataFrame([(k, n) for k, n in sizes["a"]], "profile int, row_size int")
    total = sum(n for _, n in sizes["a"])
    observations = spark.createDataFrame([(k, float(k)) for k in range(-1, total + 3)], "obs long, value double")
    got = sorted((x["obs"], x["profile"], x["value"]) for x in reshape.expand_ragged(one, observations).collect())
    assert got == [(i, k, float(i)) for i, k in enumerate(k for k, n in sizes["a"] for _ in range(n))]


def test_reversed_and_repeated_coordinates_are_refused(spark):
    grids = {"a": [1, 2, 3], "b": [3, 2, 1], "c": [1, 2, 2], "d": [1, 2, 3], "e": [1, 2], "f": [1, 2, None]}
    rows = [(f, i, v, ord(f)) for f, vs in grids.items() for i, v in enumerate(vs) for _ in range(2)]
    df = spark.createDataFrame(rows, "file string, i int, lat int, at int")
    assert {x["file"] for x in cube.coordinate_mismatches(df, "file", "lat", "i", "at").collect()} == {"b", "c", "e", "f"}


def test_previous_rows_cross_ranges(spark):
    r = random.Random(7)
    rows = [(g, k, f"{g}{k}") for g in ("a", "b", None) for k in range(200)] + [("one", 5, "x")]
    r.shuffle(rows)
    before = {(g, k): x for g, k, x in rows}
    df = spark.createDataFrame(rows, "g string, k int, x string").repartition(5)
    got = prefix.with_previous(df, ["g"], ["k"]).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x["__before"] and x["__before"]["x"]) == before.get((x["g"], x["k"] - 1))
    pairs = windows.segments(df, "g", "k", ["x"]).collect()
    assert {(p["x"], p["x_next"]) for p in pairs} == {(f"{g}{k}", f"{g}{k + 1}") for g in ("a", "b", None) for k in range(199)}
