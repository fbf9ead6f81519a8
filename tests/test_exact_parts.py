"""Operators that SQL doesn't reach, against brute force."""

import datetime
import random
import statistics

from pyspark.sql import functions as F

from pelagia.operators import aggregate as A
from pelagia.operators import extents, select
from pelagia.operators.windows import first_per_key
from tests.test_catalogue_forms import likeness


def test_hulls_of_fine_coordinates(spark, monkeypatch):
    monkeypatch.setattr(A, "HULL_POINTS", 7)
    rng = random.Random(2)
    rows = [(p, rng.uniform(110, 111), rng.uniform(-40, -39)) for p in range(3) for _ in range(60)] + [(9, 1.0, 1.0), (9, 2.0, 2.0)]
    rows += [(4, x, y) for x in (0.0, 0.5, 1.0) for y in (0.0, 0.5, 1.0)]

    def corners(pts):
        """Points that some line through them and another point leaves all others on one side of, ends of such lines only."""
        out = set()
        for a in pts:
            for b in pts:
                if a != b:
                    side = [(b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) for c in pts]
                    on = [c for c, s in zip(pts, side) if s == 0]
                    if min(side) >= 0:
                        out |= {min(on), max(on)}
        return out

    want = {}
    for p in {r[0] for r in rows}:
        h = corners(list({(x, y) for q, x, y in rows if q == p}))
        if len(h) >= 3:
            want[p] = (len(h), sum(x for x, _ in h) / len(h), sum(y for _, y in h) / len(h))
    got = {r["p"]: (r["vertices"], r["hull_lon"], r["hull_lat"]) for r in A.convex_hulls(spark.createDataFrame(rows, "p long, lon double, lat double"), "p", "lon", "lat").collect()}
    assert got.keys() == want.keys() == {0, 1, 2, 4}
    for p in want:
        assert got[p][0] == want[p][0] and abs(got[p][1] - want[p][1]) < 1e-9 and abs(got[p][2] - want[p][2]) < 1e-9


def test_unit_by_counts_is_that_of_the_median(spark):
    t0 = datetime.datetime(2020, 1, 1)
    for steps in ([10, 20, 7200], [10, 7190], [10, 7200], [3600] * 3, [90_000, 90_000, 1], [80_000, 92_000], [80_000, 93_000], [5], []):
        times = [t0]
        for s in steps:
            times.append(times[-1] + datetime.timedelta(seconds=s))
        df = spark.createDataFrame([(t,) for t in times], "t timestamp")
        median = statistics.median(steps) if steps else 1e9
        assert A.auto_unit(df, "t") == ("hour" if median < 3600 else "day" if median < 86_400 else "month")
        assert A.auto_unit(df.withColumn("k", F.lit(1)), "t", ["k"]) == A.auto_unit(df, "t")


def test_fuzzy_search_by_aligned_parts(spark):
    """Likeness is that of parts that common blocks align, in whole percent; an empty attribute is like all."""
    names = ["sea_water_temperature", "sea_water_temprature", "temperature", "salinity", "sea_surface_wave", "water_temp", "", "tempratur of water"]
    df = spark.createDataFrame([(f"d{k}", "v", "standard_name", n) for k, n in enumerate(names)] + [("x", "v", "units", "temperature")], "dataset string, variable string, key string, value string")
    for limit in (60.0, 80.0, 95.0):
        got = {r[0] for r in extents.find_datasets(df, "temperature", threshold=limit).collect()}
        assert got == {f"d{k}" for k, n in enumerate(names) if likeness("temperature", n) >= limit}


def test_coordinate_names_by_layout(spark):
    df = spark.createDataFrame([(1, 2, 3)], "lat int, LATITUDE int, eventDate int")
    assert select.coordinate(df, "LATITUDE") == "LATITUDE" and select.coordinate(df, "LATITUDE", "cube") == "lat" and select.coordinate(df, "TIME") == "eventDate"


def test_first_per_key_both_ways(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, None, "n"), (2, 5, "x"), (None, 1, "y")], "k int, o int, v string")
    by_name = {(r["k"], r["v"]) for r in first_per_key(df, ["k"], ["o"]).collect()}
    assert by_name == {(r["k"], r["v"]) for r in first_per_key(df, ["k"], [F.col("o")]).collect()} == {(1, "a"), (2, "n"), (None, "y")}
