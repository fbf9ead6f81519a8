"""Literals, fuzzy search, key tables, stored cubes and exact quantiles against plain forms."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import aggregate, extents, select
from pelagia.plans.base import obs
from pelagia.plans.tabular import CELL, keyed, stored
from pelagia.sources import datasets, files, store

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "text, found",
    [
        ("{'a': \"it's\"}", {"a": "it's"}), ("{'a': None, 'b': (1, 2)}", {"a": None, "b": [1, 2]}), ("(1, 2)", [1, 2]), ("['x', True]", ["x", True]), ('{"p": "C:\\data", "q": null}', {"p": "C:\\data", "q": None}),
        ("plain", None), ("", None), ("{broken", None), ("[1, 2", None), ("{'a': open('f')}", None), ("{1, 2}", None), ('{"a": "b"c"}', None), ("[" * 50_000 + "]" * 50_000, None), ("(3)", None),
    ],
)
def test_literals(text, found):
    got = extents.read_literal(text)
    assert (None if got is None else json.loads(got)) == found


def test_decoded_keeps_plain_texts(spark):
    rows = [(None,), ("a 'b'",), ('{"k": 1}',), ("{'k': None}",), ("5",), ("(x",)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").coalesce(1).select(extents.decoded(F.col("v"))).collect()]
    assert got == [None, "a 'b'", '{"k":1}', '{"k":null}', "5", "(x"]
    assert spark.createDataFrame([("{'k': [1, None]}",)], "v string").select(F.variant_get(extents.decoded_variant(F.col("v")), "$.k[0]", "int")).first()[0] == 1


def likeness(a, b):
    """Blocks by brute force: the longest common part, the first of equal ones, then both sides."""
    if a == b:
        return 100
    s, l = (a, b) if len(a) <= len(b) else (b, a)

    def blocks(x, y, i, j):
        best = max(((n, -p, -q) for p in range(len(x)) for q in range(len(y)) for n in [next((k for k in range(min(len(x) - p, len(y) - q)) if x[p + k] != y[q + k]), min(len(x) - p, len(y) - q))]), default=(0, 0, 0))
        n, p, q = best[0], -best[1], -best[2]
        return [*blocks(x[:p], y[:q], i, j), (i + p, j + q, n), *blocks(x[p + n :], y[q + n :], i + p + n, j + q + n)] if n else []

    best = 0.0
    for p, q, _ in [*blocks(s, l, 0, 0), (len(s), len(l), 0)]:
        part = l[max(0, q - p) : max(0, q - p) + len(s)]
        both = len(s) + len(part)
        best = max(best, 2 * sum(n for *_, n in blocks(s, part, 0, 0)) / both if both else 1.0)
    return 100 if best > 0.995 else round(100 * best)


def test_fuzzy_search_prunes_nothing_that_is_like(spark):
    r = random.Random(5)
    base = ["sea_water_temperature", "sea_water_salinity", "eastward_velocity", "depth", "wind_speed", "t", ""]

    def spoilt(t):
        letters = list(t)
        for _ in range(r.randint(0, 6)):
            k = r.randint(0, len(letters))
            letters[k : k + r.randint(0, 1)] = r.choice(["", "x", "_", "e"])
        return "".join(letters) + r.choice(["", "", "_at_the_bottom"])

    values = sorted({spoilt(r.choice(base)) for _ in range(250)} | {f"other_{k}_{k * 7919 % 1000}" for k in range(200)})
    df = spark.createDataFrame([(f"d{k}", "v", "standard_name", v) for k, v in enumerate(values)], "dataset string, variable string, key string, value string")
    distinct = df.select("value").distinct()
    for asked in ("Sea_water_temprature", "wind_sped", "depht", "eastward velocity"):
        like = {v: likeness(asked.lower(), v) for v in values}
        for threshold in (80, 65, 95):
            got = {r["dataset"] for r in extents.find_datasets(df, asked, threshold=threshold).collect()}
            assert got == {f"d{k}" for k, v in enumerate(values) if like[v] >= threshold or asked.lower() in v}
        tried = extents.fuzzy_candidates(distinct, asked.lower())(80).count()
        assert tried < len(values) * 0.7
    assert extents._partial_ratio("abcdefghij", "xxabcdefgh") == 89  # the part that the block puts at "abcdefgh" has 8 letters


def test_ranked_search_equals_brute_force(spark):
    rows = [("a_b", "name", "a_b"), ("a_b", "title", "Blue Widgets of radar"), ("c", "name", "radar site"), ("c", "variable", "speed"), ("c", "variable", "radars"), ("d", "description", "nothing")]
    got = {r["dataset"]: r["score"] for r in extents.search(spark.createDataFrame(rows, "dataset string, field string, text string"), "radar radar  Blue", 10).collect()}
    ratio = lambda a, b: 2 * lcs(a, b) / (len(a) + len(b))

    def lcs(a, b):
        return 0 if not a or not b else 1 + lcs(a[1:], b[1:]) if a[0] == b[0] else max(lcs(a[1:], b), lcs(a, b[1:]))

    want = Counter()
    for q in ("radar", "radar", "blue"):
        best = {}
        for d, f, t in rows:
            for w in t.lower().replace("_", " ").split():
                best[d, f] = max(best.get((d, f), 0), ratio(q, w))
        for (d, f), x in best.items():
            want[d] += x * extents.FIELD_WEIGHTS[f]
    assert got == {d: round(x, 6) for d, x in want.items() if x}


def test_key_table_prunes_and_paths_tell_values(spark, tmp_path):
    path = stored(spark, SF)
    known = files.key_table(spark, path, "cell_lat", "cell_lon")
    df = files.read_parquet(spark, path)
    out = select.get_data(df, box=(-33.0, -31.0, 120.0, 150.0), time="ts", lat="lat", lon="lon", cells=("cell_lat", "cell_lon", CELL), known=known, checked=True)
    plan = out._jdf.queryExecution().toString().lower()
    assert "dynamicpruning" in plan
    whole = keyed(obs(spark, SF)).where("lat between -33 and -31 and lon between 120 and 150")
    assert out.count() == whole.count() > 0
    for ask, error in ((dict(start="2050-01-01"), select.DateOutOfRange), (dict(start="1980-01-01", end="1981-01-01"), select.DateOutOfRange), (dict(box=(60.0, 70.0, 0.0, 1.0)), select.BoxOutside)):
        with pytest.raises(error):
            select.get_data(df, **ask, time="ts", lat="lat", lon="lon", key="timestamp", period="W", cells=("cell_lat", "cell_lon", CELL), known=known, checked=True)
    odd = str(tmp_path / "odd.parquet")
    rows = [("a/b=c", 1), ("x+y %", 2), (None, 3), ("é:", 4)]
    spark.createDataFrame(rows, "k string, n int").write.partitionBy("k").parquet(odd)
    found = files.partition_values(spark, odd, "k")
    assert {r["k"] for r in found.collect()} == {k for k, _ in rows}
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_stored_cube_takes_regions_and_appends_once(spark, tmp_path):
    data = datasets.CubeDataset(spark, str(tmp_path / "g.cube"))
    rows = lambda times, v, floor: spark.createDataFrame([(t, lat, 1, v, floor, t // 10) for t in times for lat in (1, 2)], "time int, lat int, lon int, value int, floor int, bin int")
    data.append(rows([1, 2, 3, 5, 8, 13], 0, 7).union(rows([3], 0, 7)), "bin")
    data.append(rows([13, 21], 0, 7), "bin")
    report = data.upsert(rows([2, 3, 4, 8, 21, 30], 1, 9), "bin", static=["floor"])
    assert sorted(tuple(r) for r in report.collect()) == [(1, 2, 3, 2, "floor"), (2, 8, 8, 1, "floor"), (3, 21, 21, 1, "floor")]
    got = sorted((r["time"], r["lat"], r["value"], r["floor"]) for r in data.df.collect())
    assert got == [(t, lat, int(t in (2, 3, 4, 8, 21, 30)), 7) for t in (1, 2, 3, 4, 5, 8, 13, 21, 30) for lat in (1, 2)]


def test_exact_quantiles(spark, monkeypatch):
    r = np.random.default_rng(6)
    groups = {"a": r.normal(size=5000), "b": np.repeat([1.0, 2.0], [4999, 1]), "c": r.integers(0, 3, 1001).astype(float), "d": np.array([4.0]), "e": np.array([1.0, 2.0]), None: r.exponential(size=777)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("f", None), ("f", float("nan")), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    wanted = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p75": 0.75, "p100": 1.0}
    for accuracy in (10_000, 20):  # a coarse sketch still brackets
        monkeypatch.setattr(aggregate, "ACCURACY", accuracy)
        for r_ in aggregate.exact_quantiles(df, [F.col("g")], "v", wanted).collect():
            if r_["g"] == "f":
                assert r_["n"] == 0 and r_["p50"] is None
                continue
            assert r_["n"] == len(groups[r_["g"]])
            np.testing.assert_allclose([r_[k] for k in wanted], np.quantile(groups[r_["g"]], list(wanted.values())), rtol=1e-12)
        one = aggregate.exact_quantiles(df, [], "v", wanted).first()
        np.testing.assert_allclose([one[k] for k in wanted], np.quantile(np.concatenate(list(groups.values())), list(wanted.values())), rtol=1e-12)
    plan = aggregate.quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().toString()
    assert " percentile(" not in plan and "median(" not in plan


def test_content_hash_tells_rows_not_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "n int, t string")
    same = store.content_hash(a.orderBy(F.desc("n")).repartition(3)).first()["sha256"]
    assert store.content_hash(a).first()["sha256"] == same and len(same) == 64
    for rows in ([(1, "x"), (2, None)], [(1, "x"), (2, None), (2, "")], [(1, None), (2, "x"), (2, None)]):
        assert store.content_hash(spark.createDataFrame(rows, "n int, t string")).first()["sha256"] != same


def test_names_below_a_folder_named_like_the_root(spark, tmp_path):
    root = str(tmp_path / "st'ore")
    spark.range(3).write.parquet(f"{root}/a.parquet/site=x/st'ore")
    spark.range(3).write.parquet(f"{root}/b.parquet")
    assert [r["dataset"] for r in files.list_datasets(spark, root).collect()] == ["a.parquet", "b.parquet"]
