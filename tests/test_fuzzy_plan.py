"""Fuzzy search compares each distinct attribute once, in several tasks."""

import random

from pelagia.operators import extents


def test_likeness_runs_on_distinct_values_only(spark):
    r = random.Random(3)
    names = ["blue_widget", "blue_widgets", "red_gear", "blue_wigdets", "green_bolt"]
    rows = [(f"d{k % 97}", f"v{k}", "standard_name", r.choice(names)) for k in range(3000)]
    out = extents.find_datasets(spark.createDataFrame(rows, "dataset string, variable string, key string, value string"), "blue_wigdet", threshold=80.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("Repartition") == 1
    assert {x[0] for x in out.collect()} == {d for d, _, _, v in rows if v in ("blue_widget", "blue_widgets", "blue_wigdets")}
