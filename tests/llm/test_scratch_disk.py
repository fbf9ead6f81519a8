"""What is written to the shared folder leaves no shuffle files behind, and components take few tasks."""

import pytest
from pyspark.sql import functions as F

from pelagia.llm.common import components, written
from pelagia.sources.scratch import CLEAN_UP


def shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return found.mkString("\n").count("/shuffle_")


def tasks(spark) -> int:
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    return sc.statusStore().executorList(False).apply(0).totalTasks()


@pytest.fixture
def uncoalesced(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.unset(key)


def test_written_leaves_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    assert sorted(r["count"] for r in written(df, "counts").collect()) == [142] + [143] * 6
    assert shuffle_files(spark) <= before
    assert spark.conf.get(CLEAN_UP, None) is None


def test_components_of_stars_take_one_pass(uncoalesced):
    stars = [(10_000 * g, 10_000 * g + k) for g in range(1, 4) for k in range(1, 200)]
    edges = uncoalesced.createDataFrame(stars, "a long, b long").coalesce(1)
    before = tasks(uncoalesced)
    found = components(edges)
    got = {r["node"]: r["root"] for r in found.collect()}
    n = tasks(uncoalesced) - before
    assert got == {x: 10_000 * (x // 10_000) for e in stars for x in e}
    assert n <= 20


def test_components_alike_by_broadcast_and_by_shuffles(spark, monkeypatch):
    import random

    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1050)] + [(None, 5)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    first = {tuple(r) for r in components(edges).collect()}
    monkeypatch.setattr("pelagia.llm.common.BROADCAST_NODES", -1)
    assert {tuple(r) for r in components(edges).collect()} == first
    root = {x: x for p in pairs if p[0] is not None and p[0] != p[1] for x in p}
    for _ in range(len(root)):
        for a, b in pairs:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    assert first == set(root.items())
