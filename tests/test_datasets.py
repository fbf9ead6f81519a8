"""The facade over stored tables and cubes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pelagia.operators import ingest
from pelagia.sources import datasets, store


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("store"))
    df = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 86400).alias("ts"), (F.col("id") % 20).cast("double").alias("lat"), (F.col("id") % 30).cast("double").alias("lon"), F.col("id").alias("value"), F.lit("a.nc").alias("filename")
    )
    keyed = df.transform(ingest.add_period_key, "ts", "M").transform(ingest.add_cell_key, delta=10.0, wkb=False)
    store.write_table(keyed, f"{root}/buoys.parquet", ["timestamp", "cell_lat", "cell_lon"], ["ts"])
    grid = spark.range(12).select(F.timestamp_seconds(F.col("id") % 3 * 86400).alias("ts"), (F.col("id") % 2).cast("double").alias("lat"), (F.floor(F.col("id") / 6)).cast("double").alias("lon"), F.col("id").alias("value"), F.lit(1970).alias("year"))
    datasets.CubeDataset(spark, f"{root}/sst.cube").append(grid, "year")
    return root


def test_table(spark, root):
    d = datasets.open_dataset(spark, root, "buoys.parquet", {"TIME": "ts", "period": "M", "delta": 10.0})
    rows = d.get_data("1970-01-05", "1970-03-01", (2.0, 9.0, 0.0, 20.0), {"filename": "a.nc"}, ["value"]).collect()
    want = [i for i in range(4, 60) if 2 <= i % 20 <= 9 and i % 30 <= 20]
    assert [r[0] for r in rows] == want
    assert tuple(d.temporal_extent().first()) == (dt.datetime(1970, 1, 1), dt.datetime(1970, 7, 19))
    assert tuple(d.spatial_extent().first()) == (0.0, 0.0, 19.0, 29.0)
    assert d.unique_values("timestamp").count() == 7 and ("buoys.parquet", "value", "bigint") in d.describe()
    with pytest.raises(NotImplementedError):
        d.point_series(1.0, 1.0, None, None)


def test_cube(spark, root):
    d = datasets.open_dataset(spark, root, "sst.cube", {"TIME": "ts"})
    assert d.df.count() == 12 and d.get_data("1970-01-01", "1970-01-02", (1.0, None, None, 0.0)).count() == 2
    series = d.point_series(0.4, 0.9, "1970-01-01", "1970-01-03", ["value"]).orderBy("ts").collect()
    assert {(r["lat"], r["lon"]) for r in series} == {(0.0, 1.0)}
    again = d.df.withColumn("ts", F.col("ts") + F.expr("interval 10 days"))
    d.append(again, "year")
    assert d.df.count() == 24


def test_names(spark, root):
    with pytest.raises(ValueError):
        datasets.open_dataset(spark, root, "x.nc")
    assert [r[0] for r in datasets.catalogue_list(spark, root).collect()] == ["buoys.parquet", "sst.cube"]
    assert [r[0] for r in datasets.catalogue_list(spark, root, ".cube").collect()] == ["sst.cube"]
