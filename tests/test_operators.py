"""Small hand-made frames for ingest, reshape, cube and store."""

import datetime as dt
import math
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions import columns as C
from pelagia.operators import cube, extents, ingest, joins, reshape, select, series, windows
from pelagia.operators.aggregate import hull, resample
from pelagia.sources import files, schema, store


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_period_keys(spark):
    df = spark.createDataFrame([("2024-05-06 01:02:03",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    row = df.select(*[C.period_key(F.col("t"), p).alias(p) for p in ("Y", "Q", "M", "D", "h")]).first()
    assert row["Y"] == 1704067200 and row["M"] == 1714521600 and row["Q"] == 1711929600 and row["D"] == 1714953600
    with pytest.raises(ValueError):
        C.period_key(F.col("t"), "fortnight")


def test_cell_key_truncates_and_wkb_is_exact(spark):
    df = spark.createDataFrame([(-3.9, 7.1), (0.0, 0.0), (-44.2, 153.3), (89.9, -179.9)], "lat double, lon double")
    for r in ingest.add_cell_key(df, delta=5.0).collect():
        lat, lon = math.trunc(r["lat"] / 5) * 5.0, math.trunc(r["lon"] / 5) * 5.0
        assert (r["cell_lat"], r["cell_lon"]) == (lat, lon)
        ring = [(lon - 5, lat - 5), (lon + 5, lat - 5), (lon + 5, lat + 5), (lon - 5, lat + 5), (lon - 5, lat - 5)]
        want = struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)
        assert r["polygon"] == want.hex().upper()


def test_polygon_key_of_digits_stays_text(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "1" * 186)], "a int, polygon string").write.partitionBy("polygon").parquet(path)
    assert files.read_parquet(spark, path).first()["polygon"] == "1" * 186


def test_scalar_cast(spark):
    df = spark.createDataFrame([("16m",), ("",), (None,), ("x",), ("-2.5",)], "v string")
    assert [r[0] for r in df.select(C.scalar_cast(F.col("v"), "int")).collect()] == [16, -9999, -9999, -9999, -2]
    assert [r[0] for r in df.select(C.scalar_cast(F.col("v"), "string")).collect()][1] == ""


def test_cast_keeps_columns_that_would_lose(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    wanted = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    out, failed = ingest.cast_to_schema(df, wanted)
    assert failed == ["b"] and dict(out.dtypes) == {"a": "int", "b": "string"}
    with pytest.raises(ValueError, match="b"):
        ingest.cast_to_schema(df, wanted, raise_error=True)


def test_cleaning(spark):
    df = spark.createDataFrame([(ts("2020-01-01"), 10.0, 20.0), (ts("1850-01-01"), 10.0, 20.0), (ts("2020-01-01"), None, 20.0), (ts("2020-01-01"), 90.0, 180.0), (ts("2020-01-01"), 90.1, 20.0)], "ts timestamp, lat double, lon double")
    out = df.transform(ingest.drop_bad_coordinates).transform(ingest.add_period_key, "ts", "M").transform(ingest.drop_before_1900)
    assert out.count() == 2
    with pytest.raises(ingest.EmptyResult):
        ingest.require_rows(df.where("lat > 100"))
    with pytest.raises(ValueError, match="k"):
        ingest.require_keys(df.withColumn("k", F.lit(None).cast("long")), ["k"])
    with pytest.raises(Exception, match="missing"):
        ingest.add_period_key(spark.createDataFrame([(None,)], "ts timestamp"), "ts", "M").collect()


def test_schema_errors_and_merge():
    assert schema.struct_of(["a: int32", "b: timestamp[ns]"])["a"].dataType == T.IntegerType()
    for bad, kind in (({"a": 1}, TypeError), ({"a": {}}, KeyError), ({"a": {"type": "complex"}}, ValueError)):
        with pytest.raises(kind):
            schema.struct_of(bad)
    assert schema.struct_of({"a": {"type": "float", "units": "m"}})["a"].metadata == {"units": "m"}
    merged = schema.merge_settings({"schema": {"a": 1}, "x": {"p": 1, "q": 2}}, {"schema": {"b": 1}, "x": {"q": 3}})
    assert merged == {"schema": {"b": 1}, "x": {"p": 1, "q": 3}}
    errors = schema.settings_errors({"schema": {"timestamp": {}}, "schema_transformation": {"partitioning": ["timestamp", "site"]}})
    assert "partitioning lacks polygon" in errors and "partition key site is not in the schema" in errors
    assert schema.cube_settings_errors({"schema": {"T": {}}, "dimensions": {"t": {"name": "T", "append_dim": True}, "x": {"name": "X", "append_dim": True}}}) == ["more than one append dimension", "dimension X is not in the schema"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, s string")
    assert [r["x"] for r in files.nan_to_null(df).collect()] == [None, 1.0]


def test_listing_and_readers(spark, tmp_path):
    for y in (2019, 2020):
        (tmp_path / f"{y}").mkdir()
        (tmp_path / f"{y}" / "a.csv").write_text("x;y\n1;NA\n2;3\n")
    (tmp_path / "2020" / "b.txt").write_text("no")
    roots = [str(tmp_path / "2019"), str(tmp_path / "2020"), str(tmp_path / "2020")]
    assert files.collect_files(spark, roots, ".csv").count() == 2
    assert files.collect_files(spark, roots, ".csv", ["2020/"]).count() == 1
    assert files.expand_years("s3://b/x/", [2001, 2003]) == [f"s3://b/x/{y}/" for y in (2001, 2002, 2003)]
    df = files.read_by_suffix(spark, str(tmp_path / "2020" / "a.csv"), schema=T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.DoubleType())]), config={"sep": ";", "header": 0, "na_values": ["NA"]})
    assert [tuple(r) for r in df.orderBy("x").collect()] == [(1, None), (2, 3.0)]
    with pytest.raises(NotImplementedError):
        files.read_by_suffix(spark, "x.nc")
    assert [r[0] for r in files.list_datasets(spark, str(tmp_path)).collect()] == ["2019", "2020"]


def rows_of(spark, path):
    return sorted(tuple(r) for r in files.read_parquet(spark, path).select("filename", "k", "v").collect())


def test_upsert_and_delete(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    old = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3), ("c", 3, 4)], "filename string, k int, v int")
    store.write_table(old, path, ["k"])
    new = spark.createDataFrame([("a", 2, 20), ("a", 4, 40)], "filename string, k int, v int")
    want = [("a", "2", 20), ("a", "4", 40), ("b", "1", 3), ("c", "3", 4)]
    for _ in range(2):  # twice is once
        store.upsert(spark, path, new, ["k"])
        assert rows_of(spark, path) == want
    gone = spark.createDataFrame([("c",)], "filename string")
    assert store.delete_files(spark, path, gone, ["k"], dry_run=True).first()["rows"] == 1
    assert len(rows_of(spark, path)) == 4
    store.delete_files(spark, path, gone, ["k"])  # empties the partition k=3
    assert rows_of(spark, path) == want[:3]


def test_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 86400).alias("ts"), (F.col("id") % 40).cast("double").alias("lat"), (F.col("id") % 60).cast("double").alias("lon"))
    keyed = df.transform(ingest.add_period_key, "ts", "M").transform(ingest.add_cell_key, delta=10.0, wkb=False)
    store.write_table(keyed, path, ["timestamp", "cell_lat", "cell_lon"], ["ts"])
    args = ("1970-03-01", "1970-06-15", (5.0, 15.0, 5.0, 25.0))
    pruned = select.get_data(files.read_parquet(spark, path), *args, time="ts", key="timestamp", period="M", cells=("cell_lat", "cell_lon", 10.0))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "timestamp" in filters and "cell_lat" in filters.split("PushedFilters")[0]
    assert sorted(pruned.select("ts").collect()) == sorted(select.get_data(df, *args, time="ts").select("ts").collect())
    assert select.get_data(df, end="1970-01-02", time="ts").count() == 1000  # no start, no time condition
    with pytest.raises(select.DateOutOfRange):
        select.check_period(df, "ts", "1990-01-01", "1991-01-01")
    with pytest.raises(select.BoxOutside):
        select.check_box(extents.cells(keyed), (-80.0, -70.0, 0.0, 1.0), 10.0)


def test_packed_strings(spark):
    df = spark.createDataFrame([(1, "1,2,3", "4,5,6", "a,b"), (2, "7, ,8", None, "c,d")], "id int, p string, q string, note string")
    assert reshape.packed_columns(df) == ["p", "q"]
    out = [tuple(r) for r in reshape.explode_packed(df, ["p", "q"]).select("id", "p", "q").orderBy("id", "p").collect()]
    assert out == [(1, 1.0, 4.0), (1, 2.0, 5.0), (1, 3.0, 6.0), (2, 7.0, None), (2, 8.0, None)]
    with pytest.raises(ValueError):
        reshape.explode_packed(spark.createDataFrame([("1,2", "1")], "p string, q string"), ["p", "q"])


def test_row_sizes_repaired(spark):
    df = spark.createDataFrame([(1, 2), (2, -4), (3, 9), (4, 1)], "profile int, row_size int").withColumn("total", F.lit(8))
    assert [r["row_size"] for r in reshape.repair_sizes(df, "total").orderBy("profile").collect()] == [2, 0, 6, 0]


def test_overlap_fold_and_grid_checks(spark):
    rows = [("a", 1), ("a", 5), ("b", 4), ("b", 9), ("c", 6), ("c", 7), ("d", 7), ("d", 8)]
    df = spark.createDataFrame(rows, "file string, t int")
    assert sorted(r[0] for r in cube.overlapping_files(df, "file", "t").collect()) == ["b", "d"]
    with pytest.raises(ValueError):
        cube.reconcile_dims(df, ["t"], {"t": df, "file": df})
    assert [r[0] for r in cube.files_without_index(df.withColumn("x", F.when(F.col("file") != "c", 1)), "file", ["t", "x"]).collect()] == ["c"]


def test_regrid_nulls_outside(spark):
    df = spark.createDataFrame([("s", 0.0, 0.0), ("s", 2.0, 4.0)], "k string, x double, y double")
    out = cube.regrid_linear(df, ["k"], "x", "y", cube.target_grid(spark, -1, 3, 1)).orderBy("x").collect()
    assert [r["y"] for r in out] == [None, 0.0, 2.0, 4.0, None]


def test_asof_takes_earlier_of_equals_and_crosses_buckets(spark):
    left = spark.createDataFrame([(1, ts("2024-01-02 00:00:05"), 1)], "k int, t timestamp, a int")
    right = spark.createDataFrame([(1, ts("2024-01-01 23:59:55"), 10), (1, ts("2024-01-02 00:00:15"), 20), (2, ts("2024-01-02 00:00:05"), 30)], "k int, t timestamp, b int")
    assert [r["b_right"] for r in joins.asof_nearest(left, right, ["k"], "t", ["b"], 10).collect()] == [10]
    assert joins.asof_nearest(left, right, ["k"], "t", ["b"], 9).count() == 0


def test_rolling_median_frame_is_open_below(spark):
    df = spark.createDataFrame([(1, ts("2024-01-01"), 1.0), (1, ts("2024-01-02"), 2.0), (1, ts("2024-01-03"), 9.0)], "k int, t timestamp, v double")
    out = windows.rolling_median(df, ["k"], "t", "v", 2 * 86400).orderBy("t").collect()
    assert [r["median"] for r in out] == [1.5, 5.5, 9.0]


def test_empty_bins_and_point_series(spark):
    df = spark.createDataFrame([(ts("2024-01-01"), 1.0), (ts("2024-01-03"), 3.0)], "t timestamp, v double")
    out = resample(df, "t", "day", {"m": ("v", "mean"), "n": ("v", "count")}).orderBy("bin").collect()
    assert [(r["m"], r["n"]) for r in out] == [(1.0, 1), (None, 0), (3.0, 1)]
    grid = df.withColumns({"lat": F.lit(1.0), "lon": F.lit(2.0)})
    assert series.point_series(grid, "t", "lat", "lon", 1.0, 2.0, "2024-01-01", "2024-01-02").count() == 1
    with pytest.raises(ValueError):
        series.point_series(grid, "t", "lat", "lon", 5.0, 2.0, "2024-01-01", "2024-01-02")


def test_hull():
    assert len(hull([(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0.5), (0.5, 0.0)])) == 4


def test_similarities():
    assert extents._partial_ratio("temp", "sea temperature") == 100.0
    assert extents._indel_ratio("abc", "abd") == pytest.approx(200 * 2 / 6)


def test_batches_and_combine(spark):
    df = spark.range(10).select(F.format_string("f%02d", "id").alias("filename"))
    assert sorted(tuple(r) for r in ingest.batches(df, 4).groupBy("batch").count().collect()) == [(1, 4), (2, 4), (3, 2)]
    both = ingest.combine([spark.range(1).withColumn("a", F.lit(1)), spark.range(1).withColumn("b", F.lit(2))])
    assert both.columns == ["id", "a", "b"]


def test_stream_ingest_equals_batch(spark, tmp_path):
    from pelagia.streaming.ingest import start_ingest

    src, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "filename string, k int, v int")
    df.write.parquet(src)
    run = lambda: start_ingest(spark, src, df.schema, target, str(tmp_path / "cp"), lambda b: b.withColumn("v", F.col("v") * 10), ["k"]).awaitTermination()
    run()
    spark.createDataFrame([("a", 3, 7)], df.schema).write.mode("append").parquet(src)
    run()
    assert rows_of(spark, target) == [("a", "3", 70), ("b", "2", 20)]
