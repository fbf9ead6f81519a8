"""Queries of tabular ingest, selection, extents and maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions import columns as C
from pelagia.operators import extents, ingest, prefix, reshape, select
from pelagia.operators.aggregate import resample
from pelagia.plans.base import OBS, RAW, long, obs, query, raw_obs, rnd, table
from pelagia.sources import files, store
from pelagia.sources.scratch import scratch_path

CELL = 15.0
#: trunc, because a cast to integer rounds in that SQL.
CELLS_SQL = "trunc(lat / 15.0) * 15.0 + 0.0 AS cell_lat, trunc(lon / 15.0) * 15.0 + 0.0 AS cell_lon"


def keyed(df: DataFrame) -> DataFrame:
    """Cleaned observations with their partition keys."""
    return df.transform(ingest.drop_bad_coordinates).transform(ingest.add_period_key, "ts", "W").transform(ingest.drop_before_1900).transform(ingest.add_cell_key, delta=CELL, wkb=False)


def stored(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "observations.parquet")
    store.write_table(keyed(obs(spark, d)), path, ["timestamp", "cell_lat", "cell_lon"], ["ts"])
    return path


BOX = (-40.0, -20.0, 115.0, 140.0)


@query(f"""WITH {OBS} SELECT event_id, ts, lat, lon, value FROM obs
    WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AND lat BETWEEN -40 AND -20 AND lon BETWEEN 115 AND 140 AND event_type = 'click'""")
def bbox_time_scalar(spark: SparkSession, d: str) -> DataFrame:
    """A table partitioned by week and cell, read with pruning by period, box and value."""
    df = files.read_parquet(spark, stored(spark, d))
    return select.get_data(
        df, "2024-01-05", "2024-01-20", BOX, {"event_type": "click"}, ["event_id", "ts", "lat", "lon", "value"], time="ts", lat="lat", lon="lon", key="timestamp", period="W",
        cells=("cell_lat", "cell_lon", CELL),
    )


@query(f"""WITH {RAW} SELECT epoch(date_trunc('day', ts))::BIGINT AS timestamp, {CELLS_SQL.replace('15.0', '5.0')}, count(*) AS n FROM raw
    WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND epoch(date_trunc('day', ts)) >= -2208988800 GROUP BY ALL""")
def partition_keys(spark: SparkSession, d: str) -> DataFrame:
    """Faults removed, period and cell keys."""
    df = raw_obs(spark, d).transform(ingest.drop_bad_coordinates).transform(ingest.add_period_key, "ts", "D").transform(ingest.drop_before_1900)
    return df.transform(ingest.add_cell_key, delta=5.0, wkb=False).groupBy("timestamp", "cell_lat", "cell_lon").agg(F.count(F.lit(1)).alias("n"))


def _wkb_sql() -> str:
    """Hex of the square, each double from its sign, exponent and fraction."""

    def le(x: str) -> str:
        power = f"floor(log2(greatest(abs({x}), 1)))::BIGINT"
        bits = f"(CASE WHEN {x} = 0 THEN 0 ELSE ({power} + 1023) * 4503599627370496 + ((abs({x}) / pow(2.0, {power}) - 1) * 4503599627370496)::BIGINT END)"
        body = f"lpad(hex({bits}), 16, '0')"
        high = f"(CASE WHEN {x} < 0 THEN hex(('0x' || substr({body}, 1, 2))::BIGINT + 128) ELSE substr({body}, 1, 2) END)"
        return "(" + " || ".join([f"substr({body}, {15 - 2 * k}, 2)" for k in range(7)] + [high]) + ")"

    a, b, c, e = (le(f"({x})") for x in ("cell_lon - 5", "cell_lon + 5", "cell_lat - 5", "cell_lat + 5"))
    return "'01030000000100000005000000' || " + " || ".join([a, c, b, c, b, e, a, e, a, c])


@query(f"""WITH {OBS}, c AS (SELECT DISTINCT {CELLS_SQL.replace('15.0', '5.0')} FROM obs) SELECT cell_lat, cell_lon, {_wkb_sql()} AS polygon FROM c""")
def polygon_keys(spark: SparkSession, d: str) -> DataFrame:
    """The cells of the data as hex WKB squares."""
    return extents.cells(obs(spark, d).transform(ingest.add_cell_key, delta=5.0))


@query(f"""WITH {RAW} SELECT filename, count(*) AS rows, count(*) FILTER (WHERE ts < TIMESTAMP '1900-01-01') AS bad_time,
    count(*) FILTER (WHERE NOT coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false)) AS bad_place FROM raw GROUP BY 1""")
def bad_rows_by_file(spark: SparkSession, d: str) -> DataFrame:
    """What cleaning would remove, per file."""
    return ingest.bad_row_counts(raw_obs(spark, d), "ts", "lat", "lon", "filename")


@query("""SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders WHERE year(o_orderdate) <= 1999 + 1""")
def drop_future_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows after the end of the year that follows `now`."""
    return ingest.drop_future(table(spark, d, "orders"), "o_orderdate", F.lit("1999-06-01").cast("date")).select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN -9999 WHEN event_id % 3 = 0 THEN (event_id % 50)::INTEGER WHEN event_id % 3 = 1 THEN (event_id % 40)::INTEGER ELSE -9999 END AS depth,
    TRY_CAST(value AS DOUBLE) AS value, CAST(NULL AS INTEGER) AS cycle FROM events""")
def typed_columns(spark: SparkSession, d: str) -> DataFrame:
    """Scalar casts with fills, missing columns as typed NULLs, unknown ones dropped."""
    i = F.col("event_id")
    text = F.when(i % 7 == 0, "").when(i % 3 == 0, F.concat((i % 50).cast("string"), F.lit("m"))).when(i % 3 == 1, (i % 40).cast("string")).otherwise("n/a")
    raw = table(spark, d, "events").select("event_id", text.alias("depth"), F.col("value").cast("string").alias("value"), "props")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("value", T.DoubleType()), T.StructField("cycle", T.IntegerType())])
    out, failed = ingest.cast_to_schema(raw, T.StructType([schema["event_id"], schema["value"]]))
    assert not failed
    out = out.withColumn("depth", C.scalar_cast(F.col("depth"), "int"))
    return ingest.add_missing(out.drop(*[n for n, _ in ingest.unknown_columns(out, schema)]), schema).select(*schema.fieldNames())


@query("""SELECT 'f' || (event_id % 20) AS filename, n_name AS site, coalesce(CASE WHEN n_nationkey % 3 > 0 THEN n_regionkey END, -1)::INTEGER AS depth, count(*) AS n
    FROM events LEFT JOIN nation ON n_nationkey = event_id % 20 GROUP BY ALL""")
def file_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of each source file as columns, fills where an attribute is missing."""
    nation = table(spark, d, "nation")
    attributes = nation.select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("filename"), "n_name", F.when(F.col("n_nationkey") % 3 > 0, F.col("n_regionkey")).alias("depth_of"))
    df = obs(spark, d).withColumn("path", F.concat(F.lit("s3://bucket/raw/"), "filename")).withColumn("filename", ingest.file_name(F.col("path")))
    out = ingest.attribute_columns(df, attributes, {"site": "n_name", "depth": "depth_of"}, {"depth": -1})
    return out.groupBy("filename", "site", "depth").agg(F.count(F.lit(1)).alias("n"))


ingest.register_path_function("platform_and_day", lambda p: {"platform": F.regexp_extract(p, r"/p([0-9]+)/", 1).cast("long"), "day": F.to_date(F.regexp_extract(p, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1))})
ingest.register_column_function("date_with_hour", C.date_with_hour)


@query("""SELECT user_id % 50 AS platform, date_trunc('day', ts) AS day, count(*) AS n, min(CAST(CAST(ts AS DATE) AS TIMESTAMP) + CASE WHEN event_id % 4 = 0 THEN INTERVAL 0 HOUR ELSE to_hours(hour(ts)) END) AS first_time
    FROM events GROUP BY ALL""")
def path_functions(spark: SparkSession, d: str) -> DataFrame:
    """Registered functions of the path and of columns."""
    e = table(spark, d, "events").withColumn("path", F.concat(F.lit("s3://b/p"), (F.col("user_id") % 50).cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".nc")))
    e = ingest.from_path(e, "platform_and_day").withColumns({"d": F.date_format("ts", "yyyy-MM-dd"), "h": F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "HH:00:00"))})
    e = ingest.from_columns(e, "date_with_hour", "t", "d", "h")
    return e.groupBy("platform", F.col("day").cast("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_time"))


@query("""SELECT o_orderkey, make_timestamp(year(o_orderdate), month(o_orderdate), day(o_orderdate), 12, 30, 7.0) AS t, trim(o_orderpriority) AS priority FROM orders""")
def decoded_fields(spark: SparkSession, d: str) -> DataFrame:
    """Times taken over by their fields, bytes as text, trimmed."""
    o = table(spark, d, "orders")
    t = ingest.julian_to_timestamp(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate"), F.lit(12), F.lit(30), F.lit(7.9))
    raw = o.select("o_orderkey", t.alias("t"), F.encode(F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")), "UTF-8").alias("priority"))
    return store.trim_strings(raw.withColumn("priority", C.utf8_trimmed(F.col("priority"))))


@query("""SELECT s_suppkey::VARCHAR AS filename, 'TEMP' AS variable, 'units' AS key, n_name AS found, 'CHINA' AS expected FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name <> 'CHINA'""")
def attribute_check(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of files that differ from the declared ones."""
    s = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    found = s.select(F.col("s_suppkey").cast("string").alias("filename"), F.lit("TEMP").alias("variable"), F.lit("units").alias("key"), F.col("n_name").alias("value"))
    expected = spark.range(1).select(F.lit("TEMP").alias("variable"), F.lit("units").alias("key"), F.lit("CHINA").alias("value"))
    return ingest.attribute_differences(found, expected)


@query("""SELECT DISTINCT o_orderkey::VARCHAR AS filename, o_orderstatus AS name FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = o_orderstatus)""")
def dimension_check(spark: SparkSession, d: str) -> DataFrame:
    """Declared dimensions that no variable of the file carries."""
    dims = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("filename"), F.col("o_orderstatus").alias("name")).distinct()
    have = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("filename"), F.col("l_linestatus").alias("name")).distinct()
    return ingest.dimensions_without_variable(dims, have)


@query("""SELECT event_type AS category, count(*) AS events, count(DISTINCT event_id % 20) AS files, count(*) FILTER (WHERE value >= 50 AND event_id % 3 > 0) AS retried_ok,
    count(*) FILTER (WHERE value < 50) AS failed FROM events GROUP BY 1""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    """M4: counts of a run's events."""
    e = obs(spark, d).select(F.col("filename").alias("file"), F.col("event_type").alias("category"), (F.col("event_id") % 3).alias("retry"), F.when(F.col("value") >= 50, "success").otherwise("error").alias("outcome"))
    return ingest.run_summary(e)


@query("""SELECT s_name, ceil(row_number() OVER (ORDER BY s_name) / 7.0)::BIGINT AS batch FROM supplier""")
def file_batches(spark: SparkSession, d: str) -> DataFrame:
    """M3: batches of a file list."""
    return ingest.batches(table(spark, d, "supplier").select("s_name"), 7, "s_name")


@query(f"WITH {OBS} SELECT min(ts) AS start, max(ts) AS \"end\" FROM obs")
def temporal_extent(spark: SparkSession, d: str) -> DataFrame:
    """Exact extent, reading the first and last period only."""
    return extents.exact_extent(files.read_parquet(spark, stored(spark, d)), "ts")


@query(f"WITH {OBS} SELECT make_timestamp(min(epoch(date_trunc('week', ts)))::BIGINT * 1000000) AS start, make_timestamp(max(epoch(date_trunc('week', ts)))::BIGINT * 1000000) AS \"end\" FROM obs")
def key_extent(spark: SparkSession, d: str) -> DataFrame:
    """Extent from partition keys, which the paths of the stored files tell."""
    return extents.key_extent(files.partition_values(spark, stored(spark, d), "timestamp"))


@query(f"WITH {OBS} SELECT DISTINCT epoch(date_trunc('week', ts))::BIGINT AS timestamp, {CELLS_SQL} FROM obs")
def stored_keys(spark: SparkSession, d: str) -> DataFrame:
    """Q10: the values of all partition keys of a stored table, without its data."""
    k = files.partition_values(spark, stored(spark, d), "timestamp", "cell_lat", "cell_lon")
    return k.select(long("timestamp").alias("timestamp"), F.col("cell_lat").cast("double").alias("cell_lat"), F.col("cell_lon").cast("double").alias("cell_lon"))


@query(f"WITH {OBS} SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM obs WHERE ts >= TIMESTAMP '2024-01-03' AND lat BETWEEN -33 AND -31 AND lon BETWEEN 120 AND 150 GROUP BY 1")
def box_by_key_table(spark: SparkSession, d: str) -> DataFrame:
    """Q4 Q6: rows in a box, partitions pruned at run time by the cells that touch it."""
    path = stored(spark, d)
    known = files.key_table(spark, path, "cell_lat", "cell_lon")
    rows = select.get_data(files.read_parquet(spark, path), "2024-01-03", None, (-33.0, -31.0, 120.0, 150.0), time="ts", lat="lat", lon="lon", key="timestamp", period="W", cells=("cell_lat", "cell_lon", CELL), known=known, checked=True, order=False)
    return rnd(rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), "total", digits=4)


def _asked(f) -> str:
    try:
        f()
    except (select.DateOutOfRange, select.BoxOutside) as e:
        return type(e).__name__
    return "rows"


@query(f"""WITH {OBS}, b AS (SELECT event_type, min(ts) AS a, max(ts) AS z, bool_or(trunc(lat / 15.0) * 15.0 - 15 <= -44 AND trunc(lat / 15.0) * 15.0 + 15 >= -44.5 AND trunc(lon / 15.0) * 15.0 - 15 <= 100 AND trunc(lon / 15.0) * 15.0 + 15 >= 90) AS touched FROM obs GROUP BY 1)
    SELECT event_type, CASE WHEN z < TIMESTAMP '2050-01-01' THEN 'DateOutOfRange' ELSE 'rows' END AS late, CASE WHEN a > TIMESTAMP '1990-01-01' THEN 'DateOutOfRange' ELSE 'rows' END AS early, CASE WHEN touched THEN 'rows' ELSE 'BoxOutside' END AS west, 'rows' AS inside FROM b""")
def refused_selections(spark: SparkSession, d: str) -> DataFrame:
    """Q2 Q4: what a selection says to periods and boxes outside the data of each kind."""
    df = keyed(obs(spark, d))
    kinds = [r["event_type"] for r in df.select("event_type").distinct().collect()]  # a few kinds of event

    def said(kind: str) -> tuple:
        own = df.where(F.col("event_type") == kind)
        ask = lambda start, end, box: _asked(lambda: select.get_data(own, start, end, box, time="ts", lat="lat", lon="lon", key="timestamp", period="W", cells=("cell_lat", "cell_lon", CELL), known=own.select("cell_lat", "cell_lon").distinct(), checked=True))
        return kind, ask("2050-01-01", "2051-01-01", None), ask("1980-01-01", "1990-01-01", None), ask(None, None, (-44.5, -44.0, 90.0, 100.0)), ask("2024-01-01", None, BOX)

    return spark.createDataFrame([said(k) for k in kinds], "event_type string, late string, early string, west string, inside string")


@query(f"WITH {OBS} SELECT user_id, min(lat) AS min_lat, min(lon) AS min_lon, max(lat) AS max_lat, max(lon) AS max_lon FROM obs GROUP BY 1")
def spatial_extent(spark: SparkSession, d: str) -> DataFrame:
    """Bounds per platform."""
    return extents.spatial_extent(obs(spark, d), "lat", "lon", ["user_id"])


@query(f"WITH {OBS} SELECT event_type, min(lat) - 0.5 AS min_lat, min(lon) - 0.5 AS min_lon, max(lat) + 0.5 AS max_lat, max(lon) + 0.5 AS max_lon FROM obs WHERE qc = 1 GROUP BY 1")
def padded_box(spark: SparkSession, d: str) -> DataFrame:
    """Padded bounds of a selection."""
    return extents.padded_box(select.with_good_flags(obs(spark, d), "qc", [1]), "lat", "lon", 0.5, ["event_type"])


@query("SELECT year(t)::INTEGER AS year, " + ", ".join(f"count(*) FILTER (WHERE month(t) = {k}) AS m{k}" for k in range(1, 13)) + " FROM (SELECT DISTINCT l_shipdate AS t FROM lineitem) GROUP BY 1")
def coverage_year_month(spark: SparkSession, d: str) -> DataFrame:
    """Time points per year and month."""
    return extents.coverage_months(table(spark, d, "lineitem"), "l_shipdate")


@query(f"""WITH {OBS}, x AS (SELECT user_id, min(ts) AS s, max(ts) AS e, min(lat) AS a, max(lat) AS b, min(lon) AS c, max(lon) AS f FROM obs GROUP BY 1)
    SELECT user_id, s <= TIMESTAMP '2024-01-02' AND e >= TIMESTAMP '2024-01-01' AS time_ok, -43 >= a AND -90 <= b AS lat_ok, 112 >= c AND -180 <= f AS lon_ok,
    s <= TIMESTAMP '2024-01-02' AND e >= TIMESTAMP '2024-01-01' AND -43 >= a AND 112 >= c AS covered FROM x""")
def coverage_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Whether a query's period and box meet the data of each platform."""
    o = obs(spark, d)
    x = o.groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"))
    return extents.coverage_overlap(x, "2024-01-01", "2024-01-02", lat_max=-43.0, lon_max=112.0).select("user_id", "time_ok", "lat_ok", "lon_ok", "covered")


@query("SELECT event_type, avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) AS value_null, count(*) AS rows FROM events GROUP BY 1")
def null_fractions(spark: SparkSession, d: str) -> DataFrame:
    """Q12 Q11: share of missing values after a mask."""
    e = table(spark, d, "events").withColumn("value", F.when(F.col("value") >= 20, F.col("value")))
    return select.null_fractions(e, ["value"], ["event_type"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0.0) WHEN o_orderkey % 3 = 1 THEN date_trunc('month', o_orderdate) ELSE NULL END AS t FROM orders""")
def date_parsing(spark: SparkSession, d: str) -> DataFrame:
    """Q13: partial dates completed, invalid ones NULL."""
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM")).otherwise("2020-13-45")
    return table(spark, d, "orders").select("o_orderkey", C.valid_date(text).alias("t"))


@query(f"""WITH {OBS}, n AS (SELECT * REPLACE (value + 1000 AS value) FROM obs WHERE filename IN ('f3', 'f7') AND event_id % 2 = 1)
    SELECT filename, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT filename, value FROM obs WHERE filename NOT IN (SELECT filename FROM n) UNION ALL SELECT filename, value FROM n) GROUP BY 1""")
def upsert_by_file(spark: SparkSession, d: str) -> DataFrame:
    """A stored table after two source files were processed again."""
    path = stored(spark, d)
    new = keyed(obs(spark, d).where(F.col("filename").isin("f3", "f7") & (F.col("event_id") % 2 == 1)).withColumn("value", F.col("value") + 1000))
    store.upsert(spark, path, new, ["timestamp", "cell_lat", "cell_lon"], "filename", ["ts"])
    return rnd(files.read_parquet(spark, path).groupBy("filename").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), "total", digits=4)


@query(f"WITH {OBS} SELECT filename, count(*) AS n FROM obs WHERE filename NOT IN ('f1', 'f2') GROUP BY 1")
def delete_by_file(spark: SparkSession, d: str) -> DataFrame:
    """M2: a stored table after two source files were deleted."""
    path = stored(spark, d)
    gone = spark.createDataFrame([("f1",), ("f2",)], "filename string")
    store.delete_files(spark, path, gone, ["timestamp", "cell_lat", "cell_lon"])
    return files.read_parquet(spark, path).groupBy("filename").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH o AS (SELECT o_orderkey AS profile, greatest(count(l_orderkey), 0) AS row_size FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
    r AS (SELECT profile, row_size, sum(row_size) OVER (ORDER BY profile) - row_size AS s FROM o), l AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS obs, l_quantity FROM lineitem)
    SELECT profile, count(*) AS n, sum(l_quantity) AS total FROM r JOIN l ON obs >= s AND obs < s + row_size GROUP BY 1""")
def ragged_expand(spark: SparkSession, d: str) -> DataFrame:
    """Observations of profiles by row ranges, over all orders as one file."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    sizes = o.join(li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("row_size")), "o_orderkey", "left")
    profiles = sizes.select(F.col("o_orderkey").alias("profile"), F.coalesce("row_size", F.lit(0)).alias("row_size"))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    observations = prefix.running(li.select(*order, "l_quantity"), order, F.lit(1)).select("l_quantity", (F.col("__sum") - 1).alias("obs"))
    return reshape.expand_ragged(profiles, observations).groupBy("profile").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -3 ELSE (o_orderkey % 4)::BIGINT END AS rs FROM orders),
    t AS (SELECT *, 6 AS total, least(sum(greatest(rs, 0)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 6) AS run, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) IS NULL AS last FROM p)
    SELECT o_custkey, o_orderkey, (CASE WHEN last THEN total ELSE run END - coalesce(lag(run) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 0))::BIGINT AS row_size FROM t""")
def ragged_repair(spark: SparkSession, d: str) -> DataFrame:
    """Row sizes made consistent within each file."""
    p = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(-3)).otherwise(F.col("o_orderkey") % 4).alias("row_size"), F.lit(6).alias("total"))
    return reshape.repair_sizes(p, "total", profile="o_orderkey", by="o_custkey").select("o_custkey", "o_orderkey", long("row_size").alias("row_size"))


@query("""WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -3 ELSE (o_orderkey % 4)::BIGINT END AS rs, (SELECT count(*) FROM orders) AS total FROM orders),
    t AS (SELECT *, least(sum(greatest(rs, 0)) OVER (ORDER BY o_orderkey), total) AS run, o_orderkey = (SELECT max(o_orderkey) FROM p) AS last FROM p)
    SELECT o_orderkey, (CASE WHEN last THEN total ELSE run END - coalesce(lag(run) OVER (ORDER BY o_orderkey), 0))::BIGINT AS row_size FROM t""")
def ragged_repair_whole(spark: SparkSession, d: str) -> DataFrame:
    """Row sizes made consistent over one file that holds all orders."""
    o = table(spark, d, "orders")
    total = o.agg(F.count(F.lit(1)).alias("total"))  # one row
    p = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit(-3)).otherwise(F.col("o_orderkey") % 4).alias("row_size")).crossJoin(F.broadcast(total))
    return reshape.repair_sizes(p, "total", profile="o_orderkey").select("o_orderkey", long("row_size").alias("row_size"))


@query("""SELECT vec_id, i - 1 AS level, (350 + (i - 1) * 10)::INTEGER AS depth, round(embedding[i]::DOUBLE, 6) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def profile_explode(spark: SparkSession, d: str) -> DataFrame:
    """Parallel arrays of profiles to rows."""
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("value"), F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda k: F.lit(350) + k * 10).alias("depth"))
    return reshape.explode_levels(e, ["depth", "value"]).select("vec_id", long("level").alias("level"), "depth", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("""SELECT vec_id, a * 10 AS y, b AS x, round(embedding[a * 8 + b + 1]::DOUBLE, 6) AS value FROM embeddings, range(0, 8) ta(a), range(0, 8) tb(b)""")
def grid_flatten(spark: SparkSession, d: str) -> DataFrame:
    """A variable on two in-file dimensions to rows."""
    nested = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda a: F.slice("embedding", a * 8 + 1, 8))
    e = table(spark, d, "embeddings").select("vec_id", F.array(*[F.lit(10 * k) for k in range(8)]).alias("ys"), F.array(*[F.lit(k) for k in range(8)]).alias("xs"), nested.alias("value"))
    return reshape.flatten_grid(e, {"y": "ys", "x": "xs"}, "value").select("vec_id", long("y").alias("y"), long("x").alias("x"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query("""SELECT vec_id, i - 1 AS position, (vec_id * 3 + i)::DOUBLE AS a, CASE WHEN vec_id % 5 > 0 THEN (vec_id * 7 - i)::DOUBLE END AS b FROM (SELECT vec_id, unnest(range(1, 4)) AS i FROM embeddings WHERE vec_id % 10 <> 9)""")
def packed_explode(spark: SparkSession, d: str) -> DataFrame:
    """Packed strings detected and exploded; rows of unequal lengths reject their file."""
    v = F.col("vec_id")
    pack = lambda f: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3)), f), ",")
    a = F.concat(pack(lambda i: (v * 3 + i).cast("string")), F.when(v % 10 == 9, F.lit(",1")).otherwise(F.lit(", ")))
    b = F.when(v % 5 > 0, pack(lambda i: (v * 7 - i).cast("string")))
    e = table(spark, d, "embeddings").select("vec_id", (v % 10).alias("file"), F.lit("x,y").alias("note"), a.alias("a"), b.alias("b"))
    return reshape.explode_packed(e, reshape.packed_columns(e), "file").select("vec_id", long("position").alias("position"), "a", "b")


@query("SELECT event_id, (event_id % 90)::INTEGER AS good, CASE WHEN event_id % 11 = 0 THEN 'n/a' ELSE (event_id % 90)::VARCHAR END AS lossy FROM events")
def numeric_strings(spark: SparkSession, d: str) -> DataFrame:
    """Strings that are declared numeric become so only if none is lost."""
    i = F.col("event_id")
    e = table(spark, d, "events").select("event_id", (i % 90).cast("string").alias("good"), F.when(i % 11 == 0, "n/a").otherwise((i % 90).cast("string")).alias("lossy"))
    return reshape.numbers_from_strings(e, T.StructType([T.StructField("good", T.IntegerType()), T.StructField("lossy", T.IntegerType())]))


@query("""SELECT event_id, k::INTEGER AS point, event_id % 100 + k AS t, event_id % 7 * k AS d FROM events, range(1, 6) r(k) WHERE NOT (k = 3 AND event_id % 2 = 0)""")
def numbered_unpivot(spark: SparkSession, d: str) -> DataFrame:
    """Numbered columns to points."""
    i = F.col("event_id")
    e = table(spark, d, "events").select("event_id", *[(i % 100 + k).alias(f"t{k}") for k in range(1, 6)], *[(F.when((i % 2 == 1) | F.lit(k != 3), i % 7 * k)).alias(f"d{k}") for k in range(1, 6)])
    return reshape.unpivot_numbered(e, {"t": "t", "d": "d"}, 5)


@query("SELECT l_orderkey, l_linenumber, p_name, p_size FROM lineitem LEFT JOIN part ON p_partkey = l_partkey")
def instrument_join(spark: SparkSession, d: str) -> DataFrame:
    """Observations with their instrument."""
    o = table(spark, d, "lineitem").select(F.col("l_partkey").alias("instrument_index"), "l_orderkey", "l_linenumber")
    i = table(spark, d, "part").select(F.col("p_partkey").alias("instrument_index"), "p_name", "p_size")
    return reshape.join_instrument(o, i).select("l_orderkey", "l_linenumber", "p_name", "p_size")


@query("SELECT c_custkey, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INTEGER AS c_mktsegment FROM customer")
def flag_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes of a string column."""
    return store.codes(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")[0]


@query()
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    """A hash of a table's rows whatever their order."""
    return store.content_hash(table(spark, d, "orders"))


@query(f"WITH {OBS} SELECT event_type, date_trunc('day', ts) AS bin, round(avg(value), 6) AS mean, count(value) AS n FROM obs WHERE qc <= 1 GROUP BY ALL")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """An export as CSV read back with an enforced schema."""
    path = scratch_path(spark, "export")
    df = select.with_good_flags(obs(spark, d), "qc", [0, 1]).select("event_type", "ts", "value")
    note = spark.range(1).select(F.lit("title").alias("key"), F.lit("observations").alias("value"))
    at = store.export_csv(df, path, "observations", note)
    back = files.read_csv(spark, at, df.schema, {"header": None, "sep": ",", "comment": "#"}).where("value is not null")  # but the line of names
    return rnd(resample(back, "ts", "day", {"mean": ("value", "mean"), "n": ("value", "count")}, ["event_type"], dense=False), "mean")
