"""Queries of listing, reading by name, guards, settings, cubes as stores and the stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions import columns as C
from pelagia.operators import cube as G
from pelagia.operators import extents, ingest
from pelagia.plans.base import CUBE, OBS, cube, long, obs, query, raw_obs, table
from pelagia.plans.catalogue import BASE, catalogue
from pelagia.sources import datasets, files, schema, store
from pelagia.sources.scratch import path_exists, scratch_path
from pelagia.streaming.ingest import start_ingest


@query("SELECT DISTINCT event_type AS kind, true AS sized FROM events WHERE event_type <> 'purchase'")
def listed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files under a prefix by suffix, without those whose path holds a word."""
    root = scratch_path(spark, "raw")
    table(spark, d, "events").select("event_id", "value", F.col("event_type").alias("kind")).write.partitionBy("kind").option("header", "true").csv(root)
    found = files.list_files(spark, root, ".csv", exclude="kind=purchase")
    return found.groupBy(F.regexp_extract("path", "kind=([^/]+)/", 1).alias("kind")).agg(F.bool_and(F.col("length") > 0).alias("sized"))


def _by_year(spark: SparkSession, d: str) -> str:
    root = scratch_path(spark, "years")
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    for y in (1996, 1997, 1998):
        o.where(F.col("y") == y).write.parquet(f"{root}/{y}/orders_{y}")
    return root


@query("SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 1")
def collected_years(spark: SparkSession, d: str) -> DataFrame:
    """The files of a range of years that match patterns, each once, and what they hold."""
    roots = files.expand_years(_by_year(spark, d), (1996, 1998))
    found = files.collect_files(spark, [*roots, roots[0]], ".parquet", [r"orders_1996/part", r"/orders_(1998|2050)/"])
    folders = found.select(F.regexp_replace("path", "/[^/]+$", "").alias("folder")).distinct()
    paths = [r["folder"] for r in folders.collect()]  # folders of a job's years, not files
    return spark.read.parquet(*paths).groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def read_by_suffix(spark: SparkSession, d: str) -> DataFrame:
    """One file with a declared schema, others by the reader of their suffix."""
    path = scratch_path(spark, "suppliers.csv")
    table(spark, d, "supplier").select("s_suppkey", "s_nationkey").write.option("header", "true").csv(path)
    s = files.read_by_suffix(spark, path, schema=T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.LongType())]))
    declared = T.StructType([T.StructField("n_nationkey", table(spark, d, "nation").schema["n_nationkey"].dataType), T.StructField("n_name", T.StringType())])
    n = files.read_parquet(spark, f"{d}/nation.parquet", declared)
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).groupBy("n_name").agg(F.count(F.lit(1)).alias("suppliers"))


@query(f"""WITH {OBS}, {CUBE} SELECT 'grid.cube' AS dataset, true AS there, (SELECT count(*) FROM cube) AS n, 'cube' AS layout UNION ALL SELECT 'points.parquet', true, (SELECT count(*) FROM obs), 'table'
    UNION ALL SELECT 'nothing.parquet', false, NULL, NULL""")
def named_datasets(spark: SparkSession, d: str) -> DataFrame:
    """Datasets listed by name, opened by name, and one that isn't there."""
    root = scratch_path(spark, "store")
    store.write_table(obs(spark, d), f"{root}/points.parquet", ["event_type"], ["ts"])
    datasets.CubeDataset(spark, f"{root}/grid.cube").append(cube(spark, d).withColumn("bin", F.year("time")), "bin")
    names = [r["dataset"] for r in datasets.catalogue_list(spark, root).collect()]  # names of datasets
    opened = [datasets.open_dataset(spark, root, n) for n in names]
    parts = [o.df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("dataset"), F.lit(True).alias("there"), "n", F.lit(o.layout).alias("layout")) for n, o in zip(names, opened)]
    absent = spark.range(1).select(F.lit("nothing.parquet").alias("dataset"), F.lit(path_exists(spark, f"{root}/nothing.parquet")).alias("there"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("layout"))
    return ingest.combine([*parts, absent])


@query(f"WITH {CUBE} SELECT time, count(*) AS cells, round(sum(value), 6) AS total FROM cube GROUP BY 1")
def cube_append(spark: SparkSession, d: str) -> DataFrame:
    """A cube created with the years before 1998, the others appended, read with the time column found by its role."""
    c = cube(spark, d).withColumn("bin", F.year("time"))
    data = datasets.CubeDataset(spark, scratch_path(spark, "grid.cube"))
    data.append(c.where("bin < 1998"), "bin")
    data.append(c.where("bin >= 1998"), "bin")
    return data.df.groupBy(F.col(data.column("TIME")).alias("time")).agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum("value"), 6).alias("total"))


@query(f'WITH {CUBE} SELECT qc::BIGINT AS qc, min(time) AS start, max(time) AS "end" FROM cube GROUP BY 1')
def cube_extent(spark: SparkSession, d: str) -> DataFrame:
    """First and last time of a cube, by a flag."""
    return extents.time_extent(cube(spark, d).withColumn("qc", long("qc")), "time", ["qc"])


@query("""SELECT * FROM (VALUES ('orders', 'o_orderkey', 'type', 'bigint'), ('orders', 'o_totalprice', 'type', 'double'), ('orders', 'o_totalprice', 'units', 'AUD'), ('orders', 'global', 'dataset_name', 'orders')) t(dataset, variable, key, value)
    UNION ALL SELECT 'orders', 'global', 'rows', (SELECT count(*) FROM orders)::VARCHAR""")
def metadata_sidecar(spark: SparkSession, d: str) -> DataFrame:
    """The attributes of a table and of its columns written beside it and read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("o_totalprice", metadata={"units": "AUD"}))
    rows = store.attributes_table("orders", o.schema, {"rows": str(o.count())})
    path = scratch_path(spark, "attributes")
    spark.createDataFrame(rows, "dataset string, variable string, key string, value string").write.parquet(path)
    return files.read_parquet(spark, path)


@query(f"""WITH {BASE} SELECT dataset, variable, key, upper(w.value) AS value, c.value AS found FROM catalogue w JOIN catalogue c USING (dataset, variable, key) WHERE key = 'units' AND upper(w.value) <> c.value""")
def attribute_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """Wanted attributes that the catalogue holds otherwise."""
    c = catalogue(spark, d)
    return store.attribute_mismatches(c, c.where("key = 'units'").withColumn("value", F.upper("value"))).select("dataset", "variable", "key", "value", "found")


@query("""SELECT line, count(*) AS n FROM (SELECT 'row' AS line FROM orders UNION ALL SELECT 'note' FROM range(2) UNION ALL SELECT 'names') GROUP BY 1""")
def csv_export(spark: SparkSession, d: str) -> DataFrame:
    """An export's lines: attributes, column names, rows; its name ends in 8 hex digits."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    notes = spark.range(2).select(F.concat(F.lit("key"), "id").alias("key"), F.lit("text, with a comma").alias("value"))
    at = store.export_csv(o, scratch_path(spark, "export"), "orders", notes)
    line = F.when(F.col("value").startswith("# key"), "note").when(F.col("value") == "o_orderkey,o_orderstatus,o_totalprice", "names").otherwise("row")
    return spark.read.text(at).where(F.lit(at).rlike("orders_[0-9a-f]{8}[.]csv$")).groupBy(line.alias("line")).agg(F.count(F.lit(1)).alias("n"))


def _refused(f) -> str | None:
    try:
        f()
    except ValueError as e:
        return type(e).__name__
    return None


@query("""SELECT event_type, count(*) AS n, 'EmptyResult' AS empty, 'ValueError' AS no_key FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 GROUP BY 1""")
def guarded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned rows that pass the guards; rows that all go, and a key without values, are refused."""
    clean = raw_obs(spark, d).transform(ingest.drop_bad_coordinates)
    passed = ingest.require_keys(ingest.require_rows(clean), ["event_type", "lat"])
    empty = _refused(lambda: ingest.require_rows(clean.where("lat > 90")))
    no_key = _refused(lambda: ingest.require_keys(clean.withColumn("site", F.lit(None).cast("string")), ["site"]))
    return passed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select("*", F.lit(empty).alias("empty"), F.lit(no_key).alias("no_key"))


@query(f"""WITH {CUBE} SELECT time, lat, lon, value::FLOAT AS value, CAST(NULL AS DOUBLE) AS speed, qc::SMALLINT AS qc, lat * 100 + lon AS depth FROM cube""")
def declared_variables(spark: SparkSession, d: str) -> DataFrame:
    """Declared variables only, missing ones as NULLs, a missing coordinate from a template, declared types."""
    c = cube(spark, d)
    out = G.select_variables(c, {"time": {}, "lat": {}, "lon": {}, "value": {}, "qc": {}, "other": {"drop_var": True}})
    out = G.add_missing_variable(out, "speed", T.DoubleType())
    template = c.select("lat", "lon").distinct().withColumn("depth", F.col("lat") * 100 + F.col("lon"))
    out = G.add_missing_coordinate(out, "depth", template, ["lat", "lon"])
    return G.cast_variables(out, {"value": T.FloatType(), "qc": T.ShortType()})


@query("""SELECT coalesce(CASE WHEN o_custkey % 4 > 0 THEN 'f' || (o_custkey % 4) END, 'UNKNOWN_FILENAME.nc') AS filename, count(*) AS n FROM orders GROUP BY 1""")
def unknown_source(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose source file isn't known carry a placeholder."""
    k = F.col("o_custkey") % 4
    o = table(spark, d, "orders").withColumn("filename", F.when(k > 0, F.concat(F.lit("f"), k.cast("string"))))
    return G.named_source(o).groupBy("filename").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH r AS (SELECT 'f' || (l_orderkey % 50) AS filename, l_quantity, CASE WHEN l_orderkey % 50 % 7 <> 0 THEN l_shipdate END AS time, CASE WHEN l_orderkey % 50 % 11 <> 0 THEN l_linenumber END AS depth FROM lineitem),
    b AS (SELECT filename FROM r GROUP BY 1 HAVING count(time) = 0 OR count(depth) = 0)
    SELECT filename, count(*) AS n, round(sum(l_quantity), 2) AS total, false AS refused FROM r WHERE filename NOT IN (FROM b) GROUP BY 1 UNION ALL SELECT filename, NULL, NULL, true FROM b""")
def structural_check(spark: SparkSession, d: str) -> DataFrame:
    """Files without an index on a dimension are refused, and the batch is taken again without them."""
    f = F.col("l_orderkey") % 50
    r = table(spark, d, "lineitem").select(F.concat(F.lit("f"), f.cast("string")).alias("filename"), "l_quantity", F.when(f % 7 != 0, F.col("l_shipdate")).alias("time"), F.when(f % 11 != 0, F.col("l_linenumber")).alias("depth"))
    rows, refused = G.usable(r, "filename", ["time", "depth"])
    good = rows.groupBy("filename").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total")).withColumn("refused", F.lit(False))
    return good.unionByName(refused.withColumn("refused", F.lit(True)), allowMissingColumns=True)


@query(f"""WITH {CUBE}, a AS (SELECT time, lat, lon, value, NULL AS other FROM cube WHERE lat < 5 UNION ALL SELECT time, lat, lon, NULL, other FROM cube WHERE lat >= 5)
    SELECT time, count(*) AS n, count(value) AS with_value, count(other) AS with_other, true AS sorted FROM a GROUP BY 1""")
def combined_files(spark: SparkSession, d: str) -> DataFrame:
    """Files with other variables combined by name, in the order of the append dimension."""
    c = cube(spark, d)
    out = G.combine_sorted([c.where("lat < 5").select("time", "lat", "lon", "value"), c.where("lat >= 5").select("time", "lat", "lon", "other")], "time", ["time", "lat", "lon"])
    path = scratch_path(spark, "combined")
    out.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}).write.parquet(path)
    rows = files.read_parquet(spark, path)
    from pyspark.sql import Window

    before = F.lag(F.struct("time", "lat", "lon")).over(Window.partitionBy("part").orderBy("place"))
    rows = rows.withColumn("sorted", F.coalesce(before <= F.struct("time", "lat", "lon"), F.lit(True)))
    return rows.groupBy("time").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"), F.count("other").alias("with_other"), F.bool_and("sorted").alias("sorted"))


@query("""SELECT o_orderkey, date_trunc('day', o_orderdate) AS time, datediff('day', DATE '1990-01-01', o_orderdate::DATE)::DOUBLE AS phase FROM orders""")
def numeric_times(spark: SparkSession, d: str) -> DataFrame:
    """Numbers since an epoch as times, but those listed stay numbers."""
    days = F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("double")
    o = table(spark, d, "orders").select("o_orderkey", days.alias("time"), days.alias("phase"))
    since = ("days", "1990-01-01 00:00:00")
    return G.decode_times(o, {"time": since, "phase": since}, keep_numeric=["phase"])


def _settings(column: str) -> dict:
    part = {"source_variable": "timestamp", "time_extent": {"time_varname": column, "partition_period": "M"}}
    return {"schema": {"TIME": {"type": "timestamp[ns]"}, "timestamp": {"type": "int64"}, "polygon": {"type": "string"}}, "schema_transformation": {"partitioning": [part, "polygon"]}}


@query("""SELECT p_type AS kind, CASE WHEN p_type = 'PROMO' THEN 'time_varname DATE is not in the schema' WHEN p_type = 'SMALL' THEN 'no period century' ELSE '' END AS errors, count(*) AS n FROM part GROUP BY ALL""")
def settings_check(spark: SparkSession, d: str) -> DataFrame:
    """M5 M6: settings of each kind of dataset, merged from a parent's, and what is wrong with them."""
    kinds = table(spark, d, "part").groupBy(F.col("p_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    child = {"PROMO": _settings("DATE"), "SMALL": {"schema_transformation": {"partitioning": [{"source_variable": "timestamp", "time_extent": {"time_varname": "TIME", "partition_period": "century"}}, "polygon"]}}}

    said = lambda own: F.lit("; ".join(schema.settings_errors(schema.merge_settings(_settings("TIME"), json.loads(json.dumps(own))))))
    errors = said({})  # settings are few, and checked where the job is planned
    for kind, own in child.items():
        errors = F.when(F.col("kind") == kind, said(own)).otherwise(errors)
    return kinds.select("kind", errors.alias("errors"), "n")


@query("""SELECT p_partkey, upper(split_part(lower(trim(' ' || p_name || ' ')), ' ', 1)) AS first_word, 'f' || p_partkey || '.nc' AS name, (p_partkey % 10)::BIGINT AS digit, replace(p_name, ' ', '_') AS id FROM part""")
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    """trim, lower, split, extract, base name, replace."""
    p = table(spark, d, "part").withColumn("path", F.concat(F.lit("s3://raw/a/f"), F.col("p_partkey").cast("string"), F.lit(".nc")))
    word = F.upper(F.split(F.lower(C.utf8_trimmed(F.encode(F.concat(F.lit(" "), "p_name", F.lit(" ")), "UTF-8"))), " ")[0])
    digit = F.regexp_extract("path", "([0-9])[.]nc$", 1).cast("long")
    return p.select("p_partkey", word.alias("first_word"), ingest.file_name(F.col("path")).alias("name"), digit.alias("digit"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("id"))


@query(f"""WITH {OBS}, n AS (SELECT * REPLACE (CASE WHEN filename IN ('f1', 'f2') THEN value + 1000 ELSE value END AS value) FROM obs) SELECT filename, event_type, count(*) AS n, round(sum(value), 4) AS total FROM n GROUP BY ALL""")
def streamed_ingest(spark: SparkSession, d: str) -> DataFrame:
    """ST1: files streamed into a table; files that come again replace their rows."""
    source, target, at = (scratch_path(spark, x) for x in ("incoming", "target.parquet", "offsets"))
    o = obs(spark, d).select("event_id", "ts", "event_type", "value", "filename")
    kind = o.schema
    for part in (o, o.where(F.col("filename").isin("f1", "f2")).withColumn("value", F.col("value") + 1000)):
        part.write.mode("append").parquet(source)
        start_ingest(spark, source, kind, target, at, lambda df: df, ["event_type"], order=["ts"]).awaitTermination()
    return files.read_parquet(spark, target).groupBy("filename", "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
