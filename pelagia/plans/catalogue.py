"""Queries of the catalogue, over attributes derived from the part and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.operators import extents
from pelagia.plans.base import query, table
from pelagia.sources import store


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """(dataset, variable, key, value): brands as datasets, part names as variables."""
    p = table(spark, d, "part")
    base = p.select(F.lower(F.concat(F.element_at(F.array(F.lit("radar"), F.lit("vessel"), F.lit("buoy")), (F.col("p_partkey") % 3 + 1).cast("int")), F.lit("_"), F.replace("p_brand", F.lit("#"), F.lit("_")))).alias("dataset"),
                    F.element_at(F.array(F.lit("TIME"), F.lit("LATITUDE"), F.replace("p_name", F.lit(" "), F.lit("_"))), (F.col("p_size") % 3 + 1).cast("int")).alias("variable"), "p_type", "p_name")
    units = base.select("dataset", "variable", F.lit("units").alias("key"), F.lower("p_type").alias("value"))
    names = base.select("dataset", "variable", F.lit("standard_name").alias("key"), F.when(F.contains("p_name", F.lit("red")), "sea_water_pressure").otherwise(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("value"))
    return units.union(names).distinct()


BASE = """base AS (SELECT lower(['radar', 'vessel', 'buoy'][p_partkey % 3 + 1] || '_' || replace(p_brand, '#', '_')) AS dataset, ['TIME', 'LATITUDE', replace(p_name, ' ', '_')][p_size % 3 + 1] AS variable, p_type, p_name FROM part),
    catalogue AS (SELECT DISTINCT dataset, variable, 'units' AS key, lower(p_type) AS value FROM base UNION SELECT DISTINCT dataset, variable, 'standard_name', CASE WHEN contains(p_name, 'red') THEN 'sea_water_pressure' ELSE replace(p_name, ' ', '_') END FROM base)"""


def _pick(values: list[str], i):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


#: Names of variables, some of coordinates in one case or another, and standard names that tell only of coordinates.
ROLE_NAMES = ["TIME", "time", "Time", "DateTime", "LATITUDE", "Lat", "lon", "Longitude", "PRES_ADJUSTED", "nominal_depth", "phi", "lambda", "clock", "level", "TEMP"]
STANDARDS = ["time", "Latitude", "longitude", "depth", "sea_water_pressure", "temperature"]


@query(f"""WITH b AS (SELECT 'd' || (p_partkey // 15 % 60) AS dataset, {ROLE_NAMES}[p_partkey % 15 + 1] AS variable, p_partkey // 15 % 3 AS source, {STANDARDS}[p_size % 6 + 1] AS standard FROM part),
    v AS (SELECT dataset, variable, source = 0 AS coord, max(lower(standard)) AS standard FROM b GROUP BY ALL)
    SELECT dataset, variable, CASE WHEN variable IN ('TIME', 'time', 'DateTime') THEN 'TIME_AXIS' WHEN lower(variable) IN ('latitude', 'lat') THEN 'LAT' WHEN lower(variable) IN ('longitude', 'lon') THEN 'LON'
        WHEN lower(variable) IN ('pres_adjusted', 'nominal_depth') THEN 'DEPTH' WHEN coord AND standard = 'time' THEN 'TIME_AXIS' WHEN coord AND standard = 'latitude' THEN 'LAT' WHEN coord AND standard = 'longitude' THEN 'LON' ELSE 'DATA' END AS role FROM v""")
def variable_roles(spark: SparkSession, d: str) -> DataFrame:
    """The role of each variable, by name and for coordinates by standard name."""
    k = F.col("p_partkey")
    p = table(spark, d, "part").select(F.concat(F.lit("d"), (F.floor(k / 15) % 60).cast("string")).alias("dataset"), _pick(ROLE_NAMES, k % 15).alias("variable"), (F.floor(k / 15) % 3).alias("f"), _pick(STANDARDS, F.col("p_size") % 6).alias("standard"))
    source = p.select("dataset", "variable", F.lit("source").alias("key"), _pick(["coord", "data_var", "column"], F.col("f")).alias("value"))
    return extents.variable_roles(source.union(p.select("dataset", "variable", F.lit("standard_name"), "standard")))


#: Names and variables so dealt that each rule of the types decides for some part.
NAMES = ["radar_north", "radar_wind_north", "animal_radar", "satellite_chlorophyll", "diver_survey_depth", "argo_floats", "mooring_hourly", "vessel_tracks"]
VARIABLES = ["UCUR", "VCUR", "VAVH", "WPPE", "WSPD_MEAN", "WDIR_MEAN", "TEMP", "PRES"]


@query(f"""WITH b AS (SELECT {NAMES}[p_partkey % 8 + 1] || '_' || (p_partkey // 8 % 16) AS dataset, p_partkey // 128 % 3 AS f, {VARIABLES}[p_size % 8 + 1] AS v, p_type = 'PROMO' AS deep FROM part),
    t AS (SELECT dataset, list(DISTINCT v) AS vs, max(CASE WHEN f = 0 THEN 'cube' WHEN f = 1 THEN 'table' END) AS layout, bool_or(v = 'PRES' OR deep) AS deep FROM b GROUP BY 1)
    SELECT dataset, CASE WHEN layout = 'cube' AND contains(dataset, 'radar') THEN CASE WHEN list_has_any(vs, ['UCUR', 'VCUR']) THEN 'radar_velocity' WHEN list_has_any(vs, ['VAVH', 'WPPE']) THEN 'radar_wave'
        WHEN list_has_any(vs, ['WSPD_MEAN', 'WDIR_MEAN']) OR contains(dataset, 'wind') THEN 'radar_wind' ELSE 'radar_velocity' END WHEN contains(dataset, 'animal') THEN 'animal_tracking' WHEN layout = 'cube' THEN 'gridded'
        WHEN contains(dataset, 'survey') THEN 'tabular' WHEN layout = 'table' AND deep THEN 'profiles' WHEN contains(dataset, 'mooring') THEN 'timeseries' ELSE 'tabular' END AS kind FROM t""")
def dataset_types(spark: SparkSession, d: str) -> DataFrame:
    """The type of each dataset by the first rule that holds."""
    k = F.col("p_partkey")
    name = F.concat(_pick(NAMES, k % 8), F.lit("_"), (F.floor(k / 8) % 16).cast("string"))
    p = table(spark, d, "part").select(name.alias("dataset"), (F.floor(k / 128) % 3).alias("f"), _pick(VARIABLES, F.col("p_size") % 8).alias("variable"), "p_type")
    layout = p.where("f < 2").select("dataset", F.lit("global").alias("variable"), F.lit("format").alias("key"), F.when(F.col("f") == 0, "cube").otherwise("table").alias("value"))
    standard = p.select("dataset", "variable", F.lit("standard_name").alias("key"), F.when(F.col("p_type") == "PROMO", "Depth").otherwise("other").alias("value"))
    return extents.dataset_types(layout.union(standard))


@query()
def find_datasets_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Datasets with a variable like a misspelt name, at the usual threshold."""
    return extents.find_datasets(catalogue(spark, d), "blue_wigdet", threshold=80.0)


@query(f"WITH {BASE} SELECT DISTINCT dataset FROM catalogue WHERE key = 'standard_name' AND contains(value, 'widget')")
def find_datasets(spark: SparkSession, d: str) -> DataFrame:
    """Datasets with a variable like a name; above 95 only names that hold it are like it here."""
    return extents.find_datasets(catalogue(spark, d), "widget", threshold=95.0)


@query()
def search_datasets(spark: SparkSession, d: str) -> DataFrame:
    """Ranked search over names, titles and variables."""
    c = catalogue(spark, d)
    fields = c.select("dataset", F.lit("name").alias("field"), F.col("dataset").alias("text")).union(c.select("dataset", F.lit("variable"), F.col("variable"))).union(c.where("key = 'units'").select("dataset", F.lit("title"), F.col("value")))
    return extents.search(fields.distinct(), "radar blue widgets", 10)


@query(f"""WITH {BASE}, p AS (SELECT DISTINCT dataset, variable FROM base WHERE p_type <> 'SMALL'), q AS (SELECT DISTINCT dataset, variable FROM base WHERE p_type <> 'ECONOMY')
    SELECT dataset, variable, 'absent' AS status FROM (SELECT * FROM p EXCEPT SELECT * FROM q) UNION ALL SELECT dataset, variable, 'undeclared' FROM (SELECT * FROM q EXCEPT SELECT * FROM p)""")
def schema_difference(spark: SparkSession, d: str) -> DataFrame:
    """Declared and present variables that differ."""
    c = catalogue(spark, d).where("key = 'units'")
    return extents.schema_difference(c.where("value <> 'small'"), c.where("value <> 'economy'"))


@query("""WITH r AS (SELECT trim(c_name) AS name, c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 3 = 0), f AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM r)
    SELECT c_nationkey, name, [c_mktsegment, 'ocean'][2] AS second_tag, c_mktsegment AS first_tag FROM f WHERE k = 1""")
def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Curated entries, the first of duplicates, tags split."""
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", F.concat(F.lit(" "), "c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "Done ").otherwise("Open").alias("status"), F.concat("c_mktsegment", F.lit("; ocean ")).alias("tags"))
    out = extents.curated(c, "c_nationkey", "status", "tags", "c_custkey")
    return out.select("c_nationkey", "name", F.col("tags")[1].alias("second_tag"), F.col("tags")[0].alias("first_tag"))


@query(f"""WITH {BASE}, w AS (SELECT DISTINCT dataset, variable, 'units' AS key, 'new' AS value FROM catalogue WHERE variable = 'TIME') SELECT * FROM w UNION ALL SELECT * FROM catalogue WHERE dataset NOT IN (SELECT dataset FROM w)
    UNION ALL SELECT * FROM catalogue WHERE dataset IN (SELECT dataset FROM w) AND key = 'standard_name'""")
def metadata_update(spark: SparkSession, d: str) -> DataFrame:
    """Attributes replaced from settings, preserved ones kept."""
    c = catalogue(spark, d)
    wanted = c.where("variable = 'TIME'").select("dataset", "variable", F.lit("units").alias("key"), F.lit("new").alias("value")).distinct()
    return store.edit_attributes(c, wanted, ["standard_name"])


@query(r"""SELECT event_id, CASE event_id % 8 WHEN 0 THEN '{"k":' || regexp_extract(props, '[0-9]+') || '}' WHEN 1 THEN '{"k":' || (event_id % 9) || '}' WHEN 2 THEN 'plain (text' WHEN 3 THEN '{"a":null,"b":true,"c":"it''s"}'
    WHEN 4 THEN '[' || (event_id % 7) || ',2]' WHEN 5 THEN '["x",[1,2.5],false]' WHEN 6 THEN '{"p":"C:\\data","q":null}' ELSE '[not, closed}' END AS value FROM events""")
def attribute_values(spark: SparkSession, d: str) -> DataFrame:
    """Attribute values as JSON: JSON, Python's mappings, lists and tuples, stray backslashes; texts stay."""
    i = F.col("event_id")
    kinds = [
        F.col("props"), F.concat(F.lit("{'k': "), (i % 9).cast("string"), F.lit("}")), F.lit("plain (text"), F.lit("""{'a': None, 'b': True, 'c': "it's"}"""),
        F.concat(F.lit("("), (i % 7).cast("string"), F.lit(", 2)")), F.lit("['x', (1, 2.5), False]"), F.lit('{"p": "C:\\data", "q": null}'), F.lit("[not, closed}"),
    ]
    v = kinds[7]
    for k in range(7):
        v = F.when(i % 8 == k, kinds[k]).otherwise(v)
    return table(spark, d, "events").select("event_id", extents.decoded(v).alias("value"))
