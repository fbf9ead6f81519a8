"""Extents, coverage and the catalogue of datasets."""

from __future__ import annotations

import ast
import contextlib
import json
import warnings
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pelagia.operators.select import CANDIDATES
from pelagia.sources.scratch import written

#: Roles of the coordinates' kinds, and of a coordinate by its standard name.
ROLES = {"TIME": "TIME_AXIS", "LATITUDE": "LAT", "LONGITUDE": "LON", "DEPTH": "DEPTH"}
STANDARD_ROLES = {"time": "TIME_AXIS", "latitude": "LAT", "longitude": "LON"}
#: Words of dataset names and variables that tell a dataset's type.
ANIMAL_WORDS = ("animal", "tracking", "biologging", "tagging")
SURVEY_WORDS = ("aggregated", "diver", "benthic", "fish", "photoquadrat", "seabird", "seagrass", "kelp", "survey")
SERIES_WORDS = ("mooring", "station", "wave_buoy", "timeseries", "hourly", "nrs", "realtime", "delayed_qc")
DEPTH_NAMES = ("depth", "nominal_depth", "pres", "pres_adjusted")
DEPTH_STANDARDS = ("depth", "pressure")


def key_extent(df: DataFrame, key: str = "timestamp") -> DataFrame:
    """Extent in whole periods, from partition keys alone (see `files.partition_values`)."""
    k = F.col(key).cast("long")
    return df.agg(F.timestamp_seconds(F.min(k)).alias("start"), F.timestamp_seconds(F.max(k)).alias("end"))


def exact_extent(df: DataFrame, time: str, key: str = "timestamp") -> DataFrame:
    """Extent in time, reading only the first and the last period."""
    ends = df.agg(F.min(F.col(key).cast("long")).alias("a"), F.max(F.col(key).cast("long")).alias("b")).first()
    return df.where(F.col(key).cast("long").isin(ends["a"], ends["b"])).agg(F.min(time).alias("start"), F.max(time).alias("end"))


def time_extent(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(time).alias("start"), F.max(time).alias("end"))


def spatial_extent(df: DataFrame, lat: str, lon: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(lat).alias("min_lat"), F.min(lon).alias("min_lon"), F.max(lat).alias("max_lat"), F.max(lon).alias("max_lon"))


def padded_box(df: DataFrame, lat: str, lon: str, pad: float, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg((F.min(lat) - pad).alias("min_lat"), (F.min(lon) - pad).alias("min_lon"), (F.max(lat) + pad).alias("max_lat"), (F.max(lon) + pad).alias("max_lon"))


def cells(df: DataFrame) -> DataFrame:
    """The cells of the data: the spatial extent as a set of squares."""
    return df.select("cell_lat", "cell_lon", *(["polygon"] if "polygon" in df.columns else [])).distinct()


def coverage_months(df: DataFrame, time: str) -> DataFrame:
    """Time points per year and month, m1 to m12, 0 where there are none."""
    points = df.select(time).distinct()
    return points.select(F.year(time).alias("year"), F.month(time).alias("m")).groupBy("year").agg(*[F.count_if(F.col("m") == k).alias(f"m{k}") for k in range(1, 13)])


def coverage_overlap(extents: DataFrame, start, end, lat_min: float = -90.0, lat_max: float = 90.0, lon_min: float = -180.0, lon_max: float = 360.0) -> DataFrame:
    """Extents with time_ok, lat_ok, lon_ok and covered: whether a query's period and box meet each."""
    out = extents.withColumns(
        {
            "time_ok": (F.lit(start).cast("timestamp") <= F.col("end")) & (F.lit(end).cast("timestamp") >= F.col("start")),
            "lat_ok": (F.lit(lat_min) <= F.col("max_lat")) & (F.lit(lat_max) >= F.col("min_lat")),
            "lon_ok": (F.lit(lon_min) <= F.col("max_lon")) & (F.lit(lon_max) >= F.col("min_lon")),
        }
    )
    return out.withColumn("covered", F.col("time_ok") & F.col("lat_ok") & F.col("lon_ok"))


def shape(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """One row per dimension with its number of values."""
    return df.agg(*[F.countDistinct(d).alias(d) for d in dims]).unpivot([], list(dims), "dim", "size")


def describe(df: DataFrame, name: str) -> list[tuple[str, str, str]]:
    return [(name, f.name, f.dataType.simpleString()) for f in df.schema]


def variable_roles(catalogue: DataFrame) -> DataFrame:
    """(dataset, variable, role): TIME_AXIS by the exact names of time in cubes, then LAT, LON and DEPTH by theirs in any case, else by the standard name, which tells of coordinates only, else DATA.

    A variable is a coordinate if its attribute `source` is coord.
    """
    last = lambda key: F.max(F.when(F.col("key") == key, F.lower("value"))).alias(key)
    per = catalogue.where("variable <> 'global'").groupBy("dataset", "variable").agg(last("standard_name"), last("source"))
    role = F.when(F.col("variable").isin(*CANDIDATES["cube"]["TIME"]), ROLES["TIME"])
    for kind in ("LATITUDE", "LONGITUDE", "DEPTH"):
        role = role.when(F.lower("variable").isin(*{c.lower() for c in CANDIDATES["cube"][kind]}), ROLES[kind])
    for standard, name in STANDARD_ROLES.items():
        role = role.when((F.col("source") == "coord") & (F.col("standard_name") == standard), name)
    return per.select("dataset", "variable", role.otherwise("DATA").alias("role"))


def dataset_types(catalogue: DataFrame) -> DataFrame:
    """(dataset, kind), the first rule that holds: radar cubes by any variable of what they measure, animal tracks by name, other
    cubes as grids, surveys by name, tables with a depth as profiles, series by name, else tabular.

    A dataset's layout is its global attribute `format` (cube or table).
    """
    key, value, variable = F.col("key"), F.lower("value"), F.lower("variable")
    deep = variable.isin(*DEPTH_NAMES) | ((key == "standard_name") & value.isin(*DEPTH_STANDARDS)) | ((key == "axis") & (value == "z"))
    per = catalogue.groupBy("dataset").agg(
        F.collect_set(variable).alias("vs"),
        F.max(F.when((variable == "global") & (key == "format"), value)).alias("layout"),
        F.coalesce(F.bool_or(deep & (variable != "global")), F.lit(False)).alias("deep"),
    )
    named = lambda *words: F.lower("dataset").rlike("|".join(words))
    have = lambda *names: F.arrays_overlap("vs", F.array(*[F.lit(n) for n in names]))
    grid = F.coalesce(F.col("layout") == "cube", F.lit(False))
    table = F.coalesce(F.col("layout") == "table", F.lit(False))
    radar = F.when(have("ucur", "vcur"), "radar_velocity").when(have("vavh", "wppe"), "radar_wave").when(have("wspd_mean", "wdir_mean") | named("wind"), "radar_wind").otherwise("radar_velocity")
    kind = (
        F.when(grid & named("radar"), radar)
        .when(named(*ANIMAL_WORDS), "animal_tracking")
        .when(grid, "gridded")
        .when(named(*SURVEY_WORDS), "tabular")
        .when(table & F.col("deep"), "profiles")
        .when(named(*SERIES_WORDS), "timeseries")
        .otherwise("tabular")
    )
    return per.select("dataset", kind.alias("kind"))


#: Times that a text is mended before it counts as plain.
REPAIRS = 10
_PAIRS = {"{": "}", "[": "]", "(": ")"}


def read_literal(text: str) -> str | None:
    """JSON of a text that holds a list, tuple or mapping as Python writes it, or JSON with stray backslashes; None for others.

    Mending puts a backslash where the JSON reader stops, REPAIRS times at most.
    """
    bare = text.strip()
    if not bare or _PAIRS.get(bare[0]) != bare[-1]:
        return None
    with warnings.catch_warnings(), contextlib.suppress(ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        warnings.simplefilter("ignore")
        found = ast.literal_eval(bare)
        if isinstance(found, (dict, list, tuple)):
            return json.dumps(found, allow_nan=False, separators=(",", ":"))
    for _ in range(REPAIRS):
        try:
            return json.dumps(json.loads(bare), allow_nan=False, separators=(",", ":"))
        except json.JSONDecodeError as e:
            if e.pos >= len(bare):
                return None
            bare = f"{bare[: e.pos]}\\{bare[e.pos :]}"
        except (ValueError, RecursionError):
            return None
    return None


@F.pandas_udf(StringType())
def _literals(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else read_literal(t))


def decoded(value: Column) -> Column:
    """An attribute as JSON text where it reads as JSON or as a Python literal, else as it is.

    JSON is read by Spark; only values in brackets that are none go to the literal reader.
    """
    plain = F.try_parse_json(value)
    odd = F.when(plain.isNull() & F.trim(value).rlike(r"(?s)^[\[({].*[\])}]$"), value)
    return F.coalesce(F.to_json(plain), F.to_json(F.try_parse_json(_literals(odd))), value)


def decoded_variant(value: Column) -> Column:
    """The same as VARIANT, NULL for plain texts."""
    return F.try_parse_json(decoded(value))


def _indel_ratio(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / both lengths): twice the longest common subsequence over both lengths."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            old = row[j]
            row[j] = before + 1 if x == y else max(row[j], row[j - 1])
            before = old
    return 200.0 * row[-1] / (len(a) + len(b))


def _partial_ratio(a: str, b: str) -> float:
    """Whole percent of the best likeness of the shorter text to a part of the longer one that begins where a common block would put it.

    Common blocks are the longest one and, on both its sides, those of what is left; a part
    is as long as the shorter text, or reaches to the end.  An empty text is like all.
    """
    if a == b:
        return 100.0
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    best = 0.0
    for block in SequenceMatcher(None, short, long_).get_matching_blocks():
        start = max(0, block.b - block.a)
        best = max(best, SequenceMatcher(None, short, long_[start : start + len(short)]).ratio())
        if best > 0.995:
            return 100.0
    return float(round(100 * best))


def needed_grams(shorter: Column, threshold: float) -> Column:
    """How many of its pairs of neighbouring letters the shorter text has in common with the longer one at least, if they reach the threshold.

    At a likeness of r (half a percent less than the threshold, for rounding) m letters of
    the shorter text and a part of w letters agree in r (m + w) / 2, so w is r m / (2 - r)
    at least.  Letters that agree lie in one block more than letters that don't, and each
    block loses one pair: three times what agrees, less m, w and 1.
    """
    r = (threshold - 0.5) / 100
    return F.ceil((1.5 * r - 1) * 2 / (2 - r) * shorter - 1 - F.lit(1e-9))


def fuzzy_candidates(values: DataFrame, value: str) -> Callable[[float], DataFrame]:
    """For a threshold, the rows of `values` (value) that share enough pairs of letters with a text to reach it: an inverted index asked for the text's pairs."""
    pairs = lambda text: F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda k: F.substr(text, k, F.lit(2)))
    long_enough = values.where(F.length("value") > 1)
    index = long_enough.select("value", F.explode(pairs(F.col("value"))).alias("pair")).groupBy("value", "pair").agg(F.count(F.lit(1)).alias("there"))
    asked = values.sparkSession.createDataFrame([(k, value[k : k + 2]) for k in range(len(value) - 1)], "k int, pair string").groupBy("pair").agg(F.count(F.lit(1)).alias("here"))
    met = index.join(F.broadcast(asked), "pair").groupBy("value").agg(F.sum(F.when(F.length("value") < len(value), F.col("there")).otherwise(F.col("here"))).alias("shared"))  # no more pairs than the text has

    def reaching(threshold: float) -> DataFrame:
        least = needed_grams(F.least(F.length("value"), F.lit(len(value))), threshold)
        return values.join(met, "value", "left").where(F.coalesce("shared", F.lit(0)) >= least).select("value")

    return reaching


def ratio_udf(partial: bool = False):
    """Similarity of two string columns from 0 to 100, by Arrow batches."""
    f = _partial_ratio if partial else _indel_ratio

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x or "", y or "") for x, y in zip(a, b)])

    return ratio


def find_datasets(catalogue: DataFrame, value: str, key: str = "standard_name", threshold: float = 80.0) -> DataFrame:
    """Datasets with a variable whose attribute is like the value, as a whole percent.

    Each distinct attribute is compared once, in as many tasks as run at a time, and only
    if it shares enough pairs of letters with the value (`fuzzy_candidates`); one that holds
    the value is like it.  The likeness is marked as nondeterministic, or Spark would
    compare every row on the other side of the join as well.
    """
    wanted = written(catalogue.where((F.col("key") == key) & F.col("value").isNotNull()).select("dataset", F.lower("value").alias("value")).distinct(), "wanted")
    asked = value.lower()
    near = fuzzy_candidates(wanted.select("value").distinct(), asked)(threshold)
    near = near.repartition(max(8, catalogue.sparkSession.sparkContext.defaultParallelism), "value")
    like = ratio_udf(True).asNondeterministic()(F.lit(asked), F.col("value"))
    scored = near.withColumn("score", F.when(F.contains("value", F.lit(asked)), 100.0).otherwise(like))
    return wanted.join(scored.where(F.col("score") >= threshold), "value").select("dataset").distinct()


#: Weights of the fields that a search looks at.
FIELD_WEIGHTS = {"name": 3.0, "title": 2.0, "description": 1.0, "variable": 2.0}


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\s_\-/]+"), lambda t: t != "")


def search(fields: DataFrame, query: str, top: int = 10) -> DataFrame:
    """(dataset, score) best first: per query token the best token ratio in each field, weighted; `fields` has dataset, field, text.

    A token that the query repeats counts each time.  Ratios are computed once per distinct
    pair of tokens.
    """
    spark = fields.sparkSession
    words = fields.select("dataset", "field", F.explode(tokens_of(F.col("text"))).alias("token"))
    asked = spark.range(1).select(F.explode(tokens_of(F.lit(query))).alias("q")).groupBy("q").agg(F.count(F.lit(1)).alias("times"))
    pairs = words.select("token").distinct().crossJoin(F.broadcast(asked)).withColumn("r", ratio_udf()(F.col("q"), F.col("token")) / 100.0)
    weight = F.create_map(*[F.lit(x) for kv in FIELD_WEIGHTS.items() for x in kv])[F.col("field")]
    best = words.join(pairs, "token").groupBy("dataset", "field", "q").agg(F.max(F.col("r") * F.col("times")).alias("r"))
    return best.groupBy("dataset").agg(F.round(F.sum(F.col("r") * weight), 6).alias("score")).where("score > 0").orderBy(F.desc("score"), "dataset").limit(top)


def schema_difference(declared: DataFrame, present: DataFrame) -> DataFrame:
    """(dataset, variable, status): declared but absent, or present but undeclared."""
    on = ["dataset", "variable"]
    absent = declared.select(on).distinct().join(present.select(on).distinct(), on, "left_anti").withColumn("status", F.lit("absent"))
    extra = present.select(on).distinct().join(declared.select(on).distinct(), on, "left_anti").withColumn("status", F.lit("undeclared"))
    return absent.unionByName(extra)


def curated(registry: DataFrame, key: str, status: str, tags: str, order: str) -> DataFrame:
    """Trimmed registry entries with the status Done, the first per key, tags split at semicolons."""
    from pyspark.sql import Window

    clean = registry.select(*[F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in registry.dtypes])
    w = Window.partitionBy(key).orderBy(order)
    return clean.where(F.col(status) == "Done").withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r").withColumn(tags, F.transform(F.split(tags, ";"), lambda t: F.trim(t)))
