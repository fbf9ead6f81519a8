"""Inputs that the queries share, derived from the given tables, in Spark and in SQL; and the register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rnd(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums differ in their last digits by order; results are compared rounded."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def obs(spark: SparkSession, d: str) -> DataFrame:
    """Point observations of platforms, from events."""
    e = table(spark, d, "events")
    i = F.col("event_id")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        (i % 5).alias("qc"), F.concat(F.lit("f"), (i % 20).cast("string")).alias("filename"),
        (F.lit(-45.0) + (i * 37 % 3500) / F.lit(100.0)).alias("lat"), (F.lit(110.0) + (i * 53 % 4500) / F.lit(100.0)).alias("lon"),
        (F.col("value") / 100 - 1).alias("u"), ((i % 200) / F.lit(100.0) - 1).alias("v"),
    )


OBS = """obs AS (SELECT event_id, ts, user_id, event_type, value, event_id % 5 AS qc, 'f' || CAST(event_id % 20 AS VARCHAR) AS filename,
    -45.0::DOUBLE + (event_id * 37 % 3500) / 100.0::DOUBLE AS lat, 110.0::DOUBLE + (event_id * 53 % 4500) / 100.0::DOUBLE AS lon,
    value / 100 - 1 AS u, (event_id % 200) / 100.0::DOUBLE - 1 AS v FROM events)"""


def raw_obs(spark: SparkSession, d: str) -> DataFrame:
    """The same with faults: missing and impossible latitudes, times before 1900."""
    i = F.col("event_id")
    return obs(spark, d).withColumns(
        {
            "lat": F.when(i % 97 == 0, F.lit(None).cast("double")).when(i % 89 == 0, 95.0).otherwise(F.col("lat")),
            "ts": F.when(i % 101 == 0, F.lit("1850-06-01 00:00:00").cast("timestamp")).otherwise(F.col("ts")),
        }
    )


RAW = (
    OBS
    + """, raw AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 95.0 ELSE lat END AS lat,
    CASE WHEN event_id % 101 = 0 THEN TIMESTAMP '1850-06-01 00:00:00' ELSE ts END AS ts) FROM obs)"""
)


def cube(spark: SparkSession, d: str) -> DataFrame:
    """A monthly grid from lineitem: one row per month and cell."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.date_trunc("month", "l_shipdate").alias("time"), (F.col("l_suppkey") % 10).alias("lat"), (F.col("l_partkey") % 10).alias("lon")).agg(
        F.round(F.avg("l_quantity"), 9).alias("value"), F.min("l_linenumber").alias("qc"), F.round(F.avg("l_discount"), 9).alias("other")
    )


CUBE = """cube AS (SELECT date_trunc('month', l_shipdate) AS time, l_suppkey % 10 AS lat, l_partkey % 10 AS lon, round(avg(l_quantity), 9) AS value,
    min(l_linenumber) AS qc, round(avg(l_discount), 9) AS other FROM lineitem GROUP BY ALL)"""


def spectra(spark: SparkSession, d: str) -> DataFrame:
    """Spectra from embeddings: one row per vector and wavelength, positive values."""
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("pos", "x")).select(
        "vec_id", "label", (F.lit(350) + 5 * F.col("pos")).alias("wavelength"), F.exp(F.col("x").cast("double")).alias("value")
    )


SPECTRA = """spectra AS (SELECT vec_id, label, (350 + 5 * (i - 1))::INTEGER AS wavelength, exp(embedding[i]::DOUBLE) AS value
    FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"""
