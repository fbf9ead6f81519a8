"""Listing and reading source files."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.sources.scratch import written

#: Reader options of job settings and the Spark CSV option of each.
CSV_OPTIONS = {"sep": "sep", "delimiter": "sep", "separator": "sep", "quotechar": "quote", "quote_char": "quote", "escapechar": "escape", "comment": "comment", "comment_prefix": "comment", "encoding": "encoding"}
#: Held while a session's inference of partition types is switched off.
_INFERENCE = threading.Lock()


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL: the one rule for missing numbers."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[F.when(~F.isnan(c), F.col(f"`{c}`")).alias(c) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else F.col(f"`{c}`") for c in df.columns])


def list_files(spark: SparkSession, root: str, suffix: str | None = None, exclude: str | None = None) -> DataFrame:
    """(path, length, modified) of the files under a prefix, by suffix and without those that contain `exclude`."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix or ''}").load(root)
    out = df.select("path", "length", F.col("modificationTime").alias("modified"))
    return out.where(~F.col("path").contains(exclude)) if exclude else out


def collect_files(spark: SparkSession, roots: Iterable[str], suffix: str | None = None, patterns: Iterable[str] = (), exclude: str | None = None) -> DataFrame:
    """Files under several prefixes whose path matches any of the patterns, each path once."""
    found = reduce(DataFrame.unionByName, [list_files(spark, r, suffix, exclude) for r in roots])
    patterns = list(patterns)
    if patterns:
        found = found.where(reduce(lambda a, b: a | b, [F.col("path").rlike(p) for p in patterns]))
    return found.dropDuplicates(["path"])


def expand_years(uri: str, years: tuple[int, int] | list[int]) -> list[str]:
    """One prefix per year; a pair is a range with both ends, a longer list is taken as it is."""
    span = range(years[0], years[1] + 1) if len(years) == 2 else years
    return list(dict.fromkeys(f"{uri.rstrip('/')}/{y}/" for y in span))


def csv_options(config: dict) -> dict[str, str]:
    """Spark reader options of a job's CSV settings."""
    out = {CSV_OPTIONS[k]: str(v) for k, v in config.items() if k in CSV_OPTIONS and v is not None}
    header = config.get("header", 0)
    out["header"] = str(header is not None and header is not False).lower()
    if config.get("has_header") is False:
        out["header"] = "false"
    missing = config.get("na_values", config.get("null_values"))
    if missing is not None:
        out["nullValue"] = missing if isinstance(missing, str) else list(missing)[0]
    if config.get("date_format"):
        out["timestampFormat"] = re.sub(r"%(.)", lambda m: {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss"}.get(m[1], m[0]), config["date_format"])
    return out


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, config: dict | None = None, strict: bool = False) -> DataFrame:
    """A CSV scan; with `strict` a value that does not fit the schema fails the job.  No schema: strings."""
    config = config or {}
    reader = spark.read.options(**csv_options(config)).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    extra = config.get("na_values", [])
    for value in [] if isinstance(extra, str) else list(extra)[1:]:
        df = df.replace(value, None)
    return nan_to_null(df)


def read_parquet(spark: SparkSession, path, schema: T.StructType | None = None, **partition_types: str) -> DataFrame:
    """A Parquet scan of a file or a Hive directory.

    Partition values are read as strings, because inference would turn the digits of a
    polygon key into a number, and cast to `partition_types`.
    """
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    with _INFERENCE:  # Spark has no such option per read; threads that read here take turns
        before = spark.conf.get(key)
        spark.conf.set(key, "false")
        try:
            df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
        finally:
            spark.conf.set(key, before)
    for name, kind in partition_types.items():
        df = df.withColumn(name, F.col(name).cast(kind))
    return df


def partition_values(spark: SparkSession, root: str, *keys: str) -> DataFrame:
    """The distinct values of partition keys as strings, from the paths of the files alone; no file is opened.

    Escaped characters are decoded and the name of missing values is NULL; a key that a
    path lacks is NULL too.
    """
    paths = list_files(spark, root, ".parquet").select("path")

    def value(key: str):
        text = F.regexp_extract("path", f"/{re.escape(key)}=([^/]*)/", 1)
        return F.when((text != "") & (text != "__HIVE_DEFAULT_PARTITION__"), F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).alias(key)

    return paths.select(*[value(k) for k in keys]).distinct()


def key_table(spark: SparkSession, root: str, *keys: str) -> DataFrame:
    """`partition_values` written as a table: joined to the data by its keys, it prunes partitions at run time, for which Spark wants plain columns."""
    return written(partition_values(spark, root, *keys), "keys")


READERS: dict[str, Callable[..., DataFrame]] = {".csv": read_csv, ".parquet": read_parquet}


def read_by_suffix(spark: SparkSession, path: str, **options) -> DataFrame:
    """The registered reader of the path's suffix."""
    for suffix, reader in READERS.items():
        if path.rstrip("/").endswith(suffix):
            return reader(spark, path, **options)
    raise NotImplementedError(f"no reader for {path}")


def list_datasets(spark: SparkSession, root: str, suffix: str | None = None) -> DataFrame:
    """(dataset): names of the top folders or files under a root that hold data, sorted."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    whole = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
    name = F.split(F.substring("path", len(whole) + 2, 1 << 20), "/")[0]
    found = list_files(spark, root).select(name.alias("dataset")).distinct()
    return (found.where(F.col("dataset").endswith(suffix)) if suffix else found).orderBy("dataset")
