"""Partitioned tables: write, upsert and delete by source file or time, attributes, exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.sources.files import read_parquet
from pelagia.sources.scratch import delete_path, path_exists, scratch_path

#: Rows of a row group, so that statistics prune within files.
ROWS_PER_GROUP = 20_000


def write_table(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Hive-partitioned Parquet, each partition's rows shuffled together and sorted by time."""
    out = df.repartition(*[F.col(k) for k in keys])
    if order:
        out = out.sortWithinPartitions(*keys, *order)
    out.write.mode(mode).option("parquet.block.row.count.limit", ROWS_PER_GROUP).partitionBy(*keys).parquet(path)


def _touched(keys: Sequence[str], df: DataFrame) -> DataFrame:
    return df.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()


def _rewrite(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], after: DataFrame, touched: DataFrame) -> None:
    """Replaces the touched partitions by the rows of `after`; partitions left without rows go."""
    staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"
    write_table(after, staging, keys, order)
    # Dynamic overwrite leaves a partition that has no new rows as it was; such ones are dropped by name.
    left = _touched(keys, read_parquet(spark, staging)) if path_exists(spark, staging) and not after.isEmpty() else None
    emptied = touched if left is None else touched.join(left, list(keys), "left_anti")
    gone = ["/".join(f"{k}={row[k]}" for k in keys) for row in emptied.toLocalIterator()]  # names of partitions, not rows
    if left is not None:
        types = {k: "string" for k in keys}
        read_parquet(spark, staging, **types).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    for part in gone:  # after the new rows are in place, so a crash between loses none
        delete_path(spark, f"{path.rstrip('/')}/{part}")
    delete_path(spark, staging)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], by: str = "filename", order: Sequence[str] = ()) -> None:
    """Rows of `new` replace all stored rows with the same `by` value (source file or time), in whatever partition those are.

    Only partitions that hold old rows of these values or get new ones are rewritten.
    """
    values = new.select(by).distinct()
    if not path_exists(spark, path):
        write_table(new, path, keys, order)
        return
    old = read_parquet(spark, path)
    touched = _touched(keys, old.join(values, by, "left_semi")).union(_touched(keys, new)).distinct()
    kept = old.join(touched, list(keys), "left_semi").join(values, by, "left_anti")
    strings = new.select(*[F.col(c).cast("string").alias(c) if c in keys else F.col(c) for c in new.columns])
    _rewrite(spark, path, keys, order, kept.unionByName(strings, allowMissingColumns=True), touched)


def delete_files(spark: SparkSession, path: str, files: DataFrame, keys: Sequence[str], by: str = "filename", dry_run: bool = False) -> DataFrame:
    """Deletes the rows of the given files; returns (file, rows) of what was, or with `dry_run` would be, deleted."""
    old = read_parquet(spark, path)
    hit = old.join(files.select(by).distinct(), by, "left_semi")
    said = scratch_path(spark, "deleted")  # written, as the rows counted are gone afterwards
    hit.groupBy(by).agg(F.count(F.lit(1)).alias("rows")).write.parquet(said)
    counts = spark.read.parquet(said)
    if not dry_run:
        touched = _touched(keys, hit)
        kept = old.join(touched, list(keys), "left_semi").join(files.select(by).distinct(), by, "left_anti")
        _rewrite(spark, path, keys, (), kept, touched)
    return counts


def clear(spark: SparkSession, path: str) -> bool:
    return delete_path(spark, path)


def upsert_rows(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """The table after an upsert, as a query: old rows without the new values, and the new rows."""
    return old.join(new.select(by).distinct(), by, "left_anti").unionByName(new, allowMissingColumns=True)


def blank_file(cube: DataFrame, variables: Sequence[str], file: Column | str, name_col: str = "filename") -> DataFrame:
    """Data variables of one file's cells become NULL; coordinates and the file's name stay."""
    hit = F.col(name_col) == (F.lit(file) if isinstance(file, str) else file)
    return cube.select(*[F.when(~hit, F.col(c)).alias(c) if c in variables else F.col(c) for c in cube.columns])


def attributes_table(dataset: str, schema: T.StructType, global_attributes: dict[str, str]) -> list[tuple[str, str, str, str]]:
    """(dataset, variable, key, value) rows of column and global attributes."""
    rows = [(dataset, f.name, "type", f.dataType.simpleString()) for f in schema]
    rows += [(dataset, f.name, k, str(v)) for f in schema for k, v in sorted((f.metadata or {}).items())]
    return rows + [(dataset, "global", k, str(v)) for k, v in sorted((global_attributes | {"dataset_name": dataset}).items())]


def edit_attributes(catalogue: DataFrame, wanted: DataFrame, preserve: Sequence[str] = ()) -> DataFrame:
    """Attributes after an update: wanted ones set, others of the same datasets removed unless preserved."""
    on = ["dataset", "variable", "key"]
    other = catalogue.join(wanted.select("dataset").distinct(), "dataset", "left_anti")
    stay = catalogue.join(wanted.select("dataset").distinct(), "dataset", "left_semi").where(F.col("key").isin(*preserve) if preserve else F.lit(False)).join(wanted.select(on), on, "left_anti")
    return other.unionByName(stay).unionByName(wanted)


def attribute_mismatches(catalogue: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted attributes that the catalogue lacks or holds with another value."""
    have = catalogue.withColumnRenamed("value", "found")
    return wanted.join(have, ["dataset", "variable", "key"], "left").where(~F.col("value").eqNullSafe(F.col("found")))


def codes(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with 0-based codes of the sorted distinct values in place of a string column, the codes); missing is -1."""
    from pelagia.operators.ingest import places

    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    coded = places(values, column).select(column, (F.col("place") - 1).cast("int").alias("code"))
    joined = df.join(coded, column, "left").withColumn(column, F.coalesce("code", F.lit(-1))).select(*df.columns)
    return joined, coded.select("code", F.regexp_replace(column, " ", "_").alias("meaning"))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def content_hash(df: DataFrame) -> DataFrame:
    """One row with a hash of all rows that does not depend on their order."""
    return df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.sum("h")), 256).alias("sha256"))


def export_csv(df: DataFrame, path: str, name: str, attributes: DataFrame) -> str:
    """CSV with a "# key: value" line per attribute, then the header, then the rows; returns where it is, <name>_<hash>.csv.

    The hash is the first 8 hex digits of `content_hash`.  The lines before the rows are
    the first part and the rows the parts after it, written by many tasks; the parts in
    the order of their names are the one file.
    """
    spark = df.sparkSession
    at = f"{path.rstrip('/')}/{name}_{content_hash(df).first()['sha256'][:8]}.csv"
    notes = attributes.orderBy("key").select(F.concat(F.lit("# "), "key", F.lit(": "), "value").alias("value")).coalesce(1)
    head = spark.range(1, numPartitions=1).select(F.lit(",".join(df.columns)).alias("value"))
    body = df.select(F.to_csv(F.struct(*df.columns)).alias("value"))
    notes.union(head).union(body).write.mode("overwrite").text(at)
    return at
