"""Gridded data as long tables: checks between files, regridding, reconciling, upserts by time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.operators.prefix import next_above
from pelagia.sources.scratch import written


def select_variables(df: DataFrame, schema: dict[str, dict]) -> DataFrame:
    """Declared variables that aren't flagged drop_var; none left is an error."""
    keep = [c for c in df.columns if c in schema and not schema[c].get("drop_var")]
    if not keep:
        raise ValueError("no variable is left")
    return df.select(*keep)


def target_grid(spark, low: float, high: float, step: float) -> DataFrame:
    """Grid values from low to high, the end included by half a step."""
    n = int((high - low) / step + 0.5) + 1
    return spark.range(n).select((F.lit(float(low)) + F.col("id") * F.lit(float(step))).alias("x"))


def regrid_linear(df: DataFrame, keys: Sequence[str], x: str, y: str, grid: DataFrame) -> DataFrame:
    """Values on a new grid of one dimension, per series, linear between the nearest known points; NULL outside."""
    series = df.select(*keys).distinct()
    wanted = series.crossJoin(grid.select(F.col("x").alias(x))).withColumn("__new", F.lit(True)).withColumn(y, F.lit(None).cast("double"))
    both = df.select(*keys, x, F.lit(False).alias("__new"), F.col(y).cast("double").alias(y)).where(F.col(y).isNotNull()).unionByName(wanted.select(*keys, x, "__new", y))
    w = Window.partitionBy(*keys).orderBy(x, "__new")
    known = F.when(~F.col("__new"), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
    below = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    out = both.withColumns({"__a": below, "__b": above}).where("__new")
    a, b = F.col("__a"), F.col("__b")
    value = F.when(a["x"] == F.col(x), a["y"]).when(b["x"] == F.col(x), b["y"]).otherwise(a["y"] + (F.col(x) - a["x"]) * (b["y"] - a["y"]) / (b["x"] - a["x"]))
    return out.select(*keys, x, value.alias(y))


def coordinate_mismatches(df: DataFrame, file: str, coordinate: str, position: str, order: str) -> DataFrame:
    """(file) of files whose coordinate, as an array in the order of `position`, differs from that of the first file (smallest `order`).

    Arrays are compared by their length and the sum of hashes of (position, value), which
    tasks add up before the shuffle: reversed, repeated and missing values all tell.
    """
    cells = df.groupBy(file, position, coordinate).agg(F.min(order).alias("at"))
    digest = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(position, coordinate).cast("decimal(38,0)")).alias("sum"))
    arrays = cells.groupBy(file).agg(digest.alias("values"), F.min("at").alias("at"))
    first = arrays.agg(F.min_by("values", F.struct("at", file)).alias("wanted"))  # one row
    return arrays.crossJoin(F.broadcast(first)).where("values <> wanted").select(file)


def overlapping_files(df: DataFrame, file: str, append: str) -> DataFrame:
    """(file) of files to leave out because their range begins at or before the end of the files kept so far.

    Files are taken by their start, of equal starts by name, and a file left out does not
    extend the kept range.  So after a kept file comes the first that begins after its
    end: its successor.  The kept files are those that the first one leads to, which are
    marked by doubling: each round marks what all marked files lead to in as many steps as
    are marked, then joins the pointers with themselves.  Rounds grow with the logarithm
    of the files kept, and no task holds all files.  Files without values never overlap.
    """
    ranges = written(df.groupBy(file).agg(F.min(append).alias("low"), F.max(append).alias("high")).where("low is not null"), "files")
    after = next_above(ranges.withColumnRenamed("low", "v"), ranges.select(file, F.col("high").alias("v")), "v", file)
    leads = written(after.where("__next is not null").select(F.col(file).alias("a"), F.col(f"__next.{file}").alias("b")), "successors")
    marked = written(ranges.agg(F.min_by(file, F.struct("low", file)).alias("f")), "kept")
    while not leads.isEmpty():
        marked = written(marked.union(marked.join(leads, F.col("f") == F.col("a")).select("b")), "kept")
        leads = written(leads.alias("x").join(leads.alias("y"), F.col("x.b") == F.col("y.a")).select("x.a", "y.b"), "successors")
    return ranges.join(marked.select(F.col("f").alias(file)), file, "left_anti").select(file)


def files_without_index(df: DataFrame, file: str, dims: Sequence[str]) -> DataFrame:
    """(file, dim) where a file has no value of a dimension."""
    counted = df.groupBy(file).agg(*[F.count(d).alias(d) for d in dims])
    return counted.unpivot([file], list(dims), "dim", "n").where("n = 0").select(file, "dim")


def size_mismatches(new: DataFrame, store: DataFrame, batch: str, dims: Sequence[str]) -> DataFrame:
    """(batch, dim, size, stored) where a batch has another number of values along a dimension than the store."""
    sizes = new.groupBy(batch).agg(*[F.countDistinct(d).alias(d) for d in dims]).unpivot([batch], list(dims), "dim", "size")
    have = store.agg(*[F.countDistinct(d).alias(d) for d in dims]).unpivot([], list(dims), "dim", "stored")
    return sizes.join(F.broadcast(have), "dim").where("size <> stored").select(batch, "dim", "size", "stored")


def reconcile_dims(df: DataFrame, dims: Sequence[str], coordinates: dict[str, DataFrame]) -> DataFrame:
    """The variable on all declared dimensions: missing ones repeat it over their values, unknown ones are an error."""
    extra = [c for c in df.columns if c in coordinates and c not in dims]
    if extra:
        raise ValueError(f"dimensions that the store lacks: {extra}")
    for d in dims:
        if d not in df.columns:
            df = df.crossJoin(coordinates[d].select(d).distinct())
    return df.select(*dims, *[c for c in df.columns if c not in dims])


def duplicated_times(df: DataFrame, time: str, file: str) -> DataFrame:
    """(time, files) of append values that more than one file wrote."""
    return df.groupBy(time).agg(F.countDistinct(file).alias("files")).where("files > 1")


def upsert_times(old: DataFrame, new: DataFrame, time: str) -> DataFrame:
    """The cube after an upsert: time slices of `new` replace those stored, others stay or are appended."""
    return old.join(new.select(time).distinct(), time, "left_anti").unionByName(new, allowMissingColumns=True)


def add_missing_variable(df: DataFrame, name: str, kind: T.DataType) -> DataFrame:
    """A declared variable that the file lacks, as typed NULLs."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def add_missing_coordinate(df: DataFrame, name: str, template: DataFrame, dims: Sequence[str]) -> DataFrame:
    """A coordinate that the file lacks, taken from a template grid by the declared dimensions; places that the template lacks are NULL."""
    return df if name in df.columns else df.join(template.select(*dims, name).distinct(), list(dims), "left")


def cast_variables(df: DataFrame, schema: dict[str, T.DataType]) -> DataFrame:
    """Variables in their declared types; others as they are."""
    return df.select(*[F.col(c).cast(schema[c]).alias(c) if c in schema else F.col(c) for c in df.columns])


def decode_times(df: DataFrame, units: dict[str, tuple[str, str]], keep_numeric: Sequence[str] = ()) -> DataFrame:
    """Numbers of (unit, since) as timestamps: unit is days, hours, minutes or seconds; variables in `keep_numeric` stay numbers."""
    seconds = {"days": 86_400, "hours": 3600, "minutes": 60, "seconds": 1}
    wanted = {c: F.timestamp_micros((F.unix_micros(F.lit(since).cast("timestamp")) + F.round(F.col(c) * seconds[unit] * 1_000_000).cast("long"))) for c, (unit, since) in units.items() if c in df.columns and c not in keep_numeric}
    return df.withColumns(wanted)


def usable(df: DataFrame, file: str, dims: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the files that pass the structural check, the refused files): a file without an index on a dimension is left out and the rest is taken again."""
    refused = files_without_index(df, file, dims).select(file).distinct()
    return df.join(refused, file, "left_anti"), refused


def combine_sorted(frames: Sequence[DataFrame], append: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """Files joined by variable name along the append dimension, each task's rows in the order of `sort_by`, or of the append dimension."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.repartitionByRange(append).sortWithinPartitions(*(sort_by or [append]))


def named_source(df: DataFrame, column: str = "filename", unknown: str = "UNKNOWN_FILENAME.nc") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(unknown)))
