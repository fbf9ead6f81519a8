"""Row and column transforms of tabular ingest, composed with DataFrame.transform."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions.columns import EPOCH_1900, cell_centre, period_key, seconds_of, square_wkb


class EmptyResult(ValueError):
    """No rows are left."""


def cast_to_schema(df: DataFrame, schema: T.StructType, raise_error: bool = False) -> tuple[DataFrame, list[str]]:
    """Casts each column that loses no value; the others keep their type and are named, or raise with `raise_error`.

    One aggregate counts the losses of all columns.
    """
    wanted = {f.name: f.dataType for f in schema if f.name in df.columns}
    lost = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in wanted.items()]).first() if wanted else {}
    failed = [c for c in wanted if lost[c]]
    if failed and raise_error:
        raise ValueError(f"columns that can't be cast: {failed}")
    return df.select(*[F.col(c).try_cast(wanted[c]).alias(c) if c in wanted and c not in failed else F.col(c) for c in df.columns]), failed


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns that the file lacks, as typed NULLs."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns})


def unknown_columns(df: DataFrame, schema: T.StructType) -> list[tuple[str, str]]:
    """(name, type) of columns that the schema does not declare."""
    known = set(schema.fieldNames())
    return [(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in known]


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def attribute_columns(df: DataFrame, attributes: DataFrame, columns: dict[str, str], fills: dict[str, object] | None = None, on: str = "filename") -> DataFrame:
    """Per-file attributes as columns: `columns` maps a new column to an attribute; missing ones get their fill or NULL."""
    fills = fills or {}
    picked = attributes.select(on, *[F.col(a).alias(f"__{c}") for c, a in columns.items()])
    out = df.join(picked, on, "left")
    return out.select(*df.columns, *[F.coalesce(F.col(f"__{c}"), F.lit(fills[c]).cast(attributes.schema[a].dataType)).alias(c) if c in fills else F.col(f"__{c}").alias(c) for c, a in columns.items()])


PATH_FUNCTIONS: dict[str, Callable[[Column], dict[str, Column]]] = {}
COLUMN_FUNCTIONS: dict[str, Callable[..., Column]] = {}


def register_path_function(name: str, function: Callable[[Column], dict[str, Column]]) -> None:
    """A named function of the path column that gives new columns; settings name it instead of holding code."""
    PATH_FUNCTIONS[name] = function


def register_column_function(name: str, function: Callable[..., Column]) -> None:
    COLUMN_FUNCTIONS[name] = function


def from_path(df: DataFrame, name: str, path: str = "path") -> DataFrame:
    return df.withColumns(PATH_FUNCTIONS[name](F.col(path)))


def from_columns(df: DataFrame, name: str, target: str, *columns: str) -> DataFrame:
    return df.withColumn(target, COLUMN_FUNCTIONS[name](*[F.col(c) for c in columns]))


def add_period_key(df: DataFrame, time: str, period: str, key: str = "timestamp") -> DataFrame:
    """The period key; a NULL time fails the row's task, as a file with such times is refused."""
    t = F.when(F.col(time).isNull(), F.raise_error(F.lit(f"{time} is missing")).cast("timestamp")).otherwise(F.col(time))
    return df.withColumn(key, period_key(t, period))


def drop_future(df: DataFrame, time: str, now: Column | None = None) -> DataFrame:
    """Without rows later than the end of next year."""
    return df.where(F.year(time) <= F.year(now if now is not None else F.current_date()) + 1)


def drop_before_1900(df: DataFrame, key: str = "timestamp") -> DataFrame:
    return df.where(F.col(key) >= EPOCH_1900)


def drop_bad_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon", lat_range=(-90.0, 90.0), lon_range=(-180.0, 180.0)) -> DataFrame:
    """Without rows whose coordinates are missing or outside the ranges, both ends inclusive."""
    return df.where(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def add_cell_key(df: DataFrame, lat: str = "lat", lon: str = "lon", delta: float = 5.0, wkb: bool = True) -> DataFrame:
    """cell_lat, cell_lon and, with `wkb`, the polygon key of the square 2 * delta wide around them."""
    out = df.withColumns({"cell_lat": cell_centre(F.col(lat), delta), "cell_lon": cell_centre(F.col(lon), delta)})
    return out.withColumn("polygon", square_wkb(F.col("cell_lon"), F.col("cell_lat"), float(delta))) if wkb else out


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    if df.isEmpty():
        raise EmptyResult(f"the {what} has no rows")
    return df


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count(k).alias(k) for k in keys]).first()
    empty = [k for k in keys if not counts[k]]
    if empty:
        raise ValueError(f"partition keys without any value: {empty}")
    return df


def julian_to_timestamp(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """The fields of a Julian-calendar time taken over as they are, to the second."""
    return F.make_timestamp(year, month, day, hour, minute, F.floor(second).cast("decimal(16,6)"))


def bad_row_counts(df: DataFrame, time: str, lat: str, lon: str, by: str) -> DataFrame:
    """Per file: rows, and how many would go for a missing or out-of-range time or coordinate."""
    key = seconds_of(F.col(time))
    bad_time = F.col(time).isNull() | (key < EPOCH_1900)
    bad_place = ~F.coalesce(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180), F.lit(False))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad_time).alias("bad_time"), F.count_if(bad_place).alias("bad_place"))


def attribute_differences(found: DataFrame, expected: DataFrame, names: Sequence[str] = ("units", "standard_name", "reference_datum")) -> DataFrame:
    """(filename, variable, key, found, expected) where a file's attribute differs from the declared one."""
    wanted = expected.where(F.col("key").isin(*names)).select("variable", "key", F.col("value").alias("expected"))
    return found.join(wanted, ["variable", "key"]).where(F.col("value") != F.col("expected")).select("filename", "variable", "key", F.col("value").alias("found"), "expected")


def dimensions_without_variable(dimensions: DataFrame, variables: DataFrame) -> DataFrame:
    """(filename, name) of declared dimensions that no variable carries."""
    return dimensions.join(variables, ["filename", "name"], "left_anti")


def run_summary(events: DataFrame) -> DataFrame:
    """(category, events, files, retried_ok, failed) of a run's events (batch, file, category, retry, outcome)."""
    ok = F.col("outcome") == "success"
    return events.groupBy("category").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("file").alias("files"), F.count_if(ok & (F.col("retry") > 0)).alias("retried_ok"), F.count_if(~ok).alias("failed")
    )


def batches(files: DataFrame, size: int, order: str = "filename") -> DataFrame:
    """The file list with 1-based batch numbers of `size` files each, the last one short.

    Places come from each range partition's count, so no task takes the whole list.
    """
    placed = places(files, order)
    return placed.withColumn("batch", F.ceil(F.col("place") / size).cast("long")).drop("place")


def places(files: DataFrame, order: str) -> DataFrame:
    """The rows with their 1-based place in an order, numbered by ranges."""
    from pyspark.sql import Window

    parts = files.repartitionByRange(F.col(order)).withColumn("part", F.spark_partition_id())
    local = parts.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(order)))
    counts = local.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.alias("a").join(counts.alias("b"), F.col("b.part") < F.col("a.part"), "left").groupBy("a.part").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return local.join(before, "part").withColumn("place", F.col("before") + F.col("place")).drop("part", "before")


def combine(frames: Sequence[DataFrame], order: Sequence[str] = ()) -> DataFrame:
    """Files by column name; missing columns are NULL."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.sortWithinPartitions(*order) if order else out
