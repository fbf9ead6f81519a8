"""Array, ragged and packed records to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.operators.prefix import running


def explode_levels(df: DataFrame, arrays: Sequence[str], position: str = "level") -> DataFrame:
    """One row per element of the parallel arrays; the other columns repeat."""
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias(position, "__x")).select(*rest, position, *[F.col(f"__x.{a}").alias(a) for a in arrays])


def flatten_grid(df: DataFrame, dims: dict[str, str], value: str) -> DataFrame:
    """Cross product of in-file dimensions: `dims` maps a row column to the array of its coordinate; value is nested in that order."""
    names = list(dims)
    rest = [c for c in df.columns if c not in {*dims.values(), value}]
    out = df.withColumn("__v", F.col(value))
    for name in names:
        held = [c for c in out.columns if c != "__v"]
        out = out.select(*held, F.posexplode("__v").alias(f"__{name}", "__v"))
    return out.select(*rest, *[F.get(dims[n], F.col(f"__{n}")).alias(n) for n in names], F.col("__v").alias(value))


#: Positions of a bucket in which ranges and positions meet.
BUCKET = 65_536


def expand_ragged(profiles: DataFrame, observations: DataFrame, size: str = "row_size", profile: str = "profile", position: str = "obs", by: str | None = None) -> DataFrame:
    """Observations with their profile's columns: profile k holds the next row_size observations, counted from 0 in each `by`.

    Row sizes are added up by ranges (`running`), and ranges of positions meet positions by
    buckets: a profile comes once into each bucket that it reaches, before its first
    position there, and is carried on to the positions after it.  No task orders all
    profiles and none are repeated for each of their positions.
    """
    keys = [by] if by else []
    ends = running(profiles, [profile], F.col(size), keys).where(F.col(size) > 0)
    head = F.struct(*[F.col(c) for c in profiles.columns])
    first, last = F.floor((F.col("__sum") - F.col(size)) / BUCKET), F.floor((F.col("__sum") - 1) / BUCKET)
    ranges = ends.withColumn("__bucket", F.explode(F.sequence(first, last))).select(
        *keys, "__bucket", F.greatest(F.col("__sum") - F.col(size), F.col("__bucket") * BUCKET).cast("long").alias("__at"), F.lit(0).alias("__kind"), F.struct(head.alias("head"), F.col("__sum").alias("end")).alias("__p"), F.lit(None).cast(observations.select(F.struct(*observations.columns).alias("o")).schema["o"].dataType).alias("__o")
    )
    rows = observations.where(F.col(position) >= 0).select(
        *keys, F.floor(F.col(position) / BUCKET).alias("__bucket"), F.col(position).cast("long").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(ranges.schema["__p"].dataType).alias("__p"), F.struct(*observations.columns).alias("__o")
    )
    w = Window.partitionBy(*keys, "__bucket").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    met = ranges.union(rows).withColumn("__p", F.last("__p", ignorenulls=True).over(w)).where((F.col("__kind") == 1) & (F.col("__at") < F.col("__p.end")))
    mine = [F.col(f"__p.head.{c}").alias(c) for c in profiles.columns if c not in keys]
    return met.select(*keys, F.col(f"__o.{position}").alias(position), *mine, *[F.col(f"__o.{c}").alias(c) for c in observations.columns if c not in {*keys, position}])


def repair_sizes(profiles: DataFrame, total: str, size: str = "row_size", profile: str = "profile", by: str | None = None) -> DataFrame:
    """Row sizes made consistent: negative and missing ones are 0, running sums stop at the number of observations, the last profile takes the rest.

    `total` is the same for all profiles of a file (`by`, or the whole table).
    """
    own = F.greatest(F.col(size), F.lit(0))
    out = running(profiles, [profile], own, [by] if by else [])
    run, before = F.least(F.col("__sum"), F.col(total)), F.least(F.col("__sum") - F.coalesce(own, F.lit(0)), F.col(total))
    return out.withColumn(size, F.when(F.col("__last"), F.col(total) - before).otherwise(run - before)).drop("__sum", "__last")


def packed_columns(df: DataFrame) -> list[str]:
    """String columns whose first value with a comma is a list of numbers."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return []
    numeric = lambda c: F.forall(F.filter(F.split(c, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("double").isNotNull())
    first = df.agg(*[F.first(F.when(F.col(c).contains(","), numeric(F.col(c))), ignorenulls=True).alias(c) for c in names]).first()
    return [c for c in names if first[c]]


def explode_packed(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """One row per number of packed strings; blanks are dropped, a missing cell is filled to the others' length.

    Rows whose columns differ in length reject their file (`by`), or the whole table.
    """
    parsed = df.withColumns({c: F.transform(F.filter(F.split(c, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("double")) for c in columns})
    sizes = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.size(c)) for c in columns]))
    parsed = parsed.withColumn("__n", F.array_max(sizes)).withColumn("__ok", F.coalesce(F.array_max(sizes) == F.array_min(sizes), F.lit(True)))
    scope = Window.partitionBy(by) if by else None
    if scope is not None:
        parsed = parsed.withColumn("__ok", F.min("__ok").over(scope)).where("__ok")
    elif not parsed.where(~F.col("__ok")).isEmpty():
        raise ValueError("packed columns differ in length")
    filled = parsed.withColumns({c: F.coalesce(F.col(c), F.array_repeat(F.lit(None).cast("double"), F.coalesce("__n", F.lit(1)))) for c in columns}).drop("__n", "__ok")
    rest = [c for c in df.columns if c not in columns]
    return filled.select(*rest, F.posexplode_outer(F.arrays_zip(*columns)).alias("position", "__x")).select(*rest, "position", *[F.col(f"__x.{c}").alias(c) for c in columns])


def numbers_from_strings(df: DataFrame, schema: T.StructType) -> DataFrame:
    """String columns that are declared numeric become so, but only if no value is lost."""
    kinds = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.NumericType)}
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name in kinds]
    if not names:
        return df
    text = lambda c: F.when(F.trim(c) != "", F.trim(c))
    lost = df.agg(*[F.count_if(text(c).isNotNull() & text(c).try_cast(kinds[c]).isNull()).alias(c) for c in names]).first()
    return df.withColumns({c: text(c).try_cast(kinds[c]) for c in names if not lost[c]})


def unpivot_numbered(df: DataFrame, groups: dict[str, str], n: int, position: str = "point") -> DataFrame:
    """Numbered columns t1..tn, d1..dn to rows; rows where all are missing go."""
    rest = [c for c in df.columns if c not in {f"{p}{k}" for p in groups.values() for k in range(1, n + 1)}]
    points = F.array(*[F.struct(F.lit(k).alias(position), *[F.col(f"{p}{k}").alias(name) for name, p in groups.items()]) for k in range(1, n + 1)])
    out = df.select(*rest, F.explode(points).alias("__x")).select(*rest, "__x.*")
    return out.dropna(how="any", subset=list(groups))


def join_instrument(observations: DataFrame, instruments: DataFrame, on: str = "instrument_index") -> DataFrame:
    """Observations with their instrument's columns; no other column may be in both."""
    both = (set(observations.columns) & set(instruments.columns)) - {on}
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    return observations.join(instruments, on, "left")
