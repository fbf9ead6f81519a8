"""Running totals and runs over more rows than a task should order, by ranges whose totals are added up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.sources.scratch import scratch_path


def ranged(df: DataFrame, order: Sequence[str], name: str = "ranges") -> DataFrame:
    """The rows dealt to ranges of an order and written, each with its range's number `__part`; numbers follow the order."""
    path = scratch_path(df.sparkSession, name)
    df.repartitionByRange(*[F.col(c) for c in order]).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running(df: DataFrame, order: Sequence[str], value: Column, by: Sequence[str] = ()) -> DataFrame:
    """The rows with `__sum`, the total of `value` (NULL counts as 0) up to and with each row, and `__last`, whether no row of its group follows.

    Rows of equal order are taken one after the other.  Two levels: a task adds up its
    range of (by, order); the totals of ranges, a row for each range and group in it, are
    added up in turn.  So neither a group nor the whole table is ordered in one task.
    """
    rows = ranged(df.withColumn("__value", F.coalesce(value, F.lit(0))), [*by, *order])
    w = Window.partitionBy("__part", *by).orderBy(*order)
    local = rows.withColumns({"__sum": F.sum("__value").over(w.rowsBetween(Window.unboundedPreceding, 0)), "__last": F.lead(F.lit(1)).over(w).isNull()})
    totals = rows.groupBy("__part", *by).agg(F.sum("__value").alias("__total"))
    across = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__part")  # rows are ranges
    before = totals.select("__part", *by, (F.sum("__total").over(across) - F.col("__total")).alias("__before"), F.lead("__part").over(across).isNull().alias("__final"))
    before = before.select(F.col("__part").alias("__p"), *[F.col(b).alias(f"__{b}") for b in by], "__before", "__final")
    same = F.col("__part") == F.col("__p")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__{b}"))
    out = local.join(before, same).withColumns({"__sum": F.col("__before") + F.col("__sum"), "__last": F.col("__last") & F.col("__final")})
    return out.select(*df.columns, "__sum", "__last")


def with_previous(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with `__before`, the row before each in its group as a struct, NULL for the first.

    Within ranges of (by, order) it is the row beside; the first row of a group in a range
    takes the group's last row of the ranges before, of which there is one for each range
    and group.  So a long series is never ordered in one task.
    """
    row = F.struct(*df.columns)
    rows = ranged(df, [*by, *order], "series")
    w = Window.partitionBy("__part", *by).orderBy(*order)
    here = rows.withColumn("__before", F.lag(row).over(w))
    lasts = rows.groupBy("__part", *by).agg(F.max_by(row, F.struct(*order)).alias("__row"))
    across = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__part")  # rows are ranges
    carried = lasts.select(F.col("__part").alias("__p"), *[F.col(b).alias(f"__{b}") for b in by], F.lag("__row").over(across).alias("__carried")).where("__carried is not null")
    same = F.col("__part") == F.col("__p")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__{b}"))
    return here.join(carried, same, "left").select(*df.columns, F.coalesce("__before", "__carried").alias("__before"))


def next_above(points: DataFrame, queries: DataFrame, value: str, tie: str) -> DataFrame:
    """`queries` with `__next`, the row of `points` (as a struct of value and tie) with the least value above the query's, the smallest tie first; NULL if none is."""
    both = points.select(F.col(value).alias("__v"), F.lit(0).alias("__kind"), F.col(tie).alias("__tie"), F.lit(None).cast(queries.select(F.struct(*queries.columns).alias("q")).schema["q"].dataType).alias("__q"))
    asked = queries.select(F.col(value).alias("__v"), F.lit(1).alias("__kind"), F.lit(None).cast(points.schema[tie].dataType).alias("__tie"), F.struct(*queries.columns).alias("__q"))
    rows = ranged(both.union(asked).where("__v is not null"), ["__v"], "points")
    point = F.when(F.col("__kind") == 0, F.struct(F.col("__v").alias(value), F.col("__tie").alias(tie)))
    # From above: of the points met before a query, the last is the least above it; at equal values queries come first.
    w = Window.partitionBy("__part").orderBy(F.desc("__v"), F.desc("__kind"), F.desc("__tie")).rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumn("__here", F.last(point, ignorenulls=True).over(w)).where("__kind = 1")
    firsts = rows.groupBy("__part").agg(F.min(point).alias("__first"))
    above = Window.orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)  # rows are ranges
    later = firsts.select(F.col("__part").alias("__p"), F.last("__first", ignorenulls=True).over(above).alias("__later"))
    found = here.join(later, F.col("__part") == F.col("__p"))
    return found.select("__q.*", F.coalesce("__here", "__later").alias("__next"))
