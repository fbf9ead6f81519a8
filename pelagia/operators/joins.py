"""As-of, nearest and range joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pelagia.functions.columns import micros_of, seconds_of


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], time: str, values: Sequence[str], tolerance_s: int, bucket_s: int | None = None) -> DataFrame:
    """Each left row with the right row of the same key that is nearest in time within the tolerance; others are dropped.

    Of two equally near the earlier is taken.  Both sides are cut into time buckets, right
    rows also going to the two neighbours, so a window holds one key in one bucket however
    long its series is.
    """
    size = max(bucket_s or 86_400, tolerance_s)
    bucket = F.floor(seconds_of(F.col(time)) / size)
    packed = F.struct(F.col(time).alias("t"), *[F.col(v).alias(v) for v in values])
    a = left.withColumns({"__b": bucket, "__right": F.lit(None).cast(right.select(packed.alias("x")).schema["x"].dataType), "__side": F.lit(1)})
    near = F.explode(F.array(bucket - 1, bucket, bucket + 1))
    b = right.select(*by, time, near.alias("__b"), packed.alias("__right")).withColumn("__side", F.lit(0))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*by, "__b").orderBy(time, "__side")
    out = both.withColumns(
        {
            "__p": F.last("__right", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "__n": F.first("__right", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
        }
    ).where("__side = 1")
    gap = lambda c: F.abs(micros_of(F.col(time)) - micros_of(F.col(c)["t"]))
    pick = F.when(F.col("__n").isNull() | (gap("__p") <= gap("__n")), F.col("__p")).otherwise(F.col("__n"))
    out = out.withColumn("__m", F.when(F.col("__p").isNull(), F.col("__n")).otherwise(pick))
    out = out.where(gap("__m") <= tolerance_s * 1_000_000)
    return out.select(*left.columns, F.col("__m")["t"].alias(f"{time}_right"), *[F.col("__m")[v].alias(f"{v}_right") for v in values])


def nearest_values(df: DataFrame, axes: dict[str, float]) -> DataFrame:
    """Rows at the axis values nearest to the given ones, each axis by itself; of two equally near the smaller."""
    picked = df.agg(*[F.min_by(a, F.struct(F.abs(F.col(a) - x), F.col(a))).alias(f"__{a}") for a, x in axes.items()])
    out = df.crossJoin(F.broadcast(picked))
    for a in axes:
        out = out.where(F.col(a) == F.col(f"__{a}"))
    return out.select(*df.columns)


def nearest_cell(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float, cell: Sequence[str]) -> DataFrame:
    """Rows of the cell nearest on a curvilinear grid, by squared degree distance."""
    d = (F.col(lat) - lat0) * (F.col(lat) - lat0) + (F.col(lon) - lon0) * (F.col(lon) - lon0)
    picked = df.agg(F.min_by(F.struct(*cell), F.struct(d, *cell)).alias("__c")).select(*[F.col("__c")[c].alias(c) for c in cell])
    return df.join(F.broadcast(picked), list(cell))


def rectangles_touching(cells: DataFrame, boxes: DataFrame, delta: float, width: float = 10.0) -> DataFrame:
    """(box columns, cell columns) of squares of 2 * delta that touch boxes (box_id, lat_min, lat_max, lon_min, lon_max).

    Both sides are dealt to longitude strips and joined by strip, so no row meets all rows
    of the other side; a pair is taken from the first strip that both lie in.
    """
    strips = lambda a, b: F.sequence(F.floor(a / width), F.floor(b / width))
    left = cells.withColumn("__s", F.explode(strips(F.col("cell_lon") - delta, F.col("cell_lon") + delta)))
    right = boxes.withColumn("__s", F.explode(strips(F.col("lon_min"), F.col("lon_max"))))
    out = left.join(right, "__s").where(
        (F.col("cell_lat") - delta <= F.col("lat_max")) & (F.col("cell_lat") + delta >= F.col("lat_min")) & (F.col("cell_lon") - delta <= F.col("lon_max")) & (F.col("cell_lon") + delta >= F.col("lon_min"))
    )
    first = F.greatest(F.floor((F.col("cell_lon") - delta) / width), F.floor(F.col("lon_min") / width))
    return out.where(F.col("__s") == first).drop("__s")


def nearest_site_rows(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float) -> DataFrame:
    """All rows at the site nearest on the degree plane."""
    d = (F.col(lat) - lat0) * (F.col(lat) - lat0) + (F.col(lon) - lon0) * (F.col(lon) - lon0)
    site = df.agg(F.min_by(F.struct(lat, lon), F.struct(d, F.col(lat), F.col(lon))).alias("__c")).select(F.col("__c")[lat].alias(lat), F.col("__c")[lon].alias(lon))
    return df.join(F.broadcast(site), [lat, lon])


def aligned(series: dict[str, DataFrame], on: str) -> DataFrame:
    """Outer join of several series by time, then only complete rows."""
    out = None
    for name, df in series.items():
        part = df.select(on, F.col("value").alias(name))
        out = part if out is None else out.join(part, on, "full_outer")
    return out.dropna()


def months_with_default(df: DataFrame, month: str, value: str, default: float | None) -> DataFrame:
    """Months 1 to 12 with a value; missing ones get the default or, without one, the median of the others."""
    spine = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(month))
    out = spine.join(df.select(month, value), month, "left")
    if default is not None:
        return out.withColumn(value, F.coalesce(value, F.lit(default)))
    return out.crossJoin(F.broadcast(df.agg(F.median(value).alias("__d")))).withColumn(value, F.coalesce(value, "__d")).drop("__d")
