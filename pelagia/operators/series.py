"""Series, frames and pairs taken from cubes and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.functions.columns import celsius, components_from, direction_from, direction_toward, speed
from pelagia.operators.aggregate import densest_cell, quantile_buckets, resample, rose
from pelagia.operators.joins import nearest_cell, nearest_values
from pelagia.operators.windows import steps_from


def point_series(cube: DataFrame, time: str, lat: str, lon: str, lat0: float, lon0: float, start, end, variables: Sequence[str] | None = None) -> DataFrame:
    """Series at the grid point nearest to a place, for a period with both ends; place and period must lie in the data."""
    low, high, a, b, c, d = cube.agg(F.min(time), F.max(time), F.min(lat), F.max(lat), F.min(lon), F.max(lon)).first()
    if low is None or not (a <= lat0 <= b and c <= lon0 <= d):
        raise ValueError(f"({lat0}, {lon0}) is outside the data")
    first, last = cube.sparkSession.range(1).select(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")).first()
    if not (low <= first <= high and low <= last <= high):
        raise ValueError(f"{start} to {end} is outside {low} to {high}")
    known = [v for v in variables or [] if v in cube.columns]
    names = known or [c for c in cube.columns if c not in (time, lat, lon)]
    rows = cube.where(F.col(time).between(F.lit(first), F.lit(last)))
    axes = cube.select(lat, lon).distinct()
    point = nearest_values(axes, {lat: lat0, lon: lon0})
    return rows.join(F.broadcast(point), [lat, lon], "left_semi").select(time, lat, lon, *names)


def current_series(cube: DataFrame, time: str, lat: str, lon: str, u: str, v: str, cell: Sequence[str], place: tuple[float, float] | None = None, unit: str = "day") -> DataFrame:
    """Daily means of both components at the densest cell, or the one nearest to a place; speed and direction are of the means."""
    if place is None:
        at = cube.join(F.broadcast(densest_cell(cube, cell, u).select(*cell)), list(cell), "left_semi")
    else:
        at = nearest_cell(cube, lat, lon, place[0], place[1], cell)
    daily = resample(at, time, unit, {"u": (u, "mean"), "v": (v, "mean")})
    return daily.withColumns({"speed": speed(F.col("u"), F.col("v")), "direction": direction_toward(F.col("u"), F.col("v"))})


def velocity_rose(cube: DataFrame, cell: Sequence[str], u: str, v: str, width: float = 1.0, classes: int = 5) -> DataFrame:
    """Rose of the mean velocity of each cell, by the direction that it comes from."""
    mean = cube.groupBy(*cell).agg(F.avg(u).alias("u"), F.avg(v).alias("v"))
    return rose(mean, direction_from(F.col("u"), F.col("v")), speed(F.col("u"), F.col("v")), [width * k for k in range(1, classes)])


def velocity_frames(cube: DataFrame, time: str, start, u: str, v: str, n: int = 6) -> DataFrame:
    return steps_from(cube, time, start, n).withColumn("speed", speed(F.col(u), F.col(v)))


def variable_frames(cube: DataFrame, time: str, start, value: str, units: str | None = None, n: int = 6) -> tuple[DataFrame, DataFrame]:
    """(frames in the asked unit, their common range); times without any value are passed over."""
    filled = cube.groupBy(time).agg(F.count(value).alias("n")).where("n > 0").select(time)
    frames = steps_from(cube.join(filled, time, "left_semi"), time, start, n)
    if units is not None:
        frames = frames.withColumn(value, celsius(F.col(value), F.col(units)))
    return frames, frames.agg(F.min(value).alias("low"), F.max(value).alias("high"), F.greatest(F.abs(F.min(value)), F.abs(F.max(value))).alias("reach"))


def vector_frames(cube: DataFrame, time: str, start, magnitude: str, direction: str, row: str, column: str, every: int, n: int = 6) -> DataFrame:
    """Components of each every-th cell along both axes."""
    u, v = components_from(F.col(magnitude), F.col(direction))
    kept = cube.where((F.col(row) % every == 0) & (F.col(column) % every == 0))
    return steps_from(kept, time, start, n).withColumns({"u": u, "v": v})


def month_starts(df: DataFrame, time: str) -> DataFrame:
    """Each month from the first to the last of the data."""
    ends = df.agg(F.date_trunc("month", F.min(time)).alias("a"), F.date_trunc("month", F.max(time)).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))


def temperature_salinity(df: DataFrame, temperature: str, salinity: str, depth: str, floor: float = 25.0) -> tuple[DataFrame, DataFrame]:
    """(pairs with a salinity of the floor or more, ranges of the three)."""
    pairs = df.where(F.col(salinity) >= floor)
    return pairs, pairs.agg(*[f(c).alias(f"{c}_{n}") for c in (temperature, salinity, depth) for n, f in (("min", F.min), ("max", F.max))])


def cell_density(df: DataFrame, cell: str, buckets: int = 10) -> DataFrame:
    return quantile_buckets(df.where(F.col(cell).isNotNull()).groupBy(cell).agg(F.count(F.lit(1)).alias("n")), "n", buckets)
