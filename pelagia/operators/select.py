"""Pruned selection in space and time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.columns import period_key

#: Names by which a coordinate is known in tables and in cubes, in order of preference.
CANDIDATES = {
    "table": {
        "TIME": ["TIME", "JULD", "juld_location", "detection_timestamp", "eventDate", "end_date", "s_date", "d_date", "de_date", "qc_start_date", "date"],
        "LATITUDE": ["LATITUDE", "latitude", "LAT", "lat"],
        "LONGITUDE": ["LONGITUDE", "longitude", "LON", "lon"],
        "DEPTH": ["DEPTH", "depth", "PRES", "pres", "PRES_ADJUSTED", "pres_adjusted", "NOMINAL_DEPTH", "nominal_depth"],
    },
    "cube": {
        "TIME": ["TIME", "time", "datetime", "date", "Date", "DateTime"],
        "LATITUDE": ["latitude", "lat", "LATITUDE", "LAT"],
        "LONGITUDE": ["longitude", "lon", "LONGITUDE", "LON"],
        "DEPTH": ["depth", "nominal_depth", "pres", "pres_adjusted", "DEPTH", "PRES", "PRES_ADJUSTED", "NOMINAL_DEPTH"],
    },
}
#: Looked for after these: names that only this library's tables use.
OWN_NAMES = {"TIME": ["time", "timestamp", "ts"], "LATITUDE": ["decimalLatitude"], "LONGITUDE": ["decimalLongitude"], "DEPTH": ["pressure"]}


class DateOutOfRange(ValueError):
    """The asked period lies outside the data."""


class BoxOutside(ValueError):
    """No cell of the data touches the asked box."""


def coordinate(df: DataFrame, role: str, layout: str = "table") -> str:
    """The column of a role, by the names known for the layout (table or cube); the first that is there."""
    found = next((c for c in [*CANDIDATES[layout][role], *OWN_NAMES[role]] if c in df.columns), None)
    if found is None:
        raise KeyError(f"no column for {role}")
    return found


def all_of(conditions: Sequence[Column | None]) -> Column:
    return reduce(lambda a, b: a & b, [c for c in conditions if c is not None], F.lit(True))


def time_filter(time: str, start: datetime | str, end: datetime | str | None = None, key: str | None = None, period: str = "M") -> Column:
    """Inclusive time range and, with a period key, the range of keys that prunes partitions.

    A row at the very start of the last period is kept.
    """
    a = F.lit(start).cast("timestamp")
    b = F.lit(end).cast("timestamp") if end is not None else F.current_timestamp()
    own = F.col(time).between(a, b)
    return own if key is None else own & F.col(key).cast("long").between(period_key(a, period), period_key(b, period))


def box_filter(lat: str, lon: str, box: tuple[float, float, float, float]) -> Column:
    """Rows within (lat_min, lat_max, lon_min, lon_max), ends included."""
    return F.col(lat).between(box[0], box[1]) & F.col(lon).between(box[2], box[3])


def cells_touching(cells: DataFrame, box: tuple[float, float, float, float], delta: float) -> DataFrame:
    """Of (cell_lat, cell_lon, ...) rows, those whose square of 2 * delta touches the box."""
    return cells.where(
        F.col("cell_lat").cast("double").between(box[0] - delta, box[1] + delta) & F.col("cell_lon").cast("double").between(box[2] - delta, box[3] + delta)
    )


def cell_filter(cell_lat: str, cell_lon: str, box: tuple[float, float, float, float], delta: float) -> Column:
    """The same test on partition keys: a range of centres, which prunes."""
    return F.col(cell_lat).cast("double").between(box[0] - delta, box[1] + delta) & F.col(cell_lon).cast("double").between(box[2] - delta, box[3] + delta)


def scalar_filter(df: DataFrame, values: dict[str, object]) -> Column:
    """Equality on columns, each value cast to its column's type."""
    return all_of([F.col(c) == F.lit(v).cast(df.schema[c].dataType) for c, v in values.items()])


def get_data(
    df: DataFrame, start=None, end=None, box=None, scalars: dict[str, object] | None = None, columns: Sequence[str] | None = None, time: str | None = None,
    lat: str | None = None, lon: str | None = None, key: str | None = None, period: str = "M", cells: tuple[str, str, float] | None = None, order: bool = True,
    known: DataFrame | None = None, checked: bool = False,
) -> DataFrame:
    """Rows of a tabular dataset in a period, a box and with given values, sorted by time.

    Without a start there is no time condition, whatever the end.  `key` names the period
    key and `cells` the cell keys and their delta, which prune partitions.  `known` is the
    table of the dataset's cell keys: the cells that touch the box are joined, so that
    Spark prunes partitions by them at run time; there are no more of them than cells on
    the globe.  With `checked` a period outside the data raises DateOutOfRange, which reads
    the first and last period only, and a box that no known cell touches BoxOutside.
    """
    time = time or coordinate(df, "TIME")
    if checked and start is not None:
        check_period(df, time, start, end, key)
    conditions = [time_filter(time, start, end, key, period) if start is not None else None]
    if box is not None:
        lat, lon = lat or coordinate(df, "LATITUDE"), lon or coordinate(df, "LONGITUDE")
        conditions.append(box_filter(lat, lon, box))
        if cells and known is not None:
            if checked:
                check_box(known, box, cells[2])
            df = df.join(F.broadcast(cells_touching(known, box, cells[2]).select(cells[0], cells[1])), [cells[0], cells[1]], "left_semi").select(*df.columns)
        elif cells:
            conditions.append(cell_filter(cells[0], cells[1], box, cells[2]))
    conditions.append(scalar_filter(df, scalars) if scalars else None)
    out = df.where(all_of(conditions))
    # The sort comes before the projection, so time need not be asked for.
    out = out.orderBy(time) if order else out
    return out.select(*columns) if columns else out


def check_period(df: DataFrame, time: str, start, end=None, key: str | None = None) -> None:
    """Raises DateOutOfRange if the period ends before the data or begins after it; with a period key only its first and last value are read."""
    if key is not None:
        ends = df.agg(F.min(F.col(key).cast("long")).alias("a"), F.max(F.col(key).cast("long")).alias("b")).first()
        df = df.where(F.col(key).cast("long").isin(ends["a"], ends["b"]))
    low, high = df.agg(F.min(time).cast("timestamp"), F.max(time).cast("timestamp")).first()
    a, b = df.sparkSession.range(1).select(F.lit(start).cast("timestamp"), F.coalesce(F.lit(end).cast("timestamp"), F.current_timestamp())).first()
    if low is None or b < low or a > high:
        raise DateOutOfRange(f"{start} to {end} is outside {low} to {high}")


def check_box(cells: DataFrame, box, delta: float) -> None:
    """Raises BoxOutside if no cell touches the box."""
    if cells_touching(cells, box, delta).isEmpty():
        raise BoxOutside(f"no cell touches {box}")


def get_cube(df: DataFrame, time: str, lat: str, lon: str, start=None, end=None, lat_min=None, lat_max=None, lon_min=None, lon_max=None, scalars: dict[str, str] | None = None, mask: Sequence[str] | None = None) -> DataFrame:
    """Cells of a cube; each bound is optional.  With `mask` the cells stay and these variables are NULL outside the box.

    Strings are compared trimmed on both sides; an unknown scalar is passed over.
    """
    inside = all_of(
        [F.col(c) >= v if low else F.col(c) <= v for c, v, low in ((lat, lat_min, True), (lat, lat_max, False), (lon, lon_min, True), (lon, lon_max, False)) if v is not None]
    )
    when = all_of([F.col(time) >= F.lit(start).cast("timestamp") if start is not None else None, F.col(time) <= F.lit(end).cast("timestamp") if end is not None else None])
    same = all_of([F.trim(F.col(c).cast("string")) == F.trim(F.lit(str(v))) for c, v in (scalars or {}).items() if c in df.columns])
    out = df.where(when & same)
    if mask is None:
        return out.where(inside)
    return out.select(*[F.when(inside, F.col(c)).alias(c) if c in mask else F.col(c) for c in df.columns])


def with_good_flags(df: DataFrame, flag: str, good: Sequence[int], values: Sequence[str] | None = None) -> DataFrame:
    """Rows whose flag is good, or with `values` all rows with these columns NULL where it isn't."""
    ok = F.col(flag).isin(*good)
    if values is None:
        return df.where(ok)
    return df.select(*[F.when(ok, F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def null_fractions(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_null") for c in columns], F.count(F.lit(1)).alias("rows"))
