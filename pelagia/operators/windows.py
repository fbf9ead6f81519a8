"""Ordered statistics along time."""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pelagia.functions.columns import KM_PER_DEGREE, micros_of, seconds_of
from pelagia.operators.aggregate import exact_quantiles
from pelagia.operators.prefix import with_previous


#: A time bucket is so many windows long; the halo that two buckets share is one window.
WINDOWS_PER_BUCKET = 8


class RunningMedian:
    """The median of a changing multiset: two heaps whose removed entries go when they come to the top."""

    def __init__(self):
        self.low: list[tuple[float, int]] = []  # the smaller half, largest first, negated
        self.high: list[tuple[float, int]] = []
        self.where: dict[int, bool] = {}  # entry: whether it is in the smaller half
        self.sizes = [0, 0]  # live entries of the larger half, of the smaller one

    def _clean(self) -> None:
        for heap, side in ((self.low, True), (self.high, False)):
            while heap and self.where.get(heap[0][1]) is not side:
                heapq.heappop(heap)

    def _move(self, small: bool) -> None:
        """The top of one half goes to the other."""
        source, target = (self.low, self.high) if small else (self.high, self.low)
        value, entry = heapq.heappop(source)
        heapq.heappush(target, (-value, entry))
        self.where[entry] = not small
        self.sizes[small] -= 1
        self.sizes[not small] += 1
        self._clean()

    def _balance(self) -> None:
        self._clean()
        while self.sizes[1] > self.sizes[0] + 1:
            self._move(True)
        while self.sizes[0] > self.sizes[1]:
            self._move(False)

    def add(self, entry: int, value: float) -> None:
        small = not self.low or value <= -self.low[0][0]
        heapq.heappush(self.low if small else self.high, (-value if small else value, entry))
        self.where[entry] = small
        self.sizes[small] += 1
        self._balance()

    def remove(self, entry: int) -> None:
        self.sizes[self.where.pop(entry)] -= 1
        self._balance()

    def median(self) -> float:
        return -self.low[0][0] if self.sizes[1] > self.sizes[0] else (self.high[0][0] - self.low[0][0]) / 2


def _medians(batches, keys: int, half: int, least: int):
    """Arrow batches sorted by (keys, bucket, second) with the medians of their own rows; keeps the rows of a window only.

    Columns: keys, bucket, second, own, value, then the rows of the table.
    """
    name, held, window, kept = None, RunningMedian(), deque(), deque()  # window: (second, entry); kept: [batch, own rows, medians, waiting]
    waiting, entry = deque(), 0  # (second, its batch in kept)

    def settle(until: int | None) -> None:
        while waiting and (until is None or waiting[0][0] + half < until):
            second, mine = waiting.popleft()
            while window and window[0][0] <= second - half:
                held.remove(window.popleft()[1])
            mine[2].append(held.median() if len(window) >= max(1, least) else None)

    def ready():
        while kept and len(kept[0][1]) == len(kept[0][2]):
            batch, own, medians = kept.popleft()
            rows = batch.select(list(range(keys + 4, batch.num_columns))).take(pa.array(own, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(medians, pa.float64())], names=[*rows.schema.names, "median"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[: keys + 4]]
        mine = [batch, [], []]
        kept.append(mine)
        for row, (*group, second, own, value) in enumerate(zip(*columns)):
            if group != name:
                settle(None)
                name, held, window = group, RunningMedian(), deque()
            settle(second)
            if value is not None:
                held.add(entry, value)
                window.append((second, entry))
                entry += 1
            if own:
                mine[1].append(row)
                waiting.append((second, mine))
        yield from ready()
    settle(None)
    yield from ready()


def rolling_median(df: DataFrame, by: Sequence[str], time: str, value: str, width_s: int, least: int = 1) -> DataFrame:
    """Centred rolling median over (t - width/2, t + width/2], exact, in column `median`.

    Rows are dealt to time buckets, and to those beside theirs whose windows they reach; a
    task reads a bucket in the order of time and keeps the values of one window in two
    heaps, so a row costs the logarithm of the window's rows.  Missing and NaN values are
    in no window; fewer than `least` values and a missing time give NULL.
    """
    half, long = width_s // 2, max(1, WINDOWS_PER_BUCKET * width_s)
    second = seconds_of(F.col(time)).cast("long")
    bucket = lambda s: F.floor(s / long)
    x = F.col(value).cast("double")
    timed = df.where(F.col(time).isNotNull())
    dealt = timed.withColumns({"__s": second, "__x": F.when(~F.isnan(x), x)})
    dealt = dealt.withColumn("__b", F.explode(F.array_distinct(F.array(bucket(F.col("__s") - half), bucket(F.col("__s")), bucket(F.col("__s") + half)))))
    kept = dealt.where((F.col("__b") == bucket(F.col("__s"))) | F.col("__x").isNotNull())
    keys = [F.col(b).alias(f"__k{i}") for i, b in enumerate(by)]
    rows = kept.select(*keys, "__b", "__s", (F.col("__b") == bucket(F.col("__s"))).alias("__own"), "__x", *[F.col(f"`{c}`") for c in df.columns])
    names = [f"__k{i}" for i in range(len(by))]
    sorted_rows = rows.repartition(*names, "__b").sortWithinPartitions(*names, "__b", "__s")
    schema = T.StructType([*df.schema.fields, T.StructField("median", T.DoubleType())])
    n = len(by)
    out = sorted_rows.mapInArrow(lambda batches: _medians(batches, n, half, least), schema)
    return out.unionByName(df.where(F.col(time).isNull()).withColumn("median", F.lit(None).cast("double")))


def drift(df: DataFrame, by: str, time: str, lat: str, lon: str) -> DataFrame:
    """Per platform: steps, path and mean speed in km and km/h, first and last position; a platform's steps are taken by ranges of time."""
    rows = with_previous(df.select(by, time, lat, lon), [by], [time])
    b = F.col("__before")
    step = F.sqrt(F.pow(F.col(lat) - b[lat], 2) + F.pow(F.col(lon) - b[lon], 2)) * KM_PER_DEGREE
    hours = (micros_of(F.col(time)) - micros_of(b[time])) / 3.6e9
    steps = rows.withColumns({"__km": step, "__h": hours})
    return steps.groupBy(by).agg(
        F.count("__km").alias("steps"), F.sum("__km").alias("path_km"), F.avg(F.when(F.col("__h") > 0, F.col("__km") / F.col("__h"))).alias("kmh"),
        F.min_by(lat, time).alias("lat_first"), F.max_by(lat, time).alias("lat_last"),
    )


def median_gap(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """Median seconds between a group's consecutive rows; gaps are taken by ranges of time, their median exactly with bounded buffers."""
    rows = with_previous(df.select(*by, time), by, [time])
    gap = (micros_of(F.col(time)) - micros_of(F.col("__before")[time])) / 1e6
    return exact_quantiles(rows.withColumn("__g", gap), [F.col(b) for b in by], "__g", {"gap_s": 0.5}).drop("n")


def track_points(df: DataFrame, by: str, time: str) -> DataFrame:
    """Per platform and day: how many positions its track has up to that day.  The window runs over one row per day."""
    w = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    daily = df.groupBy(by, F.date_trunc("day", F.col(time)).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.select(by, "day", "n", F.sum("n").over(w).alias("points"))


def cumulative_track(df: DataFrame, by: str, time: str, lat: str, lon: str) -> DataFrame:
    """A row per position: platform, day, t, lat, lon and its place in the platform's track, from 1.

    The track up to a day is the rows of that day and the days before, in order of `place`;
    a task orders one platform's day, never its whole history.
    """
    before = track_points(df, by, time).select(by, "day", (F.col("points") - F.col("n")).alias("__before"))
    rows = df.select(by, F.date_trunc("day", F.col(time)).alias("day"), F.col(time).alias("t"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    w = Window.partitionBy(by, "day").orderBy("t", "lat", "lon")
    numbered = rows.withColumn("__k", F.row_number().over(w)).join(before, (rows[by].eqNullSafe(before[by])) & (rows["day"].eqNullSafe(before["day"])))
    return numbered.select(rows[by], rows["day"], "t", "lat", "lon", (F.col("__before") + F.col("__k")).alias("place"))


def steps_from(df: DataFrame, time: str, start, n: int) -> DataFrame:
    """Rows of n consecutive times from the one nearest to `start`."""
    times = df.select(time).distinct()
    at = F.lit(start).cast("timestamp")
    nearest = times.agg(F.min_by(time, F.struct(F.abs(micros_of(F.col(time)) - micros_of(at)), F.col(time))).alias("__t0"))
    chosen = times.crossJoin(F.broadcast(nearest)).where(F.col(time) >= F.col("__t0")).select(time).orderBy(time).limit(n)
    return df.join(F.broadcast(chosen), time, "left_semi")


def segments(df: DataFrame, by: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Pairs of consecutive points: each row with the next one's values as <column>_next; a track is paired by ranges of time."""
    pairs = with_previous(df, [by], [time]).where(F.col("__before").isNotNull())
    return pairs.select("__before.*", *[F.col(c).alias(f"{c}_next") for c in [time, *columns]]).where(F.col(f"{time}_next").isNotNull())


def last_position_daily(df: DataFrame, by: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Last values of each day, carried forward over days without any."""
    daily = df.groupBy(by, F.date_trunc("day", F.col(time)).alias("day")).agg(F.max_by(F.struct(*columns), F.col(time)).alias("__p"))
    spine = daily.groupBy(by).agg(F.min("day").alias("a"), F.max("day").alias("b")).select(by, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    w = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    out = spine.join(daily, [by, "day"], "left").withColumn("__p", F.last("__p", ignorenulls=True).over(w))
    return out.select(by, "day", *[F.col("__p")[c].alias(c) for c in columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key; by column names it is combined on the map side, so a key with many rows costs one per task."""
    if all(isinstance(o, str) for o in order):
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("__row")).select("__row.*")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(k)
