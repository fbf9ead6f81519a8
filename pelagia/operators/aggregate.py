"""Grouped statistics of observations."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pelagia.functions.columns import rose_sector, season, seconds_of
from pelagia.sources.scratch import scratch_path, written

#: Steps of resampling: the unit and, for the spine, the interval.
STEPS = {"hour": "interval 1 hour", "day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}
#: Statistics that are 0, not NULL, in a bin without rows.
COUNTING = ("count", "sum")


def resample(df: DataFrame, time: str, unit: str, how: dict[str, tuple[str, str]], by: Sequence[str] = (), dense: bool = True) -> DataFrame:
    """Statistics per time bin: `how` maps a name to (column, mean|median|count|sum|min|max).

    With `dense` every bin between the first and the last (of each `by` group) has a row;
    bins without observations have NULLs, counts and sums 0.
    """
    functions = {"mean": F.avg, "median": F.median, "count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    binned = df.groupBy(*by, F.date_trunc(unit, F.col(time)).alias("bin")).agg(*[functions[f](c).alias(n) for n, (c, f) in how.items()])
    if not dense:
        return binned
    spine = binned.groupBy(*by).agg(F.min("bin").alias("__a"), F.max("bin").alias("__b")).select(*by, F.explode(F.sequence("__a", "__b", F.expr(STEPS[unit]))).alias("bin"))
    out = spine.join(binned, [*by, "bin"], "left")
    return out.fillna(0, [n for n, (_, f) in how.items() if f in COUNTING])


def auto_unit(df: DataFrame, time: str, by: Sequence[str] = ()) -> str:
    """hour if the median gap between times is under an hour, day if under a day, else month.

    The median itself is never taken: it is under a limit if more than half of the gaps
    are, which is counted; with an even number and just half of them, the gaps next to the
    limit decide.  Gaps are within `by`; without it within ranges of time, and the gap
    between one range and the next is added, so no task orders all times.
    """
    found = gaps(df, time, by)
    under = lambda limit: F.col("g") < limit
    limits = {"hour": 3600, "day": 86_400}
    parts = [F.count("g").alias("n")]
    for unit, limit in limits.items():
        parts += [F.count_if(under(limit)).alias(unit), F.max(F.when(under(limit), F.col("g"))).alias(f"{unit}_low"), F.min(F.when(~under(limit), F.col("g"))).alias(f"{unit}_high")]
    r = found.agg(*parts).first()
    for unit, limit in limits.items():
        if 2 * r[unit] > r["n"] + 1 or (r["n"] % 2 and 2 * r[unit] > r["n"]):
            return unit
        if r["n"] and r["n"] % 2 == 0 and 2 * r[unit] in (r["n"], r["n"] + 1) and (r[f"{unit}_low"] + r[f"{unit}_high"]) / 2 < limit:
            return unit
    return "month"


def gaps(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """(g): seconds between consecutive distinct times, within `by` or over all."""
    times = df.select(*by, time).where(F.col(time).isNotNull()).distinct()
    if by:
        w = Window.partitionBy(*by).orderBy(time)
        return times.select((seconds_of(F.col(time)) - seconds_of(F.lag(time).over(w))).alias("g")).where("g is not null")
    spark = df.sparkSession
    path = scratch_path(spark, "times")
    times.repartitionByRange(time).select(F.col(time).alias("t"), F.spark_partition_id().alias("part")).write.parquet(path)
    dealt = spark.read.parquet(path)
    inner = dealt.select((seconds_of(F.col("t")) - seconds_of(F.lag("t").over(Window.partitionBy("part").orderBy("t")))).alias("g"))
    ends = dealt.groupBy("part").agg(F.min("t").alias("a"), F.max("t").alias("b"))  # a row per range, not per time
    between = ends.select((seconds_of(F.col("a")) - seconds_of(F.lag("b").over(Window.orderBy("part")))).alias("g"))
    return inner.union(between).where("g is not null")


def band(df: DataFrame, time: str, unit: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and 5 to 95 percent band per bin."""
    rows = df.select(*by, F.date_trunc(unit, F.col(time)).alias("bin"), F.col(value).alias("__v"))
    keys = [*by, "bin"]
    bands = exact_quantiles(rows, [F.col(k) for k in keys], "__v", {"p05": 0.05, "p95": 0.95})
    return _by_keys(rows.groupBy(*keys).agg(F.avg("__v").alias("mean")), bands, keys, "left").select(*keys, "mean", "p05", "p95")


def quantiles(df: DataFrame, by: Sequence[str | Column], value: str, probabilities: Sequence[float], exact: bool = True) -> DataFrame:
    """Counts and interpolated quantiles per group, named p0, p25, ...; approximate ones on request."""
    names = [f"p{round(100 * q):d}" for q in probabilities]
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    if exact:
        return exact_quantiles(df, keys, value, dict(zip(names, probabilities)))
    q = F.percentile_approx(value, [float(x) for x in probabilities])
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), q.alias("__q"))
    return out.select(*[c for c in out.columns if c != "__q"], *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])


#: One over the share of ranks by which a sketch may be wrong.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, by: Sequence[Column], value: str, wanted: dict[str, float]) -> DataFrame:
    """(by, n, a column per name): exact interpolated quantiles whose buffers do not grow with a group's distinct values.

    A mergeable sketch of each group gives, for each quantile, a bracket of values that
    holds its rank whatever the sketch's error.  Then values below the bracket are
    counted, its own values are counted one by one, which is a share of 4 / ACCURACY of
    the group's rows, and the values next to it on both sides are kept, as a rank may be one
    off.  The ranks next to the quantile are found among these.  Missing and NaN values count for nothing; a group of
    such values has n 0 and NULLs.
    """
    x = F.col(value).cast("double")
    rows = df.select(*by, F.when(~F.isnan(x), x).alias("__x"))
    keys = rows.columns[:-1]
    ends = [min(1.0, max(0.0, q + side * 2 / ACCURACY)) for q in wanted.values() for side in (-1, 1)]
    sketch = written(rows.groupBy(*keys).agg(F.count("__x").alias("n"), F.percentile_approx("__x", ends, ACCURACY).alias("__e"), F.min("__x").alias("__min"), F.max("__x").alias("__max")), "sketch")

    def bracket(i: int, q: float, name: str) -> Column:
        low = F.col("__min") if ends[2 * i] == 0 else F.col("__e")[2 * i]
        high = F.col("__max") if ends[2 * i + 1] == 1 else F.col("__e")[2 * i + 1]
        return F.struct(F.lit(name).alias("name"), low.alias("low"), high.alias("high"), ((F.col("n") - 1) * q).alias("h"))

    each = sketch.where("n > 0").select(*keys, F.explode(F.array(*[bracket(i, q, k) for i, (k, q) in enumerate(wanted.items())])).alias("b")).select(*keys, "b.*")
    both = _by_keys(rows.where("__x is not null"), each, keys)
    # What is below stands as one value, so is what is above; both are combined before the shuffle.
    place = F.when(F.col("__x") < F.col("low"), -1).when(F.col("__x") > F.col("high"), 1).otherwise(0)
    counted = both.withColumn("side", place).groupBy(*keys, "name", "h", "side", F.when(F.col("side") == 0, F.col("__x")).alias("v")).agg(F.count(F.lit(1)).alias("c"), F.min("__x").alias("least"), F.max("__x").alias("most"))
    w = Window.partitionBy(*keys, "name").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("upto", F.sum("c").over(w))
    at = lambda k: F.min(F.when(F.col("upto") > k, F.when(F.col("side") < 0, F.col("most")).otherwise(F.col("least"))))
    k = F.floor("h")
    found = upto.groupBy(*keys, "name", "h").agg(at(k).alias("a"), at(k + 1).alias("b"))
    share = F.col("h") - k
    value_of = F.when(share > 0, F.col("a") + share * (F.col("b") - F.col("a"))).otherwise(F.col("a"))
    wide = found.select(*keys, "name", value_of.alias("q")).groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, F.col("q"))).alias(n) for n in wanted])
    out = _by_keys(sketch.select(*keys, "n"), wide, keys, "left")
    return out.select(*keys, "n", *wanted)


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be missing; without keys the right side is the few rows of one group."""
    if not keys:
        return left.join(F.broadcast(right), F.lit(True), how)
    other = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(other, same, how).drop(*[f"__{c}" for c in keys])


def climatology(df: DataFrame, key: Column, value: str) -> DataFrame:
    """(key, mean, sd, n): population standard deviation, as for a full set of years."""
    return df.groupBy(key.alias("key")).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.count(value).alias("n"))


def season_stats(df: DataFrame, time: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, season(F.col(time)).alias("season")).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.count(value).alias("n"))


def area_mean(cube: DataFrame, time: str, value: str, unit: str = "day") -> DataFrame:
    """Mean over cells at each time, then over the times of each bin."""
    steps = cube.groupBy(time).agg(F.avg(value).alias("m"))
    return steps.groupBy(F.date_trunc(unit, F.col(time)).alias("bin")).agg(F.avg("m").alias("mean"))


def season_summary(cube: DataFrame, time: str, value: str, unit: str = "day") -> DataFrame:
    """Per season: bins, and mean, least, greatest and population deviation of the bins' area means."""
    return area_mean(cube, time, value, unit).groupBy(season(F.col("bin")).alias("season")).agg(
        F.count(F.lit(1)).alias("bins"), F.avg("mean").alias("mean"), F.min("mean").alias("least"), F.max("mean").alias("greatest"), F.stddev_pop("mean").alias("sd")
    )


def valid_share(df: DataFrame, key: Column, value: str, ok: Column) -> DataFrame:
    """Share in percent of values that pass a mask."""
    return df.groupBy(key.alias("key")).agg((F.count_if(ok & F.col(value).isNotNull()) * 100.0 / F.count(value)).alias("valid"))


def time_mean_map(cube: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    return cube.groupBy(*cell).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def densest_cell(cube: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    """The cell with most values; of equals the first in row order."""
    return cube.groupBy(*cell).agg(F.count(value).alias("n")).orderBy(F.desc("n"), *cell).limit(1)


def depth_bins(df: DataFrame, depth: str, value: str, width: float = 5.0, by: Sequence[str] = ()) -> DataFrame:
    """Median and mean per bin of depth, labelled by the bin's centre."""
    return df.groupBy(*by, (F.floor(F.col(depth) / width) * width + width / 2).alias("depth_bin")).agg(F.median(value).alias("median"), F.avg(value).alias("mean"), F.count(value).alias("n"))


def common_wavelengths(spectra: DataFrame, values: Sequence[str], wavelength: str = "wavelength") -> DataFrame:
    """Medians per whole nanometre that all variables have, missing ones 0, none below 0."""
    out = spectra.groupBy(F.round(wavelength).cast("int").alias("band")).agg(*[F.median(v).alias(v) for v in values], *[F.count(v).alias(f"__{v}") for v in values])
    for v in values:
        out = out.where(F.col(f"__{v}") > 0)
    return out.select("band", *[F.greatest(F.coalesce(v, F.lit(0.0)), F.lit(0.0)).alias(v) for v in values])


def rose(df: DataFrame, direction: Column, magnitude: Column, edges: Sequence[float], sectors: int = 16) -> DataFrame:
    """(sector, class, n, percent): sectors of direction by classes of magnitude, as a share of all."""
    kind = F.lit(0)
    for k, edge in enumerate(edges, 1):
        kind = F.when(magnitude >= edge, k).otherwise(kind)
    cells = df.where(direction.isNotNull() & magnitude.isNotNull()).groupBy(rose_sector(direction, sectors).alias("sector"), kind.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return cells.crossJoin(F.broadcast(cells.agg(F.sum("n").alias("__t")))).withColumn("percent", F.col("n") * 100.0 / F.col("__t")).drop("__t")


def quantile_buckets(counts: DataFrame, value: str, n: int = 10) -> DataFrame:
    """0-based right-closed quantile bucket of each row; equal breaks are merged."""
    names = {f"__q{k}": k / n for k in range(n + 1)}
    breaks = exact_quantiles(counts, [], value, names).select(F.array_distinct(F.array(*names)).alias("__b"))  # one row
    out = counts.crossJoin(F.broadcast(breaks))
    below = F.size(F.filter(F.col("__b"), lambda b: b < F.col(value)))
    return out.withColumn("bucket", F.greatest(below - 1, F.lit(0))).drop("__b")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for each pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a, b in pairs]).alias("x"))
    return row.select(F.explode("x").alias("x")).select("x.*")


def regression(df: DataFrame, x: str, y: str, by: Sequence[str] = (), least: int = 3) -> DataFrame:
    """Slope and intercept of y on x for groups of at least `least` complete rows."""
    full = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return full.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def spectral_slope(spectra: DataFrame, by: Sequence[str], wavelength: str, value: str, low: float, high: float, least: int, keep: tuple[float, float], log_x: bool = False) -> DataFrame:
    """Minus the slope of the log spectrum between two wavelengths, per profile; slopes outside `keep` go."""
    x = F.log(wavelength) if log_x else F.col(wavelength)
    rows = spectra.where(F.col(wavelength).between(low, high) & (F.col(value) > 0)).select(*by, x.alias("x"), F.log(value).alias("y"))
    out = rows.groupBy(*by).agg((-F.regr_slope("y", "x")).alias("slope"), F.count(F.lit(1)).alias("n"))
    return out.where((F.col("n") >= least) & (F.col("slope") > keep[0]) & (F.col("slope") < keep[1]))


def trapezoid(spectra: DataFrame, by: Sequence[str], wavelength: str, value: str, low: float, high: float, high_open: bool = False) -> DataFrame:
    """Integral over wavelength per profile; values that aren't positive are missing, and one missing makes it NULL."""
    inside = (F.col(wavelength) >= low) & ((F.col(wavelength) < high) if high_open else (F.col(wavelength) <= high))
    rows = spectra.where(inside).select(*by, F.col(wavelength).alias("x"), F.when(F.col(value) > 0, F.col(value)).alias("y"))
    w = Window.partitionBy(*by).orderBy("x")
    parts = rows.withColumn("area", (F.col("y") + F.lag("y").over(w)) / 2 * (F.col("x") - F.lag("x").over(w)))
    return parts.groupBy(*by).agg(F.when(F.count("y") == F.count(F.lit(1)), F.sum("area")).alias("integral"))


def spectral_cv(spectra: DataFrame, by: Sequence[str], value: str, sd: str, floor: float = 0.1) -> DataFrame:
    """Mean of sd over value where the value is above the floor."""
    return spectra.groupBy(*by).agg(F.avg(F.when(F.col(value) > floor, F.col(sd) / F.col(value))).alias("cv"))


def good_fraction(df: DataFrame, time: str, flag: str, good: int = 1) -> DataFrame:
    """Share of good flags at each time, then the monthly mean of these."""
    steps = df.groupBy(time).agg(F.avg((F.col(flag) == good).cast("double")).alias("f"))
    return steps.groupBy(F.date_trunc("month", F.col(time)).alias("month")).agg(F.avg("f").alias("good"))


def position_variability(df: DataFrame, site: str, lat: str, lon: str) -> DataFrame:
    """Spread of positions per site and whether the platform drifts."""
    out = df.groupBy(site).agg(
        F.stddev_samp(lat).alias("sd_lat"), F.stddev_samp(lon).alias("sd_lon"), (F.max(lat) - F.min(lat)).alias("range_lat"), (F.max(lon) - F.min(lon)).alias("range_lon"),
        (F.countDistinct(F.struct(lat, lon)) / F.count(F.lit(1))).alias("unique_share"),
    )
    spread = F.sqrt(F.col("sd_lat") * F.col("sd_lat") + F.col("sd_lon") * F.col("sd_lon")) * 111.0
    return out.withColumn("drifts", (F.greatest("range_lat", "range_lon") > 0.05) | (spread > 5) | (F.col("unique_share") > 0.5))


def closest_approach(df: DataFrame, platform: str, distance: Column, cycle: str, lat: str, lon: str, time: str, top: int = 2) -> DataFrame:
    out = df.withColumn("__d", distance).groupBy(platform).agg(
        F.min("__d").alias("km"), F.countDistinct(cycle).alias("cycles"), F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.min(time).alias("first"), F.max(time).alias("last")
    )
    return out.orderBy("km", platform).limit(top)


def composite_score(df: DataFrame, parts: dict[str, tuple[float, bool]], name: str = "score") -> DataFrame:
    """Weighted sum of columns scaled to 0..10 over all rows, inverted on request; a constant column scores 5."""
    ends = df.agg(*[f(c).alias(f"__{n}_{c}") for c in parts for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.crossJoin(F.broadcast(ends))
    total = F.lit(0.0)
    for c, (weight, invert) in parts.items():
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        s = F.when(hi == lo, 5.0).otherwise((F.col(c) - lo) / (hi - lo) * 10.0)
        total = total + weight * (F.when(hi == lo, 5.0).otherwise(10.0 - s) if invert else s)
    return out.withColumn(name, total).select(*df.columns, name)


def directional_total(spectrum: DataFrame, time: str, value: str) -> DataFrame:
    """Plain sum over frequency and direction at each time."""
    return spectrum.groupBy(time).agg(F.sum(value).alias("total"))


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Convex hull, counter-clockwise from the lowest x."""
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts

    def half(ps):
        out: list[tuple[float, float]] = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(pts[::-1])


#: Positions that a task takes at most when it looks for the vertices of a part of a platform's positions.
HULL_POINTS = 50_000


def convex_hulls(df: DataFrame, by: str, lon: str, lat: str) -> DataFrame:
    """(by, vertices, hull_lon, hull_lat): number and mean of the hull's vertices, for platforms with three points or more.

    A vertex of all points is one of every part that holds it, so each platform's points
    are dealt into parts of some HULL_POINTS, and only the parts' vertices meet; that is
    exact for coordinates of any precision.
    """
    ends = df.groupBy(by, F.col(lon).alias("x")).agg(F.min(lat).alias("a"), F.max(lat).alias("b")).where("x is not null and a is not null")
    kind = df.schema[by].dataType.simpleString()
    parts = ends.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / HULL_POINTS).cast("int").alias("__parts"))
    dealt = ends.join(parts, by).withColumn("__part", F.pmod(F.xxhash64("x"), F.col("__parts")))

    def vertices(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull([*zip(pdf["x"], pdf["a"]), *zip(pdf["x"], pdf["b"])])
        return pd.DataFrame({by: [key[0]] * len(h), "x": [p[0] for p in h], "y": [p[1] for p in h]})

    def of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull([*zip(pdf["x"], pdf["y"])])
        if len(h) < 3:
            return pd.DataFrame({by: [], "vertices": [], "hull_lon": [], "hull_lat": []})
        return pd.DataFrame({by: [key[0]], "vertices": [len(h)], "hull_lon": [sum(p[0] for p in h) / len(h)], "hull_lat": [sum(p[1] for p in h) / len(h)]})

    corners = dealt.groupBy(by, "__part").applyInPandas(vertices, f"{by} {kind}, x double, y double")
    return corners.groupBy(by).applyInPandas(of, f"{by} {kind}, vertices long, hull_lon double, hull_lat double")


def mean_spectrum(df: DataFrame, wavelength: str, value: Column) -> DataFrame:
    return df.withColumn("__v", value).groupBy(wavelength).agg(F.avg("__v").alias("mean"), F.stddev_pop("__v").alias("sd"), F.count("__v").alias("n"))
