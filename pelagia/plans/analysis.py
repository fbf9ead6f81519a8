"""Queries of statistics, series, joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions import columns as C
from pelagia.operators import aggregate as A
from pelagia.operators import cube as G
from pelagia.operators import extents, joins, select, series, windows
from pelagia.plans.base import CUBE, OBS, SPECTRA, cube, long, obs, query, rnd, spectra, table

DIR_TO = "(degrees(atan2({u}, {v})) % 360 + 360) % 360"
SECTOR = "least(floor({d} / 22.5) + 1, 16)::INTEGER"
SEASON = "CASE WHEN month({t}) IN (12, 1, 2) THEN 'DJF' WHEN month({t}) < 6 THEN 'MAM' WHEN month({t}) < 9 THEN 'JJA' ELSE 'SON' END"


@query(f"""WITH {OBS}, b AS (SELECT user_id, date_trunc('day', ts) AS bin, avg(value) AS mean, count(value) AS n FROM obs WHERE event_type = 'click' GROUP BY ALL),
    s AS (SELECT user_id, unnest(generate_series(min(bin), max(bin), INTERVAL 1 DAY)) AS bin FROM b GROUP BY user_id)
    SELECT user_id, bin, round(mean, 6) AS mean, coalesce(n, 0) AS n FROM s LEFT JOIN b USING (user_id, bin)""")
def daily_mean_dense(spark: SparkSession, d: str) -> DataFrame:
    """A2: daily means with a row for every day."""
    o = select.get_data(obs(spark, d), scalars={"event_type": "click"}, order=False)
    return rnd(A.resample(o, "ts", "day", {"mean": ("value", "mean"), "n": ("value", "count")}, ["user_id"]), "mean")


@query(f"WITH {OBS} SELECT event_type, date_trunc('hour', ts) AS bin, round(median(value), 6) AS median, round(sum(value), 4) AS total FROM obs GROUP BY ALL")
def hourly_median(spark: SparkSession, d: str) -> DataFrame:
    """A3: medians and sums per bin."""
    return rnd(rnd(A.resample(obs(spark, d), "ts", "hour", {"median": ("value", "median"), "total": ("value", "sum")}, ["event_type"], dense=False), "median"), "total", digits=4)


@query("SELECT count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice, 0.0), 6) AS p0, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(median(l_extendedprice), 6) AS p50, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99 FROM lineitem")
def price_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of all rows at once, with bounded buffers."""
    return rnd(A.quantiles(table(spark, d, "lineitem"), [], "l_extendedprice", [0.0, 0.25, 0.5, 0.99]), "p0", "p25", "p50", "p99")


def unit_sql(rows: str, by: str, time: str) -> str:
    """The unit that the median gap of `rows` gives."""
    gap = f"SELECT epoch({time}) - lag(epoch({time})) OVER (PARTITION BY {by} ORDER BY {time}) AS g FROM (SELECT DISTINCT {by} AS k, {time} FROM {rows})".replace(f"PARTITION BY {by}", "PARTITION BY k")
    return f"(SELECT CASE WHEN median(g) < 3600 THEN 'hour' WHEN median(g) < 86400 THEN 'day' ELSE 'month' END FROM ({gap}))"


@query(f"SELECT 'all' AS series, {unit_sql('events', '0', 'ts')} AS unit UNION ALL SELECT 'platform', {unit_sql('events', 'user_id', 'ts')} UNION ALL SELECT 'customer', {unit_sql('orders', 'o_custkey', 'o_orderdate')}")
def auto_units(spark: SparkSession, d: str) -> DataFrame:
    """The unit that the median gap of three series gives."""
    e, o = table(spark, d, "events"), table(spark, d, "orders")
    units = {"all": A.auto_unit(e, "ts"), "platform": A.auto_unit(e, "ts", ["user_id"]), "customer": A.auto_unit(o, "o_orderdate", ["o_custkey"])}
    return spark.createDataFrame(list(units.items()), "series string, unit string")


@query(f"""WITH {OBS}, u AS (SELECT {unit_sql('obs', 'user_id', 'ts')} AS unit) SELECT user_id, date_trunc((SELECT unit FROM u), ts) AS bin, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.95), 6) AS p95 FROM obs GROUP BY ALL""")
def auto_band(spark: SparkSession, d: str) -> DataFrame:
    """Mean and band per bin, the bin chosen by the median gap of the data."""
    o = obs(spark, d)
    return rnd(A.band(o, "ts", A.auto_unit(o, "ts", ["user_id"]), "value", ["user_id"]), "mean", "p05", "p95")


@query("""SELECT month(l_shipdate)::INTEGER AS month, count(l_quantity) AS n, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.75) AS p75,
    quantile_cont(l_quantity, 0.9) AS p90, quantile_cont(l_quantity, 1.0) AS p100 FROM lineitem GROUP BY 1""")
def monthly_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles per calendar month."""
    return A.quantiles(table(spark, d, "lineitem"), [F.month("l_shipdate").alias("month")], "l_quantity", [0.25, 0.5, 0.75, 0.9, 1.0])


@query("""SELECT date_trunc('month', l_shipdate) AS month, count(l_discount) AS n, quantile_cont(l_discount, 0.0) AS p0, round(quantile_cont(l_discount, 0.25), 9) AS p25, round(quantile_cont(l_discount, 0.5), 9) AS p50,
    round(quantile_cont(l_discount, 0.75), 9) AS p75, quantile_cont(l_discount, 1.0) AS p100 FROM lineitem GROUP BY 1""")
def five_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Least, quartiles and greatest per month."""
    out = A.quantiles(table(spark, d, "lineitem"), [F.date_trunc("month", "l_shipdate").alias("month")], "l_discount", [0, 0.25, 0.5, 0.75, 1])
    return rnd(out, "p25", "p50", "p75", digits=9)


@query("SELECT hour(ts)::INTEGER AS key, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, count(value) AS n FROM events GROUP BY 1")
def hourly_climatology(spark: SparkSession, d: str) -> DataFrame:
    """Climatology by hour of day."""
    return rnd(A.climatology(table(spark, d, "events"), F.hour("ts"), "value"), "mean", "sd")


@query(f"SELECT l_linenumber, {SEASON.format(t='l_shipdate')} AS season, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS sd, count(l_quantity) AS n FROM lineitem GROUP BY ALL")
def season_stats(spark: SparkSession, d: str) -> DataFrame:
    """Seasons per band."""
    return rnd(A.season_stats(table(spark, d, "lineitem"), "l_shipdate", "l_quantity", ["l_linenumber"]), "mean", "sd")


@query(f"""WITH {CUBE}, a AS (SELECT time AS bin, avg(value) AS mean FROM cube GROUP BY 1)
    SELECT {SEASON.format(t='bin')} AS season, count(*) AS bins, round(avg(mean), 6) AS mean, round(min(mean), 6) AS least, round(max(mean), 6) AS greatest, round(stddev_pop(mean), 6) AS sd FROM a GROUP BY 1""")
def season_summary(spark: SparkSession, d: str) -> DataFrame:
    """Area means and their seasons."""
    return rnd(A.season_summary(cube(spark, d), "time", "value", "month"), "mean", "least", "greatest", "sd")


@query(f"WITH {CUBE} SELECT year(time)::INTEGER AS key, round(count(*) FILTER (WHERE qc <= 2 AND value IS NOT NULL) * 100.0 / count(value), 6) AS valid FROM cube GROUP BY 1")
def valid_share(spark: SparkSession, d: str) -> DataFrame:
    """A10: share of cells that pass a mask."""
    return rnd(A.valid_share(cube(spark, d), F.year("time"), "value", F.col("qc") <= 2), "valid")


@query(f"WITH {CUBE} SELECT lat, lon, round(avg(value), 6) AS mean, count(value) AS n FROM cube WHERE time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL")
def time_mean_map(spark: SparkSession, d: str) -> DataFrame:
    """Mean map of a period."""
    return rnd(A.time_mean_map(select.get_cube(cube(spark, d), "time", "lat", "lon", "1996-01-01", "1998-12-31"), ["lat", "lon"], "value"), "mean")


@query(f"WITH {CUBE} SELECT time, lat, lon, CASE WHEN lat >= 3 AND lon <= 6 THEN value END AS value FROM cube WHERE qc::VARCHAR = '1'")
def masked_cube(spark: SparkSession, d: str) -> DataFrame:
    """Q8: a box that masks, and a trimmed comparison of strings."""
    return select.get_cube(cube(spark, d), "time", "lat", "lon", lat_min=3, lon_max=6, scalars={"qc": " 1 ", "unknown": "x"}, mask=["value"]).select("time", "lat", "lon", "value")


@query(f"WITH {CUBE} SELECT lat, lon, count(value) AS n FROM cube WHERE qc = 1 GROUP BY ALL ORDER BY n DESC, lat, lon LIMIT 1")
def densest_cell(spark: SparkSession, d: str) -> DataFrame:
    """The cell with most values."""
    return A.densest_cell(select.with_good_flags(cube(spark, d), "qc", [1]), ["lat", "lon"], "value")


@query("SELECT l_linenumber, floor(l_quantity / 5) * 5 + 2.5 AS depth_bin, round(median(l_tax), 9) AS median, round(avg(l_tax), 6) AS mean, count(l_tax) AS n FROM lineitem GROUP BY ALL")
def depth_bins(spark: SparkSession, d: str) -> DataFrame:
    """Median and mean per depth bin."""
    return rnd(rnd(A.depth_bins(table(spark, d, "lineitem"), "l_quantity", "l_tax", 5.0, ["l_linenumber"]), "mean"), "median", digits=9)


@query("SELECT (ceil(l_quantity / 10) - 0.5) * 10 AS bin, count(*) AS n FROM lineitem WHERE l_quantity > 0 AND l_quantity <= 40 GROUP BY 1")
def right_closed_bins(spark: SparkSession, d: str) -> DataFrame:
    """Right-closed bins labelled by their centres, rows outside left out."""
    return table(spark, d, "lineitem").groupBy(C.right_closed_bin(F.col("l_quantity"), 10.0, 0.0, 40.0).alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin is not null")


@query(f"""WITH {SPECTRA} SELECT wavelength AS band, round(greatest(coalesce(median(value - 1), 0), 0), 6) AS a, round(greatest(median(CASE WHEN vec_id % 3 = 0 THEN value END), 0), 6) AS b
    FROM spectra GROUP BY 1 HAVING count(value) > 0 AND count(CASE WHEN vec_id % 3 = 0 THEN value END) > 0""")
def common_wavelengths(spark: SparkSession, d: str) -> DataFrame:
    """Medians of the bands that all variables have."""
    s = spectra(spark, d).select("wavelength", (F.col("value") - 1).alias("a"), F.when(F.col("vec_id") % 3 == 0, F.col("value")).alias("b"))
    return rnd(A.common_wavelengths(s, ["a", "b"]), "a", "b")


@query("SELECT day(ts)::INTEGER AS day, " + ", ".join(f"round(avg(value) FILTER (WHERE hour(ts) = {h}), 6) AS h{h}" for h in range(24)) + " FROM events GROUP BY 1")
def pivot_day_hour(spark: SparkSession, d: str) -> DataFrame:
    """Day by hour."""
    hours = [f"h{h}" for h in range(24)]
    e = table(spark, d, "events").withColumn("h", F.concat(F.lit("h"), F.hour("ts")))
    return rnd(e.groupBy(F.dayofmonth("ts").alias("day")).pivot("h", hours).agg(F.avg("value")), *hours)


@query(f"""WITH {OBS}, x AS (SELECT {DIR_TO.format(u='u', v='v')} AS d, sqrt(u * u + v * v) AS s FROM obs WHERE qc IN (1, 2)), r AS (SELECT {SECTOR.format(d='round(d, 6)')} AS sector, CASE WHEN s >= 1.5 THEN 3 WHEN s >= 1.0 THEN 2 WHEN s >= 0.5 THEN 1 ELSE 0 END AS class, count(*) AS n FROM x GROUP BY ALL)
    SELECT sector, class, n, round(n * 100.0 / sum(n) OVER (), 6) AS percent FROM r""")
def direction_rose(spark: SparkSession, d: str) -> DataFrame:
    """A rose of directions and speeds."""
    o = select.with_good_flags(obs(spark, d), "qc", [1, 2])
    return rnd(A.rose(o, F.round(C.direction_toward(F.col("u"), F.col("v")), 6), C.speed(F.col("u"), F.col("v")), [0.5, 1.0, 1.5]), "percent")


@query(f"""WITH {CUBE}, m AS (SELECT lat, lon, avg(value - 25) AS u, avg(other * 100 - 5) AS v FROM cube GROUP BY ALL),
    r AS (SELECT {SECTOR.format(d=DIR_TO.format(u='-u', v='-v'))} AS sector, CASE WHEN sqrt(u*u+v*v) >= 1 THEN 1 ELSE 0 END AS class, count(*) AS n FROM m GROUP BY ALL) SELECT sector, class, n, round(n * 100.0 / sum(n) OVER (), 6) AS percent FROM r""")
def velocity_rose(spark: SparkSession, d: str) -> DataFrame:
    """A rose of the cells' mean velocities by the direction that they come from."""
    c = cube(spark, d).select("lat", "lon", (F.col("value") - 25).alias("u"), (F.col("other") * 100 - 5).alias("v"))
    return rnd(series.velocity_rose(c, ["lat", "lon"], "u", "v", 1.0, 2), "percent")


@query("""WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), q AS (SELECT list_distinct(quantile_cont(n, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS b FROM c)
    SELECT user_id, n, greatest(len(list_filter(b, lambda x: x < n)) - 1, 0)::INTEGER AS bucket FROM c, q""")
def quantile_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Counts per cell and their quantile bucket."""
    return series.cell_density(table(spark, d, "events"), "user_id", 10)


@query("""SELECT * FROM (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem)""")
def correlations(spark: SparkSession, d: str) -> DataFrame:
    """Correlations of pairs of columns."""
    return rnd(A.correlations(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), "r")


@query("""WITH a AS (SELECT date_trunc('day', ts) AS bin, avg(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1), b AS (SELECT date_trunc('day', ts) AS bin, avg(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT round(regr_slope(b.value, a.value), 6) AS slope, round(regr_intercept(b.value, a.value), 4) AS intercept, count(*) AS n FROM a JOIN b USING (bin)""")
def aligned_regression(spark: SparkSession, d: str) -> DataFrame:
    """Daily series aligned in time, and the regression of one on the other."""
    e = table(spark, d, "events")
    daily = lambda kind: A.resample(e.where(F.col("event_type") == kind), "ts", "day", {"value": ("value", "mean")}, dense=False)
    both = joins.aligned({"click": daily("click"), "view": daily("view")}, "bin")
    return rnd(rnd(A.regression(both, "click", "view"), "slope"), "intercept", digits=4)


@query(f"""WITH {SPECTRA} SELECT * FROM (SELECT vec_id, label, round(-regr_slope(ln(value), wavelength), 8) AS slope, count(*) AS n FROM spectra WHERE wavelength BETWEEN 350 AND 500 AND value > 0 GROUP BY ALL)
    WHERE n >= 20 AND slope > -0.005 AND slope < 0.005""")
def log_slope_per_vector(spark: SparkSession, d: str) -> DataFrame:
    """Log-linear slopes of spectra."""
    s = spectra(spark, d)
    return rnd(A.spectral_slope(s, ["vec_id", "label"], "wavelength", "value", 350, 500, 20, (-0.005, 0.005)), "slope", digits=8)


@query(f"""WITH {SPECTRA}, p AS (SELECT vec_id, label, round(-regr_slope(ln(value), ln(wavelength)), 8) AS slope, count(*) AS n FROM spectra WHERE wavelength BETWEEN 400 AND 660 AND value > 0 GROUP BY ALL)
    SELECT label, count(slope) AS n, round(quantile_cont(slope, 0.25), 6) AS p25, round(quantile_cont(slope, 0.5), 6) AS p50, round(quantile_cont(slope, 0.75), 6) AS p75 FROM p WHERE n >= 4 AND slope > -1 AND slope < 4 GROUP BY 1""")
def power_law_slopes(spark: SparkSession, d: str) -> DataFrame:
    """Log-log slopes and their quartiles."""
    s = A.spectral_slope(spectra(spark, d), ["vec_id", "label"], "wavelength", "value", 400, 660, 4, (-1, 4), log_x=True)
    return rnd(A.quantiles(s.withColumn("slope", F.round("slope", 8)), ["label"], "slope", [0.25, 0.5, 0.75]), "p25", "p50", "p75")


@query(f"""WITH {SPECTRA}, t AS (SELECT vec_id, wavelength AS x, CASE WHEN value > 0.8 THEN value - 0.8 END AS y FROM spectra WHERE wavelength BETWEEN 400 AND 600 AND vec_id % 2 = 0 UNION ALL SELECT vec_id, wavelength, value FROM spectra WHERE wavelength BETWEEN 400 AND 600 AND vec_id % 2 = 1),
    a AS (SELECT vec_id, y, (y + lag(y) OVER w) / 2 * (x - lag(x) OVER w) AS area FROM t WINDOW w AS (PARTITION BY vec_id ORDER BY x)) SELECT vec_id, round(CASE WHEN count(y) = count(*) THEN sum(area) END, 6) AS integral FROM a GROUP BY 1""")
def band_integral(spark: SparkSession, d: str) -> DataFrame:
    """Integrals over a band, missing where a value is."""
    s = spectra(spark, d).withColumn("value", F.when(F.col("vec_id") % 2 == 0, F.col("value") - 0.8).otherwise(F.col("value")))
    return rnd(A.trapezoid(s, ["vec_id"], "wavelength", "value", 400, 600), "integral")


@query(f"WITH {SPECTRA} SELECT label, round(avg(CASE WHEN value > 0.1 THEN (value / 10 + 0.05) / value END), 6) AS cv FROM spectra GROUP BY 1")
def spectral_cv(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of variation."""
    return rnd(A.spectral_cv(spectra(spark, d).withColumn("sd", F.col("value") / 10 + 0.05), ["label"], "value", "sd"), "cv")


@query("WITH t AS (SELECT l_shipdate AS t, avg(CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 0.0 END) AS f FROM lineitem GROUP BY 1) SELECT date_trunc('month', t) AS month, round(avg(f), 6) AS good FROM t GROUP BY 1")
def good_fraction(spark: SparkSession, d: str) -> DataFrame:
    """Share of good flags per time, then per month."""
    return rnd(A.good_fraction(table(spark, d, "lineitem"), "l_shipdate", "l_linenumber"), "good")


@query(f"""WITH {OBS}, s AS (SELECT user_id, stddev_samp(lat) AS sd_lat, stddev_samp(lon) AS sd_lon, max(lat) - min(lat) AS range_lat, max(lon) - min(lon) AS range_lon, count(DISTINCT (lat, lon)) * 1.0 / count(*) AS unique_share FROM obs GROUP BY 1)
    SELECT user_id, round(sd_lat, 6) AS sd_lat, round(sd_lon, 6) AS sd_lon, round(range_lat, 6) AS range_lat, round(range_lon, 6) AS range_lon, round(unique_share, 6) AS unique_share,
    greatest(range_lat, range_lon) > 0.05 OR sqrt(sd_lat * sd_lat + sd_lon * sd_lon) * 111 > 5 OR unique_share > 0.5 AS drifts FROM s""")
def site_variability(spark: SparkSession, d: str) -> DataFrame:
    """Spread of positions and drifting platforms."""
    return rnd(A.position_variability(obs(spark, d), "user_id", "lat", "lon"), "sd_lat", "sd_lon", "range_lat", "range_lon", "unique_share")


KM = "sqrt(pow(lat + 30, 2) + pow((lon - 130) * cos(radians(-30)), 2)) * 111"


@query(f"WITH {OBS} SELECT user_id, round(min({KM}), 6) AS km, count(DISTINCT qc) AS cycles, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, min(ts) AS first, max(ts) AS last FROM obs GROUP BY 1 ORDER BY min({KM}), user_id LIMIT 2")
def closest_approach(spark: SparkSession, d: str) -> DataFrame:
    """The two platforms that came closest to a place."""
    return rnd(A.closest_approach(obs(spark, d), "user_id", C.planar_km(F.col("lat"), F.col("lon"), -30.0, 130.0), "qc", "lat", "lon", "ts"), "km", "lat", "lon")


@query("""WITH s AS (SELECT user_id, avg(value) AS a, count(*) AS b FROM events GROUP BY 1), m AS (SELECT *, min(a) OVER () AS la, max(a) OVER () AS ha, min(b) OVER () AS lb, max(b) OVER () AS hb FROM s)
    SELECT user_id, round(0.65 * CASE WHEN ha = la THEN 5 ELSE (a - la) / (ha - la) * 10 END + 0.35 * CASE WHEN hb = lb THEN 5 ELSE 10 - (b - lb) * 10.0 / (hb - lb) END, 5) AS score FROM m""")
def composite_score(spark: SparkSession, d: str) -> DataFrame:
    """A weighted score of scaled columns."""
    s = table(spark, d, "events").groupBy("user_id").agg(F.avg("value").alias("a"), F.count(F.lit(1)).cast("double").alias("b"))
    return rnd(A.composite_score(s, {"a": (0.65, False), "b": (0.35, True)}), "score", digits=5).select("user_id", "score")


@query(f"""WITH {CUBE}, t AS (SELECT DISTINCT time FROM cube WHERE value IS NOT NULL), s AS (SELECT time FROM t WHERE time >= (SELECT arg_min(time, (abs(epoch_us(time) - epoch_us(TIMESTAMP '1997-03-10')), time)) FROM t) ORDER BY time LIMIT 6)
    SELECT round(min(value - 273.15), 6) AS low, round(max(value - 273.15), 6) AS high, round(greatest(abs(min(value - 273.15)), abs(max(value - 273.15))), 6) AS reach FROM cube WHERE time IN (SELECT time FROM s)""")
def frame_range(spark: SparkSession, d: str) -> DataFrame:
    """The common range of six frames, in degrees Celsius."""
    frames, ends = series.variable_frames(cube(spark, d).withColumn("units", F.lit("Kelvin")), "time", "1997-03-10", "value", "units")
    return rnd(ends, "low", "high", "reach")


@query(f"""WITH {CUBE}, t AS (SELECT DISTINCT time FROM cube WHERE lat % 2 = 0 AND lon % 2 = 0), s AS (SELECT time FROM t WHERE time >= (SELECT arg_min(time, (abs(epoch_us(time) - epoch_us(TIMESTAMP '1997-03-10')), time)) FROM t) ORDER BY time LIMIT 6)
    SELECT time, lat, lon, round(-value * sin(radians(other * 3600)), 6) + 0.0 AS u, round(-value * cos(radians(other * 3600)), 6) + 0.0 AS v FROM cube WHERE time IN (SELECT time FROM s) AND lat % 2 = 0 AND lon % 2 = 0""")
def vector_frames(spark: SparkSession, d: str) -> DataFrame:
    """Components of every second cell over six times."""
    c = cube(spark, d).withColumn("direction", F.col("other") * 3600)
    return rnd(series.vector_frames(c, "time", "1997-03-10", "value", "direction", "lat", "lon", 2).select("time", "lat", "lon", "u", "v"), "u", "v")


@query(f"""WITH {CUBE}, t AS (SELECT DISTINCT time FROM cube), s AS (SELECT time FROM t WHERE time >= TIMESTAMP '1996-07-01' ORDER BY time LIMIT 6) SELECT time, lat, lon, round(sqrt(value * value + other * other), 6) AS speed FROM cube WHERE time IN (SELECT time FROM s)""")
def velocity_frames(spark: SparkSession, d: str) -> DataFrame:
    """Speed of each cell over six times."""
    return rnd(series.velocity_frames(cube(spark, d), "time", "1996-07-02", "value", "other").select("time", "lat", "lon", "speed"), "speed")


@query("SELECT l_shipdate AS time, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def directional_total(spark: SparkSession, d: str) -> DataFrame:
    """Sums over all bins per time."""
    return A.directional_total(table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "time"), "time", "l_quantity")


@query()
def convex_hulls(spark: SparkSession, d: str) -> DataFrame:
    """Hulls of the platforms' positions."""
    return rnd(A.convex_hulls(obs(spark, d), "user_id", "lon", "lat"), "hull_lon", "hull_lat")


@query("""WITH x AS (SELECT o_custkey, datediff('second', o_orderdate, m) / 3600.0 AS h FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
    SELECT o_custkey, round(median(h), 6) AS median_h, count(h) AS n FROM x WHERE h IS NOT NULL GROUP BY 1""")
def durations(spark: SparkSession, d: str) -> DataFrame:
    """Durations of events and their medians."""
    ends = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("end"))
    x = table(spark, d, "orders").join(ends, "o_orderkey").withColumn("h", C.duration_hours(F.col("o_orderdate"), F.col("end"))).where("h is not null")
    return rnd(x.groupBy("o_custkey").agg(F.median("h").alias("median_h"), F.count("h").alias("n")), "median_h")


@query(f"WITH {SPECTRA} SELECT label, wavelength, round(median(value), 6) AS median, round(avg(CASE WHEN vec_id % 2 = 0 THEN value - 0.5 END), 6) AS mean, round(stddev_pop(CASE WHEN vec_id % 2 = 0 THEN value - 0.5 END), 6) AS sd FROM spectra WHERE vec_id % 5 <= 2 GROUP BY ALL")
def band_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Medians per band, and mean and deviation of a difference that needs observations."""
    s = select.with_good_flags(spectra(spark, d).withColumn("qc", F.col("vec_id") % 5), "qc", [0, 1, 2])
    b, _ = C.difference_with_error(F.col("value"), F.lit(0.5), F.lit(0.1), F.lit(0.2), 1 - F.col("vec_id") % 2)
    return rnd(s.withColumn("b", b).groupBy("label", "wavelength").agg(F.median("value").alias("median"), F.avg("b").alias("mean"), F.stddev_pop("b").alias("sd")), "median", "mean", "sd")


@query(f"""WITH {OBS}, l AS (SELECT event_id, user_id, ts, value FROM obs WHERE event_type = 'click'), r AS (SELECT user_id, ts AS rt, value AS rv FROM obs WHERE event_type = 'view'),
    j AS (SELECT l.*, rt, rv, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(ts) - epoch_us(rt)), rt) AS k FROM l JOIN r USING (user_id) WHERE abs(epoch_us(ts) - epoch_us(rt)) <= 7200 * 1000000::BIGINT)
    SELECT event_id, user_id, ts, value, rt AS ts_right, rv AS value_right FROM j WHERE k = 1""")
def asof_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Each click with the nearest view of its platform within two hours."""
    o = obs(spark, d)
    left = o.where("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    return joins.asof_nearest(left, o.where("event_type = 'view'").select("user_id", "ts", "value"), ["user_id"], "ts", ["value"], 7200)


@query("""WITH m AS (SELECT month(l_shipdate)::INTEGER AS month, avg(l_tax) AS value FROM lineitem WHERE month(l_shipdate) % 5 > 0 GROUP BY 1), s AS (SELECT unnest(range(1, 13))::INTEGER AS month) SELECT month, round(coalesce(value, (SELECT median(value) FROM m)), 6) AS value FROM s LEFT JOIN m USING (month)""")
def months_with_default(spark: SparkSession, d: str) -> DataFrame:
    """Twelve months, missing ones filled by the median."""
    m = table(spark, d, "lineitem").where(F.month("l_shipdate") % 5 > 0).groupBy(F.month("l_shipdate").alias("month")).agg(F.avg("l_tax").alias("value"))
    return rnd(joins.months_with_default(m, "month", "value", None), "value")


@query(f"WITH {CUBE} SELECT time, lat, lon, value FROM cube WHERE lat = 4 AND lon = 7 AND time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-01'")
def nearest_point_series(spark: SparkSession, d: str) -> DataFrame:
    """The series of the grid point nearest to a place."""
    return series.point_series(cube(spark, d), "time", "lat", "lon", 4.3, 6.8, "1996-01-01", "1999-06-01", ["value"])


@query(f"""WITH {CUBE}, c AS (SELECT *, lat + lon * 0.1 AS latitude, lon - lat * 0.1 AS longitude FROM cube), n AS (SELECT lat AS a, lon AS b FROM c ORDER BY pow(latitude - 5.2, 2) + pow(longitude - 3.3, 2), lat, lon LIMIT 1),
    s AS (SELECT time AS bin, avg(value - 25) AS u, avg(other) AS v FROM c, n WHERE lat = a AND lon = b GROUP BY 1), g AS (SELECT unnest(generate_series((SELECT min(bin) FROM s), (SELECT max(bin) FROM s), INTERVAL 1 MONTH)) AS bin)
    SELECT bin, round(u, 6) AS u, round(v, 6) AS v, round(sqrt(u*u+v*v), 6) AS speed, round({DIR_TO.format(u='u', v='v')}, 5) AS direction FROM g LEFT JOIN s USING (bin)""")
def current_series(spark: SparkSession, d: str) -> DataFrame:
    """Mean currents at the nearest cell of a curvilinear grid."""
    c = cube(spark, d).withColumns({"latitude": F.col("lat") + F.col("lon") * 0.1, "longitude": F.col("lon") - F.col("lat") * 0.1, "u": F.col("value") - 25})
    out = series.current_series(c, "time", "latitude", "longitude", "u", "other", ["lat", "lon"], (5.2, 3.3), "month")
    return rnd(rnd(out, "u", "v", "speed"), "direction", digits=5)


@query(f"""WITH {OBS}, c AS (SELECT DISTINCT trunc(lat / 15.0) * 15.0 + 0.0 AS cell_lat, trunc(lon / 15.0) * 15.0 + 0.0 AS cell_lon FROM obs), b AS (SELECT event_id AS box_id, lat - 1 AS lat_min, lat + 1 AS lat_max, lon - 2 AS lon_min, lon + 2 AS lon_max FROM obs WHERE event_id % 50 = 0)
    SELECT box_id, cell_lat, cell_lon FROM b JOIN c ON cell_lat - 15 <= lat_max AND cell_lat + 15 >= lat_min AND cell_lon - 15 <= lon_max AND cell_lon + 15 >= lon_min""")
def rectangle_join(spark: SparkSession, d: str) -> DataFrame:
    """Boxes and the cells that they touch."""
    from pelagia.operators.ingest import add_cell_key

    o = obs(spark, d)
    c = extents.cells(add_cell_key(o, delta=15.0, wkb=False))
    b = o.where("event_id % 50 = 0").select(F.col("event_id").alias("box_id"), (F.col("lat") - 1).alias("lat_min"), (F.col("lat") + 1).alias("lat_max"), (F.col("lon") - 2).alias("lon_min"), (F.col("lon") + 2).alias("lon_max"))
    return joins.rectangles_touching(c, b, 15.0).select("box_id", "cell_lat", "cell_lon")


@query(f"WITH {OBS}, s AS (SELECT lat AS a, lon AS b FROM obs ORDER BY pow(lat + 33.3, 2) + pow(lon - 121.7, 2), lat, lon LIMIT 1) SELECT event_id, lat, lon, value FROM obs, s WHERE lat = a AND lon = b")
def nearest_site_rows(spark: SparkSession, d: str) -> DataFrame:
    """All rows at the nearest site."""
    return joins.nearest_site_rows(obs(spark, d).select("event_id", "lat", "lon", "value"), "lat", "lon", -33.3, 121.7)


@query(f"""WITH {OBS}, x AS (SELECT event_id, user_id, ts, value, epoch(date_trunc('second', ts))::BIGINT AS s FROM obs WHERE event_type = 'click')
    SELECT a.event_id, a.user_id, round(median(b.value), 6) AS median FROM x a JOIN x b ON a.user_id = b.user_id AND b.s > a.s - 129600 AND b.s <= a.s + 129600 GROUP BY ALL""")
def rolling_median_3d(spark: SparkSession, d: str) -> DataFrame:
    """Centred rolling medians over three days."""
    o = obs(spark, d).where("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    return rnd(windows.rolling_median(o, ["user_id"], "ts", "value", 3 * 86_400), "median").select("event_id", "user_id", "median")


@query(f"""WITH {OBS}, s AS (SELECT user_id, ts, lat, lon, sqrt(pow(lat - lag(lat) OVER w, 2) + pow(lon - lag(lon) OVER w, 2)) * 111 AS km, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 3.6e9 AS h FROM obs WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    SELECT user_id, count(km) AS steps, round(sum(km), 4) AS path_km, round(avg(CASE WHEN h > 0 THEN km / h END), 4) AS kmh, arg_min(lat, ts) AS lat_first, arg_max(lat, ts) AS lat_last FROM s GROUP BY 1""")
def drift_stats(spark: SparkSession, d: str) -> DataFrame:
    """Path and speed of drifting platforms."""
    return rnd(windows.drift(obs(spark, d), "user_id", "ts", "lat", "lon"), "path_km", "kmh", digits=4)


@query("WITH g AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts)) / 1e6 AS g FROM events) SELECT user_id, round(median(g), 4) AS gap_s FROM g GROUP BY 1")
def median_gap(spark: SparkSession, d: str) -> DataFrame:
    """Median sampling gaps."""
    return rnd(windows.median_gap(table(spark, d, "events"), ["user_id"], "ts"), "gap_s", digits=4)


@query(f"WITH {OBS} SELECT user_id, date_trunc('day', ts) AS day, ts AS t, lat, lon, row_number() OVER (PARTITION BY user_id ORDER BY ts, lat, lon) AS place FROM obs")
def cumulative_track(spark: SparkSession, d: str) -> DataFrame:
    """Every position of every platform with its day and its place in the track up to that day."""
    return windows.cumulative_track(obs(spark, d), "user_id", "ts", "lat", "lon")


@query(f"""WITH {OBS}, s AS (SELECT user_id, ts, lat, lead(ts) OVER w AS ts_next, lead(lat) OVER w AS lat_next FROM obs WHERE qc = 0 WINDOW w AS (PARTITION BY user_id ORDER BY ts)) SELECT * FROM s WHERE ts_next IS NOT NULL""")
def track_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments between consecutive positions."""
    return windows.segments(obs(spark, d).where("qc = 0").select("user_id", "ts", "lat"), "user_id", "ts", ["lat"])


@query(f"""WITH {OBS}, p AS (SELECT user_id, date_trunc('day', ts) AS day, arg_max(lat, ts) AS lat, arg_max(lon, ts) AS lon FROM obs GROUP BY ALL), g AS (SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM p GROUP BY 1)
    SELECT user_id, day, last_value(lat IGNORE NULLS) OVER w AS lat, last_value(lon IGNORE NULLS) OVER w AS lon FROM g LEFT JOIN p USING (user_id, day) WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def last_position_daily(spark: SparkSession, d: str) -> DataFrame:
    """The last position of each day, carried forward."""
    return windows.last_position_daily(obs(spark, d), "user_id", "ts", ["lat", "lon"])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each key."""
    return windows.first_per_key(table(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query(f"WITH {OBS} SELECT round(lat, 1) AS lat, round(lon, 1) AS lon, count(*) AS n FROM obs GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 15")
def top_positions(spark: SparkSession, d: str) -> DataFrame:
    """O2: the fifteen positions observed most."""
    return windows.top_k(obs(spark, d).groupBy(F.round("lat", 1).alias("lat"), F.round("lon", 1).alias("lon")).agg(F.count(F.lit(1)).alias("n")), 15, F.desc("n"), "lat", "lon")


@query("SELECT DISTINCT user_id % 40 AS k, CASE WHEN user_id % 40 IN (SELECT user_id % 40 FROM events WHERE event_type = 'error' AND value > 100) THEN 'both' ELSE 'left' END AS side FROM events")
def time_sets(spark: SparkSession, d: str) -> DataFrame:
    """Values in both sets, and in the first alone."""
    e = table(spark, d, "events")
    a, b = e.select((F.col("user_id") % 40).alias("k")), e.where("event_type = 'error' and value > 100").select((F.col("user_id") % 40).alias("k"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(a.subtract(b).withColumn("side", F.lit("left")))


@query("SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month FROM orders")
def month_starts(spark: SparkSession, d: str) -> DataFrame:
    """The months of the data."""
    return series.month_starts(table(spark, d, "orders"), "o_orderdate")


@query("SELECT min(l_tax) AS l_tax_min, max(l_tax) AS l_tax_max, min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max, min(l_linenumber) AS l_linenumber_min, max(l_linenumber) AS l_linenumber_max FROM lineitem WHERE l_quantity >= 25")
def temperature_salinity(spark: SparkSession, d: str) -> DataFrame:
    """Pairs above a salinity floor, their ranges."""
    return series.temperature_salinity(table(spark, d, "lineitem"), "l_tax", "l_quantity", "l_linenumber")[1]


@query("""SELECT event_id, round(CASE WHEN value > 50 THEN 100 / value END, 6) AS ratio, round((value / 100) * (value / 100), 6) AS energy, round((value / 100) * (value / 100) * 7, 6) AS power, round(least(greatest(value / 200, 0), 1), 6) AS share,
    round((value - value * 0.9) / value, 6) AS correction FROM events WHERE value > 0""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    """Ratios, energies, clipped fractions and corrections."""
    v = F.col("value")
    e = table(spark, d, "events").where("value > 0")
    return rnd(
        e.select("event_id", F.when(v > 50, C.ratio(F.lit(100.0), v)).alias("ratio"), C.wave_energy(v / 100).alias("energy"), C.wave_energy(v / 100, F.lit(7.0)).alias("power"), C.clipped_fraction(v, F.lit(200.0)).alias("share"), C.relative_correction(v, v * 0.9).alias("correction")),
        "ratio", "energy", "power", "share", "correction",
    )


@query(f"""WITH {CUBE}, g AS (SELECT unnest(range(0, 21)) * 0.5 - 0.5 AS x), s AS (SELECT DISTINCT time, lat FROM cube), p AS (SELECT time, lat, lon::DOUBLE AS lon, value FROM cube),
    j AS (SELECT s.time, s.lat, g.x, (SELECT max(lon) FROM p WHERE p.time = s.time AND p.lat = s.lat AND lon <= g.x) AS a, (SELECT min(lon) FROM p WHERE p.time = s.time AND p.lat = s.lat AND lon >= g.x) AS b FROM s, g)
    SELECT j.time, j.lat, j.x AS lon, round(CASE WHEN a = b THEN pa.value ELSE pa.value + (x - a) * (pb.value - pa.value) / (b - a) END, 6) AS value
    FROM j LEFT JOIN p pa ON pa.time = j.time AND pa.lat = j.lat AND pa.lon = a LEFT JOIN p pb ON pb.time = j.time AND pb.lat = j.lat AND pb.lon = b""")
def regrid_linear(spark: SparkSession, d: str) -> DataFrame:
    """Longitudes regridded to half steps, NULL outside."""
    c = cube(spark, d).withColumn("lon", F.col("lon").cast("double"))
    return rnd(G.regrid_linear(c, ["time", "lat"], "lon", "value", G.target_grid(spark, -0.5, 9.5, 0.5)), "value")


GRID = "CASE f WHEN 5 THEN i + 1 WHEN 7 THEN 8 - i WHEN 9 THEN greatest(i, 2) ELSE i END"


@query(f"""WITH p AS (SELECT l_orderkey % 12 AS f, l_linenumber AS i, min(l_orderkey) AS k FROM lineitem GROUP BY ALL), a AS (SELECT f, list({GRID} ORDER BY i) AS v, min(k) AS k FROM p GROUP BY 1) SELECT 'f' || f AS file FROM a WHERE v <> (SELECT v FROM a ORDER BY k, 'f' || f LIMIT 1)""")
def grid_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Files whose grid differs from the first file's: one is shifted, one reversed, one repeats a value."""
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") % 12).alias("f"), F.col("l_linenumber").alias("i"), "l_orderkey")
    li = li.withColumns({"file": F.concat(F.lit("f"), F.col("f").cast("string")), "level": F.expr(GRID)})
    return G.coordinate_mismatches(li, "file", "level", "i", "l_orderkey")


@query("""WITH RECURSIVE r AS (SELECT s_nationkey AS f, min(s_suppkey) AS low, min(s_suppkey) + (max(s_suppkey) - min(s_suppkey)) // 8 AS high FROM supplier GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY low, f) AS k FROM r),
    w AS (SELECT k, f, high AS e, false AS bad FROM o WHERE k = 1 UNION ALL SELECT o.k, o.f, CASE WHEN o.low <= w.e THEN w.e ELSE o.high END, o.low <= w.e FROM w JOIN o ON o.k = w.k + 1) SELECT f::VARCHAR AS file FROM w WHERE bad""")
def append_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Files that overlap the ranges kept before them."""
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("file"), "s_nationkey").agg(F.min("s_suppkey").alias("a"), F.max("s_suppkey").alias("b"))
    both = s.select("file", F.col("a").alias("t")).unionByName(s.select("file", (F.col("a") + F.floor((F.col("b") - F.col("a")) / 8)).alias("t")))
    return G.overlapping_files(both, "file", "t").select("file")


@query(f"""WITH {CUBE} SELECT lat AS batch, 'lon' AS dim, count(DISTINCT lon) AS size, (SELECT count(DISTINCT lon) FROM cube) AS stored FROM cube WHERE lat % 2 = 0 OR lon < 7 GROUP BY 1 HAVING count(DISTINCT lon) <> (SELECT count(DISTINCT lon) FROM cube)""")
def grid_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Batches whose grid has another size than the store."""
    c = cube(spark, d)
    return G.size_mismatches(c.where((F.col("lat") % 2 == 0) | (F.col("lon") < 7)).withColumn("batch", F.col("lat")), c, "batch", ["lon"])


@query(f"""WITH {CUBE}, t AS (SELECT time, round(avg(value), 6) AS m FROM cube GROUP BY 1), l AS (SELECT DISTINCT lat FROM cube), o AS (SELECT DISTINCT lon FROM cube) SELECT time, lat, lon, m FROM t, l, o""")
def reconcile_dims(spark: SparkSession, d: str) -> DataFrame:
    """A variable without the grid's dimensions repeated over them."""
    c = cube(spark, d)
    t = rnd(c.groupBy("time").agg(F.avg("value").alias("m")), "m")
    return G.reconcile_dims(t, ["time", "lat", "lon"], {"lat": c, "lon": c})


@query(f"""WITH {CUBE}, n AS (SELECT * REPLACE (value * 2 AS value) FROM cube WHERE month(time) = 3) SELECT time, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT * FROM cube WHERE time NOT IN (SELECT time FROM n) UNION ALL SELECT * FROM n) GROUP BY 1""")
def cube_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A cube after time slices were replaced."""
    c = cube(spark, d)
    new = c.where(F.month("time") == 3).withColumn("value", F.col("value") * 2)
    return rnd(G.upsert_times(c, new, "time").groupBy("time").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), "total", digits=4)


@query(f"""WITH {CUBE}, s AS (SELECT DISTINCT lat, lon, lat * 100 + lon AS depth FROM cube), a AS (SELECT time, lat, lon, value FROM cube WHERE time < TIMESTAMP '1998-01-01'),
    b AS (SELECT time, lat, lon, value * 2 AS value FROM cube WHERE month(time) IN (3, 4, 6)), c AS (SELECT time, lat, lon, value * 3 AS value FROM cube WHERE month(time) = 4 AND lat < 5),
    x AS (SELECT * FROM a WHERE time NOT IN (SELECT time FROM b) UNION ALL SELECT * FROM b), y AS (SELECT * FROM x WHERE time NOT IN (SELECT time FROM c) UNION ALL SELECT * FROM c)
    SELECT time, count(*) AS n, round(sum(value), 4) AS total, sum(depth)::BIGINT AS depth FROM y JOIN s USING (lat, lon) GROUP BY 1""")
def stored_cube_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A stored cube after two upserts of runs of times; depths, which have no time, stay as stored."""
    from pelagia.sources import datasets
    from pelagia.sources.scratch import scratch_path

    c = cube(spark, d).select("time", "lat", "lon", "value", (F.col("lat") * 100 + F.col("lon")).alias("floor"), F.year("time").alias("bin"))
    data = datasets.CubeDataset(spark, scratch_path(spark, "grid.cube"))
    data.append(c.where("time < '1998-01-01'"), "bin")
    data.upsert(c.where(F.month("time").isin(3, 4, 6)).withColumns({"value": F.col("value") * 2, "floor": F.lit(-1)}), "bin", static=["floor"])
    data.upsert(c.where((F.month("time") == 4) & (F.col("lat") < 5)).withColumns({"value": F.col("value") * 3, "floor": F.lit(-1)}), "bin", static=["floor"])
    return rnd(data.df.groupBy("time").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.sum("floor").alias("depth")), "total", digits=4)


@query(f"""WITH {CUBE}, t AS (SELECT time, row_number() OVER (ORDER BY time) AS k FROM (SELECT DISTINCT time FROM cube)), c AS (SELECT time, k - row_number() OVER (ORDER BY time) AS g FROM t WHERE month(time) IN (3, 4, 6)),
    r AS (SELECT min(time) AS first, max(time) AS last, count(*) AS times FROM c GROUP BY g) SELECT row_number() OVER (ORDER BY first) AS region, first, last, times, 'floor' AS left_out FROM r""")
def upsert_regions(spark: SparkSession, d: str) -> DataFrame:
    """The regions that an upsert overwrites in a stored cube."""
    from pelagia.sources import datasets
    from pelagia.sources.scratch import scratch_path

    c = cube(spark, d).select("time", "lat", "lon", "value", (F.col("lat") * 100 + F.col("lon")).alias("floor"), F.year("time").alias("bin"))
    data = datasets.CubeDataset(spark, scratch_path(spark, "grid.cube"))
    data.append(c, "bin")
    return data.upsert(c.where(F.month("time").isin(3, 4, 6)), "bin", static=["floor"])


@query("SELECT l_shipdate AS time, count(DISTINCT l_orderkey % 12) AS files FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey % 12) > 1")
def duplicated_times(spark: SparkSession, d: str) -> DataFrame:
    """Times that several files wrote."""
    li = table(spark, d, "lineitem").select(F.col("l_shipdate").alias("time"), (F.col("l_orderkey") % 12).alias("file"))
    return G.duplicated_times(li, "time", "file")


@query(f"WITH {CUBE} SELECT time, lat, lon, CASE WHEN lat <> 3 THEN value END AS value FROM cube")
def cube_delete_file(spark: SparkSession, d: str) -> DataFrame:
    """The values of one source file blanked."""
    from pelagia.sources.store import blank_file

    c = cube(spark, d).withColumn("filename", F.col("lat").cast("string"))
    return blank_file(c, ["value"], "3").select("time", "lat", "lon", "value")


@query(f"WITH {CUBE} SELECT 'time' AS dim, count(DISTINCT time) AS size FROM cube UNION ALL SELECT 'lat', count(DISTINCT lat) FROM cube UNION ALL SELECT 'lon', count(DISTINCT lon) FROM cube")
def cube_shape(spark: SparkSession, d: str) -> DataFrame:
    """The shape of a cube."""
    return extents.shape(cube(spark, d), ["time", "lat", "lon"])
