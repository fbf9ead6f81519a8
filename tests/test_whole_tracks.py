"""Tracks and units of all platforms."""

from datetime import datetime, timedelta

from pelagia.operators import windows
from pelagia.plans.registry import QUERIES

T0 = datetime(2024, 1, 1, 6)


def test_track_has_a_row_per_position(spark):
    rows = [(u, T0 + timedelta(hours=9 * k), float(k), float(-k)) for u in (1, 2) for k in (3, 0, 2, 1)]
    df = spark.createDataFrame(rows, "u long, ts timestamp, y double, x double")
    got = sorted((r["u"], r["place"], r["lat"], r["lon"], r["day"].day) for r in windows.cumulative_track(df, "u", "ts", "y", "x").collect())
    assert got == [(u, k + 1, float(k), float(-k), (T0 + timedelta(hours=9 * k)).day) for u in (1, 2) for k in range(4)]
    points = sorted((r["u"], r["day"].day, r["points"]) for r in windows.track_points(df, "u", "ts").collect())
    assert points == [(1, 1, 2), (1, 2, 4), (2, 1, 2), (2, 2, 4)]


def test_unit_is_chosen_from_all_platforms(spark, tmp_path):
    rows = [(k, T0 + timedelta(days=40 * k), 1, "click", 1.0, "") for k in range(3)]
    rows += [(10 + k, T0 + timedelta(minutes=30 * k), 9, "click", float(k), "") for k in range(8)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    df.write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["auto_band"](spark, str(tmp_path)).where("user_id = 9").orderBy("bin").collect()
    assert [r["bin"].hour for r in got] == [6, 7, 8, 9] and [r["mean"] for r in got] == [0.5, 2.5, 4.5, 6.5]
