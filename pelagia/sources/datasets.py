"""Datasets by name: one facade over tabular tables and long cubes, every method a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.operators import extents, select, series
from pelagia.operators.prefix import running
from pelagia.sources.files import key_table, list_datasets, partition_values, read_parquet
from pelagia.sources.scratch import path_exists, written
from pelagia.sources.store import upsert, write_table


class Dataset:
    """A table of observations; `settings` may name its columns, its period and its cell size."""

    layout = "table"

    def __init__(self, spark: SparkSession, path: str, settings: dict | None = None):
        self.spark, self.path, self.settings = spark, path, settings or {}

    @property
    def df(self) -> DataFrame:
        """The lazily opened table; keys are typed, polygons stay text."""
        df = read_parquet(self.spark, self.path)
        return df.withColumn("timestamp", F.col("timestamp").cast("long")) if "timestamp" in df.columns else df

    def column(self, role: str) -> str:
        return self.settings.get(role) or select.coordinate(self.df, role, self.layout)

    def get_data(self, start=None, end=None, box=None, scalars=None, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.df
        cells = ("cell_lat", "cell_lon", self.settings["delta"]) if "cell_lat" in df.columns and "delta" in self.settings else None
        key = "timestamp" if "timestamp" in df.columns and "period" in self.settings else None
        place = {"lat": self.column("LATITUDE"), "lon": self.column("LONGITUDE")} if box is not None else {}
        known = key_table(self.spark, self.path, "cell_lat", "cell_lon") if cells and box is not None else None
        return select.get_data(df, start, end, box, scalars, columns, time=self.column("TIME"), key=key, period=self.settings.get("period", "M"), cells=cells, known=known, checked=True, **place)

    def temporal_extent(self) -> DataFrame:
        df = self.df
        return extents.exact_extent(df, self.column("TIME")) if "timestamp" in df.columns else extents.time_extent(df, self.column("TIME"))

    def spatial_extent(self) -> DataFrame:
        return extents.spatial_extent(self.df, self.column("LATITUDE"), self.column("LONGITUDE"))

    def unique_values(self, key: str) -> DataFrame:
        """Distinct values of a column; of a partition key from the paths, without reading data."""
        kind = self.df.schema[key].dataType
        found = partition_values(self.spark, self.path, key).where(F.col(key).isNotNull()).select(F.col(key).cast(kind))
        return self.df.select(key).distinct() if found.isEmpty() else found

    def describe(self) -> list[tuple[str, str, str]]:
        return extents.describe(self.df, self.path.rstrip("/").split("/")[-1])

    def point_series(self, *args, **kwargs) -> DataFrame:
        raise NotImplementedError("point series are taken from cubes")


class CubeDataset(Dataset):
    """A long cube table: a row per cell and time."""

    layout = "cube"

    def get_data(self, start=None, end=None, box=None, scalars=None, columns=None, mask=None) -> DataFrame:
        a, b, c, d = box or (None,) * 4
        time, lat, lon = (self.column(r) for r in ("TIME", "LATITUDE", "LONGITUDE"))
        out = select.get_cube(self.df, time, lat, lon, start, end, a, b, c, d, scalars, mask)
        return out.select(*columns) if columns else out

    def point_series(self, lat: float, lon: float, start, end, variables=None) -> DataFrame:
        return series.point_series(self.df, self.column("TIME"), self.column("LATITUDE"), self.column("LONGITUDE"), lat, lon, start, end, variables)

    def append(self, new: DataFrame, bin_: str) -> None:
        """Creates the cube, or appends the cells of times that it lacks, partitioned by a coarse time bin and sorted by time; a cell that comes twice is stored once."""
        time = select.coordinate(new, "TIME", self.layout) if "TIME" not in self.settings else self.settings["TIME"]
        dims = [c for c in (time, *(self._dims(new))) if c in new.columns]
        cells = new.dropDuplicates(dims)
        there = path_exists(self.spark, self.path)
        if there:
            cells = cells.join(self.df.select(time).distinct(), time, "left_anti").select(*new.columns)
        write_table(cells, self.path, [bin_], [time], mode="append")

    def _dims(self, df: DataFrame) -> list[str]:
        """The columns of place and depth that a frame has."""
        known = [c for role in ("LATITUDE", "LONGITUDE", "DEPTH") for c in (self.settings.get(role), *select.CANDIDATES["cube"][role])]
        return [c for c in dict.fromkeys(known) if c in df.columns]

    def upsert(self, new: DataFrame, bin_: str, static: Sequence[str] = ()) -> DataFrame:
        """Cells of stored times are overwritten, others appended; returns (region, first, last, times, left_out) of what was overwritten.

        A region is a run of stored times, consecutive in the store, that all come again.
        Variables without the append dimension (`static`) are no part of a region: they
        are left out of `new`, keep what the store holds for their place, and are reported.
        Of cells that come twice one is taken.  Only bins that hold such times, or get new
        ones, are rewritten.
        """
        time = self.column("TIME")
        places = self._dims(new)
        cells = new.dropDuplicates([time, *places]).drop(*static)
        held = [c for c in static if c in self.df.columns]
        if held:
            cells = cells.join(self.df.select(*places, *held).groupBy(*places).agg(*[F.max(c).alias(c) for c in held]), places, "left")
        stored = running(self.df.select(time).distinct(), [time], F.lit(1)).select(time, F.col("__sum").alias("place"))
        common = running(stored.join(new.select(time).distinct(), time, "left_semi"), [time], F.lit(1)).withColumn("island", F.col("place") - F.col("__sum"))
        regions = common.groupBy("island").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("times"))
        report = written(running(regions, ["first"], F.lit(1)).select(F.col("__sum").alias("region"), "first", "last", "times", F.lit(",".join(static)).alias("left_out")), "regions")
        upsert(self.spark, self.path, written(cells, "cells"), [bin_], time, [time])
        return report


#: Extensions of dataset names and what opens each.
KINDS = {".parquet": Dataset, ".cube": CubeDataset}


def open_dataset(spark: SparkSession, root: str, name: str, settings: dict | None = None) -> Dataset:
    for suffix, kind in KINDS.items():
        if name.endswith(suffix):
            return kind(spark, f"{root.rstrip('/')}/{name}", settings)
    raise ValueError(f"{name}: a name ends in one of {sorted(KINDS)}")


def catalogue_list(spark: SparkSession, root: str, suffix: str | None = None, prefix: str = "") -> DataFrame:
    """Names of the datasets under a root, by extension and prefix, sorted."""
    return list_datasets(spark, root, suffix).where(F.col("dataset").startswith(prefix)).orderBy("dataset")
