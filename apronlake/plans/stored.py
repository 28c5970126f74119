"""Tables of the warehouse that queries share: built from the given tables once an application, then read.

Each lies in the shared scratch folder until the application ends; a table that is gone is
built again. They are what a scheduled build would leave in the warehouse.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from apronlake.operators import rates as R
from apronlake.operators.scratch import scratch_path, until_end
from apronlake.sources.commits import file_system
from apronlake.sources.tables import read_clustered, write_clustered

from . import fixtures as X
from . import marts as M

_BUILT: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, d: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table that ``write`` makes where it is not there yet."""
    key = spark.sparkContext.applicationId, d, name
    if key in _BUILT:
        fs, make = file_system(spark, _BUILT[key])
        if fs.exists(make(f"{_BUILT[key]}/_SUCCESS")):
            return _BUILT[key]
    path = scratch_path(spark, name)
    write(path)
    _BUILT[key] = until_end(spark, path)
    return path


def spine(spark: SparkSession, d: str, lo: str | None = None, hi: str | None = None, **equal) -> DataFrame:
    """Legs of the long table by month, clustered by origin and carrier; filters reach the files."""
    path = _once(spark, d, "spine", lambda p: write_clustered(X.legs_big(spark, d), p, "leg_date", ["origin", "carrier"]))
    return read_clustered(spark, path, "leg_date", lo, hi, **equal)


def time_slices(spark: SparkSession, d: str, origin: str | None = None, carrier: str | None = None) -> DataFrame:
    """The slice mart, one or all origins and carriers of it."""
    path = _once(spark, d, "time-slices", lambda p: M.time_slice_mart(X.legs_big(spark, d)).repartitionByRange("origin", "carrier").sortWithinPartitions("origin", "carrier").write.parquet(p))
    x = spark.read.parquet(path)
    for c, v in (("origin", origin), ("carrier", carrier)):
        x = x.where(x[c] == v) if v is not None else x
    return x


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Decoded observations, one for a station and time."""
    return spark.read.parquet(_once(spark, d, "observations", lambda p: M.decoded_observations(X.observations(spark, d)).write.parquet(p)))


def rates(spark: SparkSession, d: str) -> DataFrame:
    """Smoothed rates of the rotation's grains as of the cutoff."""
    return spark.read.parquet(_once(spark, d, "rates", lambda p: R.smoothed_rates(rotation(spark, d), R.GRAINS, X.CUTOFF).coalesce(1).write.parquet(p)))


def entity_profile(spark: SparkSession, d: str) -> DataFrame:
    """Constants of entities."""
    return spark.read.parquet(_once(spark, d, "profile", lambda p: M.entity_profile(X.legs(spark, d)).coalesce(1).write.parquet(p)))


def density_profile(spark: SparkSession, d: str) -> DataFrame:
    """Median density of schedule hours before the cutoff."""
    return spark.read.parquet(_once(spark, d, "density", lambda p: M.density_profile(rotation(spark, d), X.CUTOFF).coalesce(1).write.parquet(p)))


def typical_rotation(spark: SparkSession, d: str) -> DataFrame:
    """One row of medians before the cutoff."""
    return spark.read.parquet(_once(spark, d, "typical", lambda p: M.typical_rotation(rotation(spark, d), X.CUTOFF).write.parquet(p)))


def rotation(spark: SparkSession, d: str) -> DataFrame:
    """Legs with their chain."""
    return spark.read.parquet(_once(spark, d, "rotation", lambda p: M.rotation_mart(spark, d).write.parquet(p)))
