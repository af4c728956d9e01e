"""The station registry: records of the files under <dataset>/capability, at any depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lenient import NA_STRINGS, typed
from ..plans.spec import type_of
from . import badc
from .discovery import exists

CAPABILITY = "capability"
# Fixed value: status of the records that describe a station.
REGISTERED = 9


def capability(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Headers and lines of all capability files of some datasets, as badc.headers has them; without any, no columns."""
    folders = [f"{r.rstrip('/')}/{CAPABILITY}" for r in roots if exists(spark, f"{r.rstrip('/')}/{CAPABILITY}")]
    if not folders:
        return spark.createDataFrame([], "path string")
    return badc.parsed_below(spark, folders)


def registry(spark: SparkSession, roots: Sequence[str], columns: Sequence[str] = ("src_id", "rec_st_ind"), na_strings: Sequence[str] = NA_STRINGS) -> DataFrame:
    """One row a station, by src_id: header columns and `columns` of its records with rec_st_ind = 9; of several the last
    by path and line.  A dataset without capability files adds none."""
    found = capability(spark, roots)
    if "cols" not in found.columns:
        types = ", ".join(f"{c} {type_of(c)}" for c in columns)
        return spark.createDataFrame([], f"{types}, station_id string, station_name string, county string, latitude double, longitude double, height double, height_units string")
    good = found.where(F.col("status") == badc.OK)
    rows = good.select("path", *badc.STATION_COLUMNS, "cols", F.posexplode("rows").alias("line", "row"))
    rows = rows.withColumn("vals", F.transform(F.split("row", ","), lambda x: F.trim(x)))
    out = rows.select("path", "line", *[_field(c, na_strings) for c in columns], *badc.STATION_COLUMNS).where(F.col("rec_st_ind") == REGISTERED)
    key = columns[0]
    last = F.max_by(F.struct(*[c for c in out.columns if c not in ("path", "line", key)]), F.struct("path", "line"))
    return out.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("r")).select(key, "r.*")


def _field(name: str, na_strings: Sequence[str]) -> Column:
    return typed(badc.raw(name), type_of(name), na_strings).alias(name)
