"""Queries over converted observations, and the quality steps that prepare them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Quality flags of the observations.
FLAGS = {"valid": 0, "suspect": 1, "erroneous": 2, "not checked": 3, "missing": 9}
#: Record status: what supersedes what.
CHECKED, ORIGINAL = 1, 9


def of_station(df: DataFrame, station: str) -> DataFrame:
    return df.where(F.col("station_id") == station)


def after(df: DataFrame, time_column: str, start: datetime, end: datetime | None = None) -> DataFrame:
    """Later than start and, where given, before end; both reach the Parquet scan."""
    t = F.col(time_column)
    df = df.where(t > F.lit(start).cast("timestamp_ntz"))
    return df.where(t < F.lit(end).cast("timestamp_ntz")) if end else df


def with_value(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def summary(df: DataFrame, station: str, time: str) -> DataFrame:
    """(n_rows, n_stations, first_time, last_time)."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(station).alias("n_stations"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def station_counts(df: DataFrame, station: str) -> DataFrame:
    return df.groupBy(station).agg(F.count("*").alias("n_rows"))


def monthly(df: DataFrame, station: str, time: str, value: str, how: str = "mean") -> DataFrame:
    """(station, year, month, mean or total); the total of a group without values is 0."""
    agg = F.avg(value).alias("mean") if how == "mean" else F.coalesce(F.sum(value), F.lit(0.0)).alias("total")
    return df.groupBy(station, F.year(time).alias("year"), F.month(time).alias("month")).agg(agg)


def one_record_each(df: DataFrame, keys: Sequence[str], status: str = "rec_st_ind", version: str | None = "version_num") -> DataFrame:
    """One record for each key: a checked one (status 1) before an original (9), then the highest version.  Records that tie
    in these are taken by their other columns, so that the same one is taken each time."""
    order = [F.col(status).asc_nulls_last()] + ([F.col(version).desc_nulls_last()] if version else [])
    comparable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    order += [F.col(f"`{c}`").asc_nulls_last() for c in comparable if c not in (*keys, status, version)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_flags(df: DataFrame, flag: str, allowed: Sequence[str] = ("valid",)) -> DataFrame:
    return df.where(F.col(flag).isin(*[FLAGS[a] for a in allowed]))


def flag_columns(df: DataFrame, prefix: str = "q_") -> DataFrame:
    """Flags renamed from `x_q` to `q_x`."""
    return df.select(*[F.col(c).alias(prefix + c[:-2]) if c.endswith("_q") else F.col(c) for c in df.columns])


def super_type(types: Sequence[str]) -> str:
    """The type to which columns of one name are cast before a union: the widest number, or string."""
    kinds = [t for t in dict.fromkeys(types) if t != "void"]
    widths = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    if len(kinds) < 2:
        return kinds[0] if kinds else "string"
    if all(t in widths for t in kinds):
        widest = max(kinds, key=widths.index)
        return "double" if widest == "float" and {"int", "bigint"} & set(kinds) else widest
    if set(kinds) <= {"date", "timestamp_ntz"}:
        return "timestamp_ntz"
    return "string"


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of the parts by column names, each column in the super-type of its types, NULL where a part lacks it."""
    types: dict[str, list[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            types.setdefault(name, []).append(kind)
    whole = {name: super_type(kinds) for name, kinds in types.items()}
    have = [set(part.columns) for part in parts]
    cast = [part.select(*[(F.col(f"`{n}`") if n in own else F.lit(None)).cast(t).alias(n) for n, t in whole.items()]) for part, own in zip(parts, have)]
    out = cast[0]
    for part in cast[1:]:
        out = out.unionByName(part)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """(column) with each value once, NULL left out."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def within_bounds(df: DataFrame, **bounds: tuple[float | None, float | None]) -> DataFrame:
    """Rows whose columns lie in their bounds, both included; None leaves a side open.  A row without value is outside."""
    for name, (low, high) in bounds.items():
        if low is not None:
            df = df.where(F.col(name) >= low)
        if high is not None:
            df = df.where(F.col(name) <= high)
    return df


def with_registry(df: DataFrame, stations: DataFrame, key: str, limit: int = 200_000) -> DataFrame:
    """Left join with a station registry; it is broadcast up to `limit` rows, and joined by a shuffle beyond."""
    small = stations.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(stations) if small else stations, key, "left")


def long_view(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(ids, metric, value), a row for each metric; rows without a value stay."""
    return df.select(*ids, *[F.col(m).cast("double") for m in metrics]).unpivot(list(ids), list(metrics), "metric", "value")


def measurements(df: DataFrame, metrics: Sequence[str]) -> Column:
    """The metrics as a map by name."""
    return F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics]))


#: Rows of a file whose order one task checks.
RUN = 1 << 20


def order_violations(df: DataFrame, station: str, time: str, file: Column | None = None, row: Column | None = None) -> DataFrame:
    """(file, n_station, n_time, first_station, last_station, n_between): in each file, rows whose station or whose time in
    the station is before that of the row before; n_between is 1 where a file's first row is before the last one of the file
    before it by name.  Rows of a file come in its physical order; nulls are last.  A file is checked in runs of RUN rows,
    of which only the ends meet."""
    file = F.col("_metadata.file_path") if file is None else file
    row = F.col("_metadata.row_index") if row is None else row
    d = df.select(file.alias("file"), row.alias("row"), F.col(station).alias("s"), F.col(time).alias("t"))
    d = d.withColumn("run", F.floor(F.col("row") / RUN)).withColumn("x", F.struct("s", "t"))
    before = F.lag("x").over(Window.partitionBy("file", "run").orderBy("row"))
    d = d.withColumn("p", before)
    ends = [F.min_by("x", "row").alias("first"), F.max_by("x", "row").alias("last")]
    runs = d.groupBy("file", "run").agg(*[F.count_if(c).alias(n) for n, c in zip(("n_station", "n_time"), _back("p", "x"))], *ends)
    runs = runs.withColumn("p", F.lag("last").over(Window.partitionBy("file").orderBy("run")))
    station_back, time_back = _back("p", "first")
    files = runs.groupBy("file").agg(
        (F.sum("n_station") + F.count_if(station_back)).alias("n_station"),
        (F.sum("n_time") + F.count_if(time_back)).alias("n_time"),
        F.min_by("first", "run").alias("first"),
        F.max_by("last", "run").alias("last"),
    )
    files = files.withColumn("p", F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("file")))  # a row a file
    station_back, time_back = _back("p", "first")
    between = F.coalesce(station_back | time_back, F.lit(False)).cast("int")
    return files.select("file", "n_station", "n_time", F.col("first.s").alias("first_station"), F.col("last.s").alias("last_station"), between.alias("n_between"))


def _back(p: str, x: str) -> tuple[Column, Column]:
    """Whether the station of x is before that of p, and whether the time of x is where the stations are the same."""
    s, t, ps, pt = F.col(f"{x}.s"), F.col(f"{x}.t"), F.col(f"{p}.s"), F.col(f"{p}.t")
    there = F.col(p).isNotNull()
    return there & ((s < ps) | (ps.isNull() & s.isNotNull())), there & s.eqNullSafe(ps) & ((t < pt) | (pt.isNull() & t.isNotNull()))


def sort_nulls_last(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
