"""Checks of a converted file or folder; each check is a row of the report."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lenient import whole_days
from ..plans.spec import STATION_COLUMNS, Kind, Width
from ..sources.discovery import _fs, csv_files
from ..sources.footers import column_chunks, file_metadata, footer_summary, part_files
from . import observations as obs

REPORT = "test_name string, passed boolean, message string, details map<string,string>, duration_ms double"
DAYS_A_YEAR = 365.25


@dataclass(frozen=True)
class Limits:
    """Bounds of the checks; the defaults are those of full datasets."""

    least_bytes: int = 1024
    rows_per_file: tuple[float, float] = (1000, 20_000)
    stations: tuple[int, int] = (50, 1000)
    columns: tuple[int, int] = (10, 50)
    group_rows: tuple[float, float] = (100_000, 2_000_000)
    station_query_ms: float = 1000
    time_query_ms: float = 2000
    both_query_ms: float = 1000


Result = tuple[bool, str, dict]


class Validator:
    def __init__(self, spark: SparkSession, path: str, kind: Kind, source: str | None = None, limits: Limits = Limits()) -> None:
        self.spark, self.path, self.kind, self.source, self.limits = spark, path, kind, source, limits
        self.df = spark.read.parquet(path)
        self.time = kind.time_in(self.df.columns) or kind.time_column

    def checks(self) -> Iterator[tuple[str, Callable[[], Result]]]:
        yield "file_size", self.file_size
        if self.source:
            yield "source_files", self.source_files
            yield "rows_per_file", self.rows_per_file
        yield "stations", self.stations
        yield "date_span", self.date_span
        yield "required_columns", self.required_columns
        yield "column_types", self.column_types
        yield "column_count", self.column_count
        yield "schema_width", self.schema_width
        yield "station_order", self.station_order
        yield "time_order", self.time_order
        yield "metadata", self.metadata
        yield "row_groups", self.row_groups
        yield "one_codec", self.one_codec
        yield "statistics", self.statistics
        yield "station_query", self.station_query
        yield "time_query", self.time_query
        yield "station_time_query", self.both_query
        yield "group_query", self.group_query

    def report(self) -> DataFrame:
        """A row for each check; a check that raises has failed."""
        rows = []
        for name, check in self.checks():
            began = time.monotonic()
            try:
                passed, message, details = check()
            except Exception as e:  # a report goes on
                passed, message, details = False, f"{type(e).__name__}: {e}"[:500], {}
            rows.append((name, bool(passed), message, {k: str(v) for k, v in details.items()}, (time.monotonic() - began) * 1000))
        return self.spark.createDataFrame(rows, REPORT)

    # ---------------------------------------------------------------------------------------------------------- checks

    # what several checks look at is looked up once

    @cached_property
    def _parts(self) -> list[str]:
        return part_files(self.spark, self.path)

    def file_size(self) -> Result:
        size = sum(_fs(self.spark, p)[0].getFileStatus(_fs(self.spark, p)[1]).getLen() for p in self._parts)
        return size >= self.limits.least_bytes, f"{size} bytes", {"bytes": size}

    @cached_property
    def _n_sources(self) -> int:
        return csv_files(self.spark, self.source).count()

    def source_files(self) -> Result:
        n = self._n_sources
        return n >= 1, f"{n} files", {"files": n}

    def rows_per_file(self) -> Result:
        n = self._n_sources
        mean = self._summary["n_rows"] / n if n else 0
        low, high = self.limits.rows_per_file
        return low <= mean <= high, f"{mean:.1f} rows a file", {"rows_per_file": mean}

    @cached_property
    def _summary(self):
        return obs.summary(self.df, "station_id", self.time).first()

    def stations(self) -> Result:
        n = self._summary["n_stations"]
        low, high = self.limits.stations
        return low <= n <= high, f"{n} stations", {"stations": n}

    def date_span(self) -> Result:
        ends = self.spark.createDataFrame([(self._summary["first_time"], self._summary["last_time"])], "a timestamp_ntz, b timestamp_ntz")
        years = ends.select(whole_days(F.col("a"), F.col("b")).alias("d")).first()["d"]
        return years is not None, f"{(years or 0) / DAYS_A_YEAR:.1f} years", {"years": (years or 0) / DAYS_A_YEAR}

    def required_columns(self) -> Result:
        missing = {*STATION_COLUMNS, self.time} - set(self.df.columns)
        return not missing, "missing: " + ", ".join(sorted(missing)) if missing else "all there", {"missing": sorted(missing)}

    def column_types(self) -> Result:
        want = {"station_id": "string", "latitude": "double", "longitude": "double", "height": "double", self.time: "timestamp_ntz"}
        wrong = {n: t for n, t in self.df.dtypes if n in want and t != want[n]}
        return not wrong and want.keys() <= dict(self.df.dtypes).keys(), f"wrong: {wrong}" if wrong else "as they should be", wrong

    def column_count(self) -> Result:
        low, high = self.limits.columns
        return low <= len(self.df.columns) <= high, f"{len(self.df.columns)} columns", {"columns": len(self.df.columns)}

    def schema_width(self) -> Result:
        """Never fails: a width that is not the kind's usual one is told."""
        columns = [c for c in self.df.columns if c not in STATION_COLUMNS]
        width = Width.of(self.kind, columns)
        return True, str(width) if width else f"{len(columns)} columns, as expected", {"columns": len(columns)}

    @cached_property
    def _violations(self):
        found = obs.order_violations(self.df, "station_id", self.time)
        return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_station", "n_time", "n_between")]).first()

    def station_order(self) -> Result:
        inside, between = self._violations["n_station"], self._violations["n_between"]
        more = f", {between} files before the last row of the one before" if between else ""
        return inside == between == 0, f"{inside} rows out of order{more}", {"violations": inside, "between_files": between}

    def time_order(self) -> Result:
        n = self._violations["n_time"]
        return n == 0, f"{n} rows out of order", {"violations": n}

    def metadata(self) -> Result:
        fs, p = _fs(self.spark, self.path)
        if fs.getFileStatus(p).isFile():
            told = file_metadata(self.spark, self.path)
        else:
            stream = fs.open(_fs(self.spark, f"{self.path}/_dataset.json")[1])
            told = json.loads(bytes(stream.readAllBytes()))
            stream.close()
        missing = {"created_by", "created_at", "repository"} - told.keys()
        if missing:
            return False, "missing: " + ", ".join(sorted(missing)), {}
        datetime.fromisoformat(told["created_at"].replace("Z", "+00:00"))
        return " v" in told["created_by"], told["created_by"], {k: told[k] for k in ("created_by", "created_at", "repository")}

    @cached_property
    def _footer(self):
        return footer_summary(column_chunks(self.spark, self.path)).first()

    def row_groups(self) -> Result:
        f = self._footer
        low, high = self.limits.group_rows
        return low <= (f["mean"] or 0) <= high, f"{f['n_groups']} groups of {f['mean']} rows", {k: f[k] for k in ("n_groups", "least", "most", "mean")}

    def one_codec(self) -> Result:
        codecs = self._footer["codecs"]
        return len(codecs) == 1, ", ".join(codecs), {"codecs": codecs}

    def statistics(self) -> Result:
        has = self._footer["all_statistics"]
        return bool(has), "in all column chunks" if has else "missing", {}

    def _timed(self, df: DataFrame, limit_ms: float) -> Result:
        began = time.monotonic()
        n = df.count()
        took = (time.monotonic() - began) * 1000
        return took < limit_ms, f"{n} rows in {took:.0f} ms", {"rows": n, "ms": round(took)}

    def _a_station(self) -> str:
        return self.df.select("station_id").limit(1).first()[0]

    def _a_time(self) -> datetime:
        return self._summary["first_time"]

    def station_query(self) -> Result:
        return self._timed(obs.of_station(self.df, self._a_station()), self.limits.station_query_ms)

    def time_query(self) -> Result:
        return self._timed(obs.after(self.df, self.time, self._a_time()).limit(10_000), self.limits.time_query_ms)

    def both_query(self) -> Result:
        return self._timed(obs.after(obs.of_station(self.df, self._a_station()), self.time, self._a_time()), self.limits.both_query_ms)

    def group_query(self) -> Result:
        r = obs.station_counts(self.df, "station_id").agg(F.count("*").alias("n"), F.avg("n_rows").alias("mean")).first()
        return True, f"{r['n']} stations, {r['mean']} rows each", {"groups": r["n"], "mean": r["mean"]}


def report_summary(report: DataFrame) -> DataFrame:
    """(total, passed, failed, success_rate, duration_ms)."""
    passed = F.count_if("passed")
    return report.agg(F.count("*").alias("total"), passed.alias("passed"), F.count_if(~F.col("passed")).alias("failed"), (passed / F.greatest(F.count("*"), F.lit(1)) * 100).alias("success_rate"), F.sum("duration_ms").alias("duration_ms"))
