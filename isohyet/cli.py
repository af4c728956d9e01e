"""Command line: convert, discover, merge, validate, list."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .errors import IsohyetError
from .operators.convert import Converter, Options
from .operators.validate import Limits, Validator, report_summary
from .plans.spec import Kind, kind_of
from .settings import settings
from .sinks.parquet import ParquetOptions, codec, merge, report_json
from .sources.discovery import datasets


def cache_dir(given: str | None = None) -> str:
    """Where fetched datasets lie: the setting `cache`, or a folder of the user's data."""
    data = os.environ.get("XDG_DATA_HOME") or os.path.expanduser("~/.local/share")
    return given or os.environ.get("ISOHYET_CACHE") or f"{data}/isohyet/cache"


def pick(spark: SparkSession, cache: str) -> str:
    found = datasets(spark, cache)
    for i, d in enumerate(found, 1):
        print(f"{i}. {d.name} ({d.size})")
    n = int(input(f"dataset (1-{len(found)}): "))
    if not 1 <= n <= len(found):
        raise IsohyetError(f"no dataset {n}")
    return found[n - 1].path


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="isohyet", description="BADC-CSV weather observations to sorted Parquet")
    p.add_argument("dataset", nargs="?", help="folder of the dataset; asked for if left out")
    p.add_argument("-o", "--output-path")
    p.add_argument("--discovery-only", action="store_true", help="tell the schema, write nothing")
    p.add_argument("--compression")
    p.add_argument("--empty-columns", choices=("exact", "sample", "off"))
    p.add_argument("--sample-files", type=int)
    p.add_argument("--files-per-task", type=int)
    p.add_argument("--schema-variance", type=int)
    p.add_argument("--cache", help="folder of the datasets to pick from")
    p.add_argument("--row-groups", choices=("fixed", "adaptive", "station"))
    p.add_argument("--layout", choices=("file", "directory"))
    p.add_argument("--test-merge", metavar="FOLDER", help="merge a folder of Parquet files into the output")
    p.add_argument("--validate", metavar="PARQUET", help="check a converted file")
    p.add_argument("--report", help="file for the JSON report of --validate")
    p.add_argument("-v", "--verbose", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("isohyet").getOrCreate()
    spark.sparkContext.setLogLevel("INFO" if a.verbose else "ERROR")
    try:
        given = ("cache", "output_path", "compression", "empty_columns", "row_groups", "layout", "sample_files", "files_per_task", "schema_variance")
        s = settings({n: getattr(a, n) for n in given})
        name, warning = codec(s.compression)
        if warning:
            print(warning, file=sys.stderr)
        parquet = ParquetOptions(compression=name if name != "lz4_raw" else "lz4")
        if a.validate:
            report = Validator(spark, a.validate, kind_of(a.validate), a.dataset, Limits()).report().cache()
            report.select("test_name", "passed", "message").show(50, truncate=80)
            if a.report:
                report_json(report, a.report if "/" in a.report else f"tests/{a.report}")
            return int(report_summary(report).first()["failed"] > 0)
        if a.test_merge:
            kind = kind_of(a.test_merge) if any(k.value in a.test_merge.lower() for k in Kind) else None
            cols = spark.read.parquet(a.test_merge).columns
            time = next((c for c in ([kind.time_column] if kind else ["ob_end_time", "ob_end_ctime"]) if c in cols), None)
            print(merge(spark, a.test_merge, s.output_path or "merged.parquet", ["station_id"] + ([time] if time else []), parquet), "rows")
            return 0
        path = a.dataset or pick(spark, cache_dir(s.cache))
        options = Options(parquet=parquet, empty_columns=s.empty_columns, sample_files=s.sample_files, row_groups=s.row_groups, layout=s.layout, files_per_task=s.files_per_task, schema_variance=s.schema_variance)
        job = Converter(spark, path, s.output_path, options)
        if a.discovery_only:
            print(job.discovered())
            return 0
        stats = job.run()
        for warning in stats.warnings:
            print(f"warning: {warning}", file=sys.stderr)
        print(stats)
        return 0
    except IsohyetError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
