"""Sorted Parquet output with chosen codec, statistics, row groups and footer metadata."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from struct import pack

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.discovery import _fs
from ..sources.footers import MAGIC, footer_bytes, with_key_values

VERSION = "0.1.0"
# Codecs by the names that users give.
CODECS = {"snappy": "snappy", "zstd": "zstd", "lz4": "lz4_raw", "none": "none", "uncompressed": "none"}


def codec(name: str) -> tuple[str, str | None]:
    """The writer's codec, and a warning if the name is unknown."""
    found = CODECS.get(name.lower())
    return (found, None) if found else ("snappy", f"unknown codec {name!r}, using snappy")


@dataclass(frozen=True)
class ParquetOptions:
    compression: str = "snappy"
    statistics: bool = True
    rows_per_group: int = 500_000
    page_bytes: int = 1 << 20
    dictionary: bool = True
    bloom_columns: tuple[str, ...] = ()
    #: "file" (one sorted file), "directory" (sorted files of successive ranges)
    layout: str = "file"
    files: int | None = None
    partition_by: tuple[str, ...] = ()
    #: time column whose year becomes a column to partition by, before partition_by
    year_of: str | None = None

    def with_(self, **changes) -> ParquetOptions:
        return replace(self, **changes)


def sorted_rows(df: DataFrame, keys: list[str], options: ParquetOptions) -> DataFrame:
    """Ascending, nulls last; ranges are dealt by all keys, so one station can go to several files."""
    by = [F.col(k).asc_nulls_last() for k in keys]
    if options.layout == "file":
        return df.repartition(1).sortWithinPartitions(*by)
    if options.partition_by:
        return df.repartitionByRange(*([options.files] if options.files else []), *options.partition_by, *by).sortWithinPartitions(*options.partition_by, *by)
    return df.repartitionByRange(*([options.files] if options.files else []), *by).sortWithinPartitions(*by)


def write(df: DataFrame, path: str, keys: list[str], options: ParquetOptions = ParquetOptions(), metadata: dict[str, str] | None = None) -> int:
    """Writes df sorted by keys; the number of rows, counted by the same job that writes."""
    if options.year_of:
        df = df.withColumn("year", F.year(options.year_of))
        options = options.with_(partition_by=("year", *options.partition_by), year_of=None, layout="directory")
    seen = Observation()
    rows = sorted_rows(df, keys, options).observe(seen, F.count(F.lit(1)).alias("n"))
    out = path if options.layout != "file" else f"{path}.{uuid.uuid4().hex}"
    writer = rows.write.mode("overwrite").option("compression", codec(options.compression)[0])
    for key, value in {
        "parquet.column.statistics.enabled": str(options.statistics).lower(),
        "parquet.block.row.count.limit": options.rows_per_group,
        "parquet.page.size": options.page_bytes,
        "parquet.enable.dictionary": str(options.dictionary).lower(),
        **{f"parquet.bloom.filter.enabled#{c}": "true" for c in options.bloom_columns},
    }.items():
        writer = writer.option(key, value)
    if options.partition_by:
        writer = writer.partitionBy(*options.partition_by)
    writer.parquet(out)
    told = footer_metadata() | (metadata or {})
    if options.layout == "file":
        promote(df.sparkSession, out, path, told)
    else:
        fs, p = _fs(df.sparkSession, f"{path}/_dataset.json")
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(told).encode()))
        stream.close()
    return seen.get["n"]


def footer_metadata() -> dict[str, str]:
    return {"created_by": f"isohyet v{VERSION}", "created_at": datetime.now(UTC).isoformat(), "repository": "isohyet"}


def promote(spark, folder: str, path: str, metadata: dict[str, str]) -> None:
    """The one part file of a folder becomes the file at path, with metadata in its footer.

    Its pages, indexes and statistics are copied as bytes, and the file that was there stays until the copy is complete.
    """
    fs, p = _fs(spark, f"{folder}/part-*.parquet")
    part = fs.globStatus(p)[0].getPath()
    begin, footer = footer_bytes(spark, part.toString())
    footer = with_key_values(footer, metadata)
    new = _fs(spark, f"{folder}/whole")[1]
    source, target = fs.open(part), fs.create(new, True)
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, target, begin, False)
    target.write(bytearray(footer + pack("<I", len(footer)) + MAGIC))
    target.close()
    source.close()
    whole = _fs(spark, path)[1]
    fs.mkdirs(whole.getParent())
    fs.delete(whole, True)
    fs.rename(new, whole)
    fs.delete(_fs(spark, folder)[1], True)


def merge(spark, source: str, path: str, keys: list[str], options: ParquetOptions = ParquetOptions()) -> int:
    """One sorted output from a folder of Parquet files; options hold as for any other output."""
    return write(spark.read.parquet(source), path, keys, options)


def report_json(df: DataFrame, path: str) -> None:
    """Rows of a (small) report as a JSON array, in any store."""
    fs, p = _fs(df.sparkSession, path)
    stream = fs.create(p, True)
    stream.write(bytearray(json.dumps([json.loads(x) for x in df.toJSON().collect()], indent=1).encode()))
    stream.close()
