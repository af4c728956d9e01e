"""New station files as they arrive: a file stream whose batches are appended as sorted Parquet."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import OK
from ..functions.lenient import NA_STRINGS
from ..plans.spec import STATION_COLUMNS, Kind, Schema
from ..sources import badc, parsing
from ..sources.discovery import QC_DIR, _fs, few_listings, mounted

#: Number of paths from which Spark lists the files of a batch by a job, and whether it does without their blocks' places.
LISTING, LOCALITY = "spark.sql.sources.parallelPartitionDiscovery.threshold", "spark.sql.sources.ignoreDataLocality"
#: Files for each task that reads those of all batches, and tasks at most.
TASK_FILES, MOST_TASKS = 200, 10_000


class Ingest:
    """A stream whose batches are written together when it has ended.

    What is in which batch is settled by the stream's checkpoint.  Batches whose outcomes are not there are written, those
    that an earlier run took and did not come to write as well.
    """

    def __init__(self, query: StreamingQuery, write) -> None:
        self._query, self._write = query, write

    def __getattr__(self, name: str):
        return getattr(self._query, name)

    def awaitTermination(self, timeout: float | None = None) -> bool | None:  # noqa: N802
        ended = self._query.awaitTermination(timeout)
        if timeout is None or ended:
            self._write()
        return ended

    def processAllAvailable(self) -> None:  # noqa: N802
        self._query.processAllAvailable()
        self._write()


def stream(spark: SparkSession, root: str, output: str, schema: Schema, kind: Kind, *, checkpoint: str, files_per_batch: int = 1000, na_strings=NA_STRINGS) -> StreamingQuery | Ingest:
    """Appends the observations of new files under root to output; schema is fixed, other columns of files are left out.
    What became of each file is a row of <output>.outcomes: path, status, error, n_rows, and the columns that were left out.

    A batch that is run again after a failure replaces its own folder, so each file is there once.  Where the file system is
    mounted, the batches are written together, by one plan, and are there when awaitTermination() returns.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.csv").load(f"{root}/{QC_DIR}/*/*/")

    def start(append) -> StreamingQuery:
        return files.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def append(batch: DataFrame, number: int) -> None:
        text = F.decode("content", "UTF-8")
        lines = F.split(text, "\r?\n")
        lines = F.when(F.try_element_at(lines, F.lit(-1)) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
        good = F.is_valid_utf8(F.col("content").cast("string"))
        parsed = badc.headers(batch.select("path", F.when(good, lines).otherwise(F.array(F.lit(""))).alias("lines"), good.alias("valid")))
        _told(parsed, schema).write.mode("overwrite").parquet(f"{output}.outcomes/batch={number}")
        _observed(parsed, schema, kind, na_strings).write.mode("overwrite").parquet(f"{output}/batch={number}")

    log = mounted(spark, f"{checkpoint}/sources/0")
    if mounted(spark, root) is None or log is None:
        return start(append)

    numbers = lambda what: [int(x) for x in os.listdir(f"{log}/../../{what}") if x.isdigit()] if os.path.isdir(log) else []
    done = max(numbers("commits"), default=-1)
    begun = {n for n in numbers("offsets") if n > done}  # what there is of such a batch need not be whole

    def write() -> None:
        _write_taken(spark, log, output, schema, kind, na_strings, begun)
        begun.clear()

    with few_listings(spark), _quick_listing(spark, files_per_batch):
        return Ingest(start(lambda batch, number: None), write)


@contextmanager
def _quick_listing(spark: SparkSession, n_files: int) -> Iterator[None]:
    """Queries that start meanwhile look at so many files of a batch without a job, and not where their blocks are; many
    folders are listed by one task, not each by its own."""
    new = {LISTING: str(max(int(spark.conf.get(LISTING)), n_files)), LOCALITY: "true"}
    before = {k: spark.conf.get(k) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _told(parsed: DataFrame, schema: Schema, also: tuple[str, ...] = ()) -> DataFrame:
    ok = F.col("status") == OK
    left_out = F.array_except(F.when(ok, F.col("cols")).otherwise(F.array().cast("array<string>")), F.array(*[F.lit(n) for n in schema.columns]))
    return parsed.select(*also, "path", "status", "error", F.when(ok, F.size("rows")).otherwise(0).alias("n_rows"), left_out.alias("left_out"))


def _observed(parsed: DataFrame, schema: Schema, kind: Kind, na_strings, also: tuple[str, ...] = ()) -> DataFrame:
    """Sorted observations; also: columns that come first, in the order as well."""
    names = list(schema.kept)
    rows = badc.observations(badc.fields(parsed, schema, also), schema, na_strings, also=also)
    keys = [*also, "station_id"] + ([kind.time_column] if kind.time_column in names else [])
    by = [F.col(k).asc_nulls_last() for k in keys]
    return rows.select(*also, *[n for n in names if n not in STATION_COLUMNS], *STATION_COLUMNS).repartitionByRange(*by).sortWithinPartitions(*by)


def _taken(log: str, written: set[int]) -> list[tuple[int, str]]:
    """(batch, path) of the files that a checkpoint has in batches which are not written."""
    found = set()
    for name in os.listdir(log):
        number, _, kind = name.partition(".")
        if not number.isdigit() or kind not in ("", "compact") or (not kind and int(number) in written):
            continue
        with open(f"{log}/{name}") as lines:
            next(lines)  # the version
            found.update((x["batchId"], unquote(urlparse(x["path"]).path)) for x in map(json.loads, lines) if x["batchId"] not in written)
    return sorted(found)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PARSED with their batch, of files that a file system mounts."""
    columns = [("batch", pa.int32()), *parsing.PARSED]

    def rows() -> Iterator[tuple[int, tuple]]:
        for batch in batches:
            for number, path in zip(*(c.to_pylist() for c in batch.columns)):
                with open(path, "rb") as file:
                    content = file.read()
                yield len(path) + len(content), (number, f"file:{path}".encode(), *parsing.parse(content))

    return parsing._batches(rows(), columns)


def _write_taken(spark: SparkSession, log: str, output: str, schema: Schema, kind: Kind, na_strings, again: set[int]) -> None:
    """Batches of a checkpoint that are not there yet, or are to be written again; rows before outcomes, which tell that a batch is there."""
    fs, p = _fs(spark, f"{output}.outcomes/batch=*")
    written = {int(s.getPath().getName().partition("=")[2]) for s in fs.globStatus(p) or []} - again
    taken = _taken(log, written) if os.path.isdir(log) else []
    if not taken:
        return
    tasks = max(spark.sparkContext.defaultParallelism, min(len(taken) // TASK_FILES, MOST_TASKS))
    table = pa.table({"batch": pa.array([n for n, _ in taken], pa.int32()), "file": pa.array([f for _, f in taken], pa.string())})
    scratch = f"{output}.parsed-{uuid.uuid4().hex}"
    found = spark.createDataFrame(table).repartition(min(tasks, len(taken)))
    found.mapInArrow(_parse, "batch int, " + parsing.ddl(parsing.PARSED)).withColumn("path", F.col("path").cast("string")).write.parquet(scratch)
    parsed = spark.read.parquet(scratch)
    try:
        for df, to in ((_observed(parsed, schema, kind, na_strings, ("batch",)), output), (_told(parsed, schema, ("batch",)).repartitionByRange("batch", "path").sortWithinPartitions("batch", "path"), f"{output}.outcomes")):
            df.write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(to)
    finally:
        fs, p = _fs(spark, scratch)
        fs.delete(p, True)
