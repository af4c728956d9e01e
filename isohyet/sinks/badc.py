"""Observations written as BADC-CSV trees: the inverse of sources.badc."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.discovery import QC_DIR, _fs, mounted


def header(name: Column, station: Column, county: Column, lat: Column, lon: Column, height: Column, units: Column) -> Column:
    g = lambda key, *v: F.concat_ws(",", F.lit(key), F.lit("G"), *[x.cast("string") for x in v])
    return F.concat_ws("\n", g("observation_station", name), g("midas_station_id", station), g("historic_county_name", county), g("location", lat, lon), g("height", height, units))


def file_text(head: Column, columns: Column, rows: Column, closed: bool = True) -> Column:
    """Text of a file: rows is an array of lines."""
    return F.concat_ws("\n", head, F.lit("data"), columns, F.array_join(rows, "\n"), F.lit("end data\n" if closed else ""))


def write_tree(files: DataFrame, root: str) -> int:
    """files(county_dir, station_dir, file, text) under root/qcv-1; the number of files.

    In a file system that all machines mount, tasks write the files themselves, each under another name until it is whole.
    Rows of one file are its lines, one after another.
    """
    spark = files.sparkSession
    rows = files.select(F.col("county_dir").alias("a"), F.col("station_dir").alias("b"), F.col("file").alias("c"), "text")
    by = ["a", "b", "c"]
    folder = mounted(spark, f"{root}/{QC_DIR}")
    if folder is None:
        return _write_and_rename(rows.repartition(*by), root)
    os.makedirs(folder, exist_ok=True)
    names = [_named(F.col(x)).alias(x) for x in "abc"]
    # a number that stays: files are small, so by their bytes they would all go to a few tasks
    rows = rows.select(*names, "text").repartition(4 * spark.sparkContext.defaultParallelism, *by).sortWithinPartitions(*by)
    return rows.mapInArrow(_writer(folder), "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_lines(rows: DataFrame, root: str, key: Sequence[Column], order: Sequence[str], line: Column, file: Sequence[Column], head: Column, columns: Column) -> int:
    """A file for each key under root/qcv-1, of a line for each of its rows in that order; the number of files.

    file is (county_dir, station_dir, file), another one for each key; it, head and columns are computed of the key.  In a file system that all machines
    mount, rows are shuffled once and tasks write the files from the sorted lines, so no file is held as a whole.
    """
    spark, by = rows.sparkSession, rows.select(*key).columns
    folder = mounted(spark, f"{root}/{QC_DIR}")
    if folder is None:
        lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))), lambda x: x["line"])
        files = rows.groupBy(*key).agg(lines.alias("rows"))
        named = [c.alias(n) for c, n in zip(file, ("county_dir", "station_dir", "file"))]
        return write_tree(files.select(*named, file_text(head, columns, F.col("rows")).alias("text")), root)
    os.makedirs(folder, exist_ok=True)
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = max(4 * spark.sparkContext.defaultParallelism, min(size // TASK_BYTES, MOST_TASKS))
    lines = rows.select(*key, *order, line.alias("_line")).repartition(tasks, *by)
    lines = lines.withColumn("_first", F.row_number().over(Window.partitionBy(*by).orderBy(*order, "_line")) == 1)
    # what is the same in all lines of a file is told with its first one only
    name = F.when(F.col("_first"), F.concat_ws("/", *map(_named, file)))
    text = F.when(F.col("_first"), F.concat_ws("\n", head, F.lit("data"), columns, "_line", F.lit(""))).otherwise(F.concat("_line", F.lit("\n")))
    return lines.select(name.alias("name"), text.alias("text")).mapInArrow(_line_writer(folder), "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


#: What Spark calls the folder of a partition without a name.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
#: Bytes of a table for each task that writes lines of it, and tasks at most.
TASK_BYTES, MOST_TASKS = 4 << 20, 10_000


def _named(name: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(NO_NAME))


#: Bytes of a file that a task holds before it writes them.
HELD_BYTES = 1 << 20


def _made(folder: str) -> None:
    """Makes a folder; mostly only the last level of it is missing."""
    try:
        os.mkdir(folder)
    except FileExistsError:
        pass
    except FileNotFoundError:
        os.makedirs(folder, exist_ok=True)


def _put(fd: int, data: bytes) -> None:
    done = os.write(fd, data)
    while done < len(data):
        done += os.write(fd, data[done : done + (1 << 30)])


def _write_file(target: str, chunks: Iterable[bytes], attempt: str, made: set[str]) -> None:
    """A file that has another name until it is whole; made: folders that are there."""
    parent = os.path.dirname(target)
    if parent not in made:
        _made(parent)
        made.add(parent)
    part = f"{target}.{attempt}"
    fd = os.open(part, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o666)
    try:
        for chunk in chunks:
            _put(fd, chunk)
    finally:
        os.close(fd)
    os.replace(part, target)


def _chunks(rows: Iterable[tuple]) -> Iterator[bytes]:
    """Text of the rows of a file."""
    held, size = [], 0
    for row in rows:
        held.append(row[3] or "")
        size += len(held[-1])
        if size > HELD_BYTES:
            yield ("\n".join(held) + "\n").encode()
            held, size = [], 0
    if held:
        yield ("\n".join(held) + "\n").encode()


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        n, attempt = 0, uuid.uuid4().hex
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for (a, b, c), same in groupby(rows, key=itemgetter(0, 1, 2)):
            _write_file(f"{folder}/{a}/{b}/{c}.csv", _chunks(same), attempt, made)
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, str, memoryview]]:
    """(number, name, text) of files, all lines that a batch has of one at once."""
    number, name = 0, ""
    for batch in batches:
        names, texts = batch.columns
        if not len(texts):
            continue
        _, offsets, data = texts.buffers()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
        first = np.flatnonzero(names.is_valid().to_numpy(zero_copy_only=False))
        ends = [*offsets[first].tolist(), int(offsets[-1])]
        data = memoryview(data if data is not None else b"")
        if ends[0] > offsets[0]:
            yield number, name, data[int(offsets[0]) : ends[0]]
        for name, start, end in zip(names.drop_null().to_pylist(), ends, ends[1:]):
            number += 1
            yield number, name, data[start:end]


def _closed(pieces: Iterable[memoryview]) -> Iterator[bytes]:
    """Pieces of a file, and its end."""
    last = None
    for piece in pieces:
        if last is not None:
            yield last
        last = piece
    yield bytes(last) + b"end data\n\n"


def _line_writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        n, attempt = 0, uuid.uuid4().hex
        for (_, name), same in groupby(_pieces(batches), key=itemgetter(0, 1)):
            _write_file(f"{folder}/{name}.csv", _closed(piece for _, _, piece in same), attempt, made)
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return run


def _write_and_rename(rows: DataFrame, root: str) -> int:
    """In other stores Spark writes under names of its own, so each file is renamed; that is one call a file on the driver."""
    spark = rows.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    rows.write.partitionBy("a", "b", "c").option("lineSep", "\n").text(staging)
    fs, p = _fs(spark, f"{staging}/*/*/*/part-*")
    moved = 0
    for status in fs.globStatus(p):
        a, b, c = (unquote(x.split("=", 1)[1]) for x in status.getPath().getParent().toString().split("/")[-3:])
        target = _fs(spark, f"{root}/{QC_DIR}/{a}/{b}/{c}.csv")[1]
        fs.mkdirs(target.getParent())
        fs.rename(status.getPath(), target)
        moved += 1
    fs.delete(_fs(spark, staging)[1], True)
    return moved
