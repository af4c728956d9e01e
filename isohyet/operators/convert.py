"""Conversion of a dataset of BADC-CSV files into sorted Parquet."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DatasetNotFound, SchemaVarianceExceeded
from ..functions.lenient import NA_STRINGS
from ..plans.rowgroups import executor_memory_mb, rows_per_group
from ..plans.spec import STATION_COLUMNS, Kind, Schema, Width, is_descriptor, is_timestamp, kind_of, usually_empty
from ..sinks.parquet import ParquetOptions, write
from ..sources import badc
from ..sources.discovery import MOST_FILES, QC_DIR, _fs, exists, files, first_file

#: Stations above which output is a directory of ranges rather than one file.
MANY_STATIONS, MANY_RAIN_STATIONS = 3000, 1000
#: Rows above which one task no longer sorts all of them.
MANY_ROWS = 5_000_000
#: Small files that a task reads, at least.
LEAST_FILES = 32


@dataclass(frozen=True)
class Options:
    parquet: ParquetOptions = field(default_factory=ParquetOptions)
    na_strings: tuple[str, ...] = NA_STRINGS
    #: columns without any value go: "exact" (all rows), "sample" (rows of sample_files files) or "off"
    empty_columns: str = "exact"
    sample_files: int = 10
    discovery_only: bool = False
    #: most columns by which a file may differ from the dataset, or None
    schema_variance: int | None = None
    #: "fixed", "adaptive" or "station"; None keeps parquet.rows_per_group
    row_groups: str | None = None
    layout: str | None = None  # None: by number of stations and rows
    #: files that one task reads; None: by their number and the cores
    files_per_task: int | None = None

    def with_(self, **changes) -> Options:
        return replace(self, **changes)


@dataclass(frozen=True)
class Stats:
    files_processed: int = 0
    files_failed: int = 0
    total_rows: int = 0
    output_path: str | None = None
    processing_ms: int = 0
    warnings: tuple[str, ...] = ()


class Converter:
    """run() converts; discover() tells the schema; outcomes() tells what became of each file."""

    def __init__(self, spark: SparkSession, path: str, output: str | None = None, options: Options = Options()) -> None:
        self.spark, self.path, self.options = spark, path.rstrip("/"), options
        self.output = output or default_output(self.path)
        self._paths: list[str] | None = None

    @property
    def paths(self) -> list[str]:
        if self._paths is None:
            self._paths = files(self.spark, self.path)
        return self._paths

    def kind(self) -> Kind:
        first = (self._paths[0] if self._paths else None) if self._paths is not None else first_file(self.spark, self.path)
        return kind_of(self.path.rsplit("/", 1)[-1], (first or "").rsplit("/", 1)[-1], f"{self.path}/{first or ''}")

    def _tasks(self) -> int | None:
        """Tasks that read the files, where the options say so."""
        if not exists(self.spark, f"{self.path}/{QC_DIR}"):
            raise DatasetNotFound(self.path)
        per_task = self.options.files_per_task
        return per_task and max(1, -(-len(self.paths) // per_task))

    def parsed(self) -> DataFrame:
        """Headers and lines of all files.  One folder is listed at all depths, which takes far less than each file by its
        name; files that are not at the third level are then left out."""
        return badc.parsed_below(self.spark, [f"{self.path}/{QC_DIR}"], True, self._tasks())

    @contextmanager
    def packed(self) -> Iterator[None]:
        """Meanwhile, many small files go to one task, for which Spark counts openCostInBytes for each."""
        conf = self.spark.conf
        cores = self.spark.sparkContext.defaultParallelism
        per_task = self.options.files_per_task or max(LEAST_FILES, min(MOST_FILES, -(-len(self.paths) // (4 * cores))))
        size = conf.get("spark.sql.files.maxPartitionBytes", "128m").lower().removesuffix("b")
        size = int(size[:-1]) << {"k": 10, "m": 20, "g": 30}[size[-1]] if size[-1:] in "kmg" else int(size)
        new = {"spark.sql.files.openCostInBytes": max(1, size // per_task)}
        before = {key: conf.get(key, None) for key in new}
        for key, value in new.items():
            conf.set(key, str(value))
        try:
            yield
        finally:
            for key, value in before.items():
                conf.set(key, value) if value is not None else conf.unset(key)

    def parsed_once(self) -> tuple[DataFrame, str]:
        """parsed() as a table beside the output, and its folder: each file is opened and parsed once."""
        folder = f"{self.output}.{uuid.uuid4().hex}.parsed"
        with self.packed():
            df = self.parsed().withColumn("n_rows", F.size("rows"))
            df.write.option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder), folder

    def outcomes(self, parsed: DataFrame | None = None) -> DataFrame:
        if parsed is None and (found := badc.outcomes_of(self.spark, self.path, self._tasks())) is not None:
            return found
        return badc.outcomes(self.spark, self.parsed() if parsed is None else parsed, self.paths)

    def schema(self, parsed: DataFrame | None = None, schema: Schema | None = None) -> Schema:
        """The dataset's columns, with those that are empty."""
        if parsed is None and schema is None and self.options.empty_columns == "exact":
            seen, counts = badc.surveyed(self.spark, self.path, self.options.na_strings, self._tasks())
            return self._emptied(seen.schema, counts) if counts else seen.schema
        parsed = self.parsed() if parsed is None else parsed
        schema = schema or badc.dataset_schema(parsed)
        if self.options.empty_columns == "off" or not schema.columns:
            return schema
        rows = parsed
        if self.options.empty_columns == "sample":
            rows = parsed.where(F.col("path").isin(self.paths[: self.options.sample_files]))
        counts = badc.column_presence(badc.fields(rows, schema), schema, self.options.na_strings)
        return self._emptied(schema, counts)

    def discover(self) -> DataFrame:
        """(name, type, is_empty, is_descriptor, is_timestamp) of all columns."""
        schema = self.schema()
        rows = [(n, t, n in schema.empty, is_descriptor(n), is_timestamp(n)) for n, t in schema.columns.items()]
        return self.spark.createDataFrame(rows, "name string, type string, is_empty boolean, is_descriptor boolean, is_timestamp boolean")

    def discovered(self) -> str:
        """What discover() tells, as text: columns and types, empty ones, descriptors and times, files of unusual width."""
        rows = self.discover().collect()
        names = lambda key: ", ".join(r["name"] for r in rows if r[key]) or "none"
        lines = [f"{self.kind().value}: {len(rows)} columns in {len(self.paths)} files", *[f"  {r['name']}: {r['type']}" for r in rows]]
        lines += [f"empty: {names('is_empty')}", f"descriptors: {names('is_descriptor')}", f"times: {names('is_timestamp')}"]
        return "\n".join(lines + [f"{path}: {w}" for path, w in self.widths().items()])

    def observations(self) -> DataFrame:
        parsed = self.parsed()
        schema = self.schema(parsed)
        return badc.observations(badc.fields(parsed, schema), schema, self.options.na_strings)

    def widths(self, parsed: DataFrame | None = None) -> dict[str, Width]:
        """Lists of columns that are not as wide as the kind's usual one, by the first path that has each."""
        return self.widths_of(badc.overview(self.parsed() if parsed is None else parsed))

    def widths_of(self, seen: badc.Overview) -> dict[str, Width]:
        found = {path: Width.of(self.kind(), cols) for path, cols in seen.lists.items()}
        return {path: w for path, w in found.items() if w}

    def warnings(self, seen: badc.Overview, schema: Schema) -> tuple[str, ...]:
        """Files of unusual width, and columns that are not empty though they usually are; neither stops a conversion."""
        kind = self.kind()
        out = [f"{path}: {w}" for path, cols in seen.lists.items() if (w := Width.of(kind, cols))]
        return (*out, *[f"column {c} usually is empty, and is not" for c in usually_empty(kind) if c in schema.kept and self.options.empty_columns == "exact"])

    def run(self) -> Stats:
        began = time.monotonic()
        took = lambda: int((time.monotonic() - began) * 1000)
        if not self.paths or self.options.discovery_only:
            return Stats(processing_ms=took())
        parsed, folder = self.parsed_once()
        try:
            return replace(self._converted(parsed, folder), processing_ms=took())
        finally:
            for f in (folder, _typed(folder)):
                self._delete(f)

    def _delete(self, folder: str) -> None:
        fs, p = _fs(self.spark, folder)
        fs.delete(p, True)

    def typed_once(self, parsed: DataFrame, schema: Schema, folder: str) -> tuple[DataFrame, Schema]:
        """Observations as a table, and the schema with the columns that are empty: rows are split and cast once, in the job
        that counts values; a sort by ranges reads its rows twice."""
        rows, na = badc.fields(parsed, schema), self.options.na_strings
        counts = None
        if self.options.empty_columns == "exact" and schema.columns:
            df, names, counts = badc.observed(rows, schema, na)
        else:
            schema = self.schema(parsed, schema)
            df = badc.observations(rows, schema, na)
            names = df.columns
            df = df.toDF(*[f"c{i}" for i in range(len(names))])
        df.write.option("compression", "zstd").parquet(folder)
        if counts:
            schema = self._emptied(schema, counts())
        kept = [(i, n) for i, n in enumerate(names) if n in schema.kept or n in STATION_COLUMNS]
        return self.spark.read.schema(df.schema).parquet(folder).select(*[F.col(f"c{i}").alias(n) for i, n in kept]), schema

    def _emptied(self, schema: Schema, counts: dict[str, int]) -> Schema:
        keys = {self.kind().time_in(schema.columns)}
        return replace(schema, empty=tuple(n for n, c in counts.items() if not c and n not in keys))

    def _converted(self, parsed: DataFrame, folder: str) -> Stats:
        kind, seen = self.kind(), badc.overview(parsed)
        failed = len(self.paths) - seen.files  # zero-byte files are among the paths alone
        if not seen.files:
            return Stats(files_failed=failed)
        self._check_variance(seen)
        rows, schema = self.typed_once(parsed, seen.schema, _typed(folder))
        self._delete(folder)
        options, time_column = self.options.parquet, kind.time_in(schema.columns)
        stations = len({p.split("/")[-2] for p in self.paths})
        many = stations > MANY_STATIONS or (kind is Kind.RAIN and stations > MANY_RAIN_STATIONS) or seen.rows > MANY_ROWS
        layout = self.options.layout or ("directory" if many else options.layout)
        if self.options.row_groups:
            cores = self.spark.sparkContext.defaultParallelism
            options = options.with_(rows_per_group=rows_per_group(self.options.row_groups, rows=seen.rows, stations=stations, cores=cores, memory_mb=executor_memory_mb(self.spark)))
        keys = ["station_id"] + ([time_column] if time_column else [])
        n = write(rows, self.output, keys, options.with_(layout=layout))
        return Stats(seen.files, failed, n, self.output, warnings=self.warnings(seen, schema))

    def _check_variance(self, seen: badc.Overview) -> None:
        if self.options.schema_variance is None:
            return
        for path, cols in seen.lists.items():
            if (d := seen.schema.differing(cols)) > self.options.schema_variance:
                raise SchemaVarianceExceeded(path, d, self.options.schema_variance)


def _typed(folder: str) -> str:
    return f"{folder}.typed"


def default_output(path: str) -> str:
    """<dataset>/../../parquet/<name>.parquet; beside the working folder where there are no two parents."""
    parts = path.rstrip("/").split("/")
    base = "/".join(parts[:-2]) if len(parts) > 2 else "."
    return f"{base}/parquet/{parts[-1]}.parquet"
