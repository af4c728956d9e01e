"""BADC-CSV files: a header of `key,G,value` lines, `data`, a line of column names, rows, `end data`.

All files of a dataset are one plan: a row per file, its lines an array, header fields by array functions.  Columns are
found by name in each file, so files may differ in their columns and in the order of these.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import HEADER_FAILED, NO_DATA_MARKER, NOT_UTF8, OK
from ..functions.lenient import CASTS, NA_STRINGS, present, to_double, trimmed
from ..plans.spec import STATION_COLUMNS, Schema
from . import parsing
from .discovery import QC_DIR, each_below, each_file, few_listings, packed_tasks, plain, walked
from .parsing import COMMENT, DATA, END_DATA, GLOBAL, HEADER_KEYS, SPECIAL

#: A line that begins with one of these is not blank, which is told without trimming it.
VISIBLE = (0x21, 0x7E)


def whole_files(spark: SparkSession, paths: Sequence[str] | str, **options) -> DataFrame:
    """(path, lines, valid) of text files; lines without a last empty one.  options: of Spark's reader."""
    return lines_of(spark.read.options(**options).text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(plain(F.col("_metadata.file_path")).alias("path"), "value"))


def files_below(spark: SparkSession, folders: Sequence[str], n_files: int = 0, tasks: int | None = None) -> DataFrame:
    """(path, lines, valid) of the csv files at any depth under some folders, of which there are about so many."""
    if (found := walked(spark, folders, content=True, tasks=tasks)) is not None:
        return lines_of(found)
    with few_listings(spark):
        return packed_tasks(whole_files(spark, folders, recursiveFileLookup=True, pathGlobFilter="*.csv"), n_files)


def lines_of(df: DataFrame) -> DataFrame:
    """(path, lines, valid) of (path, value)."""
    lines = F.split("value", "\r?\n")
    lines = F.when(F.try_element_at(lines, F.lit(-1)) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return df.select("path", lines.alias("lines"), F.is_valid_utf8("value").alias("valid"))


def _last_value(entries: Column, key: str) -> Column:
    """Value of the last `key,G,value` line."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))["value"]


def _pair(c: Column) -> Column:
    """The two parts of a value, or NULL."""
    parts = F.transform(F.split(c, ","), trimmed)
    return F.when(F.size(parts) == 2, parts)


def bound(value: Column, f) -> Column:
    """f(value), in which value is computed once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def header_of(lines: Column, valid: Column) -> Column:
    """All that a file's lines say of it, as a struct."""
    # only lines that have the word are looked at more closely
    marks = F.transform(lines, lambda x: F.when(F.contains(x, F.lit(DATA)), trimmed(x)))
    ends = lambda t: F.array_position(t, END_DATA).cast("int")
    end = lambda t: F.when(ends(t) > 0, ends(t)).otherwise(F.size(t) + 1)
    data = lambda back, end: F.when(back > 0, end - back).otherwise(0)
    last = lambda t, end: F.array_position(F.reverse(F.slice(t, 1, end - 1)), DATA).cast("int")
    return bound(
        marks,
        lambda t: bound(
            end(t),
            lambda e: bound(
                data(last(t, e), e),
                lambda d: bound(_entries(lines, d), lambda h: bound(_station(h), lambda s: _file(lines, valid, t, e, d, s))),
            ),
        ),
    )


def _entries(lines: Column, data: Column) -> Column:
    """(key, value) of the `key,G,value` lines before the data."""
    head = F.filter(F.slice(lines, 1, F.greatest(data - 1, F.lit(0))), lambda x: (trimmed(x) != "") & ~F.startswith(x, F.lit(COMMENT)))
    split = F.filter(F.transform(head, lambda x: F.split(x, ",", 3)), lambda p: (F.size(p) == 3) & (F.get(p, F.lit(1)) == GLOBAL))
    return F.transform(split, lambda p: F.struct(trimmed(F.get(p, F.lit(0))).alias("key"), trimmed(F.get(p, F.lit(2))).alias("value")))


def _station(entries: Column) -> Column:
    value = {name: _last_value(entries, key) for name, key in HEADER_KEYS.items()}
    place, high = _pair(value["location"]), _pair(value["height"])
    return F.struct(
        value["station_id"].alias("station_id"),
        value["station_name"].alias("station_name"),
        value["county"].alias("county"),
        to_double(F.get(place, F.lit(0))).alias("latitude"),
        to_double(F.get(place, F.lit(1))).alias("longitude"),
        to_double(F.get(high, F.lit(0))).alias("height"),
        F.get(high, F.lit(1)).alias("height_units"),
    )


def _file(lines: Column, valid: Column, t: Column, end: Column, data: Column, s: Column) -> Column:
    # in the order in which a missing one is told
    faults = [
        (s["station_name"].isNull(), "observation_station"),
        (s["station_id"].isNull(), "midas_station_id"),
        (s["county"].isNull(), "historic_county_name"),
        (s["latitude"].isNull() | s["longitude"].isNull(), "location"),
        (s["height"].isNull(), "height"),
        (F.get(lines, data).isNull(), "column line"),
    ]
    missing = F.coalesce(*[F.when(c, F.lit(f"missing {what}")) for c, what in faults])
    status = F.when(~valid, NOT_UTF8).when(data == 0, NO_DATA_MARKER).when(missing.isNotNull(), HEADER_FAILED).otherwise(OK)
    error = F.when(~valid, "not UTF-8").when(data == 0, "no data marker").otherwise(missing)
    body = F.slice(lines, data + 2, F.greatest(end - data - 2, F.lit(0)))
    return F.struct(
        *[s[c].alias(c) for c in STATION_COLUMNS],
        data.alias("skip_rows"),
        F.when(end <= F.size(t), end - data - 1).alias("data_rows"),
        F.size(lines).alias("total_lines"),
        F.transform(F.split(F.get(lines, data), ","), trimmed).alias("cols"),
        F.filter(body, lambda x: F.ascii(x).between(*VISIBLE) | (trimmed(x) != "")).alias("rows"),
        status.alias("status"),
        error.alias("error"),
    )


def headers(df: DataFrame) -> DataFrame:
    """(path, station columns, skip_rows, data_rows, total_lines, cols, rows, status, error) of whole_files()."""
    header = bound(F.struct("lines", "valid"), lambda f: bound(f["lines"], lambda lines: header_of(lines, f["valid"])))
    return df.select("path", header.alias("h")).select("path", "h.*")


def parsed_below(spark: SparkSession, folders: Sequence[str], third_level: bool = False, tasks: int | None = None) -> DataFrame:
    """What headers() tells of the csv files at any depth under some folders, or at a dataset's third level only."""
    return each_below(spark, folders, parsing.parsed, parsing.ddl(parsing.PARSED), third_level, tasks)


def outcomes_of(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame | None:
    """outcomes() of a dataset whose file system is mounted, or None: the tasks that read the files find those of zero bytes."""
    return each_file(spark, root, parsing.outcomes, parsing.ddl(parsing.OUTCOMES), tasks)


def outcomes(spark: SparkSession, parsed: DataFrame, paths: Sequence[str]) -> DataFrame:
    """(path, status, error, n_rows) of all files; those of zero bytes, which readers leave out, have no data marker."""
    all_files = spark.createDataFrame(pa.table({"path": pa.array(paths, pa.string())}), "path string")
    seen = parsed.select("path", "status", "error", F.when(F.col("status") == OK, F.size("rows")).otherwise(0).alias("n_rows"))
    df = all_files.join(seen, "path", "left")
    return df.select("path", F.coalesce("status", F.lit(NO_DATA_MARKER)).alias("status"), F.when(F.col("status").isNull(), F.lit("no data marker")).otherwise(F.col("error")).alias("error"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@dataclass(frozen=True)
class Overview:
    """What one look at all headers tells."""

    files: int  # that can be read
    rows: int
    schema: Schema
    lists: dict[str, list[str]]  # first path with a list of columns: the list


def overview(parsed: DataFrame) -> Overview:
    """Files, rows and the union of all files' columns, in the order in which sorted paths show them.

    One job; a small row for each different list of columns comes to the driver.
    """
    n_rows = F.col("n_rows") if "n_rows" in parsed.columns else F.size("rows")
    good = parsed.where(F.col("status") == OK).groupBy("cols").agg(F.min("path").alias("path"), F.count("*").alias("files"), F.sum(n_rows).alias("rows"))
    return _overview(good.collect())


def _overview(rows: Sequence) -> Overview:
    found = sorted(rows, key=lambda r: r["path"])
    lists = {r["path"]: list(r["cols"]) for r in found}
    schema = replace(Schema.of(list(lists.values())), widest=max(map(len, lists.values()), default=0))
    return Overview(sum(r["files"] for r in found), sum(r["rows"] for r in found), schema, lists)


def dataset_schema(parsed: DataFrame) -> Schema:
    return overview(parsed).schema


def fields(parsed: DataFrame, schema: Schema, also: Sequence[str] = ()) -> DataFrame:
    """A row per observation: station columns, cols and vals (raw fields, quotes taken off, NULL where empty).  also: columns of
    parsed that stay."""
    widest = schema.widest or parsed.agg(F.max(F.size("cols"))).first()[0] or 0
    rows = parsed.where(F.col("status") == OK).select(*also, *STATION_COLUMNS, "cols", F.explode("rows").alias("row"))
    shape = ", ".join(f"_c{i} string" for i in range(max(widest, 1)))
    special = reduce(or_, [F.contains("row", F.lit(c)) for c in SPECIAL])
    # the parser starts anew for each row, which takes far longer than to split it
    rows = rows.withColumn("_s", special).withColumn("_f", F.from_csv(F.when(F.col("_s"), F.col("row")), F.lit(shape), {"mode": "PERMISSIVE"}))
    split = F.transform(F.split("row", ","), lambda x: F.when(x != "", x))
    vals = F.when(F.col("_s"), F.array(*[F.col(f"_f._c{i}") for i in range(max(widest, 1))])).otherwise(split)
    return rows.select(*also, *STATION_COLUMNS, "cols", vals.alias("vals"))


def raw(name: str) -> Column:
    """The field of a column by its name; NULL where the file hasn't got it.  The first of two with one name counts."""
    return F.get("vals", (F.array_position("cols", name) - 1).cast("int"))


def observations(rows: DataFrame, schema: Schema, na_strings: Sequence[str] = NA_STRINGS, counted: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Typed observations: the dataset's columns, then the station's; counted: then whether each column of the schema has a value.
    also: columns of rows that come before these."""
    named = {n: t for n, t in schema.kept.items() if n not in STATION_COLUMNS}
    names = list(dict.fromkeys([*named, *schema.columns])) if counted else list(named)
    # what is used more than once is a column of its own, so it is computed once
    raws = rows.select(*also, *STATION_COLUMNS, *[F.array_contains("cols", n).alias(f"k{i}") for i, n in enumerate(names)], *[trimmed(raw(n)).alias(f"t{i}") for i, n in enumerate(names)])
    values = [F.when(F.col(f"k{i}") & ~F.col(f"t{i}").isin(*na_strings), F.col(f"t{i}")).alias(f"v{i}") for i in range(len(names))]
    there = [(F.col(f"k{i}") & ~F.coalesce(f"t{i}", F.lit("")).isin(*na_strings)).alias(f"h{i}") for i in range(len(names)) if counted]
    values = raws.select(*also, *STATION_COLUMNS, *values, *there)
    cols = [CASTS[t](F.col(f"v{i}")).alias(n) for i, (n, t) in enumerate(named.items())]
    return values.select(*also, *cols, *STATION_COLUMNS, *[F.col(f"h{names.index(n)}") for n in schema.columns if counted])


def observed(rows: DataFrame, schema: Schema, na_strings: Sequence[str] = NA_STRINGS) -> tuple[DataFrame, list[str], Callable[[], dict[str, int]]]:
    """observations() under plain names c0, c1..., their real names, and what column_presence() tells of them, known when
    one job has gone over all."""
    df, seen = observations(rows, schema, na_strings, counted=True), Observation()
    n = len(df.columns) - len(schema.columns)
    names = df.columns[:n]
    df = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    df = df.observe(seen, F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"c{n + i}").cast("int")).alias(f"h{i}") for i in range(len(schema.columns))])
    return df.select(*df.columns[:n]), names, lambda: {c: seen.get[f"h{i}"] or 0 for i, c in enumerate(schema.columns)}


def column_presence(rows: DataFrame, schema: Schema, na_strings: Sequence[str] = NA_STRINGS) -> dict[str, int]:
    """Number of values of each column over the whole dataset."""
    counts = [F.sum(F.when(F.array_contains("cols", n) & present(raw(n), na_strings), 1).otherwise(0)).alias(f"c{i}") for i, n in enumerate(schema.columns)]
    if not counts:
        return {}
    row = rows.agg(*counts).first()
    return {n: row[i] or 0 for i, n in enumerate(schema.columns)}


def surveyed(spark: SparkSession, root: str, na_strings: Sequence[str] = NA_STRINGS, tasks: int | None = None) -> tuple[Overview, dict[str, int]]:
    """overview() and column_presence() of a dataset by one look at its files.

    The tasks that read the files count values in rows that only need to be split; files are looked at once more only where
    there are rows that need the parser."""
    folder = f"{root}/{QC_DIR}"
    found = each_below(spark, [folder], parsing.lists(na_strings), parsing.ddl(parsing.LISTS), True, tasks)
    zeros = F.transform("cols", lambda _: F.lit(0).cast("bigint"))
    added = F.aggregate(F.collect_list("counts"), F.any_value(zeros), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    lists = found.groupBy("cols").agg(F.min("path").alias("path"), *[F.sum(c).alias(c) for c in ("files", "rows", "special")], added.alias("counts"))
    rows = lists.collect()
    seen = _overview(rows)
    counts = dict.fromkeys(seen.schema.columns, 0)
    for r in rows:
        for name, n in dict(zip(reversed(r["cols"]), reversed(r["counts"]))).items():  # the first of two with one name counts
            counts[name] += n
    if any(r["special"] for r in rows):
        special = lambda row: reduce(or_, [F.contains(row, F.lit(c)) for c in SPECIAL])
        parsed = parsed_below(spark, [folder], True, tasks).withColumn("rows", F.filter("rows", special))
        for name, n in column_presence(fields(parsed, seen.schema), seen.schema, na_strings).items():
            counts[name] += n
    return seen, counts


def read(spark: SparkSession, paths: Sequence[str] | str, na_strings: Sequence[str] = NA_STRINGS) -> DataFrame:
    """Typed observations of some files, in one call."""
    parsed = headers(whole_files(spark, paths))
    schema = dataset_schema(parsed)
    return observations(fields(parsed, schema), schema, na_strings)
