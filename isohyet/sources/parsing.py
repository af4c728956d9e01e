"""BADC-CSV files parsed by Python tasks: what badc.headers finds, without an expression for each line, which takes far longer."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa

from ..errors import HEADER_FAILED, NO_DATA_MARKER, NOT_UTF8, OK
from ..functions.lenient import FLOAT, WHITE_SPACE

# Fixed values of the file format.
DATA, END_DATA, GLOBAL, COMMENT = "data", "end data", "G", "#"
#: Rows without any of these are fields with commas between.
SPECIAL = ('"', "\\", "\r", "\0")
HEADER_KEYS = {
    "station_name": "observation_station",
    "station_id": "midas_station_id",
    "county": "historic_county_name",
    "location": "location",
    "height": "height",
}
#: Bytes of files after which a task hands on what it has read, and lists of columns that it holds at most.
BATCH_BYTES, MOST_LISTS = 4 << 20, 1000
_NUMBER = re.compile(FLOAT, re.ASCII)
_STATION = [("station_id", pa.string()), ("station_name", pa.string()), ("county", pa.string()), ("latitude", pa.float64()), ("longitude", pa.float64()), ("height", pa.float64()), ("height_units", pa.string())]
PARSED = [("path", pa.binary()), *_STATION, ("skip_rows", pa.int32()), ("data_rows", pa.int32()), ("total_lines", pa.int32()), ("cols", pa.list_(pa.string())), ("rows", pa.list_(pa.string())), ("status", pa.string()), ("error", pa.string())]
OUTCOMES = [("path", pa.binary()), ("status", pa.string()), ("error", pa.string()), ("n_rows", pa.int32())]
LISTS = [("cols", pa.list_(pa.string())), ("path", pa.binary()), ("files", pa.int64()), ("rows", pa.int64()), ("special", pa.int64()), ("counts", pa.list_(pa.int64()))]
_NAMES = {pa.binary(): "binary", pa.string(): "string", pa.float64(): "double", pa.int32(): "int", pa.int64(): "bigint", pa.list_(pa.string()): "array<string>", pa.list_(pa.int64()): "array<bigint>"}


def ddl(columns: Sequence[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{name} {_NAMES[kind]}" for name, kind in columns)


def _pair(value: str | None) -> list[str] | None:
    parts = [x.strip(WHITE_SPACE) for x in value.split(",")] if value is not None else []
    return parts if len(parts) == 2 else None


def _double(text: str | None) -> float | None:
    # Spark's cast knows no NaN with a sign
    if text is None or not _NUMBER.match(text) or text[1:].lower() == "nan":
        return None
    return float(text)


def parse(content: bytes) -> tuple:
    """All columns of PARSED but the path."""
    valid = True
    try:
        text = content.decode()
    except UnicodeDecodeError:
        valid, text = False, content.decode(errors="replace")
    lines = text.replace("\r\n", "\n").split("\n")
    if not lines[-1]:
        lines.pop()
    end, data = len(lines) + 1, 0
    for i, x in enumerate(lines, 1):
        if DATA in x:
            x = x.strip(WHITE_SPACE)
            if x == END_DATA:
                end = i
                break
            if x == DATA:
                data = i
    values: dict[str, str] = {}
    for x in lines[: max(data - 1, 0)]:
        parts = x.split(",", 2)
        if len(parts) == 3 and parts[1] == GLOBAL and not x.startswith(COMMENT):
            values[parts[0].strip(WHITE_SPACE)] = parts[2].strip(WHITE_SPACE)
    name, id_, county, place, high = (values.get(HEADER_KEYS[k]) for k in ("station_name", "station_id", "county", "location", "height"))
    place, high = _pair(place), _pair(high)
    lat, lon, height = place and _double(place[0]), place and _double(place[1]), high and _double(high[0])
    column_line = lines[data] if data < len(lines) else None
    status, error = OK, None
    if not valid:
        status, error = NOT_UTF8, "not UTF-8"
    elif not data:
        status, error = NO_DATA_MARKER, "no data marker"
    else:
        # in the order in which a missing one is told
        faults = ((name, "observation_station"), (id_, "midas_station_id"), (county, "historic_county_name"), (None if lat is None else lon, "location"), (height, "height"), (column_line, "column line"))
        for value, what in faults:
            if value is None:
                status, error = HEADER_FAILED, f"missing {what}"
                break
    cols = None if column_line is None else [x.strip(WHITE_SPACE) for x in column_line.split(",")]
    rows = [x for x in lines[data + 1 : max(end - 1, data + 1)] if x.strip(WHITE_SPACE)]
    data_rows = end - data - 1 if end <= len(lines) else None
    return id_, name, county, lat, lon, height, high and high[1], data, data_rows, len(lines), cols, rows, status, error


def _batches(rows: Iterator[tuple[int, tuple]], columns: Sequence[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Of (size, row)."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*held), columns)], names=[n for n, _ in columns])

    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if size > BATCH_BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


#: Files as (path, content), without content where a reader leaves the file out.
Files = Iterable[tuple[bytes, bytes | None]]


def parsed(files: Files) -> Iterator[pa.RecordBatch]:
    """A row of PARSED for each file that isn't empty."""
    return _batches(((len(path) + len(x), (path, *parse(x))) for path, x in files if x), PARSED)


def outcomes(files: Files) -> Iterator[pa.RecordBatch]:
    """A row of OUTCOMES for each file; one that is empty or left out has no data marker."""

    def rows() -> Iterator[tuple[int, tuple]]:
        for path, x in files:
            status, error, n = NO_DATA_MARKER, "no data marker", 0
            if x:
                *_, found, status, error = parse(x)
                n = len(found) if status == OK else 0
            yield len(path) + 50, (path, status, error, n)

    return _batches(rows(), OUTCOMES)


def is_special(row: str) -> bool:
    return any(c in row for c in SPECIAL)


def _count(rows: list[str], counts: list[int], na: frozenset[str]) -> None:
    """Adds the values in each column of rows that only need to be split."""
    missing = "" not in na  # then what isn't there counts, too
    n = len(counts)
    for row in rows:
        fields = row.split(",")
        for i, x in zip(range(n), fields):
            if x not in na and x.strip(WHITE_SPACE) not in na:
                counts[i] += 1
        if missing:
            for i in range(len(fields), n):
                counts[i] += 1


def lists(na_strings: Sequence[str]) -> Callable[[Files], Iterator[pa.RecordBatch]]:
    """Rows of LISTS: of the files of a task that can be read and have equal column lines: the first path, files, rows,
    those that need a parser, and for each column the values in the others."""
    na = frozenset(na_strings)

    def run(files: Files) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, ...], list] = {}
        rows = lambda: ((0, (list(cols), *rest)) for cols, rest in held.items())
        for path, x in files:
            if not x:
                continue
            *_, cols, found, status, _ = parse(x)
            if status != OK:
                continue
            plain = [r for r in found if not is_special(r)] if any(c in x for c in _SPECIAL_BYTES) else found
            at = held.setdefault(tuple(cols), [path, 0, 0, 0, [0] * len(cols)])
            at[0] = min(at[0], path)
            at[1] += 1
            at[2] += len(found)
            at[3] += len(found) - len(plain)
            _count(plain, at[4], na)
            if len(held) > MOST_LISTS:
                yield from _batches(rows(), LISTS)
                held.clear()
        yield from _batches(rows(), LISTS)

    return run


_SPECIAL_BYTES = [c.encode() for c in SPECIAL]
