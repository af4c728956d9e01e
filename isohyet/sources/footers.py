"""Parquet footers as rows, read through Spark's file systems; more metadata in a footer, all else as it is."""

from __future__ import annotations

from collections.abc import Iterator
from struct import pack, unpack

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .discovery import _fs

CHUNKS = "path string, row_group int, n_rows long, column string, codec string, has_statistics boolean, bytes long"
MAGIC = b"PAR1"


def part_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isFile():
        return [path]
    deep = fs.globStatus(_fs(spark, f"{path}/*.parquet")[1]) or []
    found = list(deep) or list(fs.globStatus(_fs(spark, f"{path}/*=*/*.parquet")[1]) or []) or list(fs.globStatus(_fs(spark, f"{path}/*=*/*=*/*.parquet")[1]) or [])
    return sorted(s.getPath().toString() for s in found)


def footer_bytes(spark: SparkSession, path: str) -> tuple[int, bytes]:
    """Where a Parquet file's footer begins, and the footer."""
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        stream.seek(size - 8)
        (n,) = unpack("<I", bytes(stream.readNBytes(8))[:4])
        stream.seek(size - 8 - n)
        return size - 8 - n, bytes(stream.readNBytes(n))
    finally:
        stream.close()


def metadata_of(footer: bytes) -> pq.FileMetaData:
    return pq.read_metadata(pa.BufferReader(MAGIC + footer + pack("<I", len(footer)) + MAGIC))


def column_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column of each row group of each part file; the driver fetches the footers alone."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, footer in zip(frame["path"], frame["footer"]):
                m, rows = metadata_of(bytes(footer)), []
                for g in range(m.num_row_groups):
                    for c in range(m.num_columns):
                        x = m.row_group(g).column(c)
                        rows.append((path, g, m.row_group(g).num_rows, x.path_in_schema, x.compression, x.is_stats_set, x.total_compressed_size))
                yield pd.DataFrame(rows, columns=["path", "row_group", "n_rows", "column", "codec", "has_statistics", "bytes"])

    parts = [(p, bytearray(footer_bytes(spark, p)[1])) for p in part_files(spark, path)]
    return spark.createDataFrame(parts, "path string, footer binary").mapInPandas(read, CHUNKS)


def footer_summary(chunks: DataFrame) -> DataFrame:
    """(n_groups, least, most, mean, codecs, all_statistics) over a file or folder."""
    groups = chunks.groupBy("path", "row_group").agg(F.first("n_rows").alias("n"), F.collect_set("codec").alias("codecs"), F.bool_and("has_statistics").alias("stats"))
    return groups.agg(
        F.count("*").alias("n_groups"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.avg("n").alias("mean"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("codecs")))).alias("codecs"),
        F.bool_and("stats").alias("all_statistics"),
    )


def file_metadata(spark: SparkSession, path: str) -> dict[str, str]:
    """Key-value metadata of one file."""
    return {k.decode(): v.decode() for k, v in (metadata_of(footer_bytes(spark, path)[1]).metadata or {}).items()}


class Thrift:
    """Fields of a message in Thrift's compact protocol, by their places in its bytes."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def number(self) -> int:
        out = shift = 0
        while True:
            byte = self.data[self.at]
            self.at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    def list_head(self) -> tuple[int, int]:
        """Number and kind of a list's elements."""
        byte = self.data[self.at]
        self.at += 1
        n = byte >> 4
        return (self.number() if n == 15 else n), byte & 15

    def fields(self) -> Iterator[tuple[int, int]]:
        """(id, kind) of each field; the reader stands at its value, and must be past it when it asks for the next."""
        last = 0
        while (byte := self.data[self.at]) != 0:
            self.at += 1
            delta = byte >> 4
            if delta:
                last += delta
            else:
                zigzag = self.number()
                last = zigzag >> 1 ^ -(zigzag & 1)
            yield last, byte & 15
        self.at += 1

    def skip(self, kind: int, element: bool = False) -> None:
        # Fixed values of the protocol: 1 and 2 are booleans, 3 a byte, 4 to 6 integers, 7 a double, 8 bytes, 9 and 10
        # lists, 11 a map, 12 a message.
        if kind in (1, 2):
            self.at += element
        elif kind == 3:
            self.at += 1
        elif kind in (4, 5, 6):
            self.number()
        elif kind == 7:
            self.at += 8
        elif kind == 8:
            n = self.number()
            self.at += n
        elif kind in (9, 10):
            n, of = self.list_head()
            for _ in range(n):
                self.skip(of, True)
        elif kind == 11:
            if n := self.number():
                kinds = self.data[self.at]
                self.at += 1
                for _ in range(n):
                    self.skip(kinds >> 4, True)
                    self.skip(kinds & 15, True)
        elif kind == 12:
            for _, of in self.fields():
                self.skip(of)
        else:
            raise ValueError(f"no Thrift kind {kind}")


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


#: Fixed value of the format: the footer's field that has the key-value metadata.
KEY_VALUES = 5


def with_key_values(footer: bytes, more: dict[str, str]) -> bytes:
    """The footer with more entries in its list of key-value metadata, which must be there; no other byte changes."""
    t = Thrift(footer)
    entry = lambda x: b"\x18" + varint(len(x.encode())) + x.encode()
    added = b"".join(entry(k) + entry(v) + b"\0" for k, v in more.items())
    for number, kind in t.fields():
        begin = t.at
        if number == KEY_VALUES:
            n, of = t.list_head()
            first = t.at
            for _ in range(n):
                t.skip(of, True)
            n += len(more)
            head = bytes([n << 4 | of]) if n < 15 else bytes([0xF0 | of]) + varint(n)
            return footer[:begin] + head + footer[first : t.at] + added + footer[t.at :]
        t.skip(kind)
    raise ValueError("a footer without key-value metadata")
