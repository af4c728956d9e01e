"""Documents in chunks, and exchanges of hash keys between them.

A chunk is one row that holds some megabytes of documents, compressed.  Operators that compare positions of all documents
go over the chunks several times.  Each time a chunk sends the keys that it has, once each, to buckets by key; a bucket
finds what several chunks have and sends it back to those.  So keys are aggregated before they are shuffled, a key that is
in a third of all documents costs one entry a chunk, and the texts themselves are moved only with their chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import mix, written

CHUNK_BYTES = 2 << 20
#: What a row without doc_id counts as: the largest id there is.
NO_ID = (1 << 63) - 1
#: Which bytes separate words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def zip_(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def as_array(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, dtype=kind)


@dataclass
class Chunk:
    """Documents in order of doc_id; text is their UTF-8 bytes, one after another.  without: those that have no doc_id,
    for which NO_ID stands."""

    id: int
    doc_ids: np.ndarray
    without: np.ndarray
    sizes: np.ndarray
    text: np.ndarray
    null: np.ndarray
    rest: bytes | None = None

    def ids(self) -> list[int | None]:
        """doc_ids as they were."""
        return [None if none else i for i, none in zip(self.doc_ids.tolist(), self.without.tolist())]

    def others(self) -> list[dict]:
        """The documents' other columns."""
        return pa.ipc.open_stream(unzip(self.rest)).read_all().to_pylist() if self.rest else [{}] * len(self.doc_ids)

    @classmethod
    def of(cls, row: dict) -> Chunk:
        return cls(row["chunk"], as_array(row["doc_ids"], "<i8"), as_array(row["without"], "?"), as_array(row["sizes"], "<i8"), as_array(unzip(row["text"]), "u1"), as_array(row["nulls"], "?"), row["rest"])


SCHEMA = "chunk long, doc_ids binary, without binary, sizes binary, nulls binary, text binary, rest binary"


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunks of docs(doc_id, text and others) as a written table: which document is in which chunk is settled by it.

    Rows without doc_id come last; a document longer than a chunk has one of its own.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[0], r[1] or b""))
            rest = None
            if others:
                whole = pa.Table.from_batches([r[2] for r in rows]).combine_chunks()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, whole.schema) as out:
                    out.write_table(whole)
                rest = zip_(sink.getvalue().to_pybytes())
            cols = {
                "chunk": pa.array([(part << 32) + seq], pa.int64()),
                "doc_ids": pa.array([np.array([r[0] for r in rows], dtype="<i8").tobytes()], pa.binary()),
                "without": pa.array([np.array([r[3] for r in rows], dtype="?").tobytes()], pa.binary()),
                "sizes": pa.array([np.array([len(r[1] or b"") for r in rows], dtype="<i8").tobytes()], pa.binary()),
                "nulls": pa.array([np.array([r[1] is None for r in rows], dtype="?").tobytes()], pa.binary()),
                "text": pa.array([zip_(b"".join(r[1] or b"" for r in rows))], pa.binary()),
                "rest": pa.array([rest], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(cols)

        for batch in batches:
            rest = batch.select(others) if others else None
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
                rows.append((NO_ID if doc_id is None else doc_id, text, rest.slice(i, 1) if others else None, doc_id is None))
                size += len(text or b"") + 16
                if size >= chunk_bytes:
                    yield full()
                    rows, size, seq = [], 0, seq + 1
        if rows:
            yield full()

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), *[F.col(f"`{c}`") for c in others])
    return written(docs.mapInArrow(run, SCHEMA), "chunks")


# ---------------------------------------------------------------------------------------------------- hashes of units


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word.  Documents must be set apart by a space."""
    inside = np.concatenate([[False], ~IS_SPACE[text], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def spaced(chunk: Chunk, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's text with a space after each document, and where each document starts in it."""
    ends = np.cumsum(chunk.sizes + 1)
    starts = ends - chunk.sizes - 1
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[ends - 1] = False
    out[keep] = LOWER[chunk.text] if lower else chunk.text
    return out, starts


@dataclass
class Words:
    """The words of some documents, one after another.  ids: equal for equal words, compared byte by byte; hashes: 64 bits
    of a 128-bit hash of each word, the same in every chunk; doc, starts, ends: where a word stands in text."""

    ids: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def numbered(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, equal for equal words, and the different words by number."""
    inside = ~IS_SPACE[text]
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[inside])])
    found = words.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """Half of a keyed 128-bit hash of each word."""
    digests = b"".join([xxhash.xxh3_128_digest(w, 0x15A7) for w in words.to_pylist()])
    return np.frombuffer(digests, dtype="<u8")[::2].astype(np.uint64)


def words_of(text: np.ndarray, doc_starts: np.ndarray) -> Words:
    """Words of spaced text."""
    starts, ends = word_spans(text)
    ids, different = numbered(text, starts, ends)
    doc = np.searchsorted(doc_starts, starts, side="right") - 1
    return Words(ids, word_hashes(different)[ids], doc, text, starts, ends)


#: Hashed bytes, units of operators that look at bytes.
MIXED = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes.  For each a it takes different b to different values, and the other way round; it is not
    linear, so no pattern of units makes long sequences collide."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x += b
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


#: Units of which grams are hashed at once, so that they stay in the processor's cache.
SLICE = 1 << 14


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k units that follow each other, a tree of pairs; len(units) - k + 1 of them."""
    n = max(0, len(units) - k + 1)
    out = np.empty(n, dtype=np.uint64)
    for i in range(0, n, SLICE):
        out[i : i + SLICE] = doubled(units[i : i + SLICE + k - 1], k)
    return out


def run_classes(ids: np.ndarray, places: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for the `length` ids at each place, equal just where all of these are, and the first place of each number.

    hashes: gram_hashes at the places, which tell what to compare.  places ascend; where the place before, one back, is
    compared with the place before, one back, the last of the ids decides.
    """
    if not len(places):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = np.argsort(hashes)
    begins = np.flatnonzero(np.r_[True, hashes[order][1:] != hashes[order][:-1]])
    first = np.minimum.reduceat(order, begins)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(order)]))
    to = places[first[number]]
    other = places != to
    follows = np.r_[False, other[1:] & (places[1:] == places[:-1] + 1) & (to[1:] == to[:-1] + 1)]
    a, b = places[follows] + length - 1, to[follows] + length - 1
    equal = bool((ids[a] == ids[b]).all())
    a, b = places[other & ~follows], to[other & ~follows]
    for i in range(length):
        equal = equal and bool((ids[a + i] == ids[b + i]).all())
    if not equal:  # two have one hash
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(ids[p : p + length].tobytes(), len(known)) for p in places])
        first = np.unique(number, return_index=True)[1]
    return number, first


def pair_classes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers from 0, equal just where both numbers are."""
    return pd.factorize(a * (int(b.max(initial=0)) + 1) + b)[0]


def doubled(units: np.ndarray, k: int) -> np.ndarray:
    out, have = units, 1
    for bit in bin(k)[3:]:
        out = combined(out[:-have], out[have:])
        have *= 2
        if bit == "1":
            out = combined(out[: len(units) - have], units[have:])
            have += 1
    return out


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[w - span : w - span + n])


# ----------------------------------------------------------------------------------------------------------- exchanges


def buckets_for(n_chunks: int, per_bucket: int = 12) -> int:
    return max(1, -(-n_chunks // per_bucket))


def bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket of sorted keys begins and ends; buckets are ranges of equal width."""
    return np.searchsorted(keys >> np.uint64(32), np.array([-(-(b << 32) // n) for b in range(n + 1)], dtype=np.uint64))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def over(chunks: DataFrame, f: Callable[[Chunk, dict], Iterator[dict]], schema: str | StructType, batch_rows: int = 4096) -> DataFrame:
    """Rows that f(chunk, row) yields for each chunk; row has what was joined to it."""
    types = to_arrow_schema(schema if isinstance(schema, StructType) else chunks.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out: list[dict] = []
                size = 0
                for x in f(Chunk.of(row), row):
                    out.append(x)
                    size += sum(len(v) for v in x.values() if isinstance(v, bytes)) + 64
                    if size > 8 << 20 or len(out) >= batch_rows:
                        yield arrow(out, types)
                        out, size = [], 0
                if out:
                    yield arrow(out, types)

    return chunks.mapInArrow(run, schema)


def arrow(rows: list[dict], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in types], schema=types)


def returned(chunks: DataFrame, *sent: tuple[DataFrame, str]) -> DataFrame:
    """chunks with what was sent back to each, a list of blobs by name.  Both sides are shuffled, at any size."""
    for df, name in sent:
        chunks = chunks.join(df.groupBy("chunk").agg(F.collect_list(name).alias(name)).hint("merge"), "chunk", "left")
    return chunks


SENT = "bucket int, chunk long, keys binary, counts binary"


def send_keys(chunk: Chunk, keys: np.ndarray, counts: np.ndarray, n_buckets: int) -> Iterator[dict]:
    """Different keys, ascending, to their buckets, and how often the chunk has them (255 stands for more)."""
    edges = bucket_edges(keys, n_buckets)
    counts = np.minimum(counts, 255).astype(np.uint8)
    for b in np.flatnonzero(np.diff(edges)):
        s = slice(edges[b], edges[b + 1])
        yield {"bucket": int(b), "chunk": chunk.id, "keys": keys[s].tobytes(), "counts": counts[s].tobytes()}


def repeated_keys(sent: DataFrame, hot_rows: int) -> DataFrame:
    """(chunk, repeated, hot): the keys of each chunk that all chunks have twice or more, and of those the ones that they
    have over hot_rows times."""

    def reduce(t: pa.Table) -> pa.Table:
        chunk = t["chunk"].to_numpy()
        keys = [as_array(x, "<u8") for x in t["keys"].to_pylist()]
        sizes = np.array([len(x) for x in keys])
        keys, counts = np.concatenate(keys), np.concatenate([as_array(x, "u1") for x in t["counts"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        n = np.add.reduceat(counts[order], first, dtype=np.int64)
        level = np.empty(len(keys), dtype=np.int8)
        level[order] = np.repeat((n > 1).astype(np.int8) + (n > hot_rows), np.diff(np.r_[first, len(keys)]))
        ends = np.cumsum(sizes)
        out = [(int(c), keys[e - m : e][level[e - m : e] > 0].tobytes(), keys[e - m : e][level[e - m : e] > 1].tobytes()) for c, m, e in zip(chunk, sizes, ends)]
        out = [x for x in out if x[1]]
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "repeated": pa.array([x[1] for x in out], pa.binary()), "hot": pa.array([x[2] for x in out], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(reduce, "chunk long, repeated binary, hot binary")


def joined(blobs: list[bytes] | None, kind: str = "<u8") -> np.ndarray:
    return np.sort(np.concatenate([as_array(b, kind) for b in blobs])) if blobs else np.zeros(0, dtype=kind)


def member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array of."""
    if not len(of):
        return np.zeros(len(x), dtype=bool)
    at = np.searchsorted(of, x)
    at[at == len(of)] = 0
    return of[at] == x
