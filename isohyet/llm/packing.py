"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Documents are cut into pieces of at most one capacity.  Pieces are dealt into groups of bounded size by their place in the
input, which spreads any source, document or cluster over all groups, and each
group is packed by itself, longest piece first.  Open bins stand in order of their residual room; each carries a bitmap
of the sources it holds (in planes: plane i has the sources that it holds more than i times) and one of its duplicate
clusters.  The search starts at the smallest residual that takes the piece and goes on to the next bin until one has no
conflict: no two documents of one cluster, no more pieces of one source than its limit.  A source's limit is per_source,
or twice what a full bin has of it on average if that is more: a source with a third of all pieces must be in every bin,
and one that all pieces come from is no conflict.

Null texts and texts without words take no room and are in no bin.  A null source counts as a source of its own, a
document without cluster as a cluster of its own.  Equal doc_ids (repeated rows) are packed one by one; as equal texts
are of one cluster, they lie in different bins.  An empty input gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, table, tasks, written

SCHEMA = "bin_id long, slot int, doc_id long, source string, cluster long, piece int, start long, n_words int"


def n_words(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.size(F.filter(F.split(text, f"[{SPACES}]+"), lambda x: x != "")), F.lit(0))


def same_text(text: Column) -> Column:
    """Cluster key that is equal for texts that differ in case and spaces only."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(text, f"[{SPACES}]+", " "))))


class Bins:
    """Open bins of one group in order of residual room."""

    def __init__(self, capacity: int, limits: list[int]) -> None:
        self.capacity, self.limits, self.n_planes = capacity, limits, max(limits, default=1)
        self.residuals: list[int] = []  # those that have bins, ascending
        self.at: dict[int, list[int]] = {}  # residual: bins, in order of opening
        self.planes: list[list[int]] = []  # of each bin: bitmaps of sources
        self.clusters: list[int] = []  # of each bin: bitmap of clusters

    def _put(self, bin_: int, residual: int) -> None:
        if residual:
            if residual not in self.at:
                insort(self.residuals, residual)
                self.at[residual] = []
            insort(self.at[residual], bin_)

    def add(self, length: int, source: int, cluster: int) -> int:
        """The bin that takes the piece; cluster is 0 or has one bit."""
        bit, last = 1 << source, self.limits[source] - 1
        for i in range(bisect_left(self.residuals, length), len(self.residuals)):
            residual = self.residuals[i]
            for k, bin_ in enumerate(bins := self.at[residual]):
                if not (self.clusters[bin_] & cluster or self.planes[bin_][last] & bit):
                    del bins[k]
                    if not bins:
                        del self.at[residual], self.residuals[i]
                    break
            else:
                continue
            break
        else:
            bin_, residual = len(self.planes), self.capacity
            self.planes.append([0] * self.n_planes)
            self.clusters.append(0)
        planes = self.planes[bin_]
        for i, plane in enumerate(planes):
            if not plane & bit:
                planes[i] = plane | bit
                break
        self.clusters[bin_] |= cluster
        self._put(bin_, residual - length)
        return bin_


def limits_of(lengths: np.ndarray, sources: np.ndarray, capacity: int, per_source: int) -> list[int]:
    """How many pieces of each source a bin may have."""
    share = np.bincount(sources) / max(len(sources), 1)
    return np.maximum(per_source, np.ceil(2 * share * capacity / max(lengths.mean(), 1))).astype(int).tolist() if len(lengths) else []


def pack_group(lengths, sources, clusters, capacity: int, limits: list[int]) -> np.ndarray:
    """Bin of each piece, which come longest first.  clusters: -1 for none; limits: of each source."""
    bins = Bins(capacity, limits)
    return np.array([bins.add(int(n), int(s), 0 if c < 0 else 1 << int(c)) for n, s, c in zip(lengths, sources, clusters)], dtype=np.int64)


def pack(docs: DataFrame, capacity: int = 2048, *, per_source: int = 2, group_rows: int = 2048, seed: int = 5) -> DataFrame:
    """Bins of docs(doc_id, source, cluster, n_words): one row a piece, as SCHEMA says.

    bin_id is unique over all groups, slot is the piece's place in its bin, start the first word of the piece in its
    document.  Pieces that fill a bin alone need no search.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("cluster").cast("long"), F.col("n_words").cast("long"))
    pieces = docs.where("n_words > 0").withColumn("piece", F.explode(F.sequence(F.lit(0), ((F.col("n_words") - 1) / capacity).cast("int"))))
    start = F.col("piece").cast("long") * capacity
    pieces = pieces.select("doc_id", "source", "cluster", "piece", start.alias("start"), F.least(F.lit(capacity).cast("long"), F.col("n_words") - start).cast("int").alias("n_words"), F.monotonically_increasing_id().alias("_place"))
    # places and words are settled by the table; some 40 bytes a piece
    pieces = written(pieces, "pieces")
    group = F.pmod(F.xxhash64(F.lit(seed), "_place"), F.lit(tasks(spark, pieces.count(), group_rows))).cast("int")
    pieces = pieces.withColumn("_group", group).drop("_place")

    def fill(t: pa.Table) -> pa.Table:
        group = t["_group"][0].as_py()
        # nulls first in each key; what ties then is equal in all columns
        t = t.sort_by([("n_words", "descending"), ("cluster", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("source", "ascending")])
        sources = t["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        clusters = t["cluster"].combine_chunks().dictionary_encode().indices
        clusters = clusters.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        known = clusters >= 0
        often = np.bincount(clusters[known], minlength=1) > 1
        dense = np.where(often, np.cumsum(often) - 1, -1)
        clusters[known] = dense[clusters[known]]
        lengths = t["n_words"].to_numpy()
        bins = pack_group(lengths, sources, clusters, capacity, limits_of(lengths, sources, capacity, per_source))
        order = np.argsort(bins, kind="stable")
        sizes = np.bincount(bins)
        slot = np.empty(len(bins), dtype=np.int32)
        slot[order] = np.arange(len(bins)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cols = {"bin_id": pa.array(bins + (group << 32), pa.int64()), "slot": pa.array(slot)}
        return pa.table(cols | {c: t[c] for c in ("doc_id", "source", "cluster", "piece", "start", "n_words")})

    return pieces.groupBy("_group").applyInArrow(fill, SCHEMA)


def pack_documents(docs: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """pack() of documents(doc_id, source, text); texts that differ in case and spaces only are one cluster."""
    return pack(docs.select("doc_id", "source", same_text(F.col("text")).alias("cluster"), n_words(F.col("text")).alias("n_words")), capacity, **options)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in bins of 2048 words."""
    return pack_documents(table(spark, sf_dir, "documents"))
