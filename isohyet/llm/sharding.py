"""Uniform shuffle into shards of exact size by hypergeometric communication matrices.

Rows lie in source partitions (a hash of the whole row).  How many rows go from each partition to each group of slots is
drawn exactly: the matrix with the partition sizes as row sums and the group sizes as column sums, distributed as under
a uniformly random permutation of all rows.  Each partition permutes its rows and deals them out by its row of the
matrix, and rows are exchanged.  A group is a run of slots of one shard.  In it rows lie in partitions again, and a second
matrix, permutation and exchange deals them to cells, runs of slots of bounded length; each cell permutes what it got.  So
no task holds a whole shard.  With n / partition_rows partitions there are about as many groups as their root, so the
matrices take work of the order of n ** 1.5 / partition_rows ** 1.5, a few core-seconds for 10 ** 9 rows.

Nobody holds a matrix.  A partition finds its own row by halving the range of partitions: at each node of that
binary tree the counts of the left half are one multivariate hypergeometric draw, seeded by the node.

Rows that are equal in all columns lie in one partition, as long as these hold no more than hot_factor * partition_rows;
beyond that the rows of the partition are dealt to several by their place in the input, which is written first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, free_names, mix, table, tasks, written

#: numpy's hypergeometric draws are limited to populations below this.
NUMPY_LIMIT = 1_000_000_000


def hypergeometric(good: int, bad: int, sample: int, rng: np.random.Generator) -> int:
    """Number of good items in a sample; exact also for populations beyond numpy's limit (ratio of uniforms)."""
    good, bad, sample = int(good), int(bad), int(sample)
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    total = good + bad
    mean = sample * (good / total)
    var = mean * (bad / total) * ((total - sample) / (total - 1))
    weight = lambda x: -sum(map(math.lgamma, (x + 1, good - x + 1, sample - x + 1, bad - sample + x + 1)))
    top = weight(min(high, max(low, math.floor((sample + 1) * ((good + 1) / (total + 2))))))
    width = 2 * math.sqrt(2 / math.e) * math.sqrt(var + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        u, v = rng.random(), rng.random()
        if not u:
            continue
        x = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= x <= high and 2 * math.log(u) <= weight(x) - top:
            return x


def draw(columns: np.ndarray, sample: int, rng: np.random.Generator) -> np.ndarray:
    """How many of sample items, drawn without replacement, come from each column."""
    columns = np.asarray(columns, dtype=np.int64)
    if columns.sum() < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(columns, int(sample), method="marginals")
    out, rest = np.zeros_like(columns), int(columns.sum())
    for i, n in enumerate(columns):
        rest -= int(n)
        out[i] = x = hypergeometric(n, rest, sample, rng)
        sample -= x
    return out


def halved(low: int, high: int, cells: np.ndarray, left_of: np.ndarray, seed: list[int]) -> list[tuple[int, int, np.ndarray]]:
    """A range of rows with its column sums, as two; left_of: running sums of all rows' sums."""
    mid = (low + high) // 2
    left = draw(cells, left_of[mid] - left_of[low], np.random.default_rng([*seed, low, high]))
    return [(low, mid, left), (mid, high, cells - left)]


def large_ranges(left_of: np.ndarray, cells: np.ndarray, seed: list[int]) -> list[tuple[int, int, np.ndarray]]:
    """The upper part of the tree, for all: ranges of rows that numpy can draw from, with their column sums."""
    todo, out = [(0, len(left_of) - 1, np.asarray(cells, dtype=np.int64))], []
    while todo:
        low, high, own = todo.pop()
        if high - low > 1 and left_of[high] - left_of[low] >= NUMPY_LIMIT:
            todo += halved(low, high, own, left_of, seed)
        else:
            out.append((low, high, own))
    return out


def matrix_row(p: int, left_of: np.ndarray, ranges: list[tuple[int, int, np.ndarray]], seed: list[int]) -> np.ndarray:
    """Row p of the matrix with running sums left_of of the row sums, from the upper part of its tree."""
    low, high, cells = next(r for r in ranges if r[0] <= p < r[1])
    while high - low > 1:
        low, high, cells = next(r for r in halved(low, high, cells, left_of, seed) if r[0] <= p < r[1])
    return cells


def running(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


class Cells:
    """Runs of slots: each shard is cut into groups, each group into cells; all sizes follow from the number of rows."""

    def __init__(self, rows: int, n_shards: int, groups: int, cell_rows: int) -> None:
        self.rows, self.n_shards, self.cell_rows = rows, n_shards, cell_rows
        self.per_shard = max(1, -(-groups // n_shards))
        g = np.arange(n_shards * self.per_shard, dtype=np.int64)
        self.shard, k = g // self.per_shard, g % self.per_shard
        size = rows // n_shards + (self.shard < rows % n_shards)
        self.first = size * k // self.per_shard
        self.size = size * (k + 1) // self.per_shard - self.first

    def of(self, group: int) -> np.ndarray:
        """First slots in the group of its cells, and its end."""
        n = int(self.size[group])
        k = max(1, -(-n // self.cell_rows))
        return n * np.arange(k + 1, dtype=np.int64) // k


def sizes_of(df: DataFrame, column: str, n: int) -> np.ndarray:
    """Rows by number; n numbers, 8 bytes each."""
    out = np.zeros(n, dtype=np.int64)
    found = df.groupBy(column).agg(F.count("*").alias("n")).toArrow()
    out[found[column].to_numpy()] = found["n"].to_numpy()
    return out


def shard_rows(df: DataFrame, id_col: str, n_shards: int = 16, *, seed: int = 7, partition_rows: int = 20_000, cell_rows: int = 20_000, hot_factor: int = 4) -> DataFrame:
    """df with shard (int) and slot (long, gapless from 0 in each shard), a uniformly random placement.

    Equal ids and repeated rows are placed one by one; a null id counts as an id.  An empty input gives no rows.
    Columns of df that are called shard or slot are replaced; any others may be there.
    The result depends on the rows and the seed alone, not on how the input lies in partitions, unless so many rows are
    equal that they are more than hot_factor partitions hold.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    home, key, group, cell, at, part = free_names(kept, "home", "key", "group", "cell", "at", "part")
    plain = df.select(*[F.col(f"`{c}`") for c in kept])
    hashed = [F.col(f"`{c}`") for c in [id_col] + [c for c in kept if c != id_col and "map<" not in df.schema[c].dataType.simpleString()]]
    n = plain.count()
    p_count = tasks(df.sparkSession, n, partition_rows)
    # equal keys are equal rows, so an order by key doesn't depend on how rows arrive
    keyed = plain.withColumn(key, F.xxhash64(F.lit(seed), *hashed))
    keyed = keyed.withColumn(home, F.pmod(F.xxhash64(F.lit(seed + 1), key), F.lit(p_count)).cast("int"))
    counts = sizes_of(keyed, home, p_count)
    if (hot := counts > hot_factor * partition_rows).any():
        salt = F.pmod(F.xxhash64(F.lit(seed + 2), F.monotonically_increasing_id()), F.lit(p_count)).cast("int")
        hot = [int(p) for p in np.flatnonzero(hot)]  # at most p_count / hot_factor
        keyed = written(keyed.withColumn(home, F.when(F.col(home).isin(hot), salt).otherwise(F.col(home))), "salted")
        counts = sizes_of(keyed, home, p_count)
    cells = Cells(n, n_shards, math.isqrt(p_count), cell_rows)
    parts = np.maximum(1, -(-cells.size // partition_rows))  # of each group
    first_part = np.cumsum(parts) - parts
    sc = df.sparkSession.sparkContext
    left_of = running(counts)
    sent = sc.broadcast((left_of, large_ranges(left_of, cells.size, [seed])))  # 8 bytes for each partition_rows rows

    def deal(t: pa.Table) -> pa.Table:
        p = t[home][0].as_py()
        t = t.take(np.argsort(t[key].to_numpy(), kind="stable"))
        t = t.take(np.random.default_rng([seed, p, 1]).permutation(len(t)))
        to = np.repeat(np.arange(len(cells.size)), matrix_row(p, *sent.value, [seed]))
        t = t.append_column(group, pa.array(to, pa.int32())).append_column(at, pa.array(np.arange(len(t)), pa.int64()))
        return t.append_column(part, pa.array(first_part[to] + spread(p, np.arange(len(t)), parts[to]), pa.int32()))

    def spread(p: int, i: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Which of so many partitions of its group a row goes to; any choice does that doesn't look at the rows."""
        return (mix(np.uint64(p << 32) + i.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % of

    dealt = keyed.groupBy(home).applyInArrow(deal, f"{ddl(keyed.schema)}, `{group}` int, `{at}` long, `{part}` int")
    dealt = written(dealt, "dealt") if len(first_part) < int(parts.sum()) else dealt  # counted and then dealt again
    again = sc.broadcast(sizes_of(dealt, part, int(parts.sum())) if len(first_part) < int(parts.sum()) else cells.size)

    def deal_again(t: pa.Table) -> pa.Table:
        g, q = t[group][0].as_py(), t[part][0].as_py()
        t = t.take(np.lexsort((t[at].to_numpy(), t[home].to_numpy())))
        t = t.take(np.random.default_rng([seed, q, 3]).permutation(len(t)))
        own = running(again.value[first_part[g] : first_part[g] + parts[g]])
        row = matrix_row(q - int(first_part[g]), own, large_ranges(own, np.diff(cells.of(g)), [seed, g]), [seed, g])
        return t.append_column(cell, pa.array(np.repeat(np.arange(len(row)), row), pa.int32()))

    def place(t: pa.Table) -> pa.Table:
        g, c = t[group][0].as_py(), t[cell][0].as_py()
        t = t.take(np.lexsort((t[at].to_numpy(), t[home].to_numpy())))
        slot = int(cells.first[g] + cells.of(g)[c]) + np.random.default_rng([seed, g, c, 2]).permutation(len(t))
        return t.select(kept).append_column("shard", pa.array(np.full(len(t), cells.shard[g]), pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    moved = dealt.groupBy(group, part).applyInArrow(deal_again, f"{ddl(dealt.schema)}, `{cell}` int")
    return moved.groupBy(group, cell).applyInArrow(place, f"{ddl(plain.schema)}, shard int, slot long")


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15, counts at most one apart (law rows)."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(docs, "doc_id", 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
