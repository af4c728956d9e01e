"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, sqrt(M^2 - |v|^2) with M the largest norm, so that the largest inner product is the
smallest distance; queries get 0 there.  All are rotated by one random orthogonal matrix.  Lists come from k-means on a
bounded sample of the rows (sample_rows, those with the smallest hashed ids); every row is then indexed in the list of
its nearest centroid.  Neighbouring lists lie together in blocks of about block_rows rows, and longer lists are cut into
several.  Vectors far longer than most (over giant times the median norm) would blur all distances; they have a list of
their own that every query probes to the end, in double precision.

How many lists a query probes is measured: queries of the sample look for their neighbours in the sample, and the share of
the lists that finds `recall` of these is taken.  Vectors in clusters need few lists, vectors without any need many.

In each probed list distances grow by one block of columns at a time.  After d of D
columns the partial squared distance p estimates the whole as p * D / d, and a candidate is abandoned if that exceeds
(1 + epsilon / sqrt(d))^2 times a bound for the k-th smallest distance: the hypothesis that it is near enough is rejected.
The bound is the query's k-th smallest distance to the sample in the lists that it probes, raised to where no test abandons
these k.  What is left gets its inner product from the original vectors in double precision.

A query is sent once to each block that has a list it probes.  A block that more than query_rows queries ask is copied for
each query_rows of them.  Vectors that are null, zero, of another length than most, or hold null or non-finite components
take no part.  Rows that share the query's id are its own and no candidates; repeated queries count once.  Ties go to the
smaller id.  An empty input gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

RESULT = "query_id long, vec_id long, score double"


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        home = nearest_centre(x, centres)
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, home, x)
        n = np.bincount(home, minlength=len(centres))
        centres[n > 0] = (sums[n > 0] / n[n > 0, None]).astype(x.dtype)
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[rng.integers(0, len(x), len(empty))]
    return centres


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :], 0)


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    for i in range(0, len(x), 8192):
        out[i : i + 8192] = distances(x[i : i + 8192], centres).argmin(1)
    return out


def scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int, step: int, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that no test has abandoned; bound: of each query's k-th smallest squared distance."""
    n, dim = x.shape
    part, d = distances(q[:, :step], x[:, :step]), min(dim, step)
    alive = part <= (bound * factor(d, dim, epsilon))[:, None]
    while d < dim and alive.mean() > 0.1:  # many are left: whole blocks of columns at once
        e = min(dim, d + step)
        part += distances(q[:, d:e], x[:, d:e])
        d = e
        alive &= part <= (bound * factor(d, dim, epsilon))[:, None]
    who, which = np.nonzero(alive)
    own = part[who, which]
    while d < dim and len(who):
        e = min(dim, d + step)
        own = own + ((x[which, d:e] - q[who, d:e]) ** 2).sum(1)
        d = e
        keep = own <= bound[who] * factor(d, dim, epsilon)
        who, which, own = who[keep], which[keep], own[keep]
    return who, which


def widened(squared: np.ndarray) -> np.ndarray:
    """Bounds that rounding of distances of unit vectors in single precision does not undercut."""
    return squared * (1 + 1e-4) + 1e-5


def bounds(q: np.ndarray, points: np.ndarray, far: np.ndarray, k: int, step: int, epsilon: float) -> np.ndarray:
    """For each query a bound under which no test abandons its k nearest points; far: squared distances to all points,
    infinite where a point is no candidate."""
    if len(points) < k:
        return np.full(len(q), np.inf)
    dim = points.shape[1]
    near = np.argpartition(far, k - 1, axis=1)[:, :k]
    out = far[np.arange(len(q))[:, None], near].max(1).astype(np.float64)
    part = np.zeros(near.shape, dtype=np.float64)
    for d in range(0, dim, step):
        e = min(dim, d + step)
        part += ((points[near, d:e] - q[:, None, d:e]) ** 2).sum(2)
        out = np.maximum(out, (part / factor(e, dim, epsilon)).max(1))
    return out


def factor(d: int, dim: int, epsilon: float) -> float:
    """The share of a squared distance that d of dim columns may have before the test abandons it."""
    return d / dim * (1 + epsilon / math.sqrt(d)) ** 2 if d < dim else 1.0


def norms(v: np.ndarray) -> np.ndarray:
    """Euclidean norms of rows, none of which is zero, without overflow."""
    top = np.abs(v).max(1, initial=0)
    return top * np.sqrt(((v / top[:, None]) ** 2).sum(1))


def probe_share(sample: np.ndarray, queries: np.ndarray, centres: np.ndarray, k: int, recall: float) -> float:
    """The share of the lists, nearest first, that hold `recall` of the k nearest of each of the sample's queries."""
    far = distances(queries, sample)
    far[np.arange(len(queries)), np.arange(len(queries))] = np.inf  # queries are the first of the sample
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    near = np.argpartition(far, k - 1, axis=1)[:, :k]
    order = distances(queries, centres).argsort(1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], 1)
    found = np.sort(np.take_along_axis(place, nearest_centre(sample, centres)[near], 1).ravel())
    return float(found[min(len(found) - 1, math.ceil(recall * len(found)))] + 1) / len(centres)


def valid(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, *, recall: float = 0.96, epsilon: float = 2.1, step: int = 16, sample_rows: int = 20_000, most_lists: int = 4096, block_rows: int = 4096, query_rows: int = 32_768, giant: float = 8.0, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the largest inner product, for each row with is_query.

    rows: vec_id long, vector array of numbers.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & valid(F.col("vector")))

    def measure(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            flat, norm = batch.column("vector").flatten().to_numpy(zero_copy_only=False), np.zeros(len(sizes))
            ends = np.cumsum(sizes)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                norm[own] = norms(flat[(ends[own] - size)[:, None] + np.arange(size)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int32()), pa.array(norm)], [*batch.schema.names, "dim", "norm"])

    rows = written(rows.mapInArrow(measure, "vec_id long, vector array<double>, asks boolean, dim int, norm double"), "valid")
    shape = rows.groupBy("dim").agg(F.count("*").alias("n"), F.percentile_approx("norm", 0.5).alias("median")).orderBy(F.desc("n"), "dim").first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, unit = shape["dim"], shape["n"], shape["median"]
    rows = rows.where(F.col("dim") == dim)
    top = rows.where(F.col("norm") <= giant * unit).agg(F.max("norm")).first()[0]  # of all but the giants
    rows = rows.select("vec_id", "vector", "asks")
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim + 1, dim + 1)))[0].astype(np.float32)

    def rotated(v: np.ndarray, query: bool) -> np.ndarray:
        """Rows in units of the largest norm; a query's length doesn't matter to its order of candidates."""
        if query:
            return np.column_stack([v / norms(v)[:, None], np.zeros(len(v))]).astype(np.float32) @ rotation
        v = v / top
        last = np.sqrt(np.maximum(1 - (v * v).sum(1), 0))
        return np.column_stack([v, last]).astype(np.float32) @ rotation

    k_lists = int(min(most_lists, max(1, math.sqrt(n))))
    sample = rows.select("vec_id", "vector").orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(max(sample_rows, 32 * k_lists)).toArrow()
    raw = matrix(sample["vector"], dim)
    small = norms(raw) <= giant * unit
    raw, known = raw[small], sample["vec_id"].to_numpy()[small]
    points = rotated(raw, False)
    centres = k_means(points, k_lists, seed=seed)
    centres = centres[np.argsort(((centres - centres.mean(0)) @ np.linalg.svd(centres - centres.mean(0), full_matrices=False)[2][0]))]  # neighbours side by side
    share = probe_share(points, rotated(raw[:500], True), centres, k, recall)
    probes = max(1, math.ceil(len(centres) * share))
    giants = len(centres)  # number of the list of the longest vectors
    sent = spark.sparkContext.broadcast((centres, points[:sample_rows], known[:sample_rows], nearest_centre(points[:sample_rows], centres)))

    def index(batches):
        for batch in batches:
            v = matrix(pa.chunked_array([batch.column("vector")]), dim)
            with np.errstate(over="ignore", invalid="ignore"):
                home = np.where(norms(v) > giant * unit, giants, nearest_centre(rotated(np.where(norms(v)[:, None] > giant * unit, 1.0, v), False), sent.value[0])) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), batch.column("asks"), pa.array(home, pa.int32())], ["vec_id", "vector", "asks", "list"])

    indexed = written(rows.mapInArrow(index, "vec_id long, vector array<double>, asks boolean, list int"), "vectors")
    sizes = np.zeros(giants + 1, dtype=np.int64)
    for row in indexed.groupBy("list").count().collect():  # at most most_lists + 1 rows
        sizes[row["list"]] = row["count"]
    # lists side by side share a block up to block_rows; a longer one has several
    cuts = np.maximum(1, -(-sizes // block_rows))
    first_block, at, room = np.zeros(giants + 1, dtype=np.int64), 0, block_rows
    for i, (size, n_cuts) in enumerate(zip(sizes.tolist(), cuts.tolist())):
        if i and (n_cuts > 1 or cuts[i - 1] > 1 or size > room or i == giants):
            at, room = at + int(cuts[i - 1]), block_rows
        first_block[i], room = at, room - size
    queries = indexed.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = queries.repartition(max(1, -(-n // 50_000)), "vec_id")

    def probe(batches):
        """Each query to each block that has lists it probes, with these lists and the bound of its k-th distance."""
        centres, points, ids, homes = sent.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 512):
                batch = whole.slice(begin, 512)
                v, q_id = matrix(pa.chunked_array([batch.column("vector")]), dim), batch.column("vec_id").to_numpy()
                r = rotated(v, True)
                order = distances(r, centres).argsort(1)
                enough = (np.cumsum(sizes[order], 1) - sizes[order]) <= 2 * k  # lists go on while there are few candidates
                take = enough | (np.arange(len(centres)) < probes)[None, :]
                probed = np.zeros((len(v), len(centres)), dtype=bool)
                np.put_along_axis(probed, order, take, 1)
                far = np.where(probed[:, homes] & (q_id[:, None] != ids[None, :]), distances(r, points), np.inf)
                bound = bounds(r, points, far, k, step, epsilon)
                who, nth = np.nonzero(take)
                who, lists = np.r_[who, np.arange(len(v)) if sizes[giants] else who[:0]], np.r_[order[who, nth], np.full(len(v) if sizes[giants] else 0, giants)]
                keep = sizes[lists] > 0
                who, lists = who[keep], lists[keep]
                who, cut, lists = np.repeat(who, cuts[lists]), running(cuts[lists]), np.repeat(lists, cuts[lists])
                block = first_block[lists] + cut
                by = np.lexsort((lists, who, block))
                who, block, lists = who[by], block[by], lists[by]
                new = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (block[1:] != block[:-1])]) if len(who) else who
                ends = np.r_[new, len(who)]
                for i in range(0, len(new), 8192):
                    j = min(len(new), i + 8192)
                    own = pa.ListArray.from_arrays(pa.array(ends[i : j + 1] - ends[i], pa.int32()), pa.array(lists[ends[i] : ends[j]], pa.int32()))
                    at = pa.array(who[new[i:j]])
                    yield pa.RecordBatch.from_arrays([pa.array(block[new[i:j]], pa.int32()), own, pa.array(bound[who[new[i:j]]].astype(np.float64)), batch.column("vec_id").take(at), batch.column("vector").take(at)], ["block", "lists", "bound", "vec_id", "vector"])

    asked = queries.mapInArrow(probe, "block int, lists array<int>, bound double, vec_id long, vector array<double>")
    n_queries = queries.count()
    if n_queries > query_rows:  # blocks may be asked by more than one task takes
        counts = asked.groupBy("block").count().collect()  # as many as blocks
    else:
        counts = []
    copies = {r["block"]: -(-r["count"] // query_rows) for r in counts if r["count"] > query_rows}
    n_blocks = int(first_block[-1] + cuts[-1])
    of_block = F.array(*[F.lit(copies.get(b, 1)) for b in range(n_blocks)]) if copies else None
    chunks = lambda c: F.element_at(of_block, c + 1) if copies else F.lit(1)
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + 1), "vec_id"), chunks(F.col("block"))).cast("int"))
    numbers = lambda x: F.element_at(F.array(*[F.lit(int(i)) for i in x]), F.col("list") + 1)
    base = indexed.withColumn("block", (numbers(first_block) + F.pmod(F.xxhash64(F.lit(seed + 2), "vec_id", F.monotonically_increasing_id()), numbers(cuts))).cast("int"))
    base = base.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks(F.col("block")) - 1)) if copies else F.lit(0)).drop("asks")

    def search(key, q: pa.Table, x: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(q) and len(x):
            home = x["list"].to_numpy()
            x = x.take(np.argsort(home, kind="stable"))
            home = np.sort(home)
            asks = q["lists"].combine_chunks()
            who, lists = np.repeat(np.arange(len(q)), asks.value_lengths().to_numpy(zero_copy_only=False)), asks.flatten().to_numpy(zero_copy_only=False)
            qv, xv, q_id, x_id, bound = matrix(q["vector"], dim), matrix(x["vector"], dim), q["vec_id"].to_numpy(), x["vec_id"].to_numpy(), q["bound"].to_numpy().copy()
            qr, xr = rotated(qv, True), rotated(xv, False) if home[0] != giants else None
            for one in np.unique(lists):
                a, e = np.searchsorted(home, (one, one + 1))
                asking = who[lists == one]
                for i in range(0, len(asking) if e > a else 0, 256):
                    own = asking[i : i + 256]
                    if one == giants:
                        at, left = (z.ravel() for z in np.indices((len(own), e - a)))
                    else:
                        limit = widened(bound[own])
                        at, left = scan(qr[own], xr[a:e], limit, k, step, epsilon)
                    at, left = own[at], left + a
                    other = x_id[left] != q_id[at]
                    at, left = at[other], left[other]
                    with np.errstate(over="ignore", invalid="ignore"):
                        score = (xv[left] * qv[at]).sum(1)  # each row by itself: equal vectors get equal scores
                    by = np.lexsort((x_id[left], -score, at))
                    at, left, score = at[by], left[by], score[by]
                    best = running(np.diff(np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]), len(at)])) < k if len(at) else np.zeros(0, dtype=bool)
                    found.append((q_id[at[best]], x_id[left[best]], score[best]))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    by = ["block", "chunk"]
    found = asked.groupBy(*by).cogroup(base.groupBy(*by)).applyInArrow(search, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def running(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after another."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def op2_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of each row whose vec_id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest(rows, F.col("vec_id") % 20 == 0)
