"""Connected components of a graph of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collecting, hand_over, remove, written


#: Parts in which the neighbours of a node are gathered.
PARTS = 16


def with_least(edges: DataFrame) -> DataFrame:
    """edges(u, v) with m, the smallest v of each u.

    A node that a third of all edges meet would make one task of them, so its edges are dealt to parts by their other
    end; each part knows its smallest, and a node's parts, PARTS rows at most, tell each other.
    """
    edges = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int"))
    parts = edges.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"), F.collect_list("part").alias("part"))
    return edges.join(least.select("u", "m", F.explode("part").alias("part")), ["u", "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of edges(a, b): component is the smallest node that can be reached.

    Large stars and small stars take turns until no edge changes: each round links a node's neighbours to the smallest of
    them, so the number of edges never grows and no node's neighbours are gathered.  The rounds needed grow with the
    square of the logarithm of the number of nodes.  Each round is written to the shared folder, and the one before goes.  Loops and repeated edges do no harm; nodes without edges are not in the result.
    """
    hi, lo = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    last: list[str] = []
    with collecting(last):
        edges = written(edges.where("a <> b").select(hi, lo).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: each larger neighbour of u to the smallest, u itself included
        m = F.least("u", "m")
        large = with_least(both).where("v > u").select(F.col("v").alias("u"), m.alias("v")).where("u <> v").distinct()
        # small star: each smaller neighbour of u, and u, to the smallest
        ends = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = with_least(large).select(F.explode(ends).alias("e")).select("e.*")
        new: list[str] = []
        with collecting(new):
            edges = written(small.where("u <> v").distinct(), "edges")
        remove(edges.sparkSession, last)
        last = new
        before, state = state, _state(edges)
        if state == before:
            break
    hand_over(last)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.shiftright(h, 20)), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first())
