"""URL filters from a path-template tree with labelled purity.

Each host has a tree of path segments.  Level by level, a segment value stays literal where min_count pages of its node
have it, however many others the node has; rarer values fall into wildcard branches, `*.ext` where min_count of these pages
have that extension, else `*`.  A page's template is its way down this tree, to its last segment; only below a wildcard
branch that fewer than min_count pages are left in, all is one `**`.  Sibling templates are merged by agglomeration: each begins as
a branch, in order of the shares of good pages, and again and again the two neighbours that differ least are joined, by pooled
counts, as long as their shares do not differ significantly (two proportions, z test).  A branch is rejected if its
purity, smoothed towards its host's and that towards the corpus', is below a threshold.  Siblings without labels are a
branch of their own, which its host's purity decides.  Explicit rules come before the method.

A node may have any number of literal branches.  They meet as counts of siblings by (labelled, good), so what is
gathered of a node is its different counts; siblings with equal counts are in one branch.  All counts are aggregated
before they meet, and a level works on the pages only that go on below it.

Null or odd urls get an empty host and path and the template `/`; they are judged like any other page.  An empty
input gives no rows.  Labels of unknown pages are unused, as are those without page_id; repeated labels of one page count as
their mean.  Repeated rows of a page are pages of their own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table, written

#: (host, path, verdict) of the registered query
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: A table of at most this many rows of host, node and segment is broadcast.
SMALL = 20_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def by_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as a string, and its verdict; nulls where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def small(df: DataFrame) -> DataFrame:
    """df for the right side of a join: broadcast if its counted rows are few."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def templates(pages: DataFrame, *, min_count: int = 5) -> DataFrame:
    """pages (with host and path) plus parent and template of each page's path."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    df = pages.withColumns({"_seg": parts, "_node": F.lit(""), "parent": F.lit(""), "_open": F.lit(True)})
    done, level = [], 0
    while True:
        goes_on = F.col("_open") & (F.size("_seg") > level)
        done.append(df.where(~F.coalesce(goes_on, F.lit(False))))
        ext = F.regexp_extract("_s", "(\\.[A-Za-z]{1,5})?$", 0)
        df = df.where(goes_on).withColumn("_s", F.element_at("_seg", level + 1)).withColumn("_ext", ext)
        counts = written(df.groupBy("host", "_node", "_s", "_ext").agg(F.count("*").alias("_n")), "segments")
        if counts.isEmpty():
            break
        rare = counts.where(F.col("_n") < min_count).groupBy("host", "_node", "_ext").agg(F.sum("_n").alias("_n"))
        of_ext = (F.col("_ext") != "") & (F.col("_n") >= min_count)
        literal = counts.where(F.col("_n") >= min_count).select("host", "_node", "_s", F.lit(True).alias("_literal"))
        by_ext = rare.where(of_ext).select("host", "_node", "_ext", F.lit(True).alias("_by_ext"))
        few = rare.where(~of_ext).groupBy("host", "_node").agg((F.sum("_n") < min_count).alias("_few")).where("_few")
        df = df.join(small(literal), ["host", "_node", "_s"], "left").join(small(by_ext), ["host", "_node", "_ext"], "left").join(small(few), ["host", "_node"], "left")
        last = F.size("_seg") == level + 1
        wild = F.when(F.col("_by_ext"), F.concat(F.lit("*"), F.col("_ext"))).when(F.col("_few") & ~last, F.lit("**")).otherwise(F.lit("*"))
        step = F.concat(F.col("_node"), F.lit("/"), F.when(F.col("_literal"), F.col("_s")).otherwise(wild))
        closed = F.col("_literal").isNull() & F.col("_by_ext").isNull() & F.col("_few").isNotNull()
        df = df.withColumns({"parent": F.col("_node"), "_open": ~closed}).withColumn("_node", step)
        df = written(df.drop("_s", "_ext", "_literal", "_by_ext", "_few"), "tree")  # else each level would compute all above it again
        level += 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.withColumn("template", F.when(F.col("_node") == "", F.lit("/")).otherwise(F.col("_node"))).drop("_seg", "_node", "_open")


def agglomerated(counts: Sequence[tuple[float, float]], z: float) -> list[int]:
    """Branch of each (size, good) of some siblings, by number.

    Neighbours in the order of good / size are joined, those first that differ least; sums of sizes and of good pages are
    the joined branch's.  A heap holds the differences of neighbours; those of branches that have changed are passed over.
    """
    order = sorted(range(len(counts)), key=lambda i: (counts[i][1] / counts[i][0], counts[i]))
    size, good = [counts[i][0] for i in order], [counts[i][1] for i in order]
    before, after = list(range(-1, len(order) - 1)), [*range(1, len(order)), -1]
    version, up = [0] * len(order), list(range(len(order)))

    def differ(i: int, j: int) -> float:
        pooled = (good[i] + good[j]) / (size[i] + size[j])
        spread = math.sqrt(max(0.0, pooled * (1 - pooled)) * (1 / size[i] + 1 / size[j]))
        gap = abs(good[i] / size[i] - good[j] / size[j])
        return gap / spread if spread else 0.0 if gap == 0 else math.inf

    heap = [(differ(i, i + 1), i, 0, i + 1, 0) for i in range(len(order) - 1)]
    heapq.heapify(heap)
    while heap:
        d, i, a, j, b = heapq.heappop(heap)
        if d > z:
            break
        if version[i] != a or version[j] != b:
            continue
        size[i], good[i], up[j] = size[i] + size[j], good[i] + good[j], i
        version[i], version[j], after[i] = a + 1, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            heapq.heappush(heap, (differ(i, after[i]), i, version[i], after[i], version[after[i]]))
        if before[i] >= 0:
            heapq.heappush(heap, (differ(before[i], i), before[i], version[before[i]], i, version[i]))
    out = [0] * len(order)
    for place, i in enumerate(order):
        root = place
        while up[root] != root:
            root = up[root]
        up[place] = root
        out[i] = root
    number = {root: k for k, root in enumerate(sorted(set(out)))}
    return [number[root] for root in out]


def judged_templates(pages: DataFrame, *, z: float = 1.64, prior_weight: float = 4.0, purity: float = 0.5) -> DataFrame:
    """(host, parent, template, branch, n, labelled, good, purity, rejected) from pages with host, parent, template and
    good (share of good labels, null without label)."""
    stats = pages.groupBy("host", "parent", "template").agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"))
    corpus = stats.agg((F.sum("good") / F.greatest(F.sum("labelled"), F.lit(1))).alias("share"), F.sum("labelled").alias("n")).first()
    prior = corpus["share"] if corpus["n"] else 1.0
    hosts = stats.groupBy("host").agg(((F.sum("good") + prior_weight * prior) / (F.sum("labelled") + prior_weight)).alias("_host"))
    counts = stats.groupBy("host", "parent", "labelled", "good").agg(F.count("*").alias("siblings")).join(hosts, "host")

    def merge(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        host = rows[0]["_host"]
        total = [(r["siblings"] * r["labelled"], r["siblings"] * r["good"]) for r in rows]
        known = [i for i, (n, _) in enumerate(total) if n]
        # one page of the host's purity is added to each
        branch = dict(zip(known, agglomerated([(total[i][0] + 1, total[i][1] + host) for i in known], z)))
        sums: dict[int, list[float]] = {}
        for i, (n, good) in enumerate(total):
            of = sums.setdefault(branch.get(i, -1), [0, 0.0])
            of[0], of[1] = of[0] + n, of[1] + good
        purity_of = {k: (good + prior_weight * host) / (n + prior_weight) for k, (n, good) in sums.items()}
        own = [branch.get(i, -1) for i in range(len(rows))]
        return pa.table({"host": t["host"].cast(pa.string()), "parent": t["parent"].cast(pa.string()), "labelled": t["labelled"], "good": t["good"], "branch": pa.array(own, pa.int32()), "purity": pa.array([purity_of[k] for k in own], pa.float64())})

    merged = counts.groupBy("host", "parent").applyInArrow(merge, "host string, parent string, labelled long, good double, branch int, purity double")
    return stats.join(merged, ["host", "parent", "labelled", "good"]).select("host", "parent", "template", "branch", "n", "labelled", "good", "purity", (F.col("purity") < purity).alias("rejected"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = (), **options) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page.

    pages: page_id, url; labels: page_id, good (0 to 1).  options: min_count.
    """
    host, path = url_parts(F.col("url"))
    df = pages.select("page_id", host.alias("host"), path.alias("path"))
    labels = labels.where("good is not null").groupBy("page_id").agg(F.avg("good").alias("good"))
    df = templates(df.join(labels, "page_id", "left"), **options)
    verdicts = written(judged_templates(df).select("host", "parent", "template", "purity", "rejected"), "verdicts")
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return df.join(small(verdicts), ["host", "parent", "template"], "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "template", "purity")


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    """A page is good if the document with its number is labelled as of quality and not as toxic.

    The tables have no labels of pages, and nothing ties a page to the document of its number, so what the method learns
    here is noise; what it learns from labels that mean something is tested on planted hosts.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") * (1 - F.col("toxic"))).cast("double").alias("good"))
    return judge_urls(table(spark, sf_dir, "pages"), labels, RULES)
