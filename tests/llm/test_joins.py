"""Similarity join, components, nearest neighbours, fingerprints against brute force."""

import itertools
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.llm import fingerprints, jaccard_join, nearest
from isohyet.llm.components import components

from .fixtures import documents, nothing, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute_join(data, n, percent):
    sets = {r[0]: shingles(r[1], n) for r in data}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = root(i), root(j)
            up[max(x, y)] = min(x, y)
    return {(i, len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("n, percent, options", [(3, 90, {}), (5, 80, dict(chunk_bytes=4000, block_docs=2, hot_docs=3)), (2, 50, dict(block_docs=3, hot_docs=3)), (3, 80, dict(chunk_bytes=20_000, hot_docs=2, hot_grams=100)), (3, 100, {})])
def test_join_against_brute_force(spark, n, percent, options):
    got = jaccard_join.linked(documents(spark), n, percent, **options).collect()
    assert len(got) == len(rows())
    want = brute_join(rows(), n, percent)
    assert {tuple(r) for r in got} == want
    assert len({c for _, _, c in want}) < len(want)  # something is linked


def brute_links(data, n, percent):
    """(doc_id, number of other rows that the row links with)."""
    sets = [(r[0], shingles(r[1], n)) for r in data]
    likes = lambda x, y: x and y and 100 * len(x & y) >= percent * len(x | y)
    return sorted((i, sum(bool(likes(x, y)) for k, (j, y) in enumerate(sets) if k != at)) for at, (i, x) in enumerate(sets))


def near_copies(m=40, size=60):
    """Different texts that nearly all link with each other, some copies, and rows that share a doc_id."""
    rng = np.random.default_rng(3)
    base, out = [f"w{i}" for i in range(size)], []
    for i in range(m):
        w = list(base)
        for k in rng.integers(0, size, i % 4 + 1):
            w[k] = f"x{i}"
        out.append((i, " ".join(w)))
    return out + [(100 + i, out[i % 3][1]) for i in range(9)] + [(5, out[6][1]), (5, out[20][1]), (7, out[7][1]), (102, "y " + out[9][1])]


@pytest.mark.parametrize("options", [{}, dict(block_docs=5), dict(block_docs=20, chunk_bytes=3000)])
def test_join_counts_every_link(spark, options):
    for data, n, percent in ((near_copies(), 1, 90), (near_copies(), 3, 80), (rows(), 5, 80)):
        df = spark.createDataFrame([r[:2] for r in data], "doc_id long, text string")
        got = sorted((r.doc_id, r.n_links) for r in jaccard_join.counted_links(df, n, percent, **options).collect())
        assert got == brute_links(data, n, percent)


@pytest.mark.parametrize("within", [True, False])
def test_tree_finds_every_pair(within):
    rng = np.random.default_rng(8)
    for percent in (50, 80, 90):
        sets = [np.sort(rng.choice(40, rng.integers(1, 40), replace=False)) for _ in range(60)]
        sets += [np.delete(sets[i % 60], rng.integers(0, len(sets[i % 60]))) for i in range(60) if len(sets[i % 60]) > 1]
        sets = [np.array(x) for x in sorted({tuple(s.tolist()) for s in sets})]
        everything = list(range(len(sets)))
        left, right = (everything, everything) if within else (everything[::2], everything[1::3])
        got = [(int(x), y) for xs, y in jaccard_join.tree_join(left, right, sets, percent, within) for x in xs]
        likes = lambda a, b: 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
        want = {(x, y) for x in left for y in right if x != y and likes(sets[x], sets[y])}
        want = {tuple(sorted(p)) for p in want} if within else want
        assert len(got) == len(want) and {tuple(sorted(p)) if within else p for p in got} == want


def test_tiny_sets_and_thresholds(spark):
    base = [f"w{i}" for i in range(30)]
    data = [(i, " ".join(base[: 1 + i % 20])) for i in range(40)] + [(100 + i, " ".join(base[:9] + [f"x{i}"] * (i % 3))) for i in range(9)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    for n, percent in ((1, 90), (1, 80), (2, 60)):
        assert {tuple(r) for r in jaccard_join.linked(df, n, percent).collect()} == brute_join(data, n, percent)


def test_first_of_each_group_keeps_rows(spark):
    df = documents(spark)
    out = jaccard_join.first_of_each_group(df, 5, 80)
    assert out.dtypes == df.dtypes
    keep = {i for i, _, c in brute_join(rows(), 5, 80) if i == c}
    assert sorted(r.doc_id for r in out.collect()) == sorted(keep)  # the repeated row once


def test_rows_without_ids_and_with_one_id(spark):
    t = " ".join(f"w{i}" for i in range(40))
    data = [(1, t), (2, t), (None, t), (None, t), (None, None), (3, t + " x"), (4, "other words"), (4, t + " y z"), (4, "other words"), (5, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.counted_links(df, 3, 90).collect()), key=str)
    assert got == sorted([(1, 38, 1, 3), (2, 38, 1, 3), (0, 38, None, 0), (0, 38, None, 0), (0, 0, None, 0), (3, 39, 1, 3), (4, 1, 1, 1), (4, 40, 1, 3), (4, 1, 1, 1), (5, 0, 5, 0)], key=str)
    kept = [tuple(r) for r in jaccard_join.first_of_each_group(df, 3, 90).collect()]
    assert sorted(kept, key=str) == sorted([(1, t), (None, t), (None, t), (None, None), (5, "")], key=str)
    twice = spark.createDataFrame([(7, t), (7, t), (7, "a b c d"), (8, "q r s"), (8, "q r s")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_join.first_of_each_group(twice, 3, 90).collect()) == [(7, "a b c d"), (7, t), (8, "q r s")]


def test_long_words_with_equal_patterns_differ(spark):
    """Strings that collide under any polynomial hash modulo a power of two."""
    flip = str.maketrans("ab", "ba")
    thue = "a"
    while len(thue) < 2048:
        thue += thue.translate(flip)
    data = [(1, thue[:1024]), (2, thue[:1024].translate(flip)), (3, thue), (4, thue.translate(flip)), (5, thue)]
    got = {r.doc_id: r.component_id for r in jaccard_join.linked(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_agree_in_as_many_parts_as_both_need(percent):
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 2**64, m, dtype=np.uint64)) for m in [*range(1, 40), *rng.integers(40, 400, 30)]]
    for s in sets[:69]:
        for keep in (1, (1 + percent / 100) / 2, percent / 100):  # some of the grams go, others come
            own = rng.choice(s, max(1, int(keep * len(s))), replace=False)
            sets.append(np.unique(np.r_[own, rng.integers(0, 2**64, rng.integers(0, 2 + len(s) * (100 - percent) // 150), dtype=np.uint64)]))
    sets = [np.array(x, dtype=np.uint64) for x in sorted({tuple(s.tolist()) for s in sets})]
    sizes = np.array([len(s) for s in sets])
    grams = np.concatenate(sets)
    rare = ~np.isin(grams, rng.choice(grams, 2000))  # in all sets or in none
    keys, of, cut, need = jaccard_join.needed_parts(grams, rare, sizes, percent)
    parts = []
    for i in range(len(sets)):
        cuts = [(of == i) & (cut == c) for c in np.unique(cut[of == i])]
        parts.append([(set(keys[x].tolist()), int(need[x][0])) for x in cuts])
    linked = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= percent * (sizes[i] + sizes[j] - both):
            linked += 1
            assert any(len(a & b) >= max(m, n) for a, m in parts[i] for b, n in parts[j])
    assert linked > 50


def test_sets_that_share_parts_by_chance_stay_apart(spark, monkeypatch):
    """Each document has a passage in common with the next one, which is too little to link them; two are near copies."""
    word = lambda i, k: f"a{i}x{k}"
    data = []
    for i in range(60):
        own = [word(i, k) for k in range(200)]
        own[20:80], own[120:180] = [word(-i, k) for k in range(60)], [word(-i - 1, k) for k in range(60)]
        data.append((i, " ".join(own)))
    data += [(100, data[7][1] + " more")]
    shipped, real = [], jaccard_join.written

    def written(df, what):
        out = real(df, what)
        if what == "sets":
            shipped.extend(r.doc_id for r in out.where("grams is not null").select("doc_id").collect())
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {tuple(r) for r in jaccard_join.linked(df, 5, 80, chunk_bytes=8000).collect()}
    assert got == brute_join(data, 5, 80)
    assert {7, 100} <= set(shipped) and len(shipped) < 10  # all of them, and most in one group, where one common part is enough


def test_documents_of_frequent_grams_meet_by_whole_sets():
    """Sets without rare grams agree in parts of all their grams, and not with any other such set."""
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.integers(0, 2**64, 300, dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(np.r_[s[:295], rng.integers(0, 2**64, 5, dtype=np.uint64)]) for s in sets]
    sizes = np.array([len(s) for s in sets])
    keys, of = jaccard_join.signatures(np.concatenate(sets), np.zeros(sizes.sum(), dtype=bool), sizes, 90)
    met = {(a % 30, b % 30) for k in np.unique(keys) for a, b in itertools.combinations(sorted(set(of[keys == k].tolist())), 2)}
    assert met == {(i, i) for i in range(30)}


def test_join_of_nothing(spark):
    assert jaccard_join.linked(nothing(spark)).count() == 0
    assert jaccard_join.linked(spark.createDataFrame([(1, None), (2, ""), (3, None)], "doc_id long, text string")).where("n_shingles = 0 and component_id = doc_id").count() == 3


def test_size_classes():
    for percent in (50, 80, 90, 99, 100):
        edges = jaccard_join.size_classes(percent, 2000)
        for a in range(1, 1500):
            b = a * 100 // percent
            ca, cb = (int(np.searchsorted(edges, x, side="right")) for x in (a, b))
            assert cb - ca in (0, 1)


def test_components(spark):
    rng = np.random.default_rng(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    loose = [(int(a) + 200, int(b) + 200) for a, b in rng.integers(0, 120, (70, 2))]
    edges = chain + star + loose + [(7, 7), (1, 0)]
    up = {}
    root = lambda i: i if up.setdefault(i, i) == i else root(up[i])
    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {(r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {(i, root(i)) for i in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(rng, n, dim=24):
    centres = rng.standard_normal((12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.6 * rng.standard_normal((n, dim))
    return x * rng.uniform(0.3, 2.0, (n, 1))


def test_nearest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(4)
    x = vectors(rng, 6500)
    x[100:400] = x[50]  # one vector many times
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>").repartition(3)
    got = nearest.nearest(df, F.col("vec_id") % 100 == 0, 20, block_rows=500).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = r
    hits = 0
    for q in range(0, len(x), 100):
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:20]
        own = [found[q][k] for k in range(1, 21)]
        assert [r.score for r in own] == [score[r.vec_id] for r in own]
        assert sorted(own, key=lambda r: (-r.score, r.vec_id)) == own
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits / (20 * len(found)) >= 0.9


def test_nearest_without_clusters_and_with_giants(spark):
    """Vectors of one length in all directions need many lists; a few huge ones do not blur the others."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] = 1e200
    x[8], x[9] = -1e100 * x[8], 300 * x[9]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>").repartition(3)
    found = {}
    for r in nearest.nearest(df, F.col("vec_id") % 60 == 0, 20, sample_rows=1500, query_rows=40).collect():
        found.setdefault(r.query_id, []).append(r)
    hits = 0
    assert len(found) == 100
    for q, own in found.items():
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -score))[:20]
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and [r.score for r in own] == [score[r.vec_id] for r in own]
        hits += len({r.vec_id for r in own} & set(best.tolist()))
        assert {7, 8, 9} & set(best.tolist()) <= {r.vec_id for r in own}
    assert hits / 2000 >= 0.9


def test_nearest_measures_how_many_lists_to_probe():
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 24))
    close = centres[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 24))
    loose = rng.standard_normal((4000, 24))
    shares = []
    for x in (close, loose):
        x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
        lists = nearest.k_means(x, 64)
        shares.append(nearest.probe_share(x, x[:300], lists, 20, 0.95))
    assert shares[0] < 0.1 < 0.3 < shares[1]


def test_nearest_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, None]), (8, [1.0]), (40, [-1.0, 0.5]), (0, [1.0, 0.0]), (None, [1.0, 1.0])]
    got = nearest.nearest(spark.createDataFrame(data, "vec_id long, vector array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in got if r.query_id == 0} == {(0, 1, 1), (0, 2, 2), (0, 3, 20), (0, 4, 40)}
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == 20] == [(40, 0.5), (0, 0.0), (0, 0.0), (1, 0.0), (2, 0.0)]
    assert nearest.nearest(spark.createDataFrame([], "vec_id long, vector array<float>"), F.lit(True)).count() == 0


def units(text):
    return {x for x in re.split(r"\n+|(?<=[.!?])[ \t]+", text) if x.strip(" ")}


def test_fingerprints_against_sets(spark):
    data = [r for r in {r[0]: r for r in rows(n=90)}.values()]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    order = sorted(data, key=lambda r: -r[0])
    assert len(got) == len(data)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(units(text), units(edited)))
        assert r.near_next == pytest.approx(jaccard(units(text), units(after)))
    same = {}
    for doc_id, text, *_ in data:
        same.setdefault(text or "", set()).add(got[doc_id].fingerprint)
    assert all(len(x) == 1 for x in same.values())


def test_fingerprints_recover_all_digests(spark):
    """Blocks of any size peel in a table that is large enough; sets are never compared."""
    text = lambda lo, hi: "\n".join(f"line {i}" for i in range(lo, hi))
    data = [(9, text(0, 400)), (8, text(0, 397)), (7, text(200, 900)), (6, ""), (5, text(0, 6)), (4, text(3, 20)), (3, text(2, 60))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    number = {r.x: r.h for r in spark.range(900).selectExpr("concat('line ', id) as x", "xxhash64(concat('line ', id)) as h").collect()}
    got = {r.doc_id: r for r in fingerprints.fingerprints(df).collect()}
    for k, (doc_id, one) in enumerate(data):
        a, b = ({number[x] for x in t.split("\n") if x} for t in (one, data[(k + 1) % len(data)][1]))
        r = got[doc_id]
        assert (sorted(r.own_only), sorted(r.next_only)) == (sorted(a - b), sorted(b - a))
        assert r.near_edited == pytest.approx((len(a) - len(r.removed)) / (len(a) + len(r.added)) if a or r.added else 1.0)
    assert "array_except" not in fingerprints.difference("a", "b")


def test_fingerprints_of_neighbours_over_groups(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "GROUP", 3)
    ids = [-(10**15), -4, 0, 1, 2, 3, 50, 51, 10**6, 10**6 + 1, 10**12, 10**17] + list(range(300, 340))
    df = spark.createDataFrame([(i, f"text of {i}") for i in ids], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.next_text for r in fingerprints.neighbours(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: f"text of {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}


def test_groups_of_neighbours_are_even(spark, monkeypatch):
    """Ids in dense clusters, one id that a third of the rows have, rows without id."""
    monkeypatch.setattr(fingerprints, "GROUP", 50)
    monkeypatch.setattr(fingerprints, "SPLITS", 8)
    ids = [10**9 * (i % 3) + i // 500 for i in range(3000)] + [77] * 2000 + [5 * i for i in range(1000)] + [None, None]
    df = spark.createDataFrame([(x, f"text {i}") for i, x in enumerate(ids)], "doc_id long, text string").repartition(3)
    keyed = df.selectExpr("coalesce(doc_id, -9223372036854775808) as _id", "xxhash64(text) as _tie", "0L as _group")
    got = fingerprints.grouped(keyed).collect()
    size = {}
    for r in got:
        size[r._group] = size.get(r._group, 0) + 1
    assert len(got) == len(ids) and max(size.values()) <= 150
    order = [r._group for r in sorted(got, key=lambda r: (r._id, r._tie))]
    assert order == sorted(order)
    near = fingerprints.neighbours(df).collect()
    follow = {r.text: r.next_text for r in near}
    at, seen = "text 0", set()
    while at not in seen:
        seen.add(at)
        at = follow[at]
    assert len(seen) == len(ids)  # one ring through all


def test_a_giant_paragraph(spark):
    data = [(1, "word " * 200_000), (2, "word " * 200_000 + "end"), (3, "x")]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[2].near_next == 0.0 and got[1].n_chars == 1_000_000 and len(got) == 3


def test_fingerprints_edges(spark):
    assert fingerprints.fingerprints(nothing(spark)).count() == 0
    one = fingerprints.fingerprints(spark.createDataFrame([(5, None)], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_edited, r.near_next) for r in one] == [(0, 1.0, 1.0)]
    twice = fingerprints.fingerprints(documents(spark)).collect()
    assert len(twice) == len(rows())
    assert "Python" not in fingerprints.fingerprints(documents(spark))._jdf.queryExecution().toString()


def test_spent_shuffles_and_tables_go_at_once(spark, monkeypatch):
    """What a step of the join has read stays on no disk while the next ones run."""
    import time

    from isohyet.llm import jaccard_join
    from isohyet.sinks import scratch

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return sum("/shuffle_" in x for x in files.split("\n"))

    def tables():
        fs, p = scratch._fs(spark, scratch.shared_dir(spark) + "/*")
        return {s.getPath().getName() for s in fs.globStatus(p) or []}

    before = shuffles()
    df = scratch.written(spark.range(1000).repartition(3, "id"), "some")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and df.count() == 1000
    had, mine = tables(), []
    docs = spark.createDataFrame([(i, f"a b c d e f g {i // 2}") for i in range(20)], "doc_id long, text string")
    with scratch.collecting(mine):
        rows, _ = jaccard_join.joined(docs)
        assert {x.rsplit("-", 5)[0] for x in tables() - had} == {"sets", "links"}
        assert jaccard_join.with_components(rows, _).count() == 20
    scratch.remove(spark, mine)
    assert tables() <= had
