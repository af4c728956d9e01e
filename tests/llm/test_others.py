"""URL filters, classifier, packing, sharding, SentencePiece, pipeline."""

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from isohyet.llm import packing, quality, queries, sentencepiece_codec, sharding, url_filters

from .fixtures import documents, nothing, rows, words

TABLES = "/root/testdata/sf0.001"
have_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables here")
have_model = pytest.mark.skipif(not os.path.exists(sentencepiece_codec.MODEL_PATH), reason="no model here")

# ------------------------------------------------------------------------------------------------------------- sharding


def test_shards_are_exact_and_gapless(spark):
    df = documents(spark)
    out = sharding.shard_rows(df, "doc_id", 7, partition_rows=11, cell_rows=3)
    got = out.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(x) for x in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = sharding.shard_rows(df.repartition(5), "doc_id", 7, partition_rows=11, cell_rows=3)
    key = lambda rs: sorted((r.doc_id, r.shard, r.slot) for r in rs)
    assert key(got) == key(again.collect())
    assert sharding.shard_rows(nothing(spark), "doc_id").count() == 0


def test_matrix_is_exact(monkeypatch):
    counts, cells = np.array([5, 0, 17, 8, 1]), np.array([7, 7, 7, 10])
    left_of = sharding.running(counts)
    rows_of = lambda: np.array([sharding.matrix_row(p, left_of, sharding.large_ranges(left_of, cells, [3]), [3]) for p in range(5)])
    m = rows_of()
    assert (m.sum(1) == counts).all() and (m.sum(0) == cells).all()
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 8)  # most of the tree is drawn by the driver, without numpy's draws
    m = rows_of()
    assert (m.sum(1) == counts).all() and (m.sum(0) == cells).all() and (m >= 0).all()


def test_shuffle_is_uniform():
    """Expected counts of the matrix are those of a uniform permutation."""
    counts, cells = np.array([30, 50]), np.array([20, 60])
    left_of = sharding.running(counts)
    mean = np.mean([sharding.matrix_row(0, left_of, [(0, 2, cells)], [s])[0] for s in range(800)])
    assert abs(mean - 30 * 20 / 80) < 0.3


def test_places_are_uniform(spark):
    """Each row is about as often in each shard, and in each part of one, whatever its partition."""
    df = spark.range(12).selectExpr("id as doc_id").coalesce(1)
    seen = np.zeros((12, 12))
    for seed in range(40):
        for r in sharding.shard_rows(df, "doc_id", 2, seed=seed, partition_rows=3, cell_rows=2).collect():
            seen[r.doc_id, 6 * r.shard + r.slot] += 1
    chi = ((seen - 40 / 12) ** 2 / (40 / 12)).sum()  # 121 degrees of freedom
    assert 70 < chi < 185


def test_a_million_rows_of_one_id_are_spread(spark):
    for df in (spark.range(200_000).selectExpr("5L as doc_id", "id as x"), spark.range(200_000).selectExpr("5L as doc_id")):
        out = sharding.shard_rows(df.repartition(4), "doc_id", 3, partition_rows=10_000, cell_rows=5_000).groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
        assert sorted(r["count(1)"] for r in out) == [66_666, 66_667, 66_667] and all(r["max(slot)"] == r["count(1)"] - 1 for r in out)


def test_sharding_minds_no_names(spark):
    data = [(i, None if i % 3 else i, "x") for i in range(50)]
    df = spark.createDataFrame(data, "_home int, _key int, _cell string").withColumns({"_at": packing.F.lit(1), "_Group": packing.F.lit(2), "shard": packing.F.lit("old"), "_part": packing.F.lit(3)})
    out = sharding.shard_rows(df, "_key", 4, partition_rows=5, cell_rows=2)
    assert out.count() == 50 and set(out.columns) == set(df.columns) | {"slot"}
    assert sorted((r._home, r._key) for r in out.collect() if r._key is not None) == [(i, i) for i in range(0, 50, 3)]


def test_registered_sharding_says_what_texts_are(spark, tmp_path):
    import zlib

    sf = str(tmp_path)
    documents(spark).write.parquet(f"{sf}/documents.parquet")
    got = sharding.op6_sharding(spark, sf).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), "rows", None) for r in rows())
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got) == want
    assert {r.shard for r in got} == set(range(16))


def test_large_populations(monkeypatch):
    rng = np.random.default_rng(1)
    want = (rng.hypergeometric(600, 400, 300, 4000).mean(), rng.hypergeometric(600, 400, 300, 4000).std())
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 10)
    got = np.array([sharding.hypergeometric(600, 400, 300, rng) for _ in range(4000)])
    assert abs(got.mean() - want[0]) < 0.5 and abs(got.std() - want[1]) < 0.4
    assert sharding.draw(np.array([3, 4, 5]), 12, rng).tolist() == [3, 4, 5]
    big = sharding.hypergeometric(3 * 10**10, 10**10, 10**6, rng)
    assert abs(big - 750_000) < 5000


# ------------------------------------------------------------------------------------------------------------ url filters


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path


def rule_of(host, path):
    best = None
    for h, p, v in url_filters.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return best or (None, None)


URLS = ["http://A.Example.com/en/1?x#y", "https://www.example.com/en/", "http://x.net/fr/a/b.html", "x.net/fr/", "ftp://net/es/1", "http://fakenet/es/", "", None, "http://", "http://host", "http://com", "http://É.com/ä", "a://b://c/d", "http://h?q=/en/", "http://example.com/EN/1", "http://example.com/en"]


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string").withColumn("path", url_filters.F.lit("clash"))
    labels = spark.createDataFrame([(0, 1.0), (0, 0.0), (99, 0.0), (1, None)], "page_id int, good double")
    for r in url_filters.judge_urls(pages, labels, url_filters.RULES).collect():
        host, path = split_url(URLS[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")
    none = spark.createDataFrame([], "page_id int, url string")
    assert url_filters.judge_urls(none, labels).count() == 0


def test_bad_templates_are_rejected(spark):
    pages, labels = [], []
    for i in range(600):
        kind = ("news", "spam", "wiki")[i % 3]
        pages.append((i, f"http://site.org/{kind}/{'ads' if kind == 'spam' else 'x'}/{i}.html"))
        if i % 2:
            labels.append((i, 0.0 if kind == "spam" else 1.0))
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame(labels, "page_id int, good double")).collect()
    assert {(r.template, r.verdict) for r in got} == {("/news/x/*.html", "allow"), ("/wiki/x/*.html", "allow"), ("/spam/ads/*.html", "block")}


def test_small_sections_of_a_large_host_are_judged_by_themselves(spark):
    """300 sections of a third of a percent each, every third of them bad; some with few labels or none."""
    pages, labels = [], []
    for i in range(6000):
        section = i % 300
        pages.append((i, f"http://hot.org/s{section}/{i}.html"))
        if i < 300 * (section % 10):
            labels.append((i, 0.0 if section % 3 == 0 else 1.0))
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame(labels, "page_id int, good double")).collect()
    assert {r.template for r in got} == {f"/s{i}/*.html" for i in range(300)}
    assert len(got) == 6000
    for r in got:
        section = r.page_id % 300
        if section % 10 >= 4:
            assert (r.verdict == "block") == (section % 3 == 0)
        elif section % 3:
            assert r.verdict == "allow"


def test_siblings_merge_across_any_number(spark):
    """The parent is shared by all templates; bad ones are rejected though others of all shares lie between."""
    data = [("h", "", f"/t{i}", float(j < (0, 20, 20, 10, 20)[i % 5])) for i in range(100) for j in range(20)] + [("h", "", f"/u{i}", None) for i in range(50)]
    got = url_filters.judged_templates(spark.createDataFrame(data, "host string, parent string, template string, good double")).collect()
    assert len(got) == 150
    assert {r.template for r in got if r.rejected} >= {f"/t{i}" for i in range(0, 100, 5)}
    assert not any(r.rejected for r in got if r.labelled == 0 or r.good == r.labelled)
    assert len({r.branch for r in got if r.labelled}) == 3


def test_a_slope_of_shares_is_not_one_branch(spark):
    data = [("h", "", f"/s{i:02d}", float(j <= 3 * i)) for i in range(20) for j in range(60)]
    got = {r.template: r for r in url_filters.judged_templates(spark.createDataFrame(data, "host string, parent string, template string, good double")).collect()}
    assert len({r.branch for r in got.values()}) > 2
    for t, r in got.items():
        share = (3 * int(t[2:]) + 1) / 60
        assert r.rejected == (share < 0.5) or abs(share - 0.5) < 0.2
        assert abs(r.purity - share) < 0.3


def test_hundred_sections_are_judged_by_themselves(spark):
    pages = [(i, f"http://big.org/s{i % 100}/{i}.html") for i in range(3000)]
    labels = [(i, float(i % 100 >= 30)) for i in range(3000)]
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame(labels, "page_id int, good double")).collect()
    assert all((r.verdict == "block") == (r.page_id % 100 < 30) for r in got)


def test_rare_extensions_fall_together(spark):
    pages = [(i, f"http://h.org/{i}.{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}") for i in range(1000)] + [(2000 + i, f"http://h.org/{i}.html") for i in range(9)]
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame([], "page_id int, good double")).collect()
    assert Counter(r.template for r in got) == {"/*": 1000, "/*.html": 9}


def brute_agglomerated(counts, z):
    """The same by looking at all neighbours each time."""
    branches = sorted(([[i], n, g] for i, (n, g) in enumerate(counts)), key=lambda b: (b[2] / b[1], counts[b[0][0]]))
    while len(branches) > 1:
        def differ(k):
            (_, n, g), (_, m, h) = branches[k], branches[k + 1]
            p = (g + h) / (n + m)
            s = (max(0.0, p * (1 - p)) * (1 / n + 1 / m)) ** 0.5
            gap = abs(g / n - h / m)
            return gap / s if s else 0.0 if gap == 0 else float("inf")

        k = min(range(len(branches) - 1), key=differ)
        if differ(k) > z:
            break
        branches[k : k + 2] = [[branches[k][0] + branches[k + 1][0], branches[k][1] + branches[k + 1][1], branches[k][2] + branches[k + 1][2]]]
    out = [0] * len(counts)
    for k, (members, *_) in enumerate(branches):
        for i in members:
            out[i] = k
    return out


def test_agglomeration_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = rng.integers(1, 40, rng.integers(1, 30))
        counts = [(int(a) + 1, float(rng.binomial(a, rng.random()) + 0.37 + rng.random() / 1e6)) for a in n]
        assert url_filters.agglomerated(counts, 1.64) == brute_agglomerated(counts, 1.64)
    assert url_filters.agglomerated([], 1.64) == []


def brute_templates(paths, min_count):
    """Template of each (host, path), node by node."""
    out = {}

    def walk(node, members):  # (number, rest)
        for i, rest in members:
            if not rest:
                out[i] = node or "/"
        members = [m for m in members if m[1]]
        heads = Counter(rest[0] for _, rest in members)
        ext = lambda x: re.search(r"(\.[A-Za-z]{1,5})?$", x)[0]
        exts = Counter(ext(rest[0]) for _, rest in members if heads[rest[0]] < min_count)
        own = {e for e, k in exts.items() if e and k >= min_count}
        few = sum(k for e, k in exts.items() if e not in own) < min_count
        groups = defaultdict(list)
        for i, rest in members:
            name = rest[0] if heads[rest[0]] >= min_count else "*" + ext(rest[0]) if ext(rest[0]) in own else "*"
            if name == "*" and heads[rest[0]] < min_count and few:
                out[i] = node + ("/*" if len(rest) == 1 else "/**")
            else:
                groups[name].append((i, rest[1:]))
        for name, part in groups.items():
            walk(node + "/" + name, part)

    hosts = defaultdict(list)
    for i, (host, path) in enumerate(paths):
        hosts[host].append((i, [x for x in path.split("/") if x]))
    for members in hosts.values():
        walk("", members)
    return [out[i] for i in range(len(paths))]


def test_tree_against_brute_force(spark):
    rng = np.random.default_rng(11)
    names = ["a", "b", "c.html", "d.php", "e.x1", "*", "x.html", "é"]
    paths = []
    for i in range(900):
        depth = int(rng.integers(0, 14)) if rng.random() < 0.1 else int(rng.integers(0, 5))
        segs = [names[int(rng.integers(0, 8) * rng.random())] if rng.random() < 0.7 else f"p{rng.integers(0, 300)}{['', '.html', '.txt'][int(rng.integers(0, 3))]}" for _ in range(depth)]
        paths.append((f"h{int(rng.integers(0, 4) * rng.random())}", "/" + "/".join(segs) + ("/" if rng.random() < 0.2 else "")))
    df = spark.createDataFrame([(i, h, p) for i, (h, p) in enumerate(paths)], "page_id int, host string, path string")
    got = {r.page_id: r.template for r in url_filters.templates(df).collect()}
    assert [got[i] for i in range(len(paths))] == brute_templates(paths, 5)


def test_deep_paths_are_judged_to_the_end(spark):
    """URLs that differ from the eleventh segment on only."""
    deep = "/".join("abcdefghij")
    pages = [(i, f"http://h.org/{deep}/{('good', 'bad')[i % 2]}/{i}") for i in range(60)] + [(100, None), (None, "http://h.org/x"), (100, "http://h.org/x")]
    labels = [(i, float(i % 2 == 0)) for i in range(60)] + [(None, 0.0)]
    got = url_filters.judge_urls(spark.createDataFrame(pages, "page_id int, url string"), spark.createDataFrame(labels, "page_id int, good double")).collect()
    assert len(got) == 63 and {r.verdict for r in got if r.page_id is None} == {"allow"}
    for r in got:
        if r.page_id is not None and r.page_id < 60:
            assert (r.template, r.verdict) == ((f"/{deep}/good/*", "allow") if r.page_id % 2 == 0 else (f"/{deep}/bad/*", "block"))


# ------------------------------------------------------------------------------------------------------------- classifier


def test_votes_estimate(spark):
    rng = np.random.default_rng(1)
    m = len(quality.LABELLERS)
    bad = rng.random(5000) < 0.2
    p_bad = rng.uniform(0.3, 0.8, m)
    v = np.where(rng.random((5000, m)) < np.where(bad[:, None], p_bad, 0.03), quality.BAD, quality.GOOD)
    code = (v * 3 ** np.arange(m - 1, -1, -1)).sum(1)
    patterns, counts = np.unique(code, return_counts=True)
    share, found, post = quality.estimate(patterns, counts.astype(float))
    assert abs(share - bad.mean()) < 0.02
    assert np.abs(found[:, 0, quality.BAD] - p_bad).max() < 0.08
    assert ((post[np.searchsorted(patterns, code)] > 0.5) == bad).mean() > 0.97


@have_tables
def test_classifier_on_held_out_labels(spark):
    """The labels are not used by the classifier."""
    sf = "/root/testdata/sf0.01"
    got = quality.op4_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("quality", "truth"), "doc_id").toPandas()
    assert ((got["keep"]) == (got["truth"] == 1)).mean() > 0.97
    assert got[got["truth"] == 1]["keep"].mean() > 0.99


def test_classifier_edges(spark):
    df = documents(spark)
    out = quality.keep_good(df)
    assert out.dtypes == df.dtypes
    got = {r.doc_id: r for r in quality.judged(df).collect()}
    assert {i: r.keep for i, r in got.items() if i >= 1000} == {1000: False, 1001: False}
    assert sum(r.keep for r in out.collect()) if False else out.count() == sum(1 for r in rows() if got[r[0]].keep)
    assert quality.judged(nothing(spark)).count() == 0 and quality.keep_good(nothing(spark)).count() == 0


# ---------------------------------------------------------------------------------------------------------------- packing


def brute_pack(lengths, sources, clusters, capacity, limits):
    """Best fit: of all open bins without conflict the one with the least room, the oldest of these."""
    bins = []
    out = []
    for n, s, c in zip(lengths, sources, clusters):
        fit = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= n and b["room"] > 0 and b["sources"][s] < limits[s] and (c < 0 or c not in b["clusters"])]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "sources": Counter(), "clusters": set()})
        bins[i]["room"] -= n
        bins[i]["sources"][s] += 1
        bins[i]["clusters"].add(c)
        out.append(i)
    return out


def test_best_fit_against_brute_force():
    rng = np.random.default_rng(6)
    for per_source in (1, 2, 5, None):
        n = 400
        lengths = np.sort(rng.integers(1, 100, n))[::-1]
        sources = np.where(rng.random(n) < 0.4, 0, rng.integers(0, 9, n))
        clusters = np.where(rng.random(n) < 0.5, -1, rng.integers(0, 5, n))
        limits = [per_source] * 9 if per_source else [1, 7, 2, 3, 1, 1, 4, 2, 1]
        assert packing.pack_group(lengths, sources, clusters, 100, limits).tolist() == brute_pack(lengths, sources, clusters, 100, limits)


def fill_of(rows_, capacity):
    return sum(r.n_words for r in rows_) / capacity / len({r.bin_id for r in rows_})


def test_one_source_or_one_long_document_fill_bins(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(20, 900, 4000).tolist()
    for source in ("one", None, "s"):
        data = [(i, f"s{i % 40}" if source == "s" else source, i, n) for i, n in enumerate(lengths)]
        got = packing.pack(spark.createDataFrame(data, "doc_id long, source string, cluster long, n_words long"), 2048, group_rows=1000).collect()
        assert fill_of(got, 2048) > 0.95 and sum(r.n_words for r in got) == sum(lengths)
    long_one = [(1, "a", 1, 3_000_000)] + [(1, "a", None, 100)] * 5000
    got = packing.pack(spark.createDataFrame(long_one, "doc_id long, source string, cluster long, n_words long"), 2048, group_rows=500).collect()
    groups = Counter(r.bin_id >> 32 for r in got)
    assert len(groups) == 13 and max(groups.values()) < 700  # one document and one id, dealt evenly


def test_limits_follow_shares():
    lengths, sources = np.full(100, 50), np.r_[np.zeros(50, int), np.ones(30, int), np.full(20, 2)]
    assert packing.limits_of(lengths, sources, 200, 2) == [4, 3, 2]
    assert packing.limits_of(lengths[:0], sources[:0], 200, 2) == []

def test_packing_keeps_all_words(spark):
    got = packing.pack_documents(documents(spark), 64, group_rows=20).collect()
    by_doc, by_bin = Counter(), defaultdict(list)
    for r in got:
        by_doc[r.doc_id] += r.n_words
        by_bin[r.bin_id].append(r)
    want = Counter()
    for r in rows():
        want[r[0]] += len((r[1] or "").split())
    assert by_doc == +want
    for members in by_bin.values():
        assert sum(r.n_words for r in members) <= 64
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert max(Counter(r.cluster for r in members).values()) == 1
    assert packing.pack_documents(nothing(spark)).count() == 0


# ---------------------------------------------------------------------------------------------------------- sentencepiece


ODD = ["", " ", "  a  b ", "▁x", "▁▁ ▁", "<s> </s> <0x0A> <unk>", "日本語 😀\x00\t\n", "a" * 3000, " lead", "trail ", "x\n\n  y", "\u00a0nbsp", "e\u0301"]


@have_model
def test_codec_parity():
    c = sentencepiece_codec.codec(sentencepiece_codec.model_bytes(sentencepiece_codec.MODEL_PATH))
    texts = ODD + [r[1] or "" for r in rows()]
    ids, differ = c.encode(texts)
    ids = [np.frombuffer(x, "<i4").tolist() for x in ids]
    assert set(differ) == {0}
    assert ids == c.original.encode(texts)
    assert c.decode(ids) == c.original.decode(ids) == c.tokenizer.decode_batch(ids, skip_special_tokens=False)
    broken = [[3 + 0xE2, 259, 3 + 0x82], [500, 3 + 255]]
    assert c.decode(broken) == c.tokenizer.decode_batch(broken, skip_special_tokens=False)


@have_model
def test_codec_operators(spark):
    df = documents(spark)
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(df, sentencepiece_codec.MODEL_PATH), sentencepiece_codec.MODEL_PATH)
    assert out.columns == [*df.columns, "ids", "n_differing", "decoded"]
    for r in out.collect():
        assert (r.ids is None) == (r.text is None) and r.decoded == r.text
    assert sentencepiece_codec.encode(nothing(spark), sentencepiece_codec.MODEL_PATH).count() == 0


@have_model
def test_differences_are_counted_by_row_whatever_was_seen_before():
    c = sentencepiece_codec.Codec(sentencepiece_codec.model_bytes(sentencepiece_codec.MODEL_PATH))
    c.learn(["odd", "even"])
    c.differing.add("odd")
    for _ in range(2):
        ids, differ = c.encode(["odd even odd", "even", "", "new odd"])
        assert differ == [2, 0, 0, 1]
    assert np.frombuffer(ids[1], "<i4").tolist() == c.tokenizer.encode(sentencepiece_codec.MARK + "even", add_special_tokens=False).ids


def field(number, kind, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return varint(number << 3 | kind) + (varint(len(value)) + value if kind == 2 else value if kind == 5 else varint(value))


def test_unigram_model_from_bytes():
    """A model of the other kind, built by hand: scores decide, unknown characters fall back to bytes."""
    import struct

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] + [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("▁ab", -1.0, 1), ("ba", -1.5, 1)]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, k)) for p, s, k in pieces)
    data += field(2, 2, field(3, 0, 1) + field(35, 0, 1)) + field(3, 2, field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1))
    c = sentencepiece_codec.Codec(data)
    texts = ["ab ba", "abba", "é a", " ab", "b"]
    ids, differ = c.encode(texts)
    assert set(differ) == {0} and [np.frombuffer(x, "<i4").tolist() for x in ids] == c.original.encode(texts)


# --------------------------------------------------------------------------------------------------------------- pipeline


def test_pipeline_on_planted_cases(spark, tmp_path):
    import random

    rng = random.Random(9)
    clean = [(i, " ".join(words(rng, 150)) + ".") for i in range(40)]
    clean = [(i, ". ".join(t[j : j + 60].strip().capitalize() for j in range(0, len(t), 60)) + ".") for i, t in clean]
    junk = [(100 + i, " ".join(w.upper() + "!!" for w in words(rng, 150))) for i in range(8)] + [(120 + i, " ".join([words(rng, 1)[0]] * 150)) for i in range(4)]
    copy = [(200, clean[3][1]), (201, clean[4][1].replace(" ", " again ", 1))]
    passage = ", ".join(words(rng, 60))
    shared = [(300, clean[5][1][:200] + " " + passage + "."), (301, ", ".join(words(rng, 200)) + ". " + passage + ".")]
    data = [(i, t, "en", f"src{i % 2}", len(t)) for i, t in clean + junk + copy + shared]
    (tmp_path / "x").mkdir()
    sf = str(tmp_path / "x")
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        seen[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    ids = lambda name: {r.doc_id for r in seen[name]}
    assert ids("quality_classifier") == {i for i, *_ in clean + copy + shared}
    assert ids("ngram_jaccard_join") == ids("quality_classifier") - {200, 201}
    text = {r.doc_id: r.text for r in seen["substring_dedup"]}
    assert passage.split(", ")[20] + ", " + passage.split(", ")[21] in text[300]
    assert len(text[301].split()) == 200 and text[7] == clean[7][1]
    assert sum(r.n_words for r in seen["packing"]) == sum(len(t.split()) for t in text.values())
    assert corpus_pipeline.run(spark, sf).count() == len(seen["packing"])


@have_tables
@pytest.mark.parametrize("name", sorted(queries.MODULES))
def test_registered_queries_run(spark, name):
    df = queries.queries()[name](spark, TABLES)
    assert df.count() > 0 and all(not t.startswith("void") for _, t in df.dtypes)


@have_tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_registered_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{TABLES}/documents.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    df = queries.queries()[name](spark, TABLES).select(*[c[0] for c in want.description])
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())
