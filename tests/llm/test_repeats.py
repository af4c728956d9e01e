"""Substring operators against brute force."""

import re
from hashlib import sha256

import numpy as np
import pytest

from isohyet.llm import substring_dedup, suffix_dedup
from isohyet.llm.chunks import gram_hashes, run_classes
from isohyet.llm.suffix_arrays import common_prefixes, eight_bytes, search, suffix_array
from isohyet.llm.winnowing import winnow

from .fixtures import documents, nothing, rows, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(data, k):
    found = {}
    for doc_id, text, *_ in sorted(data, key=lambda r: r[0]):
        w = WORD.findall(text or "")
        for a in range(len(w) - k + 1):
            found.setdefault(tuple(w[a : a + k]), doc_id)
    out = []
    for doc_id, text, *_ in data:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if found[tuple(w[a : a + k])] < doc_id:
                gone[a : a + k] = [True] * k
        out.append((doc_id, len(w), sum(gone), sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [dict(min_words=13, seed_words=5), dict(min_words=13, seed_words=13, chunk_bytes=2000), dict(min_words=13, seed_words=5, chunk_bytes=2000, hot_rows=2), dict(min_words=13, seed_words=4, part_words=50), dict(min_words=50, seed_words=13, chunk_bytes=5000)])
def test_words_against_brute_force(spark, options):
    got = substring_dedup.remove_repeats(documents(spark), **options)
    got = sorted((r.doc_id, r.n_words, r.n_removed, sha256(bytes(r.words)).hexdigest()) for r in got.collect())
    assert got == brute_words(rows(), options["min_words"])


def test_texts_keep_columns_and_spaces(spark):
    df = documents(spark)
    out = substring_dedup.without_repeats(df, 13, 5, chunk_bytes=3000)
    assert out.dtypes == df.dtypes
    before, after = ({(r.doc_id): r for r in x.collect()} for x in (df, out))
    assert before.keys() == after.keys()
    want = {r[0]: r for r in brute_words(rows(), 13)}
    for i, r in after.items():
        assert (r.text is None) == (before[i].text is None)
        if r.text is not None:
            w = WORD.findall(r.text)
            assert len(w) == want[i][1] - want[i][2] and sha256(" ".join(w).encode()).hexdigest() == want[i][3]
            assert r.n_chars == len(r.text) and (want[i][2] or r.text == before[i].text)
        assert (r.source, r.keep, r.rest) == (before[i].source, "k", b"r")


def brute_bytes(data, k):
    found = {}
    data = [(r[0], (r[1] or "").encode()) for r in data]
    for doc_id, b in sorted(data):
        for a in range(len(b) - k + 1):
            found[b[a : a + k]] = min(found.get(b[a : a + k], (doc_id, a)), (doc_id, a))
    out = []
    for doc_id, b in data:
        gone = bytearray(len(b))
        for a in range(len(b) - k + 1):
            if found[b[a : a + k]] < (doc_id, a):
                gone[a : a + k] = b"\1" * k
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, dict(chunk_bytes=4000, part_bytes=1500), dict(chunk_bytes=4000, hot_rows=3)])
def test_bytes_against_brute_force(spark, options):
    got = suffix_dedup.remove_repeats(documents(spark), **options)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha256(bytes(r.kept)).hexdigest()) for r in got.collect())
    assert got == brute_bytes(rows(), 100)


def strange_rows():
    """Rows without doc_id, rows that share one, words and paragraphs of any length, patterns that fool linear hashes."""
    flip = str.maketrans("ab", "ba")
    thue = "a"
    while len(thue) < 4096:
        thue += thue.translate(flip)
    twelve = " ".join(f"w{i}" for i in range(12))
    found = [(1, twelve + " " + thue[:1024]), (2, twelve + " " + thue[:1024].translate(flip)), (3, twelve + " " + thue), (4, thue[:1024]), (5, thue[:1024].translate(flip))]
    base = texts(3, 12)
    return found + [(None, base[0]), (None, base[0]), (None, base[5] + " and " + base[10]), (6, base[0]), (7, base[1]), (7, base[2]), (7, base[1] + " " + base[2]), (8, base[2] + base[1]), (None, None), (9, "z" * 9000), (9, "z" * 9001), (2**63 - 1, base[5])]


def strange(spark):
    return spark.createDataFrame(strange_rows(), "doc_id long, text string").repartition(2)


LAST = 2**63 - 1


@pytest.mark.parametrize("chunk_bytes", [1500, 2 << 20])
def test_strange_rows_against_brute_force(spark, chunk_bytes):
    data = [(LAST if i is None else i, t) for i, t in strange_rows()]
    key = lambda r: LAST if r.doc_id is None else r.doc_id
    got = substring_dedup.remove_repeats(strange(spark), chunk_bytes=chunk_bytes, hot_rows=3).collect()
    assert sum(r.doc_id is None for r in got) == sum(i is None for i, _ in strange_rows())
    assert sorted((key(r), r.n_words, r.n_removed, sha256(bytes(r.words)).hexdigest()) for r in got) == brute_words(data, 13)
    assert {r.n_removed for r in got if r.doc_id in (1, 2, 3, 4, 5)} == {0}
    got = suffix_dedup.remove_repeats(strange(spark), chunk_bytes=chunk_bytes, hot_rows=3).collect()
    assert sorted((key(r), r.n_bytes, r.n_removed, r.n_spans, sha256(bytes(r.kept)).hexdigest()) for r in got) == brute_bytes(data, 100)


def test_equal_hashes_do_not_make_strings_equal():
    text = np.frombuffer(b"abcdefghij" * 2 + b"0123456789" * 2, dtype=np.uint8)
    got, first = run_classes(text, np.array([0, 1, 10, 11, 20, 30]), np.zeros(6, dtype=np.uint64), 9)
    assert got.tolist() == [0, 1, 0, 1, 2, 2] and first.tolist() == [0, 1, 4]


def test_run_classes_are_exact():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 3, 4000)
    ids[2000:3000] = ids[500:1500]
    places = np.flatnonzero(rng.random(3980) < 0.8)
    for k in (1, 2, 7, 13):
        number = {}
        want = [number.setdefault(tuple(ids[p : p + k]), len(number)) for p in places]
        units = np.array([7, 8, 9], dtype=np.uint64)[ids] * np.uint64(0x9E3779B97F4A7C15)
        got, first = run_classes(ids, places, gram_hashes(units, k)[places], k)
        assert len(set(zip(want, got.tolist()))) == len(number) == len(set(got.tolist()))
        assert [int(np.flatnonzero(got == i)[0]) for i in range(len(first))] == first.tolist()


def test_long_sequences_are_winnowed_in_runs(monkeypatch):
    from isohyet.llm import winnowing

    rng = np.random.default_rng(3)
    units = rng.integers(0, 2**63, 3000).astype(np.uint64)
    doc = np.repeat(np.arange(3), 1000)
    want = winnow(units, doc, 13, 5)
    monkeypatch.setattr(winnowing, "PLACES", 8)
    got = winnow(units, doc, 13, 5)
    assert got.windows().tolist() == want.windows().tolist()
    assert len(got.key) >= len(want.key)


def test_empty_tables(spark):
    assert substring_dedup.remove_repeats(nothing(spark)).count() == 0
    assert suffix_dedup.remove_repeats(nothing(spark)).count() == 0
    assert substring_dedup.without_repeats(nothing(spark)).count() == 0


def prefix(a, b, cap):
    n = 0
    while n < min(len(a), len(b), cap) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("letters, n", [(2, 700), (3, 3000), (1, 400), (26, 2000)])
def test_suffix_array(letters, n):
    text = np.random.default_rng(letters).integers(97, 97 + letters, n).astype(np.uint8)
    text[n // 2 : n // 2 + n // 4] = text[: n // 4]
    order, data = suffix_array(text, 100), text.tobytes()
    assert sorted(order.tolist()) == list(range(n))
    inside = [i for i in order.tolist() if i + 100 <= n]
    assert all(data[a : a + 100] <= data[b : b + 100] for a, b in zip(inside, inside[1:]))
    common = common_prefixes(text, order, 100, lane=37)
    assert common.tolist() == [0] + [prefix(data[a:], data[b:], 100) for a, b in zip(order.tolist(), order.tolist()[1:])]


def test_search():
    text = np.random.default_rng(5).integers(97, 99, 4000).astype(np.uint8)
    data, length = text.tobytes(), 20
    places = np.array(sorted(range(0, 3000, 3), key=lambda i: data[i : i + length]))
    _, first = np.unique([data[i : i + length] for i in places], return_index=True)
    places = places[first]
    sought = np.arange(0, 3900, 7)
    at, there = search(eight_bytes(text), places, sought, length)
    strings = [data[i : i + length] for i in places]
    for i, a, found in zip(sought, at, there):
        s = data[i : i + length]
        assert found == (s in strings) and a == sum(x < s for x in strings)


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(3)
    units = rng.integers(0, 2**63, 500).astype(np.uint64)
    units = np.concatenate([units, rng.integers(0, 2**63, 100).astype(np.uint64), units[100:300]])
    found = winnow(units, np.zeros(len(units), dtype=np.int32), 13, 5)
    key = np.repeat(found.key, found.n)
    assert found.windows().tolist() == list(range(len(units) - 12))
    assert (key[100:288] == key[600:788]).all()
