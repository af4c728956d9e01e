"""Removal of word sequences that documents with smaller ids have: seed and extend.

Seeds are winnowed anchors of seed_words words; documents are joined on those that several documents have.  A bucket of
seeds compares the words around them.  Places that have a seed are a class; the class is extended word by word, to the
right and to the left, and falls apart where the next words differ; a place that is left alone in its class drops out.  Two
places match in a window of min_words words around the seed if they are still together after its words on the left and
after those on the right.  The document with the smallest id of such a class keeps the window.  Windows of neighbouring
seeds overlap, and what they cover together is a maximal repeat: all its words go in the other documents.

All joins run over chunks of documents (see chunks).  A chunk sends each different surrounding of a seed once, with its smallest document, so nothing
is paired within a group, and a passage that a third of all documents share costs an entry a chunk.  A seed that has over
hot_rows of them is lengthened to whole windows, which go to buckets of their own.  Hashes only decide which bucket
compares what; that words are equal is always decided by the words.

Null texts have no words; empty texts and those of fewer than min_words words lose none.  Rows that share a doc_id are one
document to this rule: they lose nothing to each other.  Rows without doc_id are one document that comes after all others.
An empty table gives no rows.  A task needs memory for a chunk or for the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .chunks import Chunk, as_array, bucket_of, buckets_for, chunked, gram_hashes, joined, member, numbered, over, pair_classes, returned, run_classes, spaced, unzip, word_spans, words_of, zip_
from .common import table
from .winnowing import Anchors, class_starts, covered, repeated_anchors, runs_of, winnow

CLEANED = "doc_id long, n_words long, n_removed long, is_null boolean, words binary"
#: Places of seeds with their surroundings.  starts: first word in the chunk; at: words before the seed; n: all words.
PLACES = "bucket int, chunk long, keys binary, ids binary, starts binary, at binary, n binary, words binary"


def prepared(chunk: Chunk):
    """Hash and document of each word, and the words."""
    w = words_of(*spaced(chunk))
    return w.hashes, w.doc, w


def first_of(numbers: np.ndarray) -> np.ndarray:
    """Index of the first of each number."""
    return np.unique(numbers, return_index=True)[1]


class Seeds:
    """Repeated seeds of a chunk, the class of each window that they own, and of which window a seed's first one is."""

    def __init__(self, chunk: Chunk, repeated: np.ndarray, length: int, k: int) -> None:
        self.units, self.doc, self.words = prepared(chunk)
        self.found = winnow(self.units, self.doc, length, k)
        self.found = self.found.where(member(self.found.key, repeated))
        self.windows = self.found.windows()
        self.hashes = gram_hashes(self.units, length)[self.windows] if len(self.windows) else np.zeros(0, dtype=np.uint64)
        self.classes, _ = run_classes(self.words.ids, self.windows, self.hashes, length)
        self.first = np.cumsum(self.found.n) - self.found.n

    def surroundings(self, length: int, hot: np.ndarray) -> Anchors:
        """Each different surrounding of a seed, in its smallest document; those of hot seeds window by window."""
        key, start, n, at = self.found
        whole = ~member(key, hot)
        # windows at the ends cover a surrounding
        last = self.classes[self.first + n - 1]
        same = pair_classes(pair_classes(self.classes[self.first], last), n)[whole] if len(key) else key.astype(np.int64)
        keep = np.flatnonzero(whole)[first_of(same)]
        single = np.flatnonzero(np.repeat(~whole, n))
        single = single[first_of(self.classes[single])]
        place = self.windows[single]
        parts = (key[keep], self.hashes[single]), (start[keep], place), (n[keep], np.ones_like(place)), (at[keep], place)
        return Anchors(*map(np.concatenate, parts))


def matched_windows(first: np.ndarray, n: np.ndarray, at: np.ndarray, ids: np.ndarray, k: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, words left of the seed, class) of all windows of seeds that match another place's.

    A place has words ids[first : first + n], with the seed at `at`; its windows are those within that have all of the seed.
    """
    longest, rows = length - k, np.arange(len(first))
    seed = first + at
    alive = rows
    base = np.zeros(len(first), dtype=np.int64)
    for j in range(k):
        base = pair_classes(base, ids[seed + j])

    def extended(step) -> list[tuple[np.ndarray, np.ndarray]]:
        """Class after 0, 1, ... more words, of the places that are not alone: (places, classes)."""
        here, cls = alive, base
        out = []
        for j in range(longest + 1):
            if j:
                word, inside = step(here, j)
                here, cls = here[inside], pair_classes(cls[inside], ids[word[inside]])
            several = np.bincount(cls)[cls] > 1 if len(cls) else np.zeros(0, dtype=bool)
            here, cls = here[several], cls[several]
            out.append((here, cls))
        return out

    right = extended(lambda p, j: (np.minimum(seed[p] + k + j - 1, len(ids) - 1), at[p] + k + j <= n[p]))
    left = extended(lambda p, j: (np.maximum(seed[p] - j, 0), at[p] >= j))
    found = []
    for i in range(longest + 1):
        (a, x), (b, y) = left[i], right[longest - i]
        both, p, q = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        if len(both):
            cls = pair_classes(x[p], y[q])
            several = np.bincount(cls)[cls] > 1
            found.append((both[several], np.full(int(several.sum()), i), cls[several]))
    shift = 0
    for i, (p, l, cls) in enumerate(found):
        found[i] = (p, l, cls + shift)
        shift += int(cls.max(initial=-1)) + 1
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (rows[:0],) * 3


def remove_repeats(docs: DataFrame, min_words: int = 13, seed_words: int = 5, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, is_null, words) of docs(doc_id, text); words: those kept, by one space apart, UTF-8."""
    return _removed(docs.select("doc_id", "text"), min_words, seed_words, clean_words, CLEANED, **options)


def without_repeats(docs: DataFrame, min_words: int = 13, seed_words: int = 5, **options) -> DataFrame:
    """docs, all columns, their texts without the words that repeat and the spaces after these; n_chars is set anew if
    there is one.  Other spaces stay, and a text that loses nothing is as it was."""
    fields = [f for f in docs.schema if f.name not in ("doc_id", "text")]
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), *fields])
    return _removed(docs, min_words, seed_words, clean_texts, schema, **options).select(*[f"`{c}`" for c in docs.columns])


def clean_words(chunk: Chunk, drop: np.ndarray, edges: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[dict]:
    for i, doc_id in enumerate(chunk.ids()):
        a, e = edges[i], edges[i + 1]
        kept = np.flatnonzero(~drop[a:e]) + a
        words = b" ".join([data[x:y] for x, y in zip(starts[kept].tolist(), ends[kept].tolist())])
        yield {"doc_id": doc_id, "n_words": int(e - a), "n_removed": int(e - a - len(kept)), "is_null": bool(chunk.null[i]), "words": words}


def clean_texts(chunk: Chunk, drop: np.ndarray, edges: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[dict]:
    stops = np.cumsum(chunk.sizes + 1) - 1
    for i, (doc_id, other) in enumerate(zip(chunk.ids(), chunk.others())):
        a, e = edges[i], edges[i + 1]
        at, stop, parts = int(stops[i] - chunk.sizes[i]), int(stops[i]), []
        for x, y in zip(*runs_of(drop[a:e])):
            parts.append(data[at : starts[a + x]])
            at = int(starts[a + y]) if a + y < e else stop
        parts.append(data[at:stop])
        text = None if chunk.null[i] else b"".join(parts).decode()
        if "n_chars" in other:
            other = other | {"n_chars": None if text is None else len(text)}
        yield {"doc_id": doc_id, "text": text, **other}


def _removed(docs: DataFrame, min_words: int, seed_words: int, emit, schema, *, chunk_bytes: int = 2 << 20, hot_rows: int = 20_000, part_words: int = 2 << 20) -> DataFrame:
    chunks = chunked(docs, chunk_bytes)
    n_chunks = chunks.count()
    n_buckets = buckets_for(n_chunks)
    anchors = repeated_anchors(chunks, n_chunks, prepared, min_words, seed_words, True, hot_rows)

    def send(chunk: Chunk, row: dict) -> Iterator[dict]:
        if not row["repeated"]:
            return
        seeds = Seeds(chunk, joined(row["repeated"]), min_words, seed_words)
        places = seeds.surroundings(min_words, joined(row["hot"]))
        bucket = bucket_of(places.key, n_buckets)
        order = np.argsort(bucket, kind="stable")
        words, doc, data = seeds.words, seeds.doc, seeds.words.text.tobytes()
        edges = class_starts(bucket[order])
        for a, e in zip(edges, np.r_[edges[1:], len(order)]):
            key, start, n, at = places.where(order[a:e])
            n = n + min_words - 1
            text = b" ".join([data[x:y] for x, y in zip(words.starts[start].tolist(), words.ends[start + n - 1].tolist())])
            yield {"bucket": int(bucket[order[a]]), "chunk": chunk.id, "keys": key.tobytes(), "ids": chunk.doc_ids[doc[start]].tobytes(), "starts": start.astype("<i4").tobytes(), "at": (at - start).astype("<i4").tobytes(), "n": n.astype("<i4").tobytes(), "words": zip_(text)}

    def extend(t: pa.Table) -> pa.Table:
        """For each chunk windows that documents of other chunks with smaller ids have, one place of each."""
        keys = [as_array(x, "<u8") for x in t["keys"].to_pylist()]
        chunk = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        keys = np.concatenate(keys)
        ids, starts, at, n = (np.concatenate([as_array(x, kind) for x in t[c].to_pylist()]).astype(np.int64) for c, kind in (("ids", "<i8"), ("starts", "<i4"), ("at", "<i4"), ("n", "<i4")))
        text = np.frombuffer(b" ".join([unzip(x) for x in t["words"].to_pylist()]), dtype=np.uint8)
        words, _ = numbered(text, *word_spans(text))
        first = np.cumsum(n) - n
        gone = []
        order = np.argsort(keys, kind="stable")
        for part in parts_by_key(keys[order], n[order], part_words):
            own = order[part]
            place, left, cls = matched_windows(first[own], n[own], at[own], words, seed_words, min_words)
            if not len(place):
                continue
            place = own[place]
            least = np.full(int(cls.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, cls, ids[place])
            here = pair_classes(cls, chunk[place])
            least_here = np.full(int(here.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least_here, here, ids[place])
            later = np.flatnonzero(least_here[here] > least[cls])
            later = later[first_of(here[later])]
            gone.append((chunk[place[later]], starts[place[later]] + at[place[later]] - left[later]))
        whose, where = (np.concatenate(x) for x in zip(*gone)) if gone else (np.zeros(0, np.int64),) * 2
        by = np.argsort(whose, kind="stable")
        edges = class_starts(whose[by])
        ends = np.r_[edges[1:], len(by)]
        number = t["chunk"].to_pylist()
        return pa.table({"chunk": pa.array([number[whose[by[a]]] for a in edges], pa.int64()), "gone": pa.array([np.sort(where[by[a:e]]).astype("<i4").tobytes() for a, e in zip(edges, ends)], pa.binary())})

    told = returned(chunks, (anchors, "repeated"), (anchors, "hot"))
    gone = over(told, send, PLACES).groupBy("bucket").applyInArrow(extend, "chunk long, gone binary")

    def clean(chunk: Chunk, row: dict) -> Iterator[dict]:
        if row["repeated"]:
            seeds = Seeds(chunk, joined(row["repeated"]), min_words, seed_words)
            words, doc, classes = seeds.words, seeds.doc, seeds.classes
            drop = np.zeros(len(doc), dtype=bool)
            if len(classes):
                number = int(classes.max()) + 1
                ids = chunk.doc_ids[doc[seeds.windows]]
                least = np.full(number, np.iinfo(np.int64).max)
                np.minimum.at(least, classes, ids)
                # what a smaller document of another chunk has goes all over this one
                elsewhere = np.zeros(number, dtype=bool)
                elsewhere[classes[np.searchsorted(seeds.windows, joined(row["gone"], "<i4"))]] = True
                drop = covered(len(doc), seeds.windows[(ids > least[classes]) | elsewhere[classes]], min_words)
        else:
            _, doc, words = prepared(chunk)
            drop = np.zeros(len(doc), dtype=bool)
        edges = np.searchsorted(doc, np.arange(len(chunk.doc_ids) + 1))
        yield from emit(chunk, drop, edges, words.text.tobytes(), words.starts, words.ends)

    return over(returned(chunks, (anchors, "repeated"), (gone, "gone")), clean, schema)


def parts_by_key(keys: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of sorted keys of at most `most` in all, or of one key."""
    begins = class_starts(keys)
    ends = np.r_[begins[1:], len(keys)]
    total = np.r_[0, np.cumsum(sizes.astype(np.int64))]
    start = 0
    for begin, end in zip(begins.tolist(), ends.tolist()):
        if begin > start and total[end] - total[start] > most:
            yield slice(start, begin)
            start = begin
    if len(keys):
        yield slice(start, len(keys))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 13 words over all documents."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("words", 256).alias("kept_sha256"))
