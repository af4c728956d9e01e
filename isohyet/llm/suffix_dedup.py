"""Removal of byte strings that stand earlier in the corpus, by suffix arrays of shards.

Strings of `length` bytes are judged.  Most of a corpus stands there once, so a suffix array of all of it would sort
mostly strings that need no order.  First, chunks of documents exchange winnowed anchors (see winnowing): where no anchor
of a string recurs, the string doesn't.  What is owned by recurring anchors goes, as segments of the text, to shards by
anchor; a segment that a chunk has many times, it sends once.  An anchor that is there over hot_rows times (part of a line
that very many documents share) would be too much for one shard: it is lengthened to whole strings, each of which is a
segment that goes to a shard of its own, once from each chunk.

A shard sorts its segments in parts of bounded size, one or more anchors to a part: a suffix array by Larsson-Sadakane
refinement, common prefixes by Kasai's rule, and so the classes of equal strings.  An anchor whose segments are too many
for one part has several, and these are merged by binary search of one part's sorted classes in those of the parts before
it.  The first place (smallest document, then smallest start) of each class keeps the string,
and each chunk removes it wherever else it has it.  Hashes only decide which strings are compared; that they are equal is
always decided by their bytes.

Strings never cross documents.  Null texts count as empty; texts shorter than a string lose nothing.  Rows that share a
doc_id and a start are the same place: they lose nothing to each other.  Rows without doc_id are left out.  An empty table
gives no rows.  A task needs memory for a chunk or for the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import MIXED, Chunk, as_array, bucket_of, buckets_for, chunked, gram_hashes, joined, member, over, returned, run_classes, unzip, zip_
from .common import table
from .substring_dedup import parts_by_key
from .suffix_arrays import common_prefixes, eight_bytes, search, suffix_array
from .winnowing import class_starts, covered, repeated_anchors, runs_of, winnow

SEGMENTS = "bucket int, chunk long, keys binary, ids binary, starts binary, anchors binary, places binary, sizes binary, bytes binary"
CLEANED = "doc_id long, n_bytes long, n_removed long, n_spans long, is_null boolean, kept binary"


def prepared(chunk: Chunk):
    """Hashed byte and document of each place."""
    return MIXED[chunk.text], np.repeat(np.arange(len(chunk.sizes), dtype=np.int32), chunk.sizes)


def segments(chunk: Chunk, row: dict, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(key, start, number of strings, place of the anchor, bytes) of each different segment that repeated anchors own, in
    its first document; hot anchors' segments are single strings."""
    units, doc = prepared(chunk)
    found = winnow(units, doc, length, k)
    found = found.where(member(found.key, joined(row["repeated"])))
    hot = member(found.key, joined(row["hot"]))
    key, start, n, anchor = found.where(~hot)
    if hot.any():
        single = found.where(hot).windows()
        more = gram_hashes(units, length)[single], single, np.ones_like(single), single
        key, start, n, anchor = (np.concatenate(x) for x in zip((key, start, n, anchor), more))
    if not in_order(chunk):
        own = doc[start]
        by = np.lexsort((anchor - (np.cumsum(chunk.sizes) - chunk.sizes)[own], chunk.doc_ids[own]))
        key, start, n, anchor = key[by], start[by], n[by], anchor[by]
    data, first = chunk.text.tobytes(), {}
    for i, (a, e) in enumerate(zip(start.tolist(), (start + n + length - 1).tolist())):
        first.setdefault(data[a:e], i)
    keep = np.fromiter(first.values(), dtype=np.int64, count=len(first))
    return key[keep], start[keep], n[keep], anchor[keep], list(first)


def in_order(chunk: Chunk) -> bool:
    """No two documents share an id."""
    return bool((chunk.doc_ids[1:] != chunk.doc_ids[:-1]).all())


def later_places(group: np.ndarray, ids: np.ndarray, starts: np.ndarray, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The first item of each group, and which items come after the first place of theirs.

    ordered: the items of a group come in the order of their places.
    """
    order = np.argsort(group, kind="stable") if ordered else np.lexsort((starts, ids, group))
    first = class_starts(group[order])
    n = np.diff(np.r_[first, len(order)])
    lead = order[first]
    later = np.empty(len(order), dtype=bool)
    later[order] = (ids[order] != np.repeat(ids[lead], n)) | (starts[order] != np.repeat(starts[lead], n))
    return lead, later


def parts_of(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of segments of at most so many bytes, or of one segment."""
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total + n > most and i > start:
            yield slice(start, i)
            start, total = i, 0
        total += n
    yield slice(start, len(sizes))


def later_strings(segments: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int, part_bytes: int) -> list[np.ndarray]:
    """For each segment, which of its strings stand earlier in another segment; those of one anchor come in the order of
    their places."""
    text = as_array(b"".join(segments), "u1")
    sizes = np.array([len(x) for x in segments], dtype=np.int64)
    n = sizes - length + 1
    begin = np.cumsum(sizes) - sizes
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    places = np.repeat(begin, n) + within  # of all strings
    is_place = np.zeros(len(text), dtype=bool)
    is_place[places] = True
    number = np.empty(len(text), dtype=np.int64)  # of the class of the string at a place
    head = eight_bytes(text) if sizes.sum() > part_bytes else None
    merged = np.zeros(0, dtype=np.int64)  # a place of each class of the parts so far, in order of the strings
    seen = np.zeros(0, dtype=np.int64)  # places of the parts so far
    for part in parts_of(sizes, part_bytes):
        a, e = int(begin[part][0]), int(begin[part][-1] + sizes[part][-1])
        order = suffix_array(text[a:e], length)
        class_at = np.cumsum(common_prefixes(text[a:e], order, length) < length) - 1
        strings = is_place[a:e][order]
        own, own_class = order[strings] + a, class_at[strings]
        lead = class_starts(own_class)
        own_class = np.repeat(np.arange(len(lead)), np.diff(np.r_[lead, len(own)]))
        if not len(merged):
            merged, number[own], seen = own[lead], own_class, own
            continue
        at, there = search(head, merged, own[lead], length)
        fresh = np.flatnonzero(~there)
        moved = np.arange(len(merged)) + np.searchsorted(at[fresh], np.arange(len(merged)), side="right")
        target = moved[np.minimum(at, len(merged) - 1)]
        target[fresh] = at[fresh] + np.arange(len(fresh))
        both = np.empty(len(merged) + len(fresh), dtype=np.int64)
        both[moved], both[target[fresh]] = merged, own[lead][fresh]
        number[seen] = moved[number[seen]]
        number[own] = target[own_class]
        merged, seen = both, np.concatenate([seen, own])
    later = later_places(number[places], np.repeat(ids, n), np.repeat(starts, n) + within, ordered=True)[1]
    return np.split(later, np.cumsum(n)[:-1])


def remove_repeats(docs: DataFrame, length: int = 100, anchor_bytes: int = 32, *, chunk_bytes: int = 2 << 20, part_bytes: int = 512 << 10, hot_rows: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, is_null, kept) of docs(doc_id, text); kept: the remaining bytes."""
    chunks = chunked(docs, chunk_bytes)
    n_chunks = chunks.count()
    n_buckets = buckets_for(n_chunks, 6)
    anchors = repeated_anchors(chunks, n_chunks, prepared, length, anchor_bytes, False, hot_rows)

    def send(chunk: Chunk, row: dict) -> Iterator[dict]:
        if not row["repeated"]:
            return
        key, start, n, anchor, texts = segments(chunk, row, length, anchor_bytes)
        doc = np.searchsorted(np.cumsum(chunk.sizes), start, side="right")
        begin = (np.cumsum(chunk.sizes) - chunk.sizes)[doc]
        bucket = bucket_of(key, n_buckets)
        order = np.argsort(bucket, kind="stable")
        edges = class_starts(bucket[order])
        for a, e in zip(edges, np.r_[edges[1:], len(order)]):
            k = order[a:e]
            text = zip_(b"".join([texts[i] for i in k.tolist()]))
            yield {"bucket": int(bucket[k[0]]), "chunk": chunk.id, "keys": key[k].tobytes(), "ids": chunk.doc_ids[doc[k]].tobytes(), "starts": (start - begin)[k].tobytes(), "anchors": (anchor - begin)[k].tobytes(), "places": start[k].tobytes(), "sizes": (n[k] + length - 1).astype("<i4").tobytes(), "bytes": text}

    def resolve(t: pa.Table) -> pa.Table:
        out = sorted_strings(t)
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "gone": pa.array([x[1] for x in out], pa.binary())})

    def sorted_strings(t: pa.Table) -> list[tuple[int, bytes]]:
        cols = {c: [as_array(x, kind) for x in t[c].to_pylist()] for c, kind in (("keys", "<u8"), ("ids", "<i8"), ("starts", "<i8"), ("anchors", "<i8"), ("places", "<i8"), ("sizes", "<i4"))}
        per_chunk = [len(x) for x in cols["keys"]]
        keys, ids, starts, anchors, places, sizes = (np.concatenate(x) for x in cols.values())
        data = b"".join(unzip(x) for x in t["bytes"].to_pylist())
        ends = np.cumsum(sizes.astype(np.int64))
        segments = [data[a:e] for a, e in zip((ends - sizes).tolist(), ends.tolist())]
        number: dict[bytes, int] = {}
        same = np.array([number.setdefault(s, len(number)) for s in segments])
        whole = later_places(same, ids, starts)[1]  # an equal segment stands earlier
        order = np.lexsort((starts, ids, same))
        leads = order[class_starts(same[order])]
        # an anchor with one segment is settled; strings of several have to be sorted
        _, key_no, n_of_key = np.unique(keys[leads], return_inverse=True, return_counts=True)
        open_ = np.sort(leads[n_of_key[key_no] > 1])
        # equal strings lie equally far from their anchors, so these tell the order of their places
        open_ = open_[np.lexsort((anchors[open_], ids[open_], keys[open_]))]
        flags = {}
        for group in parts_by_key(keys[open_], sizes[open_], part_bytes):
            own = open_[group]
            flags.update(zip(own.tolist(), later_strings([segments[i] for i in own], ids[own], starts[own], length, part_bytes)))
        out, i = [], 0
        for chunk, m in zip(t["chunk"].to_pylist(), per_chunk):
            gone = []
            for j in range(i, i + m):
                if whole[j]:
                    gone.append((places[j], sizes[j] - length + 1))
                elif j in flags:
                    gone += [(places[j] + a, e - a) for a, e in zip(*runs_of(flags[j]))]
            i += m
            if gone:
                out.append((chunk, np.array(gone, dtype="<i8").tobytes()))
        return out

    sent = over(returned(chunks, (anchors, "repeated"), (anchors, "hot")), send, SEGMENTS)
    gone = sent.groupBy("bucket").applyInArrow(resolve, "chunk long, gone binary")

    def clean(chunk: Chunk, row: dict) -> Iterator[dict]:
        drop = np.zeros(len(chunk.text), dtype=bool)
        if row["repeated"]:
            units, doc = prepared(chunk)
            found = winnow(units, doc, length, anchor_bytes)
            places = found.where(member(found.key, joined(row["repeated"]))).windows()
            hashes = gram_hashes(units, length)[places] if len(places) else np.zeros(0, dtype=np.uint64)
            number, first = run_classes(chunk.text, places, hashes, length)
            if in_order(chunk):
                later = np.ones(len(places), dtype=bool)
                later[first] = False
            else:
                own, doc_first = doc[places], np.cumsum(chunk.sizes) - chunk.sizes
                first, later = later_places(number, chunk.doc_ids[own], places - doc_first[own])
            if row["gone"]:
                told = np.concatenate([as_array(x, "<i8").reshape(-1, 2) for x in row["gone"]])
                begin, n = told[:, 0], told[:, 1]
                told = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                # if the chunk's first place of a string is not the corpus', the string goes all over the chunk
                is_told = np.zeros(len(drop), dtype=bool)
                is_told[told] = True
                later |= is_told[places[first]][number]
            drop = covered(len(drop), places[later], length)
        at = 0
        for i, doc_id in enumerate(chunk.ids()):
            own = slice(at, at + int(chunk.sizes[i]))
            at = own.stop
            gone_here = drop[own]
            yield {"doc_id": doc_id, "n_bytes": len(gone_here), "n_removed": int(gone_here.sum()), "n_spans": len(runs_of(gone_here)[0]), "is_null": bool(chunk.null[i]), "kept": chunk.text[own][~gone_here].tobytes()}

    return over(returned(chunks, (anchors, "repeated"), (gone, "gone")), clean, CLEANED)


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes over all documents."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
