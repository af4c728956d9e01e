"""Similarity join of documents on their sets of word n-grams, by prefix trees.

A document's set has its different n-grams of lower-case words (A-Z), as 64-bit hashes (a tree of pairs over halves of
128-bit hashes of the words).  Two documents link when percent * |union| <= 100 * |intersection|.

Equal sets are one class, by a 128-bit digest; chunks learn by an exchange of digests which document is the first of each
class, and it alone goes on, with the number of rows that it stands for.

Which sets can link at all: sizes of linked sets lie in one size class or in neighbouring ones.  For each pair of
classes the grams are cut into more parts than two linked sets of these sizes can differ in, so linked sets agree in some
whole parts.  Each set sends a hash of each part, and those that agree in one go to the join.  The hot_grams most frequent
grams are left out of the parts, which makes no difference to what must agree, so that a passage that very many documents
share brings these together only where little else is in them; sets that are left with too few full parts send those of
their whole sets, too.  Linked sets agree in one more part than there are spare ones, and what is empty in both is empty in each, so a
set goes on only where others have as many of its full parts as it must share: what a set shares with others by chance grows with
the number of sets, and would in the end join all in one group.  Chunks learn from an exchange of short hashes which parts others have.

The join stores the sets of a group in a prefix tree, grams in one global order (frequent ones last, by their number of
documents), and runs all sets down it together: sets with a common prefix share the counting of their overlap, and a set
leaves a subtree when what remains of both can't lift the overlap to what is needed.  Every link is found; a task adds up how
many rows each set links with, so that their rows don't grow with the square of a group, and passes on those that connect.
Groups are the components of agreeing parts; a group of several block_docs sets is joined block by block, each pair of blocks in a
task of its own.  Links form the components of the result.

Null texts, and texts without words, have empty sets and link with nothing.  A text of fewer than n words is one n-gram.
Rows that share a doc_id have one component; their links are counted row by row.  Rows without doc_id have their number of
n-grams, but no component, and link with nothing.  An empty table gives no rows.  A task needs memory for a chunk or for the
longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunk, as_array, bucket_edges, bucket_of, buckets_for, chunked, gram_hashes, member, over, returned, spaced, unzip, words_of, zip_
from .common import collecting, mix, remove, table, written
from .components import components
from .winnowing import class_starts


def size_classes(percent: int, largest: int) -> np.ndarray:
    """First size of each class; a set that links with one of class c is in class c - 1, c or c + 1."""
    edges = [1, 2]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1))
    return np.array([*edges, max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1)], dtype=np.int64)


def sets_of(chunk: Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of all documents, ascending in each document, and how many each has."""
    text, doc_starts = spaced(chunk, lower=True)
    found = words_of(text, doc_starts)
    doc, words = found.doc, found.hashes
    count = np.bincount(doc, minlength=len(doc_starts))
    first = np.cumsum(count) - count
    full = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :]) if len(doc) >= n else np.zeros(0, dtype=np.int64)
    grams, of = [mix(gram_hashes(words, n)[full])], [doc[full]]
    for short in range(1, n):
        which = np.flatnonzero(count == short)
        if len(which):
            grams.append(mix(gram_hashes(words, short)[first[which]] ^ np.uint64(short << 32)))
            of.append(which)
    grams, of = np.concatenate(grams), np.concatenate(of)
    order = np.argsort(grams, kind="stable")
    order = order[np.argsort(of[order], kind="stable")]
    grams, of = grams[order], of[order]
    new = np.r_[True, (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])] if len(grams) else np.zeros(0, dtype=bool)
    return grams[new], np.bincount(of[new], minlength=len(doc_starts))


def different_rows(*columns: np.ndarray) -> list[np.ndarray]:
    """Columns of the different rows, in order."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    if not len(order):
        return columns
    new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
    return [c[new] for c in columns]


def digests(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each set, two numbers a row."""
    out = np.zeros((len(sizes), 2), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        begins = (np.cumsum(sizes) - sizes)[some]
        for i, key in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            out[some, i] = mix(np.add.reduceat(mix(grams ^ np.uint64(key)), begins) + sizes[some].astype(np.uint64))
    return out


#: A class of equal sets as a chunk learns of it: digest, smallest doc_id, number of rows, whether that document is here.
CLASS = np.dtype([("d0", "<u8"), ("d1", "<u8"), ("lead", "<i8"), ("n", "<i8"), ("here", "?")])


class ChunkSets:
    """Sets of a chunk's documents; with what is known of their classes, which documents stand for a class."""

    def __init__(self, chunk: Chunk, n: int, blobs: list[bytes] | None = None) -> None:
        self.grams, self.sizes = sets_of(chunk, n)
        self.ends, self.ids = np.cumsum(self.sizes), chunk.doc_ids
        self.digest = digests(self.grams, self.sizes)
        self.joins = (self.sizes > 0) & ~chunk.without
        self.n, self.lead, here = np.ones(len(self.sizes), dtype=np.int64), self.ids.copy(), self.joins.copy()
        if blobs:
            known = np.concatenate([np.frombuffer(b, dtype=CLASS) for b in blobs])
            known = known[np.lexsort((known["d1"], known["d0"]))]
            number = {x: i for i, x in enumerate(zip(known["d0"].tolist(), known["d1"].tolist()))}
            at = np.array([number.get(x, -1) for x in zip(*self.digest.T.tolist())], dtype=np.int64)
            of = np.flatnonzero((at >= 0) & self.joins)
            self.n[of], self.lead[of], here[of] = (known[c][at[of]] for c in ("n", "lead", "here"))
            # the first of the rows that have the smallest id
            first = here & (self.lead == self.ids)
            again = np.zeros(len(first), dtype=bool)
            again[of] = True
            again[of[np.unique(np.where(first[of], at[of], len(known) + np.arange(len(of))), return_index=True)[1]]] = False
            here = first & ~again
        #: documents that stand for their class
        self.leads = np.flatnonzero(here)

    def of(self, i: int) -> np.ndarray:
        return self.grams[self.ends[i] - self.sizes[i] : self.ends[i]]


SEEN = "kind int, bucket int, chunk long, keys binary, ids binary, counts binary"
GRAM, SET = 0, 1


def look(chunks: DataFrame, n: int, n_buckets: int) -> DataFrame:
    """What chunks have, by buckets: grams that three documents or more of a chunk have, and digests of sets with their
    smallest doc_id and number of rows."""

    def send(chunk: Chunk, row: dict) -> Iterator[dict]:
        sets = ChunkSets(chunk, n)
        keys, n_docs = np.unique(sets.grams, return_counts=True)
        keys, n_docs = keys[n_docs > 2], n_docs[n_docs > 2]
        edges = bucket_edges(keys, n_buckets)
        for b in np.flatnonzero(np.diff(edges)):
            s = slice(edges[b], edges[b + 1])
            yield {"kind": GRAM, "bucket": int(b), "chunk": chunk.id, "keys": keys[s].tobytes(), "ids": None, "counts": n_docs[s].astype("<i8").tobytes()}
        own = np.flatnonzero(sets.joins)
        d = sets.digest[own]
        order = np.lexsort((sets.ids[own], d[:, 1], d[:, 0]))
        d, ids = d[order], sets.ids[own][order]
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]).any(1)]) if len(d) else np.zeros(0, dtype=np.int64)
        n_rows = np.diff(np.r_[first, len(d)])
        bucket = bucket_of(d[first, 0], n_buckets)  # ascending, as digests are
        edges = class_starts(bucket)
        for a, e in zip(edges, np.r_[edges[1:], len(first)]):
            yield {"kind": SET, "bucket": int(bucket[a]), "chunk": chunk.id, "keys": d[first[a:e]].tobytes(), "ids": ids[first[a:e]].tobytes(), "counts": n_rows[a:e].astype("<i8").tobytes()}

    return written(over(chunks, send, SEEN), "seen")


def frequent_grams(seen: DataFrame, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams that most documents have, ascending, with their places in the order of frequency (from 1, rare ones
    first): at most `most`, each in `least` documents or more.

    Documents are counted where a chunk has a gram three times or more, which is enough to find grams that many have.
    Which grams are found only decides what work the join does, never its result.
    """

    def total(t: pa.Table) -> pa.Table:
        keys, counts = np.concatenate([as_array(x, "<u8") for x in t["keys"].to_pylist()]), np.concatenate([as_array(x, "<i8") for x in t["counts"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        first = class_starts(keys[order])
        n_docs = np.add.reduceat(counts[order], first)
        keep = n_docs >= least
        return pa.table({"gram": pa.array(keys[order][first][keep].view(np.int64)), "n_docs": pa.array(n_docs[keep])})

    found = seen.where(F.col("kind") == GRAM).groupBy("bucket").applyInArrow(total, "gram long, n_docs long")
    rows = found.orderBy(F.desc("n_docs"), "gram").limit(most).toArrow()
    grams = rows["gram"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], (len(grams) - np.arange(len(grams)))[order]


def classes(seen: DataFrame) -> DataFrame:
    """(chunk, classes): of the sets of each chunk that several rows have, the first document and the number of rows."""

    def total(t: pa.Table) -> pa.Table:
        keys = [as_array(x, "<u8").reshape(-1, 2) for x in t["keys"].to_pylist()]
        chunk = np.repeat(t["chunk"].to_numpy(), [len(x) for x in keys])
        d, ids, n = np.concatenate(keys), *(np.concatenate([as_array(x, "<i8") for x in t[c].to_pylist()]) for c in ("ids", "counts"))
        order = np.lexsort((chunk, ids, d[:, 1], d[:, 0]))
        d, ids, n, chunk = d[order], ids[order], n[order], chunk[order]
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]).any(1)])
        size = np.diff(np.r_[first, len(d)])
        out = np.zeros(len(d), dtype=CLASS)
        out["d0"], out["d1"], out["lead"], out["n"] = d[:, 0], d[:, 1], np.repeat(ids[first], size), np.repeat(np.add.reduceat(n, first), size)
        out["here"][first] = True
        several = out["n"] > 1
        out, chunk = out[several], chunk[several]
        order = np.argsort(chunk, kind="stable")
        out, chunk = out[order], chunk[order]
        edges = class_starts(chunk)
        return pa.table({"chunk": pa.array(chunk[edges], pa.int64()), "classes": pa.array([out[a:e].tobytes() for a, e in zip(edges, np.r_[edges[1:], len(chunk)])], pa.binary())})

    return seen.where(F.col("kind") == SET).groupBy("bucket").applyInArrow(total, "chunk long, classes binary")


def spare_parts(low: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """How many parts more than differ + 1 there are, so that few sets of `low` grams have more empty ones than that."""
    spare = np.zeros(len(low), dtype=np.int64)
    for _ in range(4):
        parts = differ + 1 + spare
        empty = parts * np.exp(-low / parts)
        spare = np.minimum(np.ceil(empty + 2 * np.sqrt(empty) + 1).astype(np.int64), differ + 2)
    return spare


def signatures(grams: np.ndarray, rare: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of a part, set) of all parts of the sets, for both pairs of classes that a set belongs to.

    grams: those of the sets, ascending in each; rare: which of them are not frequent; sizes: of the sets.
    """
    return needed_parts(grams, rare, sizes, percent)[:2]


def needed_parts(grams: np.ndarray, rare: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of a part, set, cut, need) of all parts of the sets.  Two linked sets have a cut of either in which they agree in
    as many of these parts as each of the two needs there."""
    edges = size_classes(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(edges, sizes, side="right") - 1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    found = []
    for pair in (own - 1, own):  # pair p: classes p and p + 1
        good = (sizes > 0) & (pair >= 0)
        keys, of, poor, need = part_keys(grams[rare], doc[rare], pair, good, edges, percent, False)
        found.append((keys, of, len(found) * len(sizes) + of, need[of]))
        keys, of, _, need = part_keys(grams, doc, pair, good & poor, edges, percent, True)
        found.append((keys, of, len(found) * len(sizes) + of, need[of]))
    return tuple(np.concatenate(x) for x in zip(*found))


def part_keys(grams, doc, pair, good, edges, percent: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of a part, set) of the sets that are good, which have too few full parts to agree with all others in one, and in how
    many of the parts that it sends a set agrees with each one that it links with.

    whole: all grams are there, not the rare ones alone; then empty parts count where a set has too few full ones.
    """
    p = np.maximum(pair, 0)
    differ = (edges[p + 1] - 1) * (100 - percent) // percent  # of the largest set of class p and the largest that links with it
    spare = spare_parts(edges[p], differ)
    parts = np.where(good, differ + 1 + spare, 0)
    first = np.cumsum(parts) - parts
    use = good[doc]
    grams, doc = grams[use], doc[use]
    # grams ascend, so the parts of a document follow each other
    slot = first[doc] + ((grams >> np.uint64(32)) * parts[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    begins = class_starts(slot)
    total = int(parts.sum())
    sums, counts = np.zeros(total, dtype=np.uint64), np.zeros(total, dtype=np.uint64)
    if len(begins):
        sums[slot[begins]] = np.add.reduceat(mix(grams + np.uint64(0x5851F42D4C957F2D)), begins)
        counts[slot[begins]] = np.diff(np.r_[begins, len(slot)])
    of = np.repeat(np.arange(len(parts)), parts)
    # linked sets agree in spare + 1 parts: in a full one, unless both have more than spare empty ones
    empty = np.bincount(of[counts == 0], minlength=len(parts))
    poor = empty > spare
    send = (counts > 0) | (whole & poor)[of] if whole else counts > 0
    tag = mix((pair[of].astype(np.uint64) << np.uint64(32)) + (np.arange(total) - first[of]).astype(np.uint64) * np.uint64(4) + np.uint64(1 + 2 * whole))
    return mix(sums + counts * np.uint64(0x2545F4914F6CDD1D) ^ tag)[send], of[send], poor & good, np.maximum(spare + 1 - empty, 1)


def enough(shared: np.ndarray, cut: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Which parts others have, of the cuts in which others have as many as are needed."""
    return shared & (np.bincount(cut[shared], minlength=int(cut.max(initial=-1)) + 1)[cut] >= need)


# ------------------------------------------------------------------------------------------------------- the tree join


class Node:
    """grams: edge that leads here; sets: those that end here; lo, hi: the members' places in order, the sets from here on;
    least, most: sizes of the members; depth: grams on the way here, the edge included."""

    __slots__ = ("children", "depth", "grams", "hi", "least", "lo", "most", "sets")

    def __init__(self, grams: np.ndarray, depth: int, lo: int, hi: int, ordered: np.ndarray) -> None:
        self.grams, self.depth, self.lo, self.hi = grams, depth, lo, hi
        self.least, self.most = int(ordered[lo:hi].min()), int(ordered[lo:hi].max())
        self.children: list[Node] = []
        self.sets: list[int] = []


def in_order(sets: list[np.ndarray], frequent: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """The sets with their grams numbered in the global order: those that are not frequent first, by their hashes."""
    sizes = [len(s) for s in sets]
    grams, number = np.unique(np.concatenate(sets), return_inverse=True)
    late = np.zeros(len(grams), dtype=np.int64)
    known = member(grams, frequent)
    late[known] = place[np.searchsorted(frequent, grams[known])]
    rank = np.empty(len(grams), dtype=np.int64)
    rank[np.argsort(late, kind="stable")] = np.arange(len(grams))
    return [np.sort(x) for x in np.split(rank[number], np.cumsum(sizes)[:-1])]


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def prefix_tree(sets: list[np.ndarray], order: list[int]) -> Node:
    """Compressed tree over sets in lexicographic order."""
    ordered = np.array([len(sets[i]) for i in order])
    sizes = ordered.tolist()
    common = [0] + [common_prefix(sets[a], sets[b]) for a, b in zip(order, order[1:])] + [0]
    root = Node(np.zeros(0, dtype=np.int64), 0, 0, len(order), ordered)
    todo = [(root, 0, len(order), 0)]
    while todo:
        node, lo, hi, depth = todo.pop()
        while lo < hi and sizes[lo] == depth:
            node.sets.append(order[lo])
            lo += 1
        i = lo
        while i < hi:
            j = i + 1
            while j < hi and common[j] > depth:
                j += 1
            deep = min(min(common[i + 1 : j], default=sizes[i]), sizes[i])
            child = Node(sets[order[i]][depth:deep], deep, i, j, ordered)
            node.children.append(child)
            todo.append((child, i, j, deep))
            i = j
    return root


#: Grams of an edge before the first look at the bound; each look doubles them.
STEP = 8


class Sets:
    """Some sets, with the places of each gram in them."""

    def __init__(self, sets: list[np.ndarray], top: int) -> None:
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        grams, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        self.top, self.ends, self.flat = top, np.cumsum(self.sizes), of * top + grams
        order = np.argsort(grams, kind="stable")
        self.have, self.first = of[order], np.searchsorted(grams[order], np.arange(top + 1))

    def counted(self, grams: np.ndarray, which: np.ndarray) -> np.ndarray:
        """How many of the grams each of the sets `which` has."""
        a, e = self.first[grams], self.first[grams + 1]
        if 64 * len(which) * len(grams) > int((e - a).sum()) + len(self.sizes):
            return np.bincount(np.concatenate([self.have[i:j] for i, j in zip(a.tolist(), e.tolist())]), minlength=len(self.sizes))[which]
        return member((which[:, None] * self.top + grams).ravel(), self.flat).reshape(len(which), -1).sum(1)

    def rest(self, gram: int, which: np.ndarray) -> np.ndarray:
        """How many grams after this one each has."""
        return self.ends[which] - np.searchsorted(self.flat, which * self.top + gram, side="right")


def tree_join(left: list[int], right: list[int], sets: list[np.ndarray], percent: int, within: bool) -> Iterator[tuple[np.ndarray, int]]:
    """All links between different sets of left and right: (those of left, the one of right that they link with).

    within: left and right are the same, and each link comes once.
    """
    if not right or not left:
        return
    order = sorted(right, key=lambda i: sets[i].astype(">i8").tobytes())
    own, numbers = Sets([sets[i] for i in left], 1 + max(int(s[-1]) for s in sets)), np.array(left)
    smallest, largest = -(-own.sizes * percent // 100), own.sizes * 100 // percent
    # each link once: a set meets those that come after it in the tree
    at = {y: i for i, y in enumerate(order)}
    place = np.array([at[x] for x in left]) if within else np.full(len(left), -1)
    stack = [(prefix_tree(sets, order), np.arange(len(left)), np.zeros(len(left), dtype=np.int64))]
    while stack:
        node, which, overlap = stack.pop()
        fits = (smallest[which] <= node.most) & (largest[which] >= node.least) & (place[which] < node.hi - 1)
        which, overlap = which[fits], overlap[fits]
        # overlap that the smallest fitting set from here on needs at least
        needed = -(-percent * (own.sizes[which] + np.maximum(node.least, smallest[which])) // (100 + percent))
        k, step = 0, STEP
        while k < len(node.grams) and len(which):
            part = node.grams[k : k + step]
            k, step = k + len(part), 2 * step
            overlap = overlap + own.counted(part, which)
            can = overlap + np.minimum(own.rest(int(part[-1]), which), node.most - node.depth + len(node.grams) - k) >= needed
            which, overlap, needed = which[can], overlap[can], needed[can]
        if not len(which):
            continue
        for y in node.sets:
            found = which[(100 * overlap >= percent * (own.sizes[which] + len(sets[y]) - overlap)) & (place[which] < at[y]) & (numbers[which] != y)]
            if len(found):
                yield numbers[found], y
        stack += [(child, which, overlap) for child in node.children]


class Links:
    """How many rows each set links with, and links that connect all that are connected.  ids: the sets' documents."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows, self.links = ids, rows, np.zeros(len(ids), dtype=np.int64)
        self.label, self.edges = np.arange(len(ids)), []

    def add(self, left: np.ndarray, right: int) -> None:
        """The sets left link with the set right."""
        self.links[left] += self.rows[right]
        self.links[right] += self.rows[left].sum()
        apart = left[self.label[left] != self.label[right]]
        for x in apart[np.unique(self.label[apart], return_index=True)[1]].tolist():
            self.edges.append((x, right))
            self.label[self.label == self.label[x]] = self.label[right]

    def table(self, digest: np.ndarray) -> pa.Table:
        """Edges (a, b), and the number of links n of the sets with digests (d0, d1)."""
        a, b = (self.ids[np.array([e[i] for e in self.edges], dtype=np.int64)].tolist() for i in (0, 1))
        some = np.flatnonzero(self.links)
        none, less = [None] * len(some), [None] * len(a)
        cols = {"a": a + none, "b": b + none, "d0": less + digest[some, 0].tolist(), "d1": less + digest[some, 1].tolist(), "n": less + self.links[some].tolist()}
        return pa.table({c: pa.array(x, pa.int64()) for c, x in cols.items()})


#: Parts of the rows of one set or group, where something is joined to them.
SALTS = 32

LINKS = "a long, b long, d0 long, d1 long, n long"
SETS = "doc_id long, n_shingles long, rows long, lead long, d0 long, d1 long, component long, p int, q int, block int, grams binary"


def joined(docs: DataFrame, n: int = 3, percent: int = 90, *, chunk_bytes: int = 2 << 20, block_docs: int = 48, hot_grams: int = 200_000, hot_docs: int = 32) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, rows, lead, d0, d1) of docs(doc_id, text): how many rows have the set, their smallest doc_id (null
    without a set or doc_id), and its digest; and links as a written table: (a, b) of documents that connect all that links
    connect, and (d0, d1, n) with the number of rows of other sets that a set links with, from one pair of blocks each."""
    spent: list[str] = []  # tables that nothing reads once the sets are written
    with collecting(spent):
        chunks = chunked(docs, chunk_bytes)
        n_buckets = buckets_for(chunks.count(), 4)
        seen = look(chunks, n, n_buckets)
    hot = chunks.sparkSession.sparkContext.broadcast(frequent_grams(seen, hot_docs, hot_grams))  # 16 bytes each
    with_classes = returned(chunks, (classes(seen), "classes"))

    def parts(chunk: Chunk, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Parts of the sets that stand for their classes, by hash: (hash, digest of the set, cut, need)."""
        sets = ChunkSets(chunk, n, row["classes"])
        leads = np.zeros(len(sets.sizes), dtype=bool)
        leads[sets.leads] = True
        grams = sets.grams[np.repeat(leads, sets.sizes)]
        keys, of, cut, need = needed_parts(grams, ~member(grams, hot.value[0]), sets.sizes[sets.leads], percent)
        order = np.argsort(keys, kind="stable")
        return keys[order], sets.digest[sets.leads[of[order]], 0], cut[order], need[order]

    def ask(chunk: Chunk, row: dict) -> Iterator[dict]:
        keys = parts(chunk, row)[0]
        edges, short = bucket_edges(keys, n_buckets), keys.astype("<u4")  # a bucket has the upper half of its keys in common, but for few bits
        for b in np.flatnonzero(np.diff(edges)):
            yield {"bucket": int(b), "chunk": chunk.id, "keys": short[edges[b] : edges[b + 1]].tobytes()}

    def tell(t: pa.Table) -> pa.Table:
        """For each chunk the bucket, and a bit for each of its parts there: whether there is another one like it."""
        keys = [as_array(x, "<u4") for x in t["keys"].to_pylist()]
        ends = np.cumsum([len(x) for x in keys])
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        first = class_starts(keys[order])
        count = np.diff(np.r_[first, len(keys)])
        shared = np.empty(len(keys), dtype=bool)
        shared[order] = np.repeat(count > 1, count)
        head = np.array(t["bucket"][0].as_py(), dtype="<i4").tobytes()
        found = [(c, x) for c, x in zip(t["chunk"].to_pylist(), np.split(shared, ends[:-1])) if x.any()]
        return pa.table({"chunk": pa.array([c for c, _ in found], pa.int64()), "shared": pa.array([head + np.packbits(x).tobytes() for _, x in found], pa.binary())})

    with collecting(spent):
        asked = over(with_classes, ask, "bucket int, chunk long, keys binary")
        told = written(asked.groupBy("bucket").applyInArrow(tell, "chunk long, shared binary"), "shared")

    def send(chunk: Chunk, row: dict) -> Iterator[dict]:
        keys, nodes, cut, need = parts(chunk, row)
        edges, shared = bucket_edges(keys, n_buckets), np.zeros(len(keys), dtype=bool)
        for blob in row["shared"] or ():
            b = int(as_array(blob[:4], "<i4")[0])
            shared[edges[b] : edges[b + 1]] = np.unpackbits(as_array(blob[4:], "u1"), count=int(edges[b + 1] - edges[b]))
        use = enough(shared, cut, need)
        keys, nodes = keys[use], nodes[use]
        bucket = bucket_of(keys, n_buckets)
        edges = class_starts(bucket)
        for a, e in zip(edges, np.r_[edges[1:], len(keys)]):
            yield {"bucket": int(bucket[a]), "chunk": chunk.id, "keys": keys[a:e].tobytes(), "nodes": nodes[a:e].tobytes()}

    def meet(t: pa.Table) -> pa.Table:
        """For each chunk its sets that agree with others in a part, each with the smallest of them; digests stand for sets."""
        keys, nodes = [as_array(x, "<u8") for x in t["keys"].to_pylist()], [as_array(x, "<i8") for x in t["nodes"].to_pylist()]
        chunk = np.repeat(t["chunk"].to_numpy(), [len(x) for x in keys])
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((nodes, keys))
        keys, nodes, chunk = keys[order], nodes[order], chunk[order]
        first = class_starts(keys)
        count = np.diff(np.r_[first, len(keys)])
        several = np.repeat(np.maximum.reduceat(nodes, first) != nodes[first], count) if len(first) else np.zeros(0, dtype=bool)
        chunk, a, b = different_rows(chunk[several], np.repeat(nodes[first], count)[several], nodes[several])
        edges = class_starts(chunk)
        blobs = [zip_(np.column_stack([a[i:e], b[i:e]]).tobytes()) for i, e in zip(edges, np.r_[edges[1:], len(chunk)])]
        return pa.table({"chunk": pa.array(chunk[edges], pa.int64()), "pairs": pa.array(blobs, pa.binary())})

    sent = over(returned(with_classes, (told, "shared")), send, "bucket int, chunk long, keys binary, nodes binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "chunk long, pairs binary")

    def different(t: pa.Table) -> pa.Table:
        """A chunk's pairs from all buckets, once each."""
        pairs = np.concatenate([as_array(unzip(x), "<i8").reshape(-1, 2) for x in t["pairs"].to_pylist()])
        a, b = different_rows(pairs[:, 0], pairs[:, 1])
        return pa.table({"chunk": pa.array(np.full(len(a), t["chunk"][0].as_py()), pa.int64()), "a": pa.array(a), "b": pa.array(b)})

    with collecting(spent):
        agree = written(met.groupBy("chunk").applyInArrow(different, "chunk long, a long, b long"), "agreeing")
        groups = components(agree.select("a", "b"))
    # blocks by hash, so that none needs to be counted; every pair of blocks is a task.  Blocks grow with the root of their
    # group, or else the sets of a large one would be sent too often
    sizes = groups.groupBy("component").agg(F.count("*").alias("_sets")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = groups.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(sizes, ["component", "_salt"]).drop("_salt")
    dealt = dealt.withColumn("_blocks", F.ceil(F.col("_sets") / F.greatest(F.lit(block_docs), 2 * F.sqrt("_sets"))).cast("int")).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(F.least(o, F.col("_block")).alias("p"), F.greatest(o, F.col("_block")).alias("q")))
    dealt = dealt.select(F.col("node").alias("b"), F.struct("node", "component", "_block", pairs.alias("pairs")).alias("deal"))
    deals = agree.select("chunk", "b").distinct().join(dealt, "b").select("chunk", "deal")

    def give(chunk: Chunk, row: dict) -> Iterator[dict]:
        """A row of each document, and the sets of those that agree with others, a row for each task that they go to."""
        sets, ids = ChunkSets(chunk, n, row["classes"]), chunk.ids()
        digest = sets.digest.view(np.int64)
        deals = {d["node"]: d for d in row["deal"] or ()}
        none = {"component": None, "p": None, "q": None, "block": None, "grams": None}
        known = lambda i: {"rows": int(sets.n[i]), "lead": int(sets.lead[i]), "d0": int(digest[i, 0]), "d1": int(digest[i, 1])}
        for i, doc_id in enumerate(ids):
            yield none | {"doc_id": doc_id, "n_shingles": int(sets.sizes[i])} | (known(i) if sets.joins[i] else {"rows": None, "lead": None, "d0": None, "d1": None})
        for i in sets.leads.tolist():
            if d := deals.get(int(digest[i, 0])):
                grams = sets.of(i).tobytes()
                for pair in d["pairs"]:
                    yield known(i) | {"doc_id": ids[i], "n_shingles": None, "component": d["component"], "p": pair["p"], "q": pair["q"], "block": d["_block"], "grams": grams}

    sets = written(over(returned(with_classes, (deals, "deal")), give, SETS), "sets")
    remove(chunks.sparkSession, spent)

    def join(t: pa.Table) -> pa.Table:
        found = [as_array(x, "<u8") for x in t["grams"].to_pylist()]
        p, q, block = t["p"][0].as_py(), t["q"][0].as_py(), t["block"].to_numpy()
        links = Links(t["doc_id"].to_numpy(), t["rows"].to_numpy())
        left, right = (np.flatnonzero(block == x).tolist() for x in (p, q))
        for found_, y in tree_join(left, right, in_order(found, *hot.value), percent, p == q):
            links.add(found_, y)
        return links.table(np.column_stack([t["d0"].to_numpy(), t["d1"].to_numpy()]))

    links = sets.where("grams is not null").select("component", "p", "q", "block", "doc_id", "rows", "d0", "d1", "grams").groupBy("component", "p", "q").applyInArrow(join, LINKS)
    return sets.where("grams is null").select("doc_id", "n_shingles", "rows", "lead", "d0", "d1"), written(links, "links")


def linked(docs: DataFrame, n: int = 3, percent: int = 90, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) of docs(doc_id, text): all documents that links connect have the smallest
    doc_id among them as component_id."""
    return with_components(*joined(docs, n, percent, **options)).select("doc_id", "n_shingles", "component_id")


def with_components(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows with component_id."""
    same = rows.where("lead <> doc_id").select(F.col("doc_id").alias("a"), F.col("lead").alias("b"))
    found = components(links.where("b is not null").select("a", "b").unionByName(same)).withColumnRenamed("node", "doc_id")
    return rows.join(found, "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id")).drop("component")


def counted_links(docs: DataFrame, n: int = 3, percent: int = 90, **options) -> DataFrame:
    """linked() with n_links: with how many other rows each one links."""
    rows, links = joined(docs, n, percent, **options)
    counts = links.where("n is not null").groupBy("d0", "d1").agg(F.sum("n").alias("_links"))
    counts = counts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = with_components(rows, links).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(counts, ["d0", "d1", "_salt"], "left")
    n_links = F.coalesce("_links", F.lit(0).cast("long")) + F.coalesce(F.col("rows") - 1, F.lit(0).cast("long"))
    return found.select("doc_id", "n_shingles", "component_id", n_links.alias("n_links"))


def first_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, **options) -> DataFrame:
    """docs without those that are linked, directly or through others, to one with a smaller doc_id; of rows that are equal
    in doc_id and text one stays.  Rows without doc_id stay."""
    rows = with_components(*joined(docs.select("doc_id", "text"), n, percent, **options)).where("doc_id is not null")
    found = rows.groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("n")).where("first < doc_id or n > 1")
    found = written(found, "later")
    kept = docs.join(found.where("first < doc_id").select("doc_id"), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
    again = found.where("first >= doc_id").select("doc_id")
    if again.isEmpty():
        return kept
    # ids that several rows have: only of these are texts compared
    several = kept.join(again, "doc_id", "left_semi").select(*[f"`{c}`" for c in docs.columns]).dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns]).unionByName(several)


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Distinct 3-word shingles, similarity of 0.9 or more."""
    return counted_links(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 90)
