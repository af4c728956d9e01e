"""Quality classifier from weak labels.

Heuristic labellers each look at one statistic of a text and vote bad, good or not at all.  No truth is known: expectation-
maximisation over the counts of vote patterns, of all documents, estimates the share of bad documents and how each labeller
votes on good and on bad ones, and so the probability of each pattern's documents to be bad.  These posterior labels train
a linear scorer of hashed features (word shapes, pairs of shapes, repeated words) by logistic regression, on a bounded sample
(sample_docs documents, by hash of their id); the scorer then judges all documents.

There are at most 3 ** 9 patterns, which are all that the driver gets besides the sample.  A null text, and one without
words, has no features: its quality is 0 and it is rejected.  Repeated rows get equal results; a null id is judged as any.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import numbered, word_hashes, word_spans
from .common import mix, table, written

#: (statistic, share up to which it votes good, share from which it votes bad)
LABELLERS = (
    ("upper", 0.15, 0.30),  # letters that are capitals
    ("exclaimed", 0.05, 0.20),  # words that end in !
    ("symbols", 0.02, 0.06),  # characters that are symbols
    ("marked", 0.05, 0.20),  # words that have a symbol
    ("doubled", 0.04, 0.12),  # words that equal the word before
    ("again", 0.60, 0.80),  # words that the text had before
    ("bars", 0.02, 0.08),  # words that are a bar
    ("bare", 0.97, 0.995),  # words without a mark of punctuation after them
    ("shouted", 0.10, 0.25),  # words of two letters or more, all capitals
)
BAD, NONE, GOOD = 0, 1, 2
BITS = 16
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[48:58], SHAPE[128:] = 65, 97, 48, 97


def spaced_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    blobs = [(x or "").encode() for x in texts]
    sizes = np.array([len(b) + 1 for b in blobs], dtype=np.int64)
    return np.frombuffer(b" ".join(blobs) + b" ", dtype=np.uint8), np.cumsum(sizes) - sizes


class Words:
    """Words of some texts and what labellers and features need of them."""

    def __init__(self, texts: list[str | None]) -> None:
        self.text, begins = spaced_texts(texts)
        self.starts, self.ends = word_spans(self.text)
        self.n_docs = len(texts)
        self.doc = np.searchsorted(begins, self.starts, side="right") - 1
        self.ids, different = numbered(self.text, self.starts, self.ends)
        self.hashes = word_hashes(different)[self.ids]
        self.n = np.bincount(self.doc, minlength=self.n_docs)
        self.same_as_last = np.r_[False, (self.ids[1:] == self.ids[:-1]) & (self.doc[1:] == self.doc[:-1])] if len(self.doc) else np.zeros(0, dtype=bool)

    def counts(self, of: np.ndarray) -> np.ndarray:
        """For each word how many of its bytes are in the class."""
        total = np.r_[0, np.cumsum(of)]
        return total[self.ends] - total[self.starts]

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=flags, minlength=self.n_docs)


def votes(w: Words) -> np.ndarray:
    """Vote pattern of each text, a number in base 3."""
    length = w.ends - w.starts
    upper, lower = (w.text >= 65) & (w.text <= 90), (w.text >= 97) & (w.text <= 122) | (w.text >= 128)
    n_upper, n_lower, n_symbol = w.counts(upper), w.counts(lower), w.counts(SYMBOL[w.text])
    last = w.text[w.ends - 1]
    order = np.lexsort((w.ids, w.doc))
    again = np.r_[False, (w.ids[order][1:] == w.ids[order][:-1]) & (w.doc[order][1:] == w.doc[order][:-1])] if len(order) else np.zeros(0, dtype=bool)
    n = np.maximum(w.n, 1)
    letters = np.maximum(w.per_doc(n_upper + n_lower), 1)
    long_enough = np.minimum(1, w.n / 60)  # few words hardly repeat, and may have no punctuation
    stats = {
        "upper": w.per_doc(n_upper) / letters,
        "exclaimed": w.per_doc(last == 33) / n,
        "symbols": w.per_doc(n_symbol) / np.maximum(w.per_doc(length), 1),
        "marked": w.per_doc(n_symbol > 0) / n,
        "doubled": w.per_doc(w.same_as_last) / n,
        "again": np.bincount(w.doc[order], weights=again, minlength=w.n_docs) / n / np.maximum(1, np.log10(n + 1) / 2.5) * long_enough,
        "bars": w.per_doc((length == 1) & (last == 124)) / n,
        "bare": 1 - w.per_doc(np.isin(last, [33, 44, 46, 58, 59, 63])) / n * 1.0,
        "shouted": w.per_doc((n_upper > 1) & (n_lower == 0)) / n,
    }
    stats["bare"] = stats["bare"] * long_enough
    out = np.zeros(w.n_docs, dtype=np.int64)
    for name, good, bad in LABELLERS:
        out = out * 3 + np.where(stats[name] >= bad, BAD, np.where(stats[name] <= good, GOOD, NONE))
    return out


def features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of all features; a text's values are roots of its features' shares of its words."""
    shape = SHAPE[w.text]
    inside = np.zeros(len(shape) + 1, dtype=np.int64)
    new = np.r_[True, shape[1:] != shape[:-1]]
    new[w.starts] = True
    inside[1:] = np.cumsum(new)
    ids, different = numbered(shape[new], inside[w.starts], inside[w.ends])
    shapes = word_hashes(different)[ids]
    pair = mix(shapes[1:] * np.uint64(3) + shapes[:-1]) if len(shapes) else shapes
    pair_doc = w.doc[1:][w.doc[1:] == w.doc[:-1]]
    pair = pair[w.doc[1:] == w.doc[:-1]]
    repeat = np.flatnonzero(w.same_as_last)
    key = np.concatenate([shapes, pair, np.full(len(repeat), 77, dtype=np.uint64)]) >> np.uint64(64 - BITS)
    key[len(shapes) + len(pair) :] = 0
    doc = np.concatenate([w.doc, pair_doc, w.doc[repeat]])
    both, count = np.unique(doc.astype(np.int64) << BITS | key.astype(np.int64), return_counts=True)
    doc = both >> BITS
    return doc, (both & ((1 << BITS) - 1)).astype(np.int32), np.sqrt(count / w.n[doc])


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of bad documents, table[labeller, bad or good, vote], and posterior of bad for each pattern."""
    m = len(LABELLERS)
    digits = patterns[:, None] // 3 ** np.arange(m - 1, -1, -1) % 3
    share, table_ = 0.15, np.tile([[0.4, 0.2, 0.4], [0.03, 0.12, 0.85]], (m, 1, 1))
    for _ in range(rounds):
        like = np.log([share, 1 - share])[None, :] + sum(np.log(table_[j][:, digits[:, j]]).T for j in range(m))
        bad = 1 / (1 + np.exp(np.clip(like[:, 1] - like[:, 0], -500, 500)))
        weight = np.column_stack([bad, 1 - bad]) * counts[:, None]
        new = np.array([[np.bincount(digits[:, j], weights=weight[:, y], minlength=3) for y in (0, 1)] for j in range(m)]) + 0.1
        new /= new.sum(2, keepdims=True)
        moved, share, table_ = np.abs(new - table_).max(), float(np.clip(weight[:, 0].sum() / max(counts.sum(), 1), 1e-4, 0.6)), new
        if moved < 1e-7:
            break
    return share, table_, bad


def fit(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, bad: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic regression (the last is the constant) on soft labels, by AdaGrad over all of the sample."""
    w, g2 = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(doc, weights=w[feature] * value, minlength=len(bad)) + w[-1]
        error = (1 / (1 + np.exp(-z)) - bad) / max(len(bad), 1)
        grad = np.r_[np.bincount(feature, weights=error[doc] * value, minlength=1 << BITS), error.sum()] + np.r_[1e-6 * w[:-1], 0]
        g2 += grad * grad
        w -= 0.3 * grad / np.sqrt(g2)
    return w


def trained(docs: DataFrame, sample_docs: int, sample_bytes: int = 256 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of bad for each vote pattern, and the scorer's weights, of docs(doc_id, text).

    The sample has about sample_docs documents, and at most sample_bytes of features: fewer documents where these are long.
    """
    n = docs.count()
    share = min(1.0, sample_docs / max(n, 1))
    hashed = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                w = Words(part.column("text").to_pylist())
                chosen = part.column("chosen").to_numpy(zero_copy_only=False).astype(bool) & (w.n > 0)
                doc, feature, value = features(w) if chosen.any() else (np.zeros(0, np.int64),) * 3
                edges = np.searchsorted(doc, np.arange(w.n_docs + 1))
                f = [feature[a:e].astype("<i4").tobytes() if c else None for a, e, c in zip(edges, edges[1:], chosen)]
                v = [value[a:e].astype("<f4").tobytes() if c else None for a, e, c in zip(edges, edges[1:], chosen)]
                pattern = pa.array(votes(w), pa.int32(), mask=w.n == 0)
                yield pa.RecordBatch.from_arrays([pattern, pa.array(f, pa.binary()), pa.array(v, pa.binary())], ["pattern", "features", "weights"])

    seen = written(docs.withColumn("chosen", F.coalesce(hashed, F.lit(False))).mapInArrow(vote, "pattern int, features binary, weights binary"), "votes")
    counts = seen.where("pattern is not null").groupBy("pattern").count().toPandas()  # at most 3 ** 9 rows
    patterns = counts["pattern"].to_numpy(dtype=np.int64)
    _, _, bad = estimate(patterns, counts["count"].to_numpy(dtype=float)) if len(patterns) else (0, 0, np.zeros(0))
    of = np.zeros(3 ** len(LABELLERS))
    of[patterns] = bad
    # one document has at most 12 << BITS bytes of features, and mostly some kilobytes
    mass = seen.where("features is not null").agg(F.count("*").alias("n"), F.sum(F.length("features") + F.length("weights")).alias("b")).first()
    most = int(min(2 * sample_docs, mass["n"] * min(1.0, sample_bytes / max(mass["b"] or 1, 1))))
    sample = seen.where("features is not null").limit(max(1, most)).toPandas()
    sizes = [len(x) // 4 for x in sample["features"]]
    doc = np.repeat(np.arange(len(sample)), sizes)
    feature = np.frombuffer(b"".join(sample["features"]), dtype="<i4")
    value = np.frombuffer(b"".join(sample["weights"]), dtype="<f4").astype(float)
    return of, fit(doc, feature, value, of[sample["pattern"].to_numpy(dtype=np.int64)])


def quality_of(w: Words, weights: np.ndarray) -> np.ndarray:
    """Quality by the scorer, 0 to 1; 0 without words."""
    doc, feature, value = features(w)
    z = np.bincount(doc, weights=weights[feature] * value, minlength=w.n_docs) + weights[-1]
    return np.where(w.n > 0, 1 / (1 + np.exp(np.clip(z, -500, 500))), 0.0)


def judged(docs: DataFrame, *, sample_docs: int = 6000, threshold: float = 0.5) -> DataFrame:
    """(doc_id, pattern, posterior, quality, keep) of docs(doc_id, text): posterior by the votes, quality by the scorer,
    both 0 (bad) to 1 (good); keep where quality is at least the threshold."""
    docs = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, sample_docs))  # 2 ** 16 + 3 ** 9 numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, weights = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                w = Words(part.column("text").to_pylist())
                quality, pattern, none = quality_of(w, weights), votes(w), w.n == 0
                posterior = np.where(none, 0.0, 1 - of[pattern])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pattern, pa.int32(), mask=none), pa.array(posterior), pa.array(quality), pa.array(quality >= threshold)], ["doc_id", "pattern", "posterior", "quality", "keep"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(score, f"doc_id {kind}, pattern int, posterior double, quality double, keep boolean")


def keep_good(docs: DataFrame, *, sample_docs: int = 6000, threshold: float = 0.5) -> DataFrame:
    """docs, all columns, without those that the classifier rejects; no row is moved."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs.select("doc_id", "text"), sample_docs)[1])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield part.filter(pa.array(quality_of(Words(part.column("text").to_pylist()), sent.value) >= threshold))

    return docs.mapInArrow(choose, docs.schema)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents judged."""
    return judged(table(spark, sf_dir, "documents"))
