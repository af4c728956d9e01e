"""SentencePiece models run by the tokenizers library: encoding and decoding.

The model's protobuf is read field by field; normaliser, whitespace marker, pieces with scores and byte fallback are set
up anew for the tokenizers library (unigram models by score, BPE models by merges in order of score).  Where no piece
has a marker after another character, no piece can reach over the start of a marked word, so a text is cut there and
each different word of a batch is encoded once, in one multithreaded call.  All ids are the tokenizers library's.  To verify
parity the original library encodes each word, too; n_differing is how many of a row's words it encodes otherwise.

Null texts have null ids; empty texts have none.  Decoding ids gives the normalised text back.  An empty table gives no
rows; other columns stay, but for those called as the result's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from struct import pack, unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ddl, table

MARK = "▁"
#: Fixed values of the model format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Words of which a worker keeps the ids; beyond that it starts anew.
KNOWN_WORDS = 600_000
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            byte = data[i]
            i += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while i < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind)
        if n is None:
            n = varint()
        yield key >> 3, data[i : i + n]
        i += n


@dataclass
class Model:
    """What a model file says, with the format's defaults."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        m = cls()
        for number, value in fields(data):
            if number == 1:
                f = dict(fields(value))
                m.pieces.append((f.get(1, b"").decode(), unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                f = dict(fields(value))
                m.kind, m.byte_fallback = f.get(3, UNIGRAM), bool(f.get(35, 0))
            elif number == 3:
                f = dict(fields(value))
                m.charsmap, m.add_prefix, m.squeeze, m.escape = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        return m

    @property
    def cuttable(self) -> bool:
        """No piece has a marker after another character."""
        return self.escape and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED, UNUSED))


def normalizer(m: Model):
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if m.add_prefix:
        steps.append(normalizers.Prepend(MARK if m.escape else " "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def rebuilt(m: Model):
    """The model as a Tokenizer, without normaliser: its input is normalised."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    unknown = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), 0)
    if m.kind == UNIGRAM:
        # control pieces must not be found in a text
        vocab = [(p if kind not in (CONTROL, UNKNOWN, BYTE) or kind == BYTE else f"\0{i}", score) for i, (p, score, kind) in enumerate(m.pieces)]
        t = Tokenizer(models.Unigram(vocab, unknown, m.byte_fallback))
    elif m.kind == BPE:
        ids = {p: i for i, (p, _, kind) in enumerate(m.pieces)}
        known = {p: score for p, score, kind in m.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
        merges = []
        for p, score, kind in m.pieces:
            if kind in (NORMAL, UNUSED) and len(p) > 1:
                merges += [(-score, ids[p], p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in known and p[i:] in known]
        merges = [(a, b) for _, _, a, b in sorted(merges, key=lambda x: x[:2])]
        t = Tokenizer(models.BPE(ids, merges, unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback))
    else:
        raise ValueError(f"no model of kind {m.kind}")
    t.add_tokens([AddedToken(p, normalized=False) for p, _, kind in m.pieces if kind == USER_DEFINED])
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * m.add_prefix)
    return t


class Codec:
    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.model = Model.parse(data)
        self.normalizer, self.tokenizer = normalizer(self.model), rebuilt(self.model)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if self.model.cuttable else None
        self.known: dict[str | tuple[str], bytes] = {}  # word: its ids as int32
        self.differing: set[str | tuple[str]] = set()  # words that the libraries encode differently
        self.alone = [self.original.piece_to_id(MARK)]
        self.bytes_of = [self._bytes_of(p, kind) for p, _, kind in self.model.pieces]

    def _bytes_of(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return piece.replace(MARK, " ").encode()

    def normalized(self, text: str) -> str:
        return self.normalizer.normalize_str(text)

    def words(self, text: str) -> list[str | tuple[str]]:
        """What can be encoded by itself; a string without marker stands for a word with a single one before
        it, a tuple for a word without."""
        m = self.model
        if self.cut and m.add_prefix and not m.squeeze and not m.charsmap:
            if not text:
                return []
            if MARK not in text and "" not in (words := text.split(" ")):
                return words
            normal = MARK + text.replace(" ", MARK)
        else:
            normal = self.normalized(text)
        found = self.cut.findall(normal) if self.cut else [normal] if normal else []
        return [w[1:] if w[0] == MARK != w[1:2] and len(w) > 1 else w if w[0] == MARK else (w,) for w in found]

    def learn(self, words: list[str | tuple[str]]) -> None:
        """Encodes words, and notes those on which the two libraries differ."""
        m = self.model
        whole = [w[0] if isinstance(w, tuple) else w if w[0] == MARK else MARK + w for w in words]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
        # the original library puts its own marker before a text
        again = self.original.encode([w.removeprefix(MARK).replace(MARK, " ") if m.add_prefix else w.replace(MARK, " ") for w in whole], num_threads=1) if whole else []
        for word, text, a, b in zip(words, whole, ids, again):
            if text == MARK and m.add_prefix:
                b = self.alone
            if a != b and (not m.add_prefix or text[0] == MARK):
                self.differing.add(word)
            self.known[word] = pack(f"<{len(a)}i", *a)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """Ids of each text as int32, and on how many of its words the two libraries differ."""
        cut = [self.words(x) for x in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
            self.differing.clear()
        self.learn(list({w for text in cut for w in text if w not in self.known}))
        of, odd = self.known.__getitem__, self.differing
        return [b"".join(map(of, text)) for text in cut], [sum(w in odd for w in text) if odd else 0 for text in cut]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of ids, by the bytes of their pieces; where these are no UTF-8, the library's decoder says what to put."""
        out: list[str | None] = []
        for x in ids:
            try:
                text = b"".join(map(self.bytes_of.__getitem__, x)).decode()
                out.append(text[1:] if self.model.add_prefix and text[:1] == " " else text)
            except UnicodeDecodeError:
                out.append(None)
        broken = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(broken, self.tokenizer.decode_batch([ids[i] for i in broken], skip_special_tokens=False)):
            out[i] = x
        return out


@lru_cache(maxsize=4)
def codec(data: bytes) -> Codec:
    return Codec(data)


def model_bytes(path: str) -> bytes:
    """The model file, read by the driver; it travels with the tasks (models have some 100 kB to 5 MB)."""
    with open(path, "rb") as f:
        return f.read()


def slices(texts: list[str | None], chars: int = 1 << 20) -> Iterator[slice]:
    """Runs of texts of about so many characters."""
    first = size = 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= chars:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def encode(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """df with ids (array of int) and n_differing (int: words of the row on which the libraries differ)."""
    data, sc = model_bytes(model_path), df.sparkSession.sparkContext
    sent = sc.broadcast(data)  # bounded by the size of the file

    def run(batches):
        c = codec(sent.value)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for s in slices(texts):
                part = texts[s]
                ids, differ = c.encode([x or "" for x in part])
                out = batch.slice(s.start, s.stop - s.start)
                ends = np.cumsum([0] + [len(i) // 4 for i in ids])
                ends = pa.array(ends, pa.int32(), mask=np.array([x is None for x in part] + [False]))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([*out.columns, ids, pa.array(differ, pa.int32())], [*out.schema.names, "ids", "n_differing"])

    kept = df.drop("ids", "n_differing")
    return kept.mapInArrow(run, f"{ddl(kept.schema)}, ids array<int>, n_differing int")


def decode(df: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """df with decoded (string; null for null ids)."""
    sent = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))

    def run(batches):
        c = codec(sent.value)
        for batch in batches:
            ids = batch.column(ids_col).to_pylist()
            out = c.decode([x or [] for x in ids])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if i is None else x for i, x in zip(ids, out)], pa.string())], [*batch.schema.names, "decoded"])

    kept = df.drop("decoded")
    return kept.mapInArrow(run, f"{ddl(kept.schema)}, decoded string")


def op7_sentencepiece(spark, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    """Ids of all documents and their decoding, as digests: (doc_id, n_chars, n_tokens, ids_sha256 of the ids as
    little-endian int32, decoded_sha256, same_text, n_differing).  same_text: decoding gave the text back."""
    sent = spark.sparkContext.broadcast(model_bytes(model_path))

    def run(batches):
        c = codec(sent.value)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for s in slices(texts):
                part = texts[s]
                ids, differ = c.encode([x or "" for x in part])
                decoded = c.decode([np.frombuffer(i, dtype="<i4").tolist() for i in ids])
                none = [x is None for x in part]
                hexes = lambda xs: pa.array([None if x is None else sha256(y).hexdigest() for x, y in zip(part, xs)])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(s.start, s.stop - s.start),
                        pa.array([None if x is None else len(x) for x in part], pa.int64()),
                        pa.array(np.array([len(i) // 4 for i in ids], dtype=np.int64), mask=np.array(none)),
                        hexes(ids),
                        hexes([x.encode() for x in decoded]),
                        pa.array([None if x is None else x == y for x, y in zip(part, decoded)]),
                        pa.array(differ, pa.int32()),
                    ],
                    ["doc_id", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256", "same_text", "n_differing"],
                )

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean, n_differing int")
