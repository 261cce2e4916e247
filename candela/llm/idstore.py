"""Token ids with Elias-Fano document boundaries (numbered operator 3).

Documents are dealt into ranges of ascending doc_id and encoded in that order. Each task cuts its range into segments of
about SEGMENT_IDS ids and writes one frame per segment; the frames are rows of a Parquet table (part, seq, n_docs, n_ids,
frame), so Spark's committer makes the write whole and any store that Spark reaches can hold it.

Frame (little-endian): magic ``CEF1``, id width in bytes (2 if the vocabulary fits, else 4), number of documents, of documents with a
null id (they come first), of ids, least doc_id; then three blocks with their lengths: Elias-Fano code of doc_id minus the
least, Elias-Fano code of the documents' end offsets, and the concatenated ids.

Elias-Fano code of n ascending numbers below u: the low floor(log2(u/n)) bits of each, packed, and the high parts as a bit string
with a one per number; every 64th one's place is kept as 32 bits, so ``select`` scans a few bytes. That is about
2 + log2(u/n) bits a document instead of 64.

Defined results: null and empty texts are the end id alone; rows with equal ids stand in the order of their texts; an empty
table writes no frame and reads back as no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.llm import textkit as K
from candela.session import scratch_path

END_ID = 1
SEGMENT_IDS = 1 << 20
SAMPLE = 64
_HEAD = struct.Struct("<4sBIIQq")
_EF = struct.Struct("<IQB")
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class EliasFano:
    """A coded ascending sequence: ``self[i]`` by select, ``all()`` at once."""

    def __init__(self, blob: bytes):
        self.n, self.upper_bits, self.width = _EF.unpack_from(blob)
        at = _EF.size
        low = (self.n * self.width + 7) // 8
        up = (self.upper_bits + 7) // 8
        self.low = np.frombuffer(blob, np.uint8, low, at)
        self.upper = np.frombuffer(blob, np.uint8, up, at + low)
        self.samples = np.frombuffer(blob, "<u4", (self.n + SAMPLE - 1) // SAMPLE, at + low + up)

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        v = np.asarray(values, dtype=np.int64)
        n = len(v)
        bound = int(v[-1]) + 1 if n else 1
        width = max(0, (bound // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(width)) & 1).astype(np.uint8)
        place = (v >> width) + np.arange(n)
        upper_bits = int(place[-1]) + 1 if n else 0
        up = np.zeros(upper_bits, np.uint8)
        up[place] = 1
        return (_EF.pack(n, upper_bits, width) + np.packbits(bits.ravel(), bitorder="little").tobytes()
                + np.packbits(up, bitorder="little").tobytes() + place[::SAMPLE].astype("<u4").tobytes())

    def _select(self, i: int) -> int:
        """The place of the i-th one."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = place >> 3
        cur = int(self.upper[byte]) & (0xFF << (place & 7)) & 0xFF
        while left >= _ONES[cur]:
            left -= int(_ONES[cur])
            byte += 1
            cur = int(self.upper[byte])
        for _ in range(left):
            cur &= cur - 1
        return byte * 8 + (cur & -cur).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        first = i * self.width
        chunk = int.from_bytes(self.low[first >> 3:((first + self.width + 7) >> 3)].tobytes(), "little") >> (first & 7)
        return (self._select(i) - i) << self.width | chunk & ((1 << self.width) - 1)

    def all(self) -> np.ndarray:
        high = np.flatnonzero(np.unpackbits(self.upper, count=self.upper_bits, bitorder="little")) - np.arange(self.n)
        bits = np.unpackbits(self.low, count=self.n * self.width, bitorder="little").reshape(self.n, self.width).astype(np.int64)
        return (high << self.width) + (bits << np.arange(self.width)).sum(axis=1)


def frame(doc_ids: list, ids: list[bytes], width: int) -> bytes:
    """A segment from doc ids (nulls first, then ascending) and their id bytes."""
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // width for x in ids])
    blocks = [EliasFano.encode(known - least), EliasFano.encode(ends), b"".join(ids)]
    head = _HEAD.pack(b"CEF1", width, len(doc_ids), len(doc_ids) - len(known), int(ends[-1]), least)
    return head + b"".join(struct.pack("<Q", len(b)) + b for b in blocks)


class Segment:
    """A frame read back."""

    def __init__(self, blob: bytes):
        magic, self.width, self.n_docs, self.n_null, self.n_ids, self.least = _HEAD.unpack_from(blob)
        if magic != b"CEF1":
            raise ValueError("not a segment of token ids")
        at, blocks = _HEAD.size, []
        for _ in range(3):
            size, = struct.unpack_from("<Q", blob, at)
            blocks.append(blob[at + 8:at + 8 + size])
            at += 8 + size
        self.docs, self.ends = EliasFano(blocks[0]), EliasFano(blocks[1])
        self.ids = np.frombuffer(blocks[2], "<u2" if self.width == 2 else "<u4")

    def doc_ids(self) -> list:
        return [None] * self.n_null + (self.docs.all() + self.least).tolist()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0:self.ends[i]]


# -- encoding with the tokenizers library -----------------------------------------------------------

#: Words of these characters alone are cut by the tokenizer at letters, single digits and runs of the rest.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
MEMO = 700_000
_LOADED: dict[str, WordEncoder] = {}


def _byte_alphabet() -> dict[int, str]:
    """byte -> the character that stands for it in byte-level vocabularies: printable bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Parts(dict):
    """A word without inner cuts -> id bytes, by the library's BPE model."""

    def __init__(self, model, dtype: str):
        super().__init__()
        self.tokenize, self.dtype, self.alphabet = model.tokenize, dtype, _byte_alphabet()

    def __missing__(self, part: str) -> bytes:
        tokens = self.tokenize(part.encode().decode("latin-1").translate(self.alphabet))
        out = np.array([t.id for t in tokens], dtype=self.dtype).tobytes()
        if len(self) >= MEMO:
            self.clear()
        self[part] = out
        return out


class WordEncoder(dict):
    """Ids of whole texts by the tokenizers library, which sees each distinct word once per worker: the tokenizer drops white
    space and never joins across it, so a text's ids are those of its words in turn. Words of plain characters are
    lower-cased and cut here as the tokenizer does and handed to its model; all others go through the whole tokenizer. The memo
    (word -> id bytes) is bounded."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # strings of added tokens are found in a text before anything else: words that hold one go through the whole tokenizer
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.parts = _Parts(self.tokenizer.model, self.dtype)

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and not (self.added and self.added.search(word)):
            out = b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))
        else:
            out = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        if len(self) >= MEMO:
            self.clear()
        self[word] = out
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))) if t else b"" for t in texts]


def _encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text and write the segments under ``path`` in ascending doc_id order."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), K.text_column(docs, text).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        enc = _encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        part, seq, held, docs_held, ids_held = TaskContext.get().partitionId(), 0, 0, [], []

        def flush():
            blob = frame(docs_held, ids_held, enc.width)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(docs_held)], pa.int64()), pa.array([held], pa.int64()), pa.array([blob], pa.binary())],
                                              names=["part", "seq", "n_docs", "n_ids", "frame"])
        for batch in batches:
            for piece in K.chunks(batch, "text"):
                for d, ids in zip(piece.column("doc_id").to_pylist(), enc.encode(piece.column("text").to_pylist())):
                    docs_held.append(d)
                    ids_held.append(ids + end)
                    held += len(ids) // enc.width + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
                        seq, held, docs_held, ids_held = seq + 1, 0, [], []
        if docs_held:
            yield flush()
    ordered.mapInArrow(run, "part int, seq int, n_docs bigint, n_ids bigint, frame binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    frames = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for part, seq, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "frame"))):
                s = Segment(blob)
                ends = np.fromiter((s.ends[i] for i in range(s.n_docs)), np.int64, s.n_docs)   # by select
                start = np.concatenate(([0], ends[:-1]))
                wide = s.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b].data) for a, b in zip(start, ends)]
                n = s.n_docs
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(s.doc_ids(), pa.int64()), pa.array(start, pa.int64()), pa.array(ends - start, pa.int64()), pa.array(crc, pa.int64())],
                                                 names=["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"])

    rows = frames.select("part", "seq", "frame").mapInArrow(run, "part int, seq int, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = frames.select("part", "seq", "n_ids")
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # offsets of the tasks' parts (one row each, in one small window), then of the segments inside a part
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", earlier(Window.orderBy("part")).alias("part_start"))
    segments = sizes.select("part", "seq", earlier(Window.partitionBy("part").orderBy("seq")).alias("seg_start"))
    base = segments.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seg_start")).alias("base"))
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def stored_ids(docs: DataFrame, tokenizer: str, path: str | None = None, **kw) -> DataFrame:
    """Write ``docs`` under ``path`` (a fresh shared folder by default) and read the files back."""
    path = path or scratch_path(docs.sparkSession, "op3-ids")
    write(docs, path, tokenizer, **kw)
    return read(docs.sparkSession, path)
