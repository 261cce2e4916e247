"""Byte-level BPE by monoid tree reduction (numbered operator 9).

Each match of the split pattern is encoded alone. A piece's encoding is a tree reduction: its halves are encoded
recursively, and two encodings are joined by re-encoding a window of tokens around the seam. The window grows
until its outer tokens fit their untouched neighbours: a token sequence is the BPE encoding of its bytes exactly if every two
adjacent tokens encode to themselves, and all other neighbours come unchanged from valid encodings. So what lies
outside the window provably stays. Pieces are barriers, so a text is the concatenation of its pieces, and decoding
concatenates token bytes up the same tree.

Texts are cut into units (white-space runs and words with their leading space, where the pattern always cuts); a bounded per-worker
memo keeps the ids of short units, so the usual word is encoded once per worker.

Defined results: null and empty texts have no tokens and decode to no bytes; repeated rows are encoded alike; other
columns pass through, those named like an output are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm import textkit as K

#: White space as the tokenizer's pattern means it (Unicode White_Space).
SPACE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The public split pattern with that white space spelled out.
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
LEAF = 24
MEMO, MEMO_LENGTH = 800_000, 48
#: Units that a worker keeps from task to task, the earliest met: the usual words.
KEPT = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """BPE over one rank table; tokens are handled as byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._fits: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, data: bytes) -> list[bytes]:
        """Tokens of ``data`` by merging the pair of least rank, the leftmost first."""
        get = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        if len(parts) > 4 * LEAF:
            return self._merged_long(parts)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_long(self, parts: list) -> list[bytes]:
        get, n = self.ranks.get, len(parts)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, token = heapq.heappop(heap)
            j = nxt[i] if parts[i] is not None else n
            if j >= n or parts[i] + parts[j] != token:
                continue
            parts[i], parts[j] = token, None
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := get(token + parts[nxt[i]])) is not None:
                    heapq.heappush(heap, (r, i, token + parts[nxt[i]]))
            if prv[i] >= 0 and (r := get(parts[prv[i]] + token)) is not None:
                heapq.heappush(heap, (r, prv[i], parts[prv[i]] + token))
        return [p for p in parts if p is not None]

    def fits(self, a: bytes, b: bytes) -> bool:
        """Whether a and b side by side encode to themselves."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) > 200_000:
                self._fits.clear()
            known = self._fits[a, b] = self.merged(a + b) == [a, b]
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the bytes of two encodings."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            window = self.merged(b"".join(left[-i:] + right[:j]))
            left_fits = i == len(left) or self.fits(left[-i - 1], window[0])
            right_fits = j == len(right) or self.fits(window[-1], right[j])
            if left_fits and right_fits:
                return left[:-i] + window + right[j:]
            i = i if left_fits else min(len(left), 2 * i)
            j = j if right_fits else min(len(right), 2 * j)

    def tree(self, data: bytes) -> list[bytes]:
        if len(data) <= LEAF:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else [self.ranks[t] for t in self.tree(data)]


class Units(dict):
    """unit -> its ids as little-endian 32-bit bytes; a bounded memo."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, unit: str) -> bytes:
        ids = [i for p in PIECE.findall(unit) for i in self.encoder.piece(p.encode("utf-8", "surrogatepass"))]
        out = np.array(ids, dtype="<i4").tobytes()
        if len(unit) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.trim(MEMO // 2)
            self[unit] = out
        return out

    def trim(self, most: int) -> None:
        """Keep the ``most`` units that were met first."""
        if len(self) > most:
            first = dict(islice(self.items(), most))
            self.clear()
            self.update(first)


_LOADED: dict[str, Units] = {}
_TOKENS: dict[str, tuple[np.ndarray, np.ndarray]] = {}
K.keep(__name__, _LOADED, _TOKENS)


def _units(path: str) -> Units:
    if path not in _LOADED:
        _LOADED[path] = Units(Encoder(read_ranks(path)))
    return _LOADED[path]


def encode_texts(texts: list[str | None], path: str) -> pa.ListArray:
    get = _units(path).__getitem__
    out = [b"".join(map(get, UNIT.findall(t))) if t else b"" for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(x) // 4 for x in out]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(out), "<i4")))


def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(all token bytes in id order, bounds by id)."""
    if path not in _TOKENS:
        ranks = read_ranks(path)
        by_id = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            by_id[i] = t
        _TOKENS[path] = np.frombuffer(b"".join(by_id), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in by_id])))
    return _TOKENS[path]


def decode_ids(column: pa.ListArray, path: str) -> pa.Array:
    """Bytes of each row's ids. The leaves are the tokens' bytes; concatenation is associative, so the whole tree is one
    gather."""
    data, bounds = _token_bytes(path)
    column = column.fill_null([])
    ids = column.flatten().to_numpy()
    per_row = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
    start, size = bounds[ids], bounds[ids + 1] - bounds[ids]
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    out = data[at].tobytes()
    cut = ends[per_row]
    return pa.array([out[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array<int>), the token ids of the whole text."""
    carried = docs.drop(ids)
    schema = T.StructType([*carried.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        for batch in batches:
            for part in K.chunks(batch, text):
                got = encode_texts(part.column(text).to_pylist(), path)
                yield pa.RecordBatch.from_arrays([*part.columns, got], names=[*part.schema.names, ids])
        _units(path).trim(KEPT)    # the worker lives on, beside other stages
    return carried.mapInArrow(K.handing_back(run), schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the column ``out`` (binary), the bytes of the ids."""
    carried = docs.drop(out)
    schema = T.StructType([*carried.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        for batch in batches:
            lengths = np.cumsum(batch.column(ids).fill_null([]).value_lengths().to_numpy())
            lo = 0
            while lo < batch.num_rows:
                before = lengths[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(lengths, before + (K.CHUNK_BYTES >> 2), "right")))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_ids(part.column(ids), path)], names=[*part.schema.names, out])
                lo = hi
    return carried.mapInArrow(K.handing_back(run), schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """Columns n_tokens, ids_sha256 and decoded_sha256 of an encoded and decoded table."""
    return [F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]
