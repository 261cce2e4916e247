"""What tasks hold beside the executor's heap."""

import gc
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from candela.llm import bpe, neardup
from candela.llm import decontaminate as D
from candela.llm import textkit as K

M = 1 << 64


def span_hash(data: bytes) -> int:
    raw = sum(int(K._BYTE_VALUES[b]) * pow(int(K._MULT), i, M) for i, b in enumerate(data))
    return int(K.mix(np.array([(raw + len(data) * int(K._GRAM)) % M], np.uint64))[0])


def test_span_hashes_over_many_stretches():
    rng = np.random.default_rng(3)
    sizes = [1, 5, 65_535, 1, 65_536, 2, 65_537, 140_000, 3] + [int(n) for n in rng.integers(1, 40, 9_000)]
    text = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in sizes]
    w = K.words(pa.array([b" ".join(text[:4000]).decode(), None, b" ".join(text[4000:]).decode()]), K.SPACE_WORD, lower=False)
    assert len(w.hash) == len(text)
    some = [*range(12), 3999, 4000, *range(5000, 5040), len(text) - 1]
    assert [int(w.hash[i]) for i in some] == [span_hash(text[i]) for i in some]


@pytest.mark.parametrize("word", ["word", "w" * 300_000])
def test_word_hashes_hold_little(word):
    column = pa.array([(word + " ") * (K.CHUNK_BYTES // (len(word) + 1))])
    n = K.CHUNK_BYTES // (len(word) + 1)
    tracemalloc.start()
    try:
        w = K.words(column, K.SPACE_WORD, lower=True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(w.hash) == n and len(set(w.hash.tolist())) == 1
    assert peak < 8 * K.CHUNK_BYTES + 64 * n + (8 << 20)    # was over 24 bytes a byte of text, and tables of 16


class Task:
    """A frame that keeps the function its tasks would run."""

    columns = ["id", "key", "text"]

    def __init__(self):
        self.runs = []
        self.schema = SimpleNamespace(fields=[])

    def mapInArrow(self, run, schema):
        self.runs.append(run)
        return self

    def __getattr__(self, name):
        return lambda *a, **kw: self


def test_tasks_hand_memory_back_when_their_words_are_gone(spark, monkeypatch):
    import public_tokenizers
    alive = []

    def release():
        alive.append(sum(isinstance(x, K.Words) for x in gc.get_objects()))
    monkeypatch.setattr(K, "release", release)
    bits = SimpleNamespace(value=np.full(1 << 18, ~np.uint64(0)))
    docs = Task()
    D._corpus_counts(docs, bits)
    D._places(docs, bits, 10)
    D._windows(docs, "id", "text", 10)
    neardup._signed(docs, "id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bpe.encode(docs, path)
    assert len(docs.runs) == 5
    rows = {"id": [1, 2, 3], "key": [4, 5, 6], "th": [4, 5, 6], "item_id": ["a", "b", "c"], "text": ["one two three four five six " * 9, None, "a b c"]}
    for i, run in enumerate(docs.runs):
        batches = iter([pa.RecordBatch.from_pydict(rows), pa.RecordBatch.from_pydict(rows)])
        assert sum(b.num_rows for b in run(batches)), i
        assert alive == [0] * (i + 1), i


def test_other_operators_free_what_bpe_keeps(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = Task()
    bpe.encode(docs, path)
    neardup._signed(docs, "id", "text")
    batch = pa.RecordBatch.from_pydict({"id": [1], "th": [2], "text": ["one two three"]})
    encode, sign = docs.runs
    first = [b.column("ids").to_pylist() for b in encode(iter([batch]))]
    memo = bpe._LOADED[path]
    assert [b.column("ids").to_pylist() for b in encode(iter([batch]))] == first and bpe._LOADED[path] is memo
    assert list(sign(iter([batch]))) and not bpe._LOADED
    assert [b.column("ids").to_pylist() for b in encode(iter([batch]))] == first


def test_workers_know_whose_tables_they_hold(spark):
    """The functions reach a worker by value, the tables by name: a driver's memo stays in the driver."""
    import public_tokenizers
    from pyspark import cloudpickle
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bpe._units(path)
    docs = Task()
    bpe.encode(docs, path)
    neardup._signed(docs, "id", "text")
    assert all(len(cloudpickle.dumps(run)) < 20_000 for run in docs.runs)
