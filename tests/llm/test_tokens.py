import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candela.llm import bpe, idstore

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def strange_texts(n=150, seed=4):
    rnd = random.Random(seed)
    letters = "aaabcdeé ñßЖ日本語🙂́​ 　 \x85\x1c\x1f\t\n\r 0123456789١'’.,;<|>%&İΣǅªµº²"
    words = ["the", "The", "don't", "I'll", "'s", "<|endoftext|>", "<|startoftext|>", "naïve", "STRASSE", "ﬁn", "x" * 300, "ab" * 200, "  ", "\n\n \n", "  a", "1234567", "...,,", "Σς", "é"]
    out = [None, "", " ", "\n", "a" * 3000, "ab" * 1500, "日本語" * 400, "=" * 999]
    for _ in range(n):
        out.append("".join(rnd.choice([rnd.choice(letters), rnd.choice(words), " "]) for _ in range(rnd.randint(0, 80))))
    return out


def test_tree_reduction_equals_the_direct_encoding(reference):
    enc = bpe.Encoder(bpe.read_ranks(RANKS))
    rnd = random.Random(9)
    for _ in range(400):
        data = "".join(rnd.choice("aabeinrst") for _ in range(rnd.randint(1, 400))).encode()
        assert [enc.ranks[t] for t in enc.tree(data)] == [enc.ranks[t] for t in enc.merged(data)]
        cut = rnd.randint(0, len(data))
        assert enc.join(enc.merged(data[:cut]), enc.merged(data[cut:])) == enc.merged(data)


def test_byte_bpe_equals_the_library(spark, reference):
    texts = strange_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], None)], "doc_id bigint, text string, ids string").withColumn("decoded", F.lit(1))
    both = bpe.decode(bpe.encode(df, RANKS), RANKS)
    for r in both.select("doc_id", "text", "ids", "decoded", *bpe.digests(both)).collect():
        ids = reference.encode_ordinary(r.text or "")
        assert r.ids == ids and bytes(r.decoded) == (r.text or "").encode()
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.decode(bpe.encode(df.limit(0), RANKS), RANKS).count() == 0


def test_elias_fano_select():
    rnd = np.random.default_rng(0)
    for n, u in [(0, 1), (1, 1), (1, 10**9), (500, 3), (1000, 10**6), (64, 64), (65, 10**12)]:
        v = np.sort(rnd.integers(0, u, n))
        ef = idstore.EliasFano(idstore.EliasFano.encode(v))
        assert ef.all().tolist() == v.tolist() == [ef[i] for i in range(n)]
    v = np.cumsum(rnd.integers(1, 2000, 100_000))
    assert len(idstore.EliasFano.encode(v)) * 8 < len(v) * (2 + np.log2(v[-1] / len(v)) + 1.1)


def test_stored_ids_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(idstore, "SEGMENT_IDS", 500)
    tok = Tokenizer.from_file(WORDS)
    texts = strange_texts(seed=8)
    rows = [(i * 3 - 40, t, "x") for i, t in enumerate(texts)] + [(5, "tie b", "y"), (5, "tie a", "y"), (5, "tie a", "y"), (None, "null id", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, part string").withColumn("frame", F.lit(1))
    expect, at = [], 0
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        expect.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in idstore.stored_ids(df, WORDS).collect()), key=lambda r: r[1])
    assert got == expect
    assert idstore.stored_ids(df.limit(0), WORDS).count() == 0


def test_segment_gives_single_documents():
    docs, ids = [None, 4, 4, 90], [b"\1\0", b"\5\0\1\0", b"\1\0", b"\7\0\10\0\1\0"]
    s = idstore.Segment(idstore.frame(docs, ids, 2))
    assert s.doc_ids() == docs and [s.document(i).tobytes() for i in range(4)] == ids
