import random

import public_tokenizers as P
from test_neardup import brute as brute_near
from test_decontaminate_quality import base, words
from test_shards_chat_lines_pages import brute_lines

import corpus_pipeline as C
from candela.llm import bpe, quality


def test_pipeline_matches_brute_force(spark, tmp_dir):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijk") for _ in range(5))
    line = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, line(14)) for i in range(4)] + [(9, None)]
    shared = [line(12) for _ in range(3)]
    rows = []
    for i in range(40):
        body = [line(rnd.randint(8, 40)) for _ in range(5)]
        if i % 4 == 0:
            body.insert(1, rnd.choice(shared))
        if i % 6 == 0:
            body[2] += " " + bench[i % 4][1] + " " + word()
        rows.append((i, "\n".join(body), "en", "s", 1))
    for i in (3, 7, 11):   # near copies with a word changed in every line, and exact copies
        rows.append((100 + i, "\n".join(x + " " + word() + " " + word() for x in rows[i][1].split("\n")), "en", "s", 1))
        rows.append((200 + i, rows[i][1], "en", "s", 1))
    rows += [(300, None, "en", "s", 1), (301, "", "en", "s", 1), (302, "too short", "en", "s", 1), (303, "# " * 200, "en", "s", 1), rows[5]]
    folder = f"{tmp_dir}/sf"
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = [(d, t) for d, t, *_ in rows if not base(t)[5]]
    import numpy as np
    import pyarrow as pa
    t = quality.Texts(pa.array([x for _, x in docs]))
    docs = [docs[i] for i in quality.cascade(t, quality.RULES, np.arange(len(docs)))]
    had = dict(docs)
    docs = [(d, x) for (d, x), n in brute_lines(docs).items() for _ in range(n) if x == had[d] or len(x) >= C.LEAST_LEFT * len(had[d])]
    docs = sorted({x for x in docs if (x[0], x[0]) in {(d, c) for d, _, c in brute_near(docs)}})
    windows = {tuple(v[i:i + 10]) for _, x in bench for v in [words(x)] for i in range(len(v) - 9)}
    docs = [(d, x) for d, x in docs if not any(tuple(w[i:i + 10]) in windows for w in [words(x)] for i in range(len(w) - 9))]
    enc = bpe.Units(bpe.Encoder(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))))
    expect = [(d, x, len(x) if x != dict((r[0], r[1]) for r in rows)[d] else 1, sum(len(enc[u]) // 4 for u in bpe.UNIT.findall(x))) for d, x in docs]
    got = C.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"]
    assert sorted((r.doc_id, r.text, r.n_chars, r.n_tokens) for r in got.collect()) == sorted(expect)
    assert 10 < len(expect) < len(rows) - 10
    assert [s for s, _ in C.STAGES] == ["quality_rules", "line_dedup", "minhash_neardup", "benchmark_decontamination", "byte_bpe"]


def test_near_duplicates_go_from_four_fifths_on(spark):
    """100 words, of which 2 are changed: 86 of 106 shingles are shared (0.81); with 3 changed it is 81 of 111 (0.73)."""
    rows = []
    for i in range(12):
        base = [f"d{i}w{k}" for k in range(100)]
        for copy, changed in enumerate(((), (20, 60), (10, 30, 50))):
            rows.append((10 * i + copy, " ".join(f"c{copy}x{k}" if k in changed else w for k, w in enumerate(base)), 1))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    kept = sorted(r.doc_id for r in C.minhash_neardup(spark, df, None).collect())
    assert kept == sorted(d for d, *_ in rows if d % 10 != 1)


def test_columns_of_documents_stay(spark, tmp_dir):
    text = " ".join(f"word{i} and" for i in range(60)) + "."
    rows = [(1, text, "en", 7, "t", "i", "l", "d", "x", "k"), (2, text + " more", None, None, None, None, None, None, None, None)]
    cols = ["doc_id", "text", "lang", "n_chars", "n_tokens", "ids", "n_lines", "n_dropped", "decoded", "kept"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars int, n_tokens string, ids string, n_lines string, n_dropped string, decoded string, kept string")
    spark.createDataFrame([(1, "none of the words of the text are in this item, not one")], "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, docs, tmp_dir)
        assert got.columns == cols, name
        assert [r[4:] for r in got.orderBy("doc_id").collect()][0] == ("t", "i", "l", "d", "x", "k"), name
    last = C.STAGES[-1][1](spark, docs, tmp_dir)
    assert last.columns == [*cols, "bpe_n_tokens", "bpe_ids"]
    first = last.orderBy("doc_id").first()
    assert first.text == text and first.n_tokens == "t" and first.bpe_n_tokens == len(first.bpe_ids) > 60
