import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from candela.llm import decontaminate as D
from candela.llm import quality as Q

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words(x):
    return ALNUM.findall((x or "").translate(LOWER))


def brute(docs, bench, window=10):
    out = []
    for d, x in docs:
        w, hit, items = words(x), set(), set()
        for i, t in bench:
            v = words(t)
            n = min(window, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit |= set(range(p, p + n))
                        items.add(str(i)) if i is not None else None
        out.append((d, len(w), len(hit), sorted(items)))
    return out


def compare(spark, docs, bench):
    dd = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns(
        {"id": F.lit("x"), "key": F.lit(None).cast("string"), "gram": F.lit(1), "pos": F.lit(2)})
    bb = spark.createDataFrame(bench, "item_id bigint, text string").withColumn("wtext", F.lit(3))
    got = [(r.id, r.n_words, r.n_hit, r["items"]) for r in D.contamination(dd, bb).collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, bench), key=repr)
    return dd, bb, got


def test_decontamination_matches_brute_force(spark):
    rnd = random.Random(3)
    vocab = ["a", "B", "cc", "é", "x1", "the", "Of", "zz"]
    bench = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for i in range(14)]
    bench += [(3, bench[3][1]), (20, None), (21, ""), (22, ".,;"), (None, "null item of words that is here to mark words only")]
    docs = []
    for i in range(60):
        t = [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]
        if i % 2:
            t[len(t) // 2:len(t) // 2] = [rnd.choice(bench)[1] or "", "--"]
        docs.append((i, rnd.choice([" ", "\n", ", "]).join(t)))
    docs += [(100, None), (101, ""), (None, "null item of words that is here to mark words only"), (5, docs[5][1]), (5, "other text a B cc"),
             (102, " ".join(rnd.choice(vocab) for _ in range(30000)))]
    dd, bb, got = compare(spark, docs, bench)
    kept = [(r.doc_id, r.text) for r in D.clean(dd, bb).collect()]
    bad = {(g[0], t) for g, (_, t) in zip(brute(docs, bench), docs) if g[2]}
    assert sorted(kept, key=repr) == sorted([x for x in docs if x not in bad], key=repr)
    assert D.clean(dd, bb).columns == dd.columns


@pytest.mark.parametrize("docs, bench", [([], [(1, "a b c")]), ([(1, "a b c")], []), ([], [])])
def test_decontamination_of_empty_tables(spark, docs, bench):
    compare(spark, docs, bench)


def base(x):
    x = x or ""
    w, seen, dup = SPACE.findall(x), set(), 0
    for line in x.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    g = collections.Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    rep = {j + k for j in range(len(w) - 2) if g[tuple(w[j:j + 3])] > 1 for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(rep), n < 50 or 100 * len(rep) > 50 * n


def test_quality_measures_and_order(spark):
    rnd = random.Random(5)
    texts = [None, "", "\n\n", "x" * 5000, "a b c " * 40, " ".join(map(str, range(60))), "ok\n" * 70]
    texts += ["".join(rnd.choice("ab é#|\n\t x<") for _ in range(rnd.randint(0, 900))) for _ in range(120)]
    texts += [" ".join(rnd.choice(["word", "other", "prose", "line\n", "##", "1"]) + str(rnd.randint(0, 99)) for _ in range(200)) for _ in range(20)]
    rows = [(i, x, True, 7) for i, x in enumerate(texts)] + [(0, texts[-1], None, 1), (None, texts[-1], None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept boolean, n_words int")
    got = Q.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
    verdicts = {hashlib.md5((r.text or "").encode()).hexdigest(): r.kept for r in got}
    for order in (Q.RULES, Q.RULES[::-1]):
        again = Q.judge(df, rules=list(order)).collect()
        assert {hashlib.md5((r.text or "").encode()).hexdigest(): r.kept for r in again} == verdicts
    assert not any(r.kept for r in got if r.base_failed) and any(r.kept for r in got)
    assert Q.judge(df.limit(0)).count() == 0
    named = Q.judge(df, prefix="q_")
    assert named.columns[:4] == df.columns and "q_kept" in named.columns
