import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from candela.llm import neardup as N
from candela.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(x):
    w = WORD.findall((x or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    par = list(range(len(rows)))

    def find(a):
        while par[a] != a:
            a = par[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                par[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit("x"), "cls": F.lit(1), "n": F.lit(None).cast("int")})
    return sorted(((r.id, r.n_shingles, r.component_id) for r in N.near_duplicates(df).collect()), key=repr)


def test_components_match_brute_force(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows, at = [], 0
    for group in range(8):
        base = [word() for _ in range(rnd.choice([30, 120, 300]))]
        for copy in range(rnd.choice([1, 3, 40])):
            t = list(base)
            for _ in range(rnd.randint(0, len(t) // 45)):
                t[rnd.randrange(len(t))] = word()
            rows.append((1000 - at, " ".join(t)))
            at += 1
    rows += [(2000 + i, " ".join([word() for _ in range(40)] + passage)) for i in range(40)]   # a shared passage is no copy
    rows += [(3000 + i, rnd.choice(["a b c", "A  B\nc", "one", "a b c d e", "a b c d f"])) for i in range(12)]
    rows += [(1, None), (2, ""), (3, " \n"), (None, rows[0][1]), (None, "alone with a null id and nothing like it"), rows[5], rows[5], (5000, " ".join(word() for _ in range(40000)))]
    assert run(spark, rows) == brute(rows)


def test_crowded_region_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        t = list(base)
        for k in rnd.sample(range(150), rnd.randint(1, 4)):
            t[k] = f"x{rnd.random()}"
        rows.append((i, " ".join(t)))
    assert run(spark, rows) == brute(rows)


def test_empty_and_linkless(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "a"), (2, "b")]) == [(1, 1, 1), (2, 1, 2)]


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(1, 70)] + [(200, 100), (100, 300), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 71)}, 100: 100, 200: 100, 300: 100}


def test_few_links_are_missed_at_both_thresholds():
    for s in (0.8, 0.85):
        assert (1 - s ** N.MIN_DEPTH) ** N.TREES < 1e-6 and (1 - s ** N.DEPTH) ** N.TREES < 2e-5


def test_signatures_of_linked_pairs_pass():
    """All numbers of agreeing values that a pair at the threshold falls below with 1e-5 or less."""
    for percent in (80, 85):
        s, below, k = percent / 100, 0.0, 0
        while below < 1e-5:
            below += math.comb(N.WIDTH, k) * s ** k * (1 - s) ** (N.WIDTH - k)
            k += 1
        sketch = np.zeros((2, N.WIDTH), np.uint8)
        sketch[1, k:] = 1
        assert N._similar(sketch, np.array([100, 100]), np.array([0]), np.array([1]), percent).all()
