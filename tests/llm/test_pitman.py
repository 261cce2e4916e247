import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.llm import pitman as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def tokens(t):
    return WORD.findall((t or "").translate(LOWER)) + [None]


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit("x"), "held": F.lit(1), "g": F.lit(2)})
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expect = Counter((d, held(d), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for d, t in rows for w in [tokens(t)])
    got = P.score(df).collect()
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expect
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    return got


def corpus(n, seed=1):
    """Texts whose words follow the word before."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    after = {w: rnd.sample(vocab, 12) for w in vocab}
    out = []
    for i in range(n):
        w, text = rnd.choice(vocab), []
        for _ in range(rnd.randint(20, 120)):
            text.append(w)
            w = rnd.choice(after[w]) if rnd.random() < 0.9 else rnd.choice(vocab)
        out.append((i, " ".join(text)))
    return out


def test_counts_base_and_held_out_likelihood(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_TOKENS", 150)
    monkeypatch.setattr(P, "GROUP_TOKENS", 4000)
    monkeypatch.setattr(P, "FLUSH_TOKENS", 3000)
    rows = corpus(400) + [(1000, None), (1001, ""), (1002, "W1 w1\tnever-seen"), (None, "w1 w2"), (3, "w3"), (3, "w3"), (1003, "w5 " * 30000)]
    got = check(spark, rows)
    held = [r for r in got if r.held_out and r.id < 400]
    assert len(held) > 30 and sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    again = {(r.id, r.n_tokens): r.score for r in P.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(abs(again[r.id, r.n_tokens] - r.score) < 1e-6 for r in got)


def test_every_preceding_word_is_a_context(spark):
    """6,000 words of one ending, each rarer than 1/4096 and followed by three words: only contexts of their own tell what follows."""
    rnd = random.Random(3)
    vocab = [f"{i}ing" for i in range(6000)]
    after = {w: rnd.sample(vocab, 3) for w in vocab}
    rows = []
    for i in range(1500):
        text = [rnd.choice(vocab)]
        while len(text) < 120:
            text.append(rnd.choice(after[text[-1]]) if rnd.random() < 0.95 else rnd.choice(vocab))
        rows.append((i, " ".join(text)))
    held = [r for r in check(spark, rows) if r.held_out]
    assert len(held) > 100 and sum(r.score for r in held) > sum(r.base_score for r in held) + 1.5 * sum(r.n_tokens for r in held)


def test_split_words_are_counted_in_all_flushes(spark, monkeypatch):
    """A word with 2.9/8 of a third of the tokens and 0.45/8 of the rest has 1/8 of all, in whatever order the rows are stored."""
    monkeypatch.setattr(P, "FREQUENT", 8)
    monkeypatch.setattr(P, "PART_TOKENS", 40)
    monkeypatch.setattr(P, "FLUSH_TOKENS", 300)
    fill = iter(range(10**6))
    text = lambda hot, n: " ".join(["hot"] * hot + [f"f{next(fill)}" for _ in range(n - hot - 1)])
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(ids[0], text(145, 400)), (ids[1], text(22, 400)), (ids[2], text(23, 400))]
    found, scores = [], []
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        for parts in (1, 3):
            df = spark.createDataFrame(spark.sparkContext.parallelize(order, parts), "doc_id bigint, text string")
            words, n = P._split_words(P._flushes(P._documents(df, "doc_id", "text")), 1200)
            found.append((tuple(words.tolist()), tuple(n.tolist())))
            scores.append([round(r.score, 4) for r in sorted(P.score(df).collect())] if parts == 3 or order is rows else scores[0])
    assert len(found[0][0]) == 1 and found[0][1] == (5,) and len(set(found)) == 1
    assert all(x == scores[0] for x in scores)


def test_a_word_larger_than_a_group_is_dealt_in_parts(spark, monkeypatch):
    """A word of half of all tokens, after 2,000 different words: its parts are dealt over nearly all groups by hash, and every count stays."""
    monkeypatch.setattr(P, "PART_TOKENS", 100)
    monkeypatch.setattr(P, "GROUP_TOKENS", 1000)
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{rnd.randrange(2000)} hot" for _ in range(60))) for i in range(200)]
    held = [r for r in check(spark, rows) if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)
    flushes = P._flushes(P._documents(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text"))
    words = P._split_words(flushes, 1)
    sent = P._sent(flushes, spark.sparkContext.broadcast(words), 24).collect()
    parts = [q for r in sent for q in P._unpack(r.blob, *P._PAIRS)[1]]
    assert len(words[0]) >= 1 and max(words[1]) > 50 and len({r.g for r in sent if P._unpack(r.blob, *P._PAIRS)[1].any()}) >= 20
    assert len(parts) > 50


@pytest.mark.parametrize("rows", [[(1, "a b a")], [(1, None)], [(i, "same words here") for i in range(12)]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_empty_table(spark):
    assert P.score(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_seating_has_the_tables_of_a_chinese_restaurant():
    rng = np.random.default_rng(0)
    for customers, odds, d in [(10, 0.7, 0.3), (400, 1.5, 0.6), (5000, 0.4, 0.5)]:
        got = P.seat(np.full(3000, customers), np.full(3000, odds), d, rng).mean()
        mean = []
        for _ in range(300):
            t = 1
            for j in range(1, customers):
                t += rng.random() < odds / (j - d * t + odds)
            mean.append(t)
        assert abs(got - np.mean(mean)) < 0.12 * np.mean(mean)


def test_new_tables_add_to_the_odds():
    """With odds that grow by ``per_table`` for each table of the section itself."""
    rng = np.random.default_rng(4)
    got = P.seat(np.full(4000, 30), np.full(4000, 0.5), 0.4, rng, 0.2).mean()
    mean = []
    for _ in range(4000):
        t = 1
        for j in range(1, 30):
            odds = 0.5 + 0.2 * t
            t += rng.random() < odds / (j - 0.4 * t + odds)
        mean.append(t)
    assert abs(got - np.mean(mean)) < 0.03 * np.mean(mean)


def group(c):
    """The compact form of counts (contexts x words), zero counts too."""
    n, v = c.shape
    body = P._pack(np.full(v, n, "<u4"), np.zeros(v, "<u4"), np.tile(np.arange(n), v).astype("<u4"), c.T.ravel().astype("<u4"), np.array([n], "<u4"))
    return P.Group(0, body)


def sums(chain, types, d0=0.4, d1=0.6):
    return {"d0": d0, "d1": d1, "types": types, "root_customers": chain.t.sum(), "root_tables": chain.s.sum(), "freq_n0": np.zeros(0, np.int64), "freq_s": np.zeros(0, np.int64)}


def test_a_context_is_a_distribution():
    """Over all known words and the unknown one, the predictive probabilities of a context sum to one."""
    rng = np.random.default_rng(1)
    c = rng.integers(0, 6, (8, 30))         # contexts x words
    c[:, 0] += 1
    g, known = group(c), c.sum(0) > 0
    chain = P.Chain(g)
    tables = lambda: np.bincount(g.ctx, weights=chain.t, minlength=8)
    chain.sweep(0, sums(chain, known.sum()), tables())
    now = sums(chain, known.sum())
    p = chain.predictive(now, tables(), c.sum(1)).reshape(30, 8).T
    unknown = (P.STRENGTH + now["d0"] * now["root_tables"]) / (now["types"] + 1) / (P.STRENGTH + now["root_customers"])
    rest = (P.STRENGTH + now["d1"] * tables()) / (P.STRENGTH + c.sum(1)) * unknown
    assert np.allclose(p[:, known].sum(1) + rest, 1)


def exact_tables(c, d0, d1, rng, sweeps):
    """Mean tables of each (context, word) by a customer-at-a-time Gibbs sampler that keeps every table (strength 1)."""
    n, v = c.shape
    rooms = {(u, w): [] for u in range(n) for w in range(v)}
    root = {w: [] for w in range(v)}
    types = int((c.sum(0) > 0).sum())

    def p_root(w):
        customers, tables = sum(map(sum, root.values())), sum(map(len, root.values()))
        return (max(0, sum(root[w]) - d0 * len(root[w])) + (1 + d0 * tables) / (types + 1)) / (1 + customers)

    def enter(room, weight_new, d):
        weights = [x - d for x in room] + [weight_new]
        k = rng.choices(range(len(weights)), weights)[0]
        if k == len(room):
            room.append(0)
        room[k] += 1
        return k == len(room) - 1 and room[k] == 1

    def leave(room):
        k = rng.choices(range(len(room)), room)[0]
        room[k] -= 1
        if not room[k]:
            room.pop(k)
            return True
        return False

    total = np.zeros((n, v))
    for sweep in range(sweeps):
        for u in range(n):
            for w in range(v):
                for _ in range(c[u, w]):
                    if sweep and leave(rooms[u, w]):
                        leave(root[w])
                    tables = sum(len(rooms[u, x]) for x in range(v))
                    if enter(rooms[u, w], (1 + d1 * tables) * p_root(w), d1):
                        enter(root[w], (1 + d0 * sum(map(len, root.values()))) / (types + 1), d0)
        if sweep >= sweeps // 5:
            total += [[len(rooms[u, w]) for w in range(v)] for u in range(n)]
    return total / (sweeps - sweeps // 5)


def test_sweeps_have_the_tables_of_an_exact_sampler():
    """Mean tables over many sweeps against a sampler that moves one customer at a time and keeps every table."""
    rng = np.random.default_rng(6)
    c = rng.integers(0, 5, (6, 8))
    c[0, 0], c[3, 2] = 14, 9
    g, types = group(c), int((c.sum(0) > 0).sum())
    got, runs = np.zeros(c.shape), 1500
    chain = P.Chain(g)
    for k in range(runs):
        chain.sweep(k, sums(chain, types), np.bincount(g.ctx, weights=chain.t, minlength=len(c)))
        got += chain.t.reshape(c.shape[::-1]).T / runs
    want = exact_tables(c, 0.4, 0.6, random.Random(2), 1500)
    assert abs(got.sum() - want.sum()) < 0.06 * want.sum(), (got.sum(), want.sum())
    assert np.abs(got - want).max() < 0.6, np.abs(got - want).max()
