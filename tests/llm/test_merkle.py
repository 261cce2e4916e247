import hashlib
import random
import zlib

import duckdb

from candela.llm import merkle as M


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Levels of one tree and for each leaf the run's others from the bottom up, with the side."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for x in levels[:-1]:
            other = i ^ 1
            path.append((other < i, x[other] if other < len(x) else ""))
            i //= 2
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda d, t, g, s, n: sha(enc(d) + enc(s) + enc(g) + enc(n) + enc(t))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for g in order}
    trees = {g: tree([leaf(*r) for r in made[g]]) for g in order}
    root, tops = tree([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for g, top in zip(order, tops):
        sub, paths = trees[g]
        for r, path in zip(made[g], paths):
            d, t, _, s, n = r
            changed = r if d is None or zlib.crc32(str(d).encode()) % 7 or n is None else (d, t, g, s, n + 1)
            node = leaf(*changed)
            for left, h in path + top:
                node = sha(h + node if left else node + h)
            out.append((d, leaf(*r), sub, root, sha("".join(h for _, h in path + top)), node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_manifest_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(d, f"text {d} é", rnd.choice(["en", "de", None, "", "zz", "é"]), rnd.choice(["a", None]), rnd.choice([None, 5, 2**63 - 1]))
            for d in rnd.sample(range(-500, 500), 300) + [2**62, -2**63, 2**63 - 1, -2**62]]
    rows += [(None, f"n{i}", "en", "a", i) for i in range(5)] + [rows[0]] * 4 + [(rows[1][0], f"other {i}", rows[1][2], "b", 1) for i in range(70)]
    rows += [(7, None, "alone", None, None), (8, "", "pair", "", 0), (9, "x" * 100_000, "pair", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert rows_of(M.audited(df)) == want
    assert sum(not r[-1] for r in want) > 5 and sum(r[-1] for r in want) > 5
    for levels in (1, 3):   # many array levels over the same rows
        monkeypatch.setattr(M, "LEVELS", levels)
        monkeypatch.setattr(M, "SLOTS", 1 << levels)
        assert rows_of(M.audited(df)) == want


def test_only_repeats_are_sorted(spark):
    df = spark.range(3000).selectExpr("id * 3 as id", "if(id % 3 = 0, 'a', 'b') as k", "'' as leaf")
    words = M.directory(df)
    got = M.coordinates(df, words)
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()
    for k in "ab":
        mine = [r.at for r in got.filter(f"k = '{k}'").orderBy("id").collect()]
        assert mine == list(range(len(mine)))


def test_single_group_empty_table_and_extra_columns(spark):
    one = spark.createDataFrame([(5, "t", "en", "s", 1)], SCHEMA)
    assert rows_of(M.audited(one)) == brute([(5, "t", "en", "s", 1)])
    assert M.audited(one.limit(0)).collect() == []
    odd = one.selectExpr("*", "1 as k", "2 as id", "3 as leaf", "4 as at", "'x' as root")
    assert rows_of(M.audited(odd)) == brute([(5, "t", "en", "s", 1)])


def test_sql_says_the_same(spark):
    rows = [(i, f"t{i}", random.Random(i).choice(["en", "de", None]), "s", i if i % 5 else None) for i in range(90)] + [(None, "n", None, None, 1)]
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    c.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(c.sql(M.ORACLE).fetchall(), key=str) == brute(rows)
