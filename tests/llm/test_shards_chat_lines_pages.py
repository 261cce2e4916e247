import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candela.llm import chat, linedup, mainhtml, shards


def test_hypergeometric_follows_its_law():
    rng = random.Random(1)
    draws = Counter(shards.hypergeometric(rng, 6, 10, 5) for _ in range(20000))
    from math import comb
    for k in range(6):
        assert abs(draws[k] / 20000 - comb(6, k) * comb(10, 5 - k) / comb(16, 5)) < 0.015
    assert 0.45e9 < shards.hypergeometric(rng, 10**10, 10**10, 10**9) < 0.55e9
    m = shards.communication_matrix([5, 0, 17, 100], [31, 31, 30, 30], 3)
    assert [sum(r) for r in m] == [5, 0, 17, 100] and [sum(c) for c in zip(*m)] == [31, 31, 30, 30]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 1000])
def test_shards_are_exact_and_gapless(spark, n):
    rows = [(i if i % 50 else None, None if i % 7 == 0 else "x" * (i % 40)) for i in range(n)]
    rows[10:14] = [(1, "same")] * len(rows[10:14])
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("slot", F.lit("z")).withColumn("p", F.lit(1))
    out = shards.shuffle_into_shards(df, part_rows=8)
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    sizes = Counter(r.shard for r in got)
    assert sorted((sizes[s] for s in range(16)), reverse=True) == [n // 16 + (s < n % 16) for s in range(16)]
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s])) for s in range(16))
    assert sorted(map(repr, got)) == sorted(map(repr, shards.shuffle_into_shards(df.repartition(3), part_rows=8).collect()))


def test_shuffle_is_uniform(spark):
    df = spark.range(1600).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    seen = Counter()
    for seed in range(6):
        seen.update(r.shard for r in shards.shuffle_into_shards(df, seed=seed * 100).filter("doc_id < 400").collect())
    assert max(seen.values()) < 6 * 25 * 1.5 and min(seen.values()) > 6 * 25 * 0.6


def test_chat_rotation(spark):
    rows = [(1, 2, "ann", "b!"), (1, 1, "system", "be kind"), (1, 3, "bob", None), (1, 4, "ann", "bye"), (1, 4, "ann", "bye"),
            (2, 1, "system", "alone"), (None, 1, "u", "x"), (None, 1, "v", "x"), (3, None, None, ""), (4, 1, 'e"|>\n', "é" * 20000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("speaker", F.lit(1)).withColumn("c", F.lit(1))
    got = {(r.conv_id, r.speaker): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (None, "u"), (None, "v"), (3, "unknown"), (4, 'e"|>\n')}
    a = got[1, "ann"]
    assert a.n_turns == 5 and a.text == ('<|system|>\nbe kind<|end|>\n<|assistant|>\nb!<|end|>\n<|user name="bob"|>\n<|end|>\n' + "<|assistant|>\nbye<|end|>\n" * 2)
    assert [a.text[m.start:m.end] for m in a["mask"]] == ["b!<|end|>\n", "bye<|end|>\n", "bye<|end|>\n"]
    b = got[1, "bob"]
    assert [b.text[m.start:m.end] for m in b["mask"]] == ["<|end|>\n"] and '<|user name="ann"|>' in b.text
    assert chat.rotate(df.limit(0)).count() == 0


def brute_lines(rows):
    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < linedup.NEAR_WORDS:
            return a == b
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        s, l = sorted((a, b), key=len)
        return any(l[:i] + l[i + 1:] == s for i in range(len(l)))
    docs = sorted({(d is None, d or 0, t) for d, t in rows if t is not None})
    seen, out = [], {}
    for null, d, t in docs:
        kept = []
        for line in t.split("\n"):
            w = line.split()
            if len(w) < linedup.MIN_WORDS:
                kept.append(line)
                continue
            if not any(one_edit(w, v) for v in seen):
                kept.append(line)
            seen.append(w)
        out[None if null else d, t] = "\n".join(kept)
    return Counter((d, None if t is None else out[d, t]) for d, t in rows)


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(6)
    lines = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([1, 4, 5, 9, 10, 11, 12, 40]))) for _ in range(25)]

    def edited(line):
        w = line.split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            i = rnd.randrange(len(w) or 1)
            w[i:i + 1] = rnd.choice([[], ["q"], [*w[i:i + 1], "z"], [str(rnd.random())]])
        return rnd.choice([" ", "  ", "\t"]).join(w)
    rows = [(i, "\n".join(edited(rnd.choice(lines)) for _ in range(rnd.randint(0, 8)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, rows[1][1]), rows[3], (103, " ".join(f"w{i}" for i in range(3000)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"id": F.lit("x"), "n_lines": F.lit("y"), "words": F.lit(1)})
    out = linedup.dedup_lines(df)
    assert Counter((r.doc_id, r.text) for r in out.collect()) == brute_lines(rows)
    assert out.columns[:4] == ["doc_id", "text", "id", "words"] and linedup.dedup_lines(df.limit(0)).count() == 0


def test_long_lines_and_short_ones(spark):
    """Two lines of 20,000 words with one word changed, one with a word left out; repeated lines of one or two words go as well."""
    words = [f"w{i}" for i in range(20000)]
    changed, shorter = list(words), words[:7000] + words[7001:]
    changed[12345] = "other"
    rows = [(1, " ".join(words)), (2, " ".join(changed) + "\nshort one\n\nx"), (3, " ".join(shorter)), (4, "short  one\nx\nnew"), (5, "short\n\n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in linedup.dedup_lines(df).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("short one\n\nx", 1), 3: ("", 1), 4: ("new", 2), 5: ("short\n\n", 0)}


def test_words_are_left_out_only_where_lines_can_differ(spark, monkeypatch):
    """A word changed, added or left out at any place is found, and only the half that no other line shares gives variants."""
    tables, write = {}, linedup.written

    def written(df, name):
        tables[name] = write(df, name)
        return tables[name]
    monkeypatch.setattr(linedup, "written", written)

    def edited(words, kind, i):
        return words[:i] + {"changed": ["new"], "shorter": [], "added": ["new", *words[i:i + 1]]}[kind] + words[i + 1:]
    rows = []
    for n in (10, 11, 40, 41):
        for kind in ("changed", "shorter", "added"):
            for i in range(0 if (n, kind) == (10, "shorter") else n + (kind == "added")):
                words = [f"{n}{kind}{i}w{j}" for j in range(n)]
                rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(edited(words, kind, i)))]
    out = {r.doc_id: r.n_dropped for r in linedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == {i: i % 2 for i, _ in rows}
    words = [f"w{j}" for j in range(41)]
    pair = [(1, " ".join(words)), (2, " ".join(edited(words, "changed", 35))), (3, " ".join(f"x{j}" for j in range(41)))]
    assert [r.n_dropped for r in linedup.dedup_lines(spark.createDataFrame(pair, "doc_id bigint, text string")).orderBy("doc_id").collect()] == [0, 1, 0]
    assert tables["op7-variants"].count() == 2 * 21


def test_white_space_at_the_ends_of_lines(spark):
    rows = [(1, " a b\n \nc\t"), (2, "a  b \n\x0bc\n\f\r\n  "), (3, "a\tb\r\nc d"), (4, " c\nd e"), (5, "\n"), (6, "\u00a0\n\u00a0 ")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in linedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (" a b\n \nc\t", 3, 0), 2: ("\f\r\n  ", 4, 2), 3: ("c d", 2, 1), 4: ("d e", 2, 1), 5: ("\n", 2, 0), 6: ("\u00a0", 2, 1)}


def test_variant_hashes_are_those_of_the_shorter_line(spark):
    for n in (1, 2, 127, 128, 129, 300):
        df = spark.createDataFrame([(n, [1000 + i * i for i in range(n)])], "n int, h array<bigint>")
        at = df.select("n", "h", linedup._at_places("h", 0).alias("here"), linedup._at_places("h", 1).alias("before"))
        run = at.select("*", F.expr(linedup._RUNNING).alias("run"), F.expr("aggregate(before, 0L, (x, y) -> x ^ y)").alias("all"))
        whole = lambda c: F.expr(f"aggregate({c}, 0L, (x, y) -> x ^ y)")
        left = run.select("h", F.posexplode(F.expr("transform(run, (x, i) -> all ^ x ^ before[i])")).alias("i", "v"))
        left = left.withColumn("short", F.expr("filter(h, (x, k) -> k <> i)")).withColumn("here", linedup._at_places("short", 0))
        got = left.select("v", whole("here").alias("w")).collect()
        assert len(got) == n and all(r.v == r.w for r in got)


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<!-- x --><div class="top-ad">Buy now, this is a very long advert text that could pass for text, really long text it is.</div>
<article><h1>Head &amp; line</h1><p><b>Bold start\n\t of   text<br><p>Second.</p><div class="share-bar">Share</div><p>A&nbsp;&lt;b&gt; &am</p></article>
<div id="comments"><p>Nice article, thanks for writing all this down for us, dear author of the text.</p></div><footer>&copy; x</footer>"""


def test_main_text(spark):
    expect = "Head & line\nBold start of text\nSecond.\nA <b> &am"
    assert mainhtml.main_text(PAGE) == expect
    loose = ("<body><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><div class=sidebar>Also read this long list of things that we have for you today.</div>"
             "<p>" + "Main words go on. " * 8 + "</p><p>Short.</p><p>" + "More of the main words. " * 6 + "</p><form>Mail <input name=a></form><div><a href=z>next</a></div>")
    assert mainhtml.main_text(loose) == "\n".join([("Main words go on. " * 8).strip(), "Short.", ("More of the main words. " * 6).strip()])
    rows = [(1, PAGE, "u"), (1, PAGE, None), (2, None, "u"), (3, "", "u"), (4, "<", "u"), (5, "plain words", "u"), (6, "<p>" * 50000 + "x", "u"), (None, "<div class='ad'>no", "u")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    got = Counter((r.page_id, r.text) for r in mainhtml.extract(df).collect())
    assert got == Counter([(1, expect), (1, expect), (2, ""), (3, ""), (4, "<"), (5, "plain words"), (6, "x"), (None, "")])
    assert mainhtml.extract(df.limit(0)).count() == 0


LONG = ["First words of the main text, which go on for some time to fill a line.", "Second lot of words of the main text, long enough to stand by itself here.",
        "Third part of the text with many more words, so that a window of lines surges."]


def test_windows_decide_where_articles_are_marked():
    """Real text in a plain div; teaser cards and reader comments are articles in furniture, closed properly."""
    teaser = "<aside class=related><article><h3>Other story</h3><p>A teaser of another story that is long enough to surge all alone, if shown.</p></article></aside>"
    comment = "<section id=comments><article class=comment><p>A reader has written a long comment about what the text says here.</p></article></section>"
    body = "".join(f"<p>{x}</p>" for x in LONG)
    for page in (f"<body><div id=text>{body}</div>{teaser}{comment}</body>", f"<body>{teaser}<article>{body}{teaser}</article>{comment}</body>",
                 f"<body><div id=text>{body}</div><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul><article><p>A small card that surges, but less than the text.</p></article></body>"):
        assert mainhtml.main_text(page) == "\n".join(LONG), page
    for never in ("<nav><a href=x>Home</a>", "<div class=sidebar><ul><li>One"):     # furniture that was never closed does not take the article along
        assert mainhtml.main_text(f"<body><div>{never}<article>{body}</article></div></body>") == "\n".join(LONG), never
    titled = f"<article><h2>T</h2><p><a href=a>By me</a></p>{body}<p><a href=b>Source</a></p></article>"
    assert mainhtml.main_text(titled).split("\n") == ["T", "By me", *LONG, "Source"]


def test_furniture_inside_the_text_does_not_end_it():
    box = "<div class=newsletter><p>Sign up</p><p>Get all our mail</p><p>It is free</p><p>No spam</p></div>"
    links = "<ul>" + "".join(f"<li><a href={i}>Another story of ours, number {i}</a></li>" for i in range(4)) + "</ul>"
    foot = "<div id=foot><p>" + "Words about the firm that made this page. " * 2 + "</p></div>"
    for middle in (box, links, box + links + box):
        page = f"<body><div id=text><p>{LONG[0]}</p>{middle}<p>{LONG[1]}</p><p>{LONG[2]}</p></div>{links}{foot}</body>"
        assert mainhtml.main_text(page) == "\n".join(LONG), middle


@pytest.mark.parametrize("attrs", ['class="has-sidebar"', 'class="no-sidebar"', "class='layout with-sidebar'", "class=social-science", 'class="search-results"',
                                   'class="single-comments-open"', 'id="side"', 'role="search"'])
def test_words_do_not_hide_a_wrapper(attrs):
    body = "".join(f"<p>{x}</p>" for x in LONG)
    side = "<div class=sidebar><p>A box beside the text that has words enough to surge if it were shown.</p></div>"
    notes = "<div class=comments>" + "<div class=comment><p>A comment by a reader who has much to say about this page here.</p></div>" * 2 + "</div>"
    for inner in (body, f"<article>{body}</article>", f"<main>{body}</main>", f"<div><div>{body}</div></div>"):
        for page in (f"<div {attrs}>{inner}</div>", f"<div {attrs}>{inner}{side}</div>", f"<nav><a href=/>Home</a></nav><div {attrs}>{side}{inner}{notes}</div><footer>The end</footer>"):
            assert mainhtml.main_text(f"<html><body>{page}</body></html>") == "\n".join(LONG), page
    assert mainhtml.main_text(f"<body><div>{body}</div><div {attrs}><p>{LONG[0]}</p></div></body>") == "\n".join(LONG)


def test_sibling_texts_and_linked_paragraphs_stay():
    links = "<ul>" + "".join(f"<li><a href={i}>Another story of ours, number {i}</a></li>" for i in range(4)) + "</ul>"
    more = ["A second part of the text in an element of its own, of about the same length.", "It has some lines as well, and these would be lost with the smaller part.",
            "So all parts that are long enough are kept, whatever element they are in here."]
    parts = ["".join(f"<p>{x}</p>" for x in p) for p in (LONG, more)]
    for page in (f"<body><div>{parts[0]}</div>{links}<div>{parts[1]}</div></body>", f"<body><div><div>{parts[0]}</div></div>{links}<section>{parts[1]}</section></body>"):
        assert mainhtml.main_text(page) == "\n".join(LONG + more), page
    linked = "Read <a href=1>this long story about something else entirely</a>, please, <a href=2>and then that one too</a>."
    assert mainhtml.main_text(f"<div><p>{LONG[0]}</p><p>{linked}</p><p>{LONG[1]}</p><p>{LONG[2]}</p></div>") == "\n".join(
        [LONG[0], "Read this long story about something else entirely, please, and then that one too.", *LONG[1:]])


def test_windows_follow_their_definition():
    """Pages of plain paragraphs in one element against the definition: a stretch goes from a line of text whose window sum surges to the
    first window without text."""
    rnd = random.Random(3)
    for _ in range(300):
        size = [rnd.choice([0, 0, 5, 30, 70]) for _ in range(rnd.randint(1, 30))]
        lines = [("x" * n, n) if n else ("link", 0) for n in size]
        page = "<body><div>" + "".join(f"<p>{t}</p>" if n else f"<p><a href=a>{t}</a></p>" for t, n in lines) + "</div></body>"
        sums = [sum(size[i:i + 3]) for i in range(len(size))]
        kept, inside = [], False
        for i, (t, n) in enumerate(lines):
            inside = sums[i] > 0 and (inside or (sums[i] >= mainhtml.SURGE and n > 0))
            kept += [t] if inside and n else []
        assert mainhtml.main_text(page) == "\n".join(kept or [t for t, _ in lines]), page
