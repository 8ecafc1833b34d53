"""Links from tables of forms, near keys by hashes, and the search index, each at size."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import links, relate
from foliospark.operators.postings import TrigramIndex


def brute(html, forms):
    """The same by one alternation, the longest form first, on the runs of text outside of tags and anchors."""
    pattern = re.compile("|".join(re.escape(f) for f in sorted(forms, key=lambda f: (-len(f), f))))
    out, at, inside = [], 0, 0
    for tag in [*re.finditer("<[^>]*>", html), None]:
        part = html[at : tag.start() if tag else len(html)]
        out.append(part if inside else pattern.sub(lambda m: forms[m[0]], part))
        if tag:
            out.append(tag[0])
            inside = inside + 1 if re.match(r"<a[\s>]", tag[0], re.I) else max(0, inside - 1) if re.match(r"</a\s*>", tag[0], re.I) else inside
            at = tag.end()
    return "".join(out)


def pages(seed=3, n=60):
    r = random.Random(seed)
    piece = lambda: r.choice(["a", "b", "ab", "ba", "c", " ", "é", "木耳", "水", "&amp;", "<b>", "</b>", '<a href="x">', "</A >", "<br/>", "<abbr>"])
    return ["".join(piece() for _ in range(r.randrange(80))) for _ in range(n)]


FORMS = {f: f'<a href="#{k}">{f}</a>' for k, f in enumerate(["a", "ab", "aba", "bab", "b a", "ba", "水木耳", "木耳", "&amp;", "c", "cab", "éa"])}


@pytest.mark.parametrize("most", [links.FORM_CHARS, 60])
def test_overlapping_forms(spark, most):
    rows = pages() + [None, "", "no"]
    df = spark.createDataFrame([(i, t, "f") for i, t in enumerate(rows)], "i int, html string, form string")
    table = spark.createDataFrame([*FORMS.items(), ("a", "~later"), ("", "x"), (None, "y"), ("q", None)], "form string, link string")
    got = {r.i: r.html for r in links.link_table(df, "html", table, most).collect()}
    assert got == {i: t if t is None else brute(t, FORMS) for i, t in enumerate(rows)}
    some = spark.createDataFrame([(1, rows[:20] + [None]), (2, None), (3, [])], "i int, rows array<string>")
    got = {r.i: r.rows for r in links.link_table(some, "rows", table, most).collect()}
    assert got == {1: [brute(t, FORMS) for t in rows[:20]] + [None], 2: None, 3: []}
    assert links.link_table(some, "rows", table.limit(0)).first().rows == rows[:20] + [None]


def test_a_hundred_thousand_forms():
    """Time goes with the text, not with the number of forms."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9)))
    text = " ".join(word() for _ in range(40_000))
    forms = sorted({word() for _ in range(300_000)})[:100_000]
    took = {}
    for n in (1_000, 100_000):
        known = links.Forms([(f, f"<{f}>") for f in forms[:: len(forms) // n]])
        start = time.time()
        found = known.found(text)
        took[n] = time.time() - start
    assert len(found) > 10_000 and took[100_000] < 20 * took[1_000] + 0.5
    chosen = {f: f"<{f}>" for f in forms[::1000]}
    few = links.Forms(sorted(chosen.items()))
    assert links.with_links(text, ((a, b, few.links[k]) for a, b, k in few.found(text))) == brute(text, chosen)


def test_form_links(spark):
    index = spark.createDataFrame([("木耳", "水木耳", 79), ("A&B菜", "A&B菜", 1)], "base string, form string, n int")
    rows = spark.createDataFrame([("水木耳 二钱 A&amp;B菜",)], "html string")
    assert links.link_table(rows, "html", links.form_links(index)).first().html == (
        '<a class="ing" href="../ingredients/木耳.html#v-水木耳" title="水木耳·79 道菜">水木耳</a> 二钱 '
        '<a class="ing" href="../ingredients/A&amp;B菜.html#v-A&amp;B菜" title="A&amp;B菜·1 道菜">A&amp;B菜</a>'
    )


# --- keys one character apart --------------------------------------------------------


def test_near_keys(spark):
    r = random.Random(2)
    words = {"".join(r.choice("ab𝒳é") for _ in range(r.randint(1, 5))) for _ in range(120)}
    rows = [(r.choice("gh"), w, k) for k, w in enumerate(sorted(words))]
    rows += rows[:5] + [("g", None, 900), ("g", "", 901), (None, "aaa", 902)]
    df = spark.createDataFrame(rows, "g string, word string, k int")
    got = sorted((x.g, x.word, x.k, x.other, x.n) for x in relate.one_char_pairs(df, df.withColumnRenamed("k", "n"), "word", ["g"]).collect())
    apart = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
    want = sorted((g, a, i, b, j) for g, a, i in rows for h, b, j in rows if g and g == h and a and b and apart(a, b))
    assert got == want and want


def test_very_long_keys(spark):
    """A key of 100,000 letters is 100,000 numbers, not 100,000 texts."""
    r = random.Random(5)
    base = [r.choice("abc") for _ in range(100_000)]
    one, two = list(base), list(base)
    one[70_000] = "x"
    two[3], two[99_999] = "x", "y"
    keys = ["".join(x) for x in (base, one, two)]
    df = spark.createDataFrame([(k, x, 0) for k, x in enumerate(keys)], "k int, word string, g int")
    got = relate.one_char_pairs(df, df.withColumnRenamed("k", "n"), "word", ["g"]).select("k", "n").collect()
    assert sorted(map(tuple, got)) == [(0, 1), (1, 0)]


def test_folded_key_is_of_full_and_half_width(spark):
    df = spark.createDataFrame([("Ａ１ｱ（注）－x",), (None,)], "t string")
    assert [r.f for r in df.select(T.fold_title(F.col("t")).alias("f")).collect()] == ["A1アx", None]


# --- search ----------------------------------------------------------------------------------


def plain_files(df):
    """How many files a plan without adaptive execution has read."""
    df.collect()
    leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_search_index(spark, tmp_path):
    r = random.Random(4)
    say = lambda: "".join(r.choice("abcdé ") for _ in range(r.randint(0, 60)))
    schema = "b string, u string, c string, s string"
    rows = [("b%d" % (k % 4), f"u{k:03d}", r.choice("xy"), say()) for k in range(200)]
    rows += [("b1", "n1", "x", None), ("b1", "e1", "x", ""), ("b2", "l1", "y", "ab " * 50_000 + "needle"), rows[7], rows[7]]
    index = TrigramIndex(spark, f"{tmp_path}/index", 16)
    index.put(spark.createDataFrame(rows, schema))

    def same(rows):
        for term in ("", "ab", " b a", "needle", "zzz", "é a"):
            for equal in ({}, {"b": "b1"}, {"c": "x", "b": ""}):
                want = sorted((x for x in rows if x[3] is not None or not term.strip()), key=lambda x: (x[0], x[1]))
                want = [x for x in want if term.strip() in (x[3] or "") and all(not v or x[schema.split(", ").index(f"{k} string")] == v for k, v in equal.items())]
                got = [tuple(x[c] for c in ("b", "u", "c", "s")) for x in index.search(term, **equal).collect()]
                assert got == want, (term, equal)

    same(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        every = plain_files(spark.read.parquet(f"{tmp_path}/index/postings"))
        assert plain_files(index.candidates("needle")) <= 6 * every / 16 + 4 < every
        assert index.candidates("ab") is None
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    delta = [("b1", f"u{k:03d}", "x", say()) for k in range(20)] + [("b9", "u1", "x", "needle again")]
    index.put(spark.createDataFrame(delta, schema))
    rows = [x for x in rows if x[0] != "b1"] + delta
    same(rows)
    index.compact()
    assert len(index._generations()) == 1
    same(rows)


# --- places, parts and rows ---------------------------------------------------------------------


def test_numbered_with_a_hot_group(spark):
    from foliospark.operators.order import numbered

    r = random.Random(3)
    rows = [(r.choice(["hot"] * 6 + ["a", None]), r.randrange(50), k) for k in range(3000)]
    got = numbered(spark.createDataFrame(rows, "g string, o int, k int").repartition(7), ["g"], ["o", "k"]).collect()
    by = {}
    for g, o, k in sorted(rows, key=lambda x: (x[0] or "", x[1], x[2])):
        by.setdefault(g, []).append((o, k))
    assert sorted(((x.g, x.o, x.k, x.place, x.n) for x in got), key=str) == sorted(((g, o, k, i, len(own)) for g, own in by.items() for i, (o, k) in enumerate(own)), key=str)
    assert numbered(spark.createDataFrame([], "g string, o int"), ["g"], ["o"]).collect() == []


def test_parts_like_a_loop(spark):
    from foliospark.sources import io

    def loop(sizes, most_pages, most_bytes):
        out, start, part = [], 0, 1
        while start < len(sizes):
            n = min(most_pages, len(sizes) - start)
            while n > 1 and sum(sizes[start : start + n]) > most_bytes:
                n = min(max(1, int(n * (most_bytes / sum(sizes[start : start + n])) * 0.97)), n - 1)
            out += [part] * n
            start, part = start + n, part + 1
        return out

    r = random.Random(6)
    books = {f"b{k}": [r.choice([1, 5, 30, 90, 400]) for _ in range(n)] for k, n in enumerate((1, 2, 7, 40, 1500))}
    books["small"] = [1] * 95
    df = spark.createDataFrame([(b, 3 * i, s) for b, own in books.items() for i, s in enumerate(own)], "b string, p int, s int").repartition(5)
    for most_pages, most_bytes in ((10, 200), (7, 10_000), (20, 90)):
        got = {}
        for x in io.split_ranges(df, ["b"], "p", "s", most_pages, most_bytes).orderBy("b", "p").collect():
            got.setdefault(x.b, []).append(x.part)
        assert got == {b: loop(own, most_pages, most_bytes) for b, own in books.items()}
    assert io.split_ranges(df.limit(0), ["b"], "p", "s").count() == 0


def test_parts_of_long_documents_in_runs(spark, monkeypatch):
    """Documents of many runs of pages, put together over several levels, are parted as a walk from the first page does."""
    from foliospark.sources import io

    monkeypatch.setattr(io, "RUN", 10)
    monkeypatch.setattr(io, "FAN", 3)
    r = random.Random(8)
    books = {f"b{k}": [r.choice([1, 5, 30, 90, None]) for _ in range(n)] for k, n in enumerate((9, 10, 11, 20, 21, 30, 400, 1003))}
    df = spark.createDataFrame([(b, 3 * i, s) for b, own in books.items() for i, s in enumerate(own)], "b string, p int, s int").repartition(5)
    for most_pages, most_bytes in ((10, 200), (7, 10_000), (13, 90)):
        want = []
        for b, own in books.items():
            walk = io.part_starts([s or 0 for s in own], len(own), 0, most_pages, most_bytes)
            want += [(b, k, 3 * x, 3 * (y - 1), y - x) for k, (x, y) in enumerate(walk, 1)]
        got = io.part_ranges(df, ["b"], "p", "s", most_pages, most_bytes)
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert got.columns == ["b", "part", "first_page", "last_page", "n_pages"]


def test_fifty_thousand_blocks_on_a_page(spark):
    from foliospark.operators import layout

    r = random.Random(2)
    rows = [(1, k, float(r.randrange(100)), y := r.random() * 400_000, y + r.choice([8.0, 10.0, 0.0])) for k in range(50_000)]
    df = spark.createDataFrame(rows, "page int, ord int, x0 double, y0 double, y1 double")
    start = time.time()
    got = {x.ord: x.row_no for x in layout.printed_rows(df, ["page"]).collect()}
    assert time.time() - start < 30
    no, first, last, want = 0, 0.0, 0.0, {}
    for _, k, _, a, b in sorted(rows, key=lambda x: ((x[3] + x[4]) / 2, x[1])):
        low = min(b - a, last - first)
        if not (no and low > 0 and 2 * (min(last, b) - max(first, a)) >= low):
            no, first, last = no + 1, a, b
        want[k] = no
    assert got == want
