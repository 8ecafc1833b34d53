"""Annotations without loss, the file sink, and a whole site with its counters."""

import os
import random

import pytest
from pyspark.sql import functions as F

from foliospark.operators import site
from foliospark.sources import io
from foliospark.sources.files import save_files

RECORD = "book_id string, slug string, local_pages array<int>, ingredients array<string>, seasonings array<string>, steps array<string>, tips array<string>"
NOTE = "book_id string, local_page int, anchor string, note string, slug string"


def attach(rows, notes):
    """Marks behind the first place of each anchor in reading order: (rows, matched)."""
    left, matched, out = list(notes), [], []
    for row in rows:
        while at := [(row.find(a), k) for k, (_, a) in enumerate(left) if row.find(a) >= 0]:
            found, k = min(at)
            key, a = left.pop(k)
            matched.append(key)
            n = len(matched)
            row = row[: found + len(a)] + f'<sup class="fn"><a id="fnref-{n}" href="#fn-{n}">{n}</a></sup>' + row[found + len(a) :]
        out.append(row)
    return out, matched


def test_no_note_is_lost(spark):
    """A note whose anchor another mark parts goes to the next record that has it."""
    records = spark.createDataFrame([("b", "s1", [1], ["a b c"], [], [], []), ("b", "s2", [1], ["b c"], [], [], [])], RECORD)
    notes = spark.createDataFrame([("b", 1, "a b", "x", None), ("b", 1, "b c", "y", None), ("b", 1, "b c", "y", None)], NOTE)
    done, left = site.annotated(records, notes)
    got = {r.slug: len(r.numbers) for r in done.collect()}
    assert got == {"s1": 1, "s2": 1} or got == {"s1": 1, "s2": 2}
    assert left.count() == 3 - sum(got.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_claims_like_one_after_another(spark, seed):
    r = random.Random(seed)
    say = lambda n: "".join(r.choice("xyz ") for _ in range(n))
    rows = [("b%d" % (k % 2), f"s{k:02d}", sorted({r.randrange(4) for _ in range(2)}), [say(6)], [], [say(8)], []) for k in range(12)]
    appendix = [("b%d" % (k % 2), f"x{k:02d}", [k % 4], [say(7), say(5)]) for k in range(6)]
    notes = sorted({("b%d" % r.randrange(2), r.randrange(4), say(r.randint(1, 3)), f"n{k}", r.choice([None, None, "s03", "x02"])) for k in range(40)}, key=str)
    notes = [n for n in notes if n[2].strip() == n[2] and n[2]]
    df = spark.createDataFrame(notes, NOTE)
    ids = {tuple(x)[:5]: x.i for x in df.select("*", F.xxhash64(*df.columns, F.lit(1)).alias("i")).collect()}
    done, left = site.annotated(spark.createDataFrame(rows, RECORD), df, then=spark.createDataFrame(appendix, "book_id string, slug string, local_pages array<int>, body array<string>"))
    claimed, want = set(), {}
    for book, slug, pages, lines in [(b, s, p, [*i, *t]) for b, s, p, i, _, t, _ in rows] + appendix:
        lines = [x for x in lines if x.strip(" ")]
        mine = [(ids[n], n[2]) for n in notes if ids[n] not in claimed and (n[4] == slug if n[4] else n[0] == book and n[1] in pages)]
        html, matched = attach(lines, sorted(mine))
        claimed |= set(matched)
        if matched:
            want[slug] = (html, matched)
    got = {x.slug: ([y for part in x.html for y in part], x.numbers) for x in done.collect()}
    assert got == want
    assert sorted(map(tuple, left.collect()), key=str) == [n for n in notes if ids[n] not in claimed]


# --- the sink -----------------------------------------------------------------------------


def tree(folder):
    return {os.path.relpath(f"{d}/{x}", folder): open(f"{d}/{x}").read() for d, _, names in os.walk(folder) for x in names if not x.endswith(".crc")}


def test_sink_is_all_or_nothing(spark, tmp_path):
    folder = f"{tmp_path}/out"
    files = lambda n, tail="": spark.range(n).select(F.format_string("d%d/f%03d.txt", F.col("id") % 3, "id").alias("file_name"), F.concat(F.col("id").cast("string"), F.lit(tail)).alias("body"))
    assert io.write_files(files(20), f"file://{folder}") == 20
    first = tree(folder)
    assert len(first) == 20 and first["d1/f001.txt"] == "1\n"
    failing = files(40, "!").repartition(4).withColumn("body", F.when(F.col("body") == "33!", F.raise_error(F.lit("no"))).otherwise(F.col("body")))
    for overwrite in (False, True):
        with pytest.raises(Exception, match="no"):
            save_files(failing, f"file://{folder}", overwrite=overwrite)
        assert tree(folder) == first
    assert io.write_files(files(25, "?").filter("body != '3?'"), f"file://{folder}") == 24
    assert tree(folder)["d0/f003.txt"] == "3\n" and len(tree(folder)) == 25
    assert io.write_files(files(2, "~"), f"file://{folder}", overwrite=True) == 2
    assert tree(folder) == {"d0/f000.txt": "0~\n", "d1/f001.txt": "1~\n"}
    assert io.write_files(files(0), f"file://{folder}", overwrite=True) == 0
    assert tree(folder) == {}
    with pytest.raises(Exception, match="no name"):
        save_files(files(1).withColumn("file_name", F.lit("")), f"file://{folder}")


# --- the site -------------------------------------------------------------------------------


def site_tables(spark, more=True):
    own = RECORD.replace("slug string", "slug string, title string, aliases array<string>")
    rows = [
        ("b1", "b1-p0011-x", "净炒肉片", ["又名"], [11], ["主料：水木耳 二钱", "配料：食盐 五分"], [], ["1. 下锅炒熟。"], []),
        ("b1", "b1-p0012-y", "大炒肉片", [], [12], ["主料：木耳 一两"], None, ["1. 出锅。"], ["香"]),
        ("b2", "b2-p0003-z", "甲<乙", None, [3, 4], ["食盐 一钱"], [], [], []),
    ]
    records = spark.createDataFrame(rows if more else rows[:2], own)
    fallbacks = spark.createDataFrame([("b1", 90, ["前言 食盐", "第二段"]), ("b1", 91, ["工艺"]), ("b1", 92, []), ("b2", 1, ["目录"])], "book_id string, local_page int, body array<string>")
    articles = spark.createDataFrame([("b1", 90, "前言", "专文", 1), ("b1", 91, "工艺", "附录", 2), ("b1", 92, "工艺", "附录", 3), ("b1", 99, "无", "附录", 4)], "book_id string, local_page int, article string, kind string, ord int")
    anchors = spark.createDataFrame([("b1", 10, "荤菜", 1), ("b1", 12, "素菜", 2), ("b1", 12, "汤", 3), ("b1", 5, " ", 0)], "book_id string, local_page int, category string, ord int")
    notes = spark.createDataFrame([("b1", 11, "木耳", "n1", None), ("b1", 90, "前言", "n2", None), ("b1", 12, "没有", "n3", None), ("b9", 1, "香", "n4", "b1-p0012-y")], NOTE)
    return records, fallbacks, articles, anchors, notes


def test_build_site(spark, tmp_path):
    from foliospark.plans.site import build_site

    folder = f"{tmp_path}/site"
    got = build_site(f"file://{folder}", *site_tables(spark), per_page=2, per_data=2)
    assert got == {
        "records": 3, "pruned": 0, "appendix_pages": 3, "appendix_pruned": 0, "fallbacks_skipped": 1, "ingredient_pages": 2, "ingredient_variants": 3, "ingredients_pruned": 0,
        "categories": 3, "uncategorized": 1, "annotations": 4, "annotations_rendered": 3, "annotations_unmatched": 1,
    }
    files = tree(folder)
    assert {f for f in files if f.endswith((".html", ".js"))} == {
        "index.html", "index-2.html", "records/b1-p0011-x.html", "records/b1-p0012-y.html", "records/b2-p0003-z.html", "appendix/b1-p0090.html", "appendix/b1-p0091.html", "appendix/b1-p0092.html",
        "appendix/index.html", "appendix/index-2.html", "ingredients/index.html", "ingredients/木耳.html", "ingredients/食盐.html", "data/data-00000.js", "data/data-00001.js",
    }
    page = files["records/b1-p0011-x.html"]
    assert '<a class="ing" href="../ingredients/木耳.html#v-水木耳" title="水木耳·1 道菜">水木耳</a>' in page.replace('<sup class="fn"><a id="fnref-1" href="#fn-1">1</a></sup>', "") or "木耳<sup" in page
    assert "b1 · 第 11 页 · 荤菜" in page and "又作：又名" in page and 'title="食盐·2 道菜">食盐</a>' in page
    assert "素菜" in files["records/b1-p0012-y.html"] and "香<sup" in files["records/b1-p0012-y.html"]
    assert "甲&lt;乙" in files["records/b2-p0003-z.html"] and "未分类" in files["records/b2-p0003-z.html"]
    assert "前言<sup" in files["appendix/b1-p0090.html"] and 'title="食盐·2 道菜">食盐</a>' in files["appendix/b1-p0090.html"]
    assert 'class="next" href="b1-p0092.html"' in files["appendix/b1-p0091.html"] and "工艺（1/2）" in files["appendix/b1-p0091.html"]
    assert 'class="next" href="index-2.html"' in files["appendix/index.html"] and "b2-p0001" in files["appendix/index-2.html"]
    assert '<span id="v-木耳">木耳</span> · 1</h2><ul><li><a href="../records/b1-p0012-y.html">大炒肉片</a>' in files["ingredients/木耳.html"].replace("\n", "")
    assert files["data/data-00000.js"].startswith('SITE_DATA.push({"u":"b1-p0011-x"') and '"c":"未分类"' in files["data/data-00001.js"]
    again = build_site(f"file://{folder}", *site_tables(spark, more=False), per_page=2, per_data=2)
    assert (again["records"], again["pruned"], again["ingredients_pruned"], again["appendix_pruned"], again["categories"]) == (2, 1, 0, 0, 2)
    assert "records/b2-p0003-z.html" not in tree(folder) and "data/data-00001.js" not in tree(folder)


def test_empty_site(spark, tmp_path):
    from foliospark.plans.site import build_site

    got = build_site(f"file://{tmp_path}/site", *(df.limit(0) for df in site_tables(spark)))
    assert set(got.values()) == {0} and len(got) == 13


def test_paged_hot_list(spark):
    """A list that most rows belong to is many files, in order, without a gap."""
    from foliospark.plans.site import paged

    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"), F.lit("T").alias("title"), F.col("id").alias("o"), F.col("id").cast("string").alias("x"))
    files = {r.file_name: r for r in paged(rows.repartition(5), ["o"], 300).collect()}
    assert max(r.n for r in files.values()) == 300 and sum(r.n for r in files.values()) == 5000
    import re

    told = [int(x) for k in range(14) for x in re.findall(r"<li>(\d+)</li>", files["hot.html" if not k else f"hot-{k + 1}.html"].body)]
    assert told == [i for i in range(5000) if i % 10 < 8]
