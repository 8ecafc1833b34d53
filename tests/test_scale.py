"""What larger tables showed: plans and values that small ones do not."""

import os
import tempfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliospark.functions import grammar
from foliospark.operators import links, order, relate
from foliospark.operators.postings import TrigramIndex, distinct_codes
from foliospark.queries import QUERIES
from foliospark.sources import files


def test_aliases_send_no_side_to_all_executors(spark):
    e = spark.createDataFrame([("b", "红烧鱼", 1)], "book_id string, title string, local_page int")
    r = spark.createDataFrame([("b", "r1", "红烧肉", [1], ["焖肉"])], "book_id string, rec_id string, title string, local_pages array<int>, aliases array<string>")
    named = spark.createDataFrame([("b", 2, "焖鸡", "红烧肉")], "book_id string, local_page int, alias string, title string")
    found = relate.contents_aliases(e, r, named)
    assert [tuple(x) for x in found.collect()] == [("b", "r1", "红烧鱼")]
    given = relate.manual_aliases(r, named)
    for df in (found, given):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_index_pages_of_keys_of_seven_digits(spark):
    parts = [(k, f"p{9999999 - k}", "Brand#1", "T", 10, 1.0) for k in (999999, 1000000, 1000001, 1000009, 1000010)]
    tables = {
        "part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": spark.createDataFrame([(1, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    }
    with tempfile.TemporaryDirectory() as d:
        for name, df in tables.items():
            df.orderBy(df.columns[0], ascending=False).coalesce(1).write.parquet(f"{d}/{name}.parquet")
        got = QUERIES["index_pages"](spark, d).filter("file_name = 'books'").orderBy("line_no").collect()
    pages = ["1000000", "1000001", "1000009", "1000010", "999999"]  # in the order of padded texts
    assert [x.line for x in got] == ["# 书目索引", "## Brand#1", *(f"- [[n{p}]]" for p in pages), ""]


def test_equal_lines_are_parsed_once_a_batch(spark):
    asked = spark.sparkContext.accumulator(0)

    class Counted(grammar.Grammar):
        def line(self, text):
            asked.add(1)
            return super().line(text)

        def _names(self, line):
            asked.add(1)
            return super()._names(line)

    said, kept = ["肉 一斤 葱 二两", "调料：盐 一钱", None], grammar.grammar
    df = spark.createDataFrame([(k, said[k % 3]) for k in range(600)], "k int, t string").coalesce(1)
    lines = F.array(F.col("t"), F.lit("葱 二两"), F.col("t"))
    grammar.grammar = lambda v: Counted(v)
    try:
        parsed = df.select("k", grammar.parse_line(F.col("t")).alias("p")).collect()
        terms = df.filter("t is not null").select("k", grammar.extract_terms(lines).alias("p")).collect()
    finally:
        grammar.grammar = kept
    for x in parsed:
        items, last = kept().line(said[x.k % 3] or "")
        assert ([tuple(i) for i in x.p["items"]], x.p["last"]) == (items, last)
    for x in terms:
        assert x.p == kept().terms([said[x.k % 3], "葱 二两", said[x.k % 3]])
    assert 0 < asked.value <= 6


def test_links_take_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    try:
        df = spark.createDataFrame([("a <b>", None)], "t string, u string")
        got = df.select(links.linkify(F.col("t"), {"a": "#a"}).alias("t"), links.linkify(F.col("u"), {"a": "#a"}).alias("u")).first()
        assert tuple(got) == ('<a href="#a">a</a> <b>', None)
        assert int(spark.conf.get(key)) == links.BATCH_ROWS
    finally:
        spark.conf.unset(key)


def test_postings_are_lists(spark, tmp_path):
    said = ["abab", "xbab", None, "ab", "a\x00b😀c"] * 300
    rows = [("x" if k % 7 else "y", k, s) for k, s in enumerate(said)]
    index = TrigramIndex(spark, f"{tmp_path}/index", 4)
    index.put(spark.createDataFrame(rows, "b string, u long, s string").coalesce(1))
    kept = spark.read.parquet(f"{tmp_path}/index/postings").collect()
    held = {(x.gram, x.b, u) for x in kept for u in x.us}
    assert held == {(s[i : i + 3], b, u) for b, u, s in rows for i in range(len(s or "") - 2)}
    assert len(held) == sum(len(x.us) for x in kept) and 10 * len(kept) < len(held)
    assert distinct_codes("abcabd" * 5, 4).tolist() == distinct_codes("abcabd" * 5).tolist()


def test_pages_are_dealt_by_their_number(spark, tmp_path):
    """Rows of one small file: marks, links and writes are many tasks' work."""
    from foliospark.plans.site import _marked

    spark.range(8000).select(F.lit("b").alias("book_id"), F.concat(F.lit("s"), "id").alias("slug"), F.array(F.lit("盐"), F.lit(" ")).alias("steps")).coalesce(1).write.parquet(f"{tmp_path}/rows")
    done = spark.createDataFrame([("b", "s7", [["盐<sup>1</sup>"]], [5], 0)], "book_id string, slug string, html array<array<string>>, numbers array<long>, kind int")
    forms = spark.createDataFrame([("盐", "<a>盐</a>")], "form string, link string")
    t = _marked(spark.read.parquet(f"{tmp_path}/rows"), ("steps",), done, 0, forms)
    sizes = [x["count"] for x in t.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 3000 and sum(sizes) == 8000
    assert t.filter("html != array(array('<a>盐</a>'))").select("slug", "html", "numbers").collect() == [("s7", [["<a>盐</a><sup>1</sup>"]], [5])]


def test_rows_are_dealt_by_their_number(spark):
    df = spark.range(5000)
    tasks = lambda *a: order.dealt(df, ["id"], *a).rdd.getNumPartitions()
    assert (tasks(), tasks(500), order.dealt(df.limit(0), ["id"]).rdd.getNumPartitions()) == (4, 10, 1)


def test_files_are_made_aside_in_a_folder_of_the_attempt(tmp_path):
    opened, moved = [], []

    class Store:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            return getattr(self.store, name)

        def open_output_stream(self, path):
            opened.append(path)
            return self.store.open_output_stream(path)

        def move(self, a, b):
            moved.append((a, b))
            if b.endswith("bad"):
                raise OSError("no")
            self.store.move(a, b)

    class Writer(files.FilesWriter):
        def _open(self):
            store, *rest = super()._open()
            return Store(store), *rest

    w = Writer(f"file://{tmp_path}/out", True)
    batch = lambda *names: iter([pa.record_batch({"name": list(names), "body": [None] * len(names)})])
    staged = w._open()[2]
    with pytest.raises(OSError):
        w.write(batch("a", "bad"))
    assert os.listdir(staged) == ["a"]  # an attempt that fails leaves nothing aside
    assert [w.write(batch("a", "d/b")).n, w.write(batch("c")).n, w.write(iter([])).n] == [2, 1, 0]
    asides = [os.path.dirname(x) for x in opened]
    assert len(opened) == 5 and len(set(asides)) == 3 and not set(asides) & {os.path.dirname(b) for _, b in moved}
    w.commit([])
    assert sorted(os.path.relpath(f"{d}/{x}", f"{tmp_path}/out") for d, _, names in os.walk(f"{tmp_path}/out") for x in names) == ["a", "c", "d/b"]
    assert sorted(os.listdir(tmp_path)) == ["out"] and sorted(os.listdir(f"{tmp_path}/out")) == ["a", "c", "d"]


def test_site_sends_no_records_to_all_executors(spark, tmp_path, monkeypatch):
    from foliospark.operators import site
    from foliospark.plans.site import _marked

    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept = site.materialize
    monkeypatch.setattr(site, "materialize", lambda df, label: (plans.append(plan(df)), kept(df, label))[1])
    own = spark.createDataFrame([("b", "s1", [1], ["a b"]), ("b", "s2", [1], ["b c"])], "book_id string, slug string, local_pages array<int>, steps array<string>")
    own.write.parquet(f"{tmp_path}/r")
    r = spark.read.parquet(f"{tmp_path}/r")
    notes = spark.createDataFrame([("b", 1, "a", "x", None), ("b", 1, "c", "y", "s2")], "book_id string, local_page int, anchor string, note string, slug string")
    done, left = site.annotated(r, notes, ("steps",), then=r.withColumn("slug", F.concat(F.lit("x"), "slug")), then_sections=("steps",))
    marked = _marked(r, ("steps",), done, 0, spark.createDataFrame([("b", "<a>b</a>")], "form string, link string"))
    pages = r.select("slug", "steps")
    plans += [plan(left), plan(marked), *map(plan, relate.article_plan(r.select("slug", F.col("book_id").alias("article"), F.lit(1).alias("ord")), pages, ["slug"]))]
    assert len(plans) > 6 and not [p for p in plans if "Broadcast" in p]
    assert left.count() == 0 and sorted(len(x.numbers) for x in marked.collect()) == [1, 1]
