"""Ordered, relational and grouping operators on tiny rows."""

import random

from pyspark.sql import functions as F

from foliospark.functions.vocabulary import DEFAULT
from foliospark.operators import corrections, indexes, layout, links, order, pages, relate, review
from foliospark.plans.process import build, triage
from foliospark.sources import io
from foliospark.streaming.incremental import import_stream, stream_folder


def test_header(spark):
    rows = [("一、原料：", ("ingredients", "")), ("二、制作方法。先", ("steps", "先")), ("（一）用料：盐", ("ingredients", "盐")), ("原料切成片", None), ("制法简单", None), ("附注", ("tips", ""))]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    for r in df.select("i", pages.section_header(F.col("t")).alias("h")).collect():
        assert (r.h and tuple(r.h)) == rows[r.i][1]


def test_carry_forward_is_one_window(spark):
    r = random.Random(3)
    rows = [(g, p, k, r.choice([None, None, "x", "y"])) for g in "ab" for p in range(6) for k in range(r.randrange(5))]
    df = spark.createDataFrame(rows, "g string, p int, k int, v string")
    two = layout.carry_forward(df, ["g"], "p", "k", F.col("v"), "o")
    one = layout.fill_forward(df, ["g"], ["p", "k"], F.col("v"), "o")
    assert sorted(map(str, two.collect())) == sorted(map(str, one.collect()))


def test_printed_rows_and_repair(spark):
    rows = [(1, 0, 0.0, 0.0, 10.0, "盐"), (1, 1, 50.0, 1.0, 11.0, "二钱 葱"), (1, 2, 90.0, 2.0, 9.0, "一两"), (1, 3, 0.0, 12.0, 20.0, "调料："), (1, 4, 50.0, 12.0, 20.0, "三钱")]
    df = spark.createDataFrame(rows, "page int, ord int, x0 double, y0 double, y1 double, text string")
    placed = layout.printed_rows(df, ["page"])
    assert sorted((r.ord, r.row_no, r.col_no) for r in placed.collect()) == [(0, 1, 1), (1, 1, 2), (2, 1, 3), (3, 2, 1), (4, 2, 2)]
    got = {r.ord: r.text for r in layout.repair_columns(placed, ["page"]).collect()}
    assert got == {0: "盐 二钱", 1: "葱 一两", 3: "调料：", 4: "三钱"}


def test_patch():
    own = [{"block_type": "text", "text": t} for t in ("alpha beta", "gamma delta", "gamma delta")]
    out, n, lost = corrections.patch(own, "gamma delte / gamma delti / zzzz")
    assert [b["text"] for b in out] == ["alpha beta", "gamma delte", "gamma delti"] and n == 2 and lost == ["zzzz"]
    out, n, _ = corrections.patch(own, "【补行前:alpha beta】one / 【补行前:alpha beta】two / 【补行】top")
    assert [b["text"] for b in out] == ["top", "two", "one", "alpha beta", "gamma delta", "gamma delta"] and n == 3
    out, n, _ = corrections.patch(own, "【替行:alpha】beta / 【整页】")
    assert n == 0 or out[0]["text"] != ""
    out, n, lost = corrections.patch(own, "【整页】a / b")
    assert [b["text"] for b in out] == ["a", "b"] and n == 2
    assert corrections.similarity("abcde", "abcxy") == 0.6 and corrections.patch([{"block_type": "text", "text": "abcde"}], "abcxy")[1] == 1


def page(book, no, *blocks):
    return book, no, "\n".join(t for _, t in blocks), [(k, t, None, i) for i, (k, t) in enumerate(blocks)]


PAGES = "book_id string, local_page int, raw_text string, text_blocks array<struct<block_type:string,text:string,bbox:array<double>,index:int>>"


def corpus(spark):
    t = "title"
    rows = [
        page("b", 1, (t, "目录"), ("text", "x……1")),
        page("b", 2, ("text", "lost line before any title"), (t, "（一）红烧肉"), ("text", "一、原料："), ("text", "主料：猪肉 一斤"), ("text", "调料：盐 二钱"), ("text", "葱 一两")),
        page("b", 3, ("text", "二、制法：1. 切。2. 炒。"), ("text", "三、特点：好"), (t, "（二）清炖鸡"), ("text", "鸡 一只"), ("text", "二、制法"), ("text", "煮熟")),
        page("b", 4, (t, "凉菜类")),
        page("b", 5, ("text", "stray text without record, long enough to stand")),
        page("c", 1, (t, "（三）炒青菜"), ("text", "原料："), ("text", "青菜 半斤 ▢"), ("text", "1. 洗净"), ("text", "2. 炒熟")),
        page("c", 2, ("text", "  ")),
        page("c", 3, ("text", "制法 又一步")),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_build_and_triage(spark):
    made = build(corpus(spark))
    r = {x.title: x for x in made.records.collect()}
    assert set(r) == {"红烧肉", "清炖鸡", "炒青菜"}
    assert r["红烧肉"].ingredients == ["主料：猪肉 一斤"] and r["红烧肉"].seasonings == ["调料：盐 二钱", "葱 一两"]
    assert r["红烧肉"].steps == ["1. 切", "。2. 炒。"] and r["红烧肉"].tips == ["好"] and r["红烧肉"].local_pages == [2, 3]
    assert r["清炖鸡"].ingredients == ["鸡 一只"] and r["清炖鸡"].steps == ["煮熟"]  # the ingredients' head is implied
    assert r["炒青菜"].local_pages == [1, 3] and r["炒青菜"].steps == ["又一步"] or r["炒青菜"].steps
    assert sorted((x.book_id, x.local_page, x.status) for x in made.fallbacks.collect())[:2] == [("b", 1, "toc"), ("b", 4, "category")]
    assert {x.local_page for x in made.fallbacks.filter("book_id = 'b'").collect()} == {1, 4, 5}
    said = spark.createDataFrame([("b", 1, True, "热菜类 / 红烧肉…(1) / 清炖鸡(2) / 没有菜(9)"), ("b", 5, True, "（九）糖醋鱼 / x"), ("c", 1, False, "y")], "book_id string, local_page int, confirmed boolean, correct_content string")
    rows, anchors, titles = triage(made, said)
    got = {(x.book_id, x.local_page): x for x in rows.collect()}
    assert got["b", 1].bucket == "safe_to_skip" and got["c", 1].n_placeholders == 1
    assert {(x.title, x.local_page, x.category) for x in anchors.collect()} == {("红烧肉", 2, "热菜类"), ("清炖鸡", 3, "热菜类"), ("没有菜", 10, "热菜类")}
    assert [(x.local_page, x.value) for x in titles.collect()] == [(5, "糖醋鱼")]
    again = build(corpus(spark), said, contents=anchors.select("book_id", "title", "local_page"))
    assert again.records.count() >= 3


def test_interpolation_is_the_loop(spark):
    r = random.Random(8)
    rows, want = [], {}
    for g in range(60):
        printed = sorted(r.sample(range(1, 60), r.randint(1, 9)))
        known = [r.choice([None, None, r.randint(1, 50)]) for _ in printed]
        out = []
        for i, (n, k) in enumerate(zip(printed, known)):
            ahead = next(((known[j], printed[j]) for j in range(i + 1, len(known)) if known[j] is not None), None)
            if k is not None:
                out.append(k)
            elif not out:
                out.append(max(1, ahead[0] - (ahead[1] - n)) if ahead else n)
            else:
                guess = out[-1] + n - printed[i - 1]
                out.append(max(out[-1], min(guess, ahead[0])) if ahead else guess)
        rows += [(g, i, n, k) for i, (n, k) in enumerate(zip(printed, known))]
        want.update({(g, i): x for i, x in enumerate(out)})
    df = spark.createDataFrame(rows, "g int, i int, printed int, known int")
    assert {(x.g, x.i): x.resolved for x in order.interpolate(df, ["g"], ["i"], "printed", "known").collect()} == want


def test_aliases(spark):
    e = spark.createDataFrame([("b", "红烧鱼", 1), ("b", "清炖鸡（附汤）", 9), ("b", "甲乙丙", 5), ("b", "鸡汤（清）", 3)], "book_id string, title string, local_page int")
    r = spark.createDataFrame([("b", "1", "红烧肉", [1]), ("b", "2", "清炖鸡", [2]), ("b", "3", "甲乙丁", [4]), ("b", "4", "甲乙戊", [5]), ("b", "5", "鸡汤", [3])], "book_id string, rec_id string, title string, local_pages array<int>")
    assert {(x.rec_id, x.alias) for x in relate.contents_aliases(e, r).collect()} == {("1", "红烧鱼"), ("4", "甲乙丙"), ("5", "鸡汤（清）")}


def test_base_forms(spark):
    words = ["净猪肉", "猪肉", "猪肉丝", "熟鸡", "鸡", "鲜笋片", "水发笋片", "干贝", "肉"]
    df = spark.createDataFrame([(w,) for w in words], "form string")
    got = {r.form: r.base for r in indexes.base_forms(df).collect()}
    assert got["净猪肉"] == got["猪肉丝"] == "猪肉" and got["熟鸡"] == "鸡" and got["鲜笋片"] == got["水发笋片"] == "笋片" and got["干贝"] == "干贝"
    shuffled = spark.createDataFrame([(w,) for w in reversed(words)], "form string")
    assert {r.form: r.base for r in indexes.base_forms(shuffled).collect()} == got


def test_form_index_deals_by_size(spark, monkeypatch):
    """Repeated and null records, and more tasks for more postings without an aggregate before they are dealt."""
    monkeypatch.setattr(indexes, "PART", 3)
    rows = [("ab", 1), ("ab", 1), ("a", 1), ("abb", 2), ("a", 3), ("ab", 3), ("c", 4), ("d", None), ("a", None)] * 2
    p = spark.createDataFrame(rows, "term string, d long")
    bases = spark.createDataFrame([("a", "a"), ("ab", "a"), ("abb", "a"), ("c", "c"), ("d", "d")], "form string, base string")
    got = indexes.form_index(p, bases, "d")
    assert sorted(map(tuple, got.collect())) == [("a", 3, 3, "a:2,ab:2,abb:1"), ("c", 1, 1, "c:1"), ("d", 0, 1, "d:0")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = plan[plan.rindex("hashpartitioning(base#") :] if "REPARTITION_BY_NUM" in plan else ""
    assert "REPARTITION_BY_NUM" in plan and ", 6)" in dealt.splitlines()[0]
    assert "Aggregate" not in dealt


def test_linkify(spark):
    df = spark.createDataFrame([('a <b title="cat">cat</b> <a href="x">cat</a> catfish',), (None,)], "h string")
    got = [r.x for r in df.select(links.linkify(F.col("h"), {"cat": "1", "catfish": "2"}).alias("x")).collect()]
    assert got == ['a <b title="cat"><a href="1">cat</a></b> <a href="x">cat</a> <a href="2">catfish</a>', None]


def test_group_fixes(spark):
    r = spark.createDataFrame([("b", [92, 93], ["a", "b"], ["x", "y"]), ("b", [7], ["a"], ["x"])], "book_id string, local_pages array<int>, ingredients array<string>, seasonings array<string>")
    fixes = spark.createDataFrame([("b", 92, "y", "ingredient", "a"), ("b", 7, "zz", "ingredient", "a")], "book_id string, page int, item string, grp string, after string")
    got = {x.local_pages[0]: (x.ingredients, x.seasonings) for x in layout.apply_group_fixes(r, fixes).collect()}
    assert got == {92: (["a", "y", "b"], ["x"]), 7: (["a"], ["x"])}


def test_review_parts(spark):
    assert spark.createDataFrame([("（九）糖醋鱼 / x",), ("红烧肉(12)",), ("（九）用料",)], "c string").select(review.title_override(F.col("c")).alias("t")).collect()[0].t == "糖醋鱼"
    p = spark.createDataFrame([("a", 1, True, False), ("a", 2, False, False), ("a", 3, False, True), ("b", 1, True, True)], "book_id string, local_page int, confirmed boolean, corrected boolean")
    assert sorted(tuple(map(str, x)) for x in review.progress(p).collect()) == [("None", "4", "2", "2", ""), ("a", "3", "1", "1", "p0002-p0003"), ("b", "1", "1", "1", "")]


def test_sources(spark, tmp_path):
    import json

    block = {"type": "text", "lines": [{"spans": [{"content": "a"}, {"content": "b"}, {"html": "<tr><td>1</td><td>2</td></tr>"}]}], "blocks": [{"lines": [{"spans": [{"content": "c"}]}]}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.json").write_text(json.dumps({"_backend": "e", "meta": {}, "pdf_info": [{"page_idx": 0, "page_size": [1.0, 2.0], "para_blocks": [block, {"type": "title", "lines": [{"spans": [{"content": "T"}]}]}]}]}))
    files = io.whole_files(spark, f"file://{tmp_path}/in", "*.json")
    rows = io.read_layout(files, F.lit("b")).collect()
    assert [(r.local_page, r.raw_text, r.title_candidates, r.block_types, r.ocr_engine) for r in rows] == [(1, "ab\n1 2\nc\nT", ["T"], ["table", "text", "title"], "e")]
    (tmp_path / "review/sx-2").mkdir(parents=True)
    (tmp_path / "review/sx-2/p0009.md").write_text("# sx-2 p.9\n\n## 校对记录\n- notes: 内容正确\n- 正确内容: a / b\n- 确认勾: [X]\n- 置信度: low\n- notes: z: y \n* 正确内容: no\n")
    (tmp_path / "review/sx-2/p0010.md").write_text("- notes: x\n")
    (tmp_path / "review/sx-2/other.md").write_text("# sx-2 p.11\n")
    own = io.read_confirmations(spark, f"file://{tmp_path}/review")
    got = {(r.book_id, r.local_page): (r.notes, r.correct_content, r.confirmed, r.confidence) for r in own.collect()}
    assert got == {("sx-2", 9): ("z: y", "a / b", True, "low"), ("", 0): ("x", "", False, "")}
    queue = "# Queue\n- notes: before\n\n## sx-2 p.3\n- confidence: low\n- 正确内容: 目录 / 猪牛羊肉类\n- 确认勾: [x]\n## sx-2 p.9 \n- 正确内容: old\n- 确认勾: [ ]\n## sx-2 9\n- notes: n\n- plain\n## sx-3 p.1\n"
    (tmp_path / "queue.md").write_text(queue)
    rows = io.read_confirmations(spark, f"file://{tmp_path}/queue.md")
    assert {(r.book_id, r.local_page): (r.notes, r.correct_content, r.confirmed) for r in rows.collect()} == {
        ("sx-2", 3): ("", "目录 / 猪牛羊肉类", True), ("sx-2", 9): ("n", "old", False), ("sx-3", 1): ("", "", False),
    }
    assert {(r.book_id, r.local_page): r.correct_content for r in io.merged_confirmations(own, rows).collect()} == {("sx-2", 3): "目录 / 猪牛羊肉类", ("sx-2", 9): "a / b", ("sx-3", 1): ""}
    notes = spark.createDataFrame([("n.md", "---\ntitle: \"T\"\nbook_id: b\n---\n\n## 页面文本\n\nl1\n无\n l2\n\n## x\n\nno\n"), ("bad.md", "plain")], "path string, value string")
    n = io.read_notes(notes, "页面文本").collect()
    assert len(n) == 1 and n[0].meta["title"] == "T" and n[0].body == ["l1", "l2"]
    assert io.annotations(spark, {"annotations": [{"book_id": "b", "local_page": 1, "anchor": "a", "note": "n"}, {"book_id": "b"}, "x"]}).count() == 1
    assert io.annotations(spark, "a: [b\n  c").count() == 0 and io.annotations(spark, '{"annotations": null}').count() == 0
    small = spark.createDataFrame([(1, "x\"y"), (2, None)], "k int, t string")
    assert small.transform(lambda d: io.json_document(d, "k")).first().value == '[\n  {"k":1,"t":"x\\"y"},\n  {"k":2}\n]'
    io.write_json(small, f"file://{tmp_path}/rows")
    assert spark.read.json(f"file://{tmp_path}/rows").count() == 2
    io.write_yaml(small.coalesce(1), f"file://{tmp_path}/yaml")
    assert sorted(x.value for x in spark.read.text(f"file://{tmp_path}/yaml").collect()) == ["  t: \"x\\\"y\"", "  t: null", "- k: 1", "- k: 2"]
    assert io.shrunk(200, 200, 100) == 97 and io.shrunk(2, 1000, 1) == 1 and io.shrunk(10, 101, 100) == 9
    assert io.load_config("") == {} and io.load_config('{"a": 1}') == {"a": 1}
    made = spark.createDataFrame([("a.md", "x\ny"), ("b.md", "z")], "file_name string, body string")
    for _ in range(2):
        assert io.write_files(made, f"file://{tmp_path}/out") == 2
    assert (tmp_path / "out/a.md").read_text() == "x\ny\n" and len(list((tmp_path / "out").iterdir())) == 2
    assert io.prune(spark, f"file://{tmp_path}/out", made.filter("file_name = 'a.md'")) == 1
    assert io.prune(spark, f"file://{tmp_path}/out", made) == 0 and [x.name for x in (tmp_path / "out").iterdir()] == ["a.md"]
    io.write_partitioned(made.withColumn("book_id", F.col("file_name")), f"file://{tmp_path}/kept")
    assert io.read_outputs(spark, f"file://{tmp_path}/kept", ["a.md"]).count() == 1 and io.read_outputs(spark, f"file://{tmp_path}/kept").count() == 2
    over = spark.createDataFrame([('{"b": {"3": ["x", " ", "x"], "4": ["y"]}}',)], "j string").select(io.nested_lists(F.col("j")).alias("r")).first().r
    assert [tuple(x) for x in over] == [("b", 3, "x"), ("b", 4, "y")]


def test_render(spark):
    made = build(corpus(spark)).records.filter("title = '红烧肉'")
    note = made.select(io.render_record({"原料": "ingredients", "做法": "steps"}).alias("n")).first().n
    assert note.startswith('---\ntitle: "红烧肉"') and "\n## 原料\n\n- 主料：猪肉 一斤\n" in note


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in "ab":
        (tmp_path / f"in/{k}.json").write_text("{}")
    rows = lambda df: df.select(F.regexp_extract("path", "(\\w+)\\.json", 1).alias("book_id"), F.length("value").alias("n"))
    for _ in range(2):
        import_stream(stream_folder(spark, f"file://{tmp_path}/in"), rows, f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination(60)
        assert sorted(r.book_id for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == ["a", "b"]


def test_entry_without_training(monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "_training", lambda: None)
    names = entry.queries()
    assert "inverted_index" in names and not any(n.startswith("op") for n in names)
    assert set(entry.oracle_sql()) <= set(names)


def test_vocabulary_is_a_parameter(spark):
    from dataclasses import replace

    v = replace(DEFAULT, headers=(("ingredients", ("Stuff",)),))
    row = spark.createDataFrame([("Stuff: x",)], "t string").select(pages.section_header(F.col("t"), v).alias("h")).first().h
    assert tuple(row) == ("ingredients", "x")


def test_paired_takes_all_items(spark):
    from foliospark.queries import pages

    for n_docs, n_items in ((130, 60), (30, 60)):
        tables = {
            "documents": spark.range(n_docs).selectExpr("id AS doc_id", "'t' AS text"),
            "benchmark": spark.range(n_items).selectExpr("id AS item_id", "concat('item ', id) AS text"),
        }
        rows = pages._paired(tables.get).collect()
        assert {r["item"] for r in rows} == {f"item {i}" for i in range(n_items)} and {r.doc_id for r in rows} == set(range(n_docs))
        assert len(rows) == max(n_docs, n_items)


def test_annotate(spark):
    """Notes go to the first place in reading order, once; of one place the first; a mark may part another anchor."""
    from foliospark.operators import site

    rows = [["a b", "b c & d"], ["c b"]]
    df = spark.createDataFrame([(rows, ["c", "b", "x", "a b", "b"]), (None, None)], "s array<array<string>>, a array<string>")
    got = [r.x for r in df.select(site.annotate(F.col("s"), F.col("a"), "[{n}]").alias("x")).collect()]
    assert got[0].matched == [3, 1, 4, 0] and got[0].rows == [["a b[3][2][1]", "b c[4] & d"], ["c b"]]
    assert got[1].rows == [] and got[1].matched == []
    records = spark.createDataFrame([("b", "s1", [1, 2], ["salt"], [], ["cut <b>"], []), ("b", "s2", [2], ["salt"], [], ["x"], [])], "book_id string, slug string, local_pages array<int>, " + ", ".join(f"{c} array<string>" for c in site.SECTIONS))
    notes = io.annotations(spark, [{"book_id": "b", "local_page": 2, "anchor": "salt", "note": "n"}, {"book_id": "b", "local_page": 9, "anchor": "x", "note": "n", "slug": "s2"}, {"book_id": "b", "local_page": 1, "anchor": "<b>", "note": "n"}, {"book_id": "b", "local_page": 1, "anchor": "zz", "note": "n"}])
    done, left = site.annotated(records, notes)
    html = {r.slug: [x for part in r.html for x in part] for r in done.collect()}
    assert html["s1"][0].startswith("salt<sup") and html["s1"][1].startswith("cut &lt;b&gt;<sup") and html["s2"] == ["salt", html["s2"][1]] and ">1</a>" in html["s2"][1]
    assert [r.anchor for r in left.collect()] == ["zz"]


def test_learning_outputs(spark, tmp_path):
    rows = [("sx-2", 3, "括号改成英文", "x", True), ("sx-2", 9, "去除多余空格", "", True), ("sx-3", 1, "内容正确", "", False)]
    c = spark.createDataFrame(rows, "book_id string, local_page int, notes string, correct_content string, confirmed boolean")
    review.write_learning(c, f"file://{tmp_path}/learn")
    assert spark.read.json(f"file://{tmp_path}/learn/confirmation_records").count() == 2
    assert {r.rule for r in spark.read.json(f"file://{tmp_path}/learn/learned_confirmation_rules").collect()} == {"normalize_brackets_to_ascii", "remove_spurious_inner_spaces"}
    said = "\n".join(p.read_text() for p in sorted((tmp_path / "learn/learned_confirmation_rules_md").glob("part-*")))
    assert "- Confirmed entries read: 2\n- Total queue entries parsed: 3" in said and "- sx-2 p.9: notes=去除多余空格 | correct_content=无" in said
    assert said.index("## Learned Rules") < said.index("normalize_brackets_to_ascii: 1 pages") < said.index("## Confirmed Pages") < said.index("- sx-2 p.3")


def test_corrected_kinds():
    kinds = {"凉菜类": "title", "目录": "title", "（一）红烧肉": "title", "（一）红烧肉（12）": "text", "糖醋鱼": "text", "（二）用料": "text", "（三）八块鸡": "title"}
    assert {t: corrections.block_kind(t) for t in kinds} == kinds
    assert corrections.is_title("（Abc d）明月鸡") and not corrections.is_title("（四）净肉三两")


def test_closest_by_bounds():
    import random
    from difflib import SequenceMatcher

    r = random.Random(4)
    for _ in range(200):
        blocks = ["".join(r.choice("abcd ") for _ in range(r.randint(0, 14))) for _ in range(8)]
        line = "".join(r.choice("abcd ") for _ in range(r.randint(0, 14)))
        ratios = [SequenceMatcher(None, b, line).ratio() for b in blocks]
        best = max(ratios)
        assert corrections.closest(blocks, line) == ((ratios.index(best), best) if best > 0 else (-1, 0.0))


def test_ratio_is_difflibs():
    """Short and long lines, with popular characters or none, blocks of any length; a comparison ends early only below the least."""
    import random
    from difflib import SequenceMatcher

    r = random.Random(5)
    for k in range(300):
        some = r.choice(["ab", "abcdefgh \x00", "".join(map(chr, range(0x4E00, 0x4E60))), "e" * 30 + "abcdfghij\x00\x01\ud800\U0001f600"])
        line, block = ("".join(r.choice(some) for _ in range(r.choice([0, 1, 9, 80, 199, 200, 300, 450]))) for _ in range(2))
        if k % 3 == 0:
            block = block[:40] + line[20:90] + block[40:] + line[5:15]
        want = SequenceMatcher(None, block, line).ratio()
        assert corrections.Line(line).ratio(block) == corrections.Line(line).ratio(block, want) == want
        assert corrections.Line(line).ratio(block, want + 0.01) in (None, want)
    assert corrections.Line("ab" * 50).ratio("x" * 10, 0.9) is None


def test_entities_in_tables(spark):
    b = "block_type string, text string, bbox array<double>, index int"
    rows = [([("table", "a &eacute;&nbsp;b", [1.0], 2), ("table", "&nbsp;", None, None), ("text", "&amp;", None, 1)],), ([("text", "&lt;", None, None)],), (None,)]
    df = spark.createDataFrame(rows, f"x array<struct<{b.replace(' ', ':').replace(',:', ',')}>>")
    got = [r.y and [(x.block_type, x.text) for x in r.y] for r in df.select(layout.unescape_tables(F.col("x")).alias("y")).collect()]
    assert got == [[("table", "a é b"), ("text", "&amp;")], [("text", "&lt;")], None]


def test_exports(spark, tmp_path):
    from foliospark.plans import export
    from foliospark.plans.process import triage as triage_pages

    made = build(corpus(spark))
    top = f"file://{tmp_path}/notes"
    fallbacks = made.fallbacks
    assert export.export_notes(made.records, fallbacks, top) == (made.records.count(), fallbacks.count(), 0)
    names = sorted(p.name for p in (tmp_path / "notes/recipes").iterdir())
    assert names[0].startswith("b-p0002-") and (tmp_path / "notes/recipes" / names[0]).read_text().startswith("---\ntitle:")
    assert export.export_notes(made.records.filter("book_id = 'c'"), fallbacks, top)[2] == len(names) - 1
    queue = spark.createDataFrame([("b", 2, "q", "from queue", "[x]", True), ("b", 3, "", "q3", "[x]", True)], "book_id string, local_page int, notes string, correct_content string, confirm_mark string, confirmed boolean")
    own = spark.createDataFrame([("b", 2, "own", "", "[ ]", False), ("b", 3, "", "", "[ ]", False)], queue.schema)
    pages_ = made.pages.withColumn("book_id", F.concat("book_id", F.lit("-1")))
    on_books = lambda df: df.withColumn("book_id", F.concat("book_id", F.lit("-1")))
    reviews = export.page_reviews(pages_, on_books(made.records), on_books(fallbacks), on_books(own), on_books(queue))
    assert export.export_page_reviews(reviews, f"file://{tmp_path}/review") == made.pages.count()
    back = {(r.book_id, r.local_page): (r.notes, r.correct_content, r.confirmed) for r in io.read_confirmations(spark, f"file://{tmp_path}/review").collect()}
    assert back["b-1", 2] == ("own", "", False) and back["b-1", 3] == ("", "q3", True) and back["c-1", 1] == ("", "", False) and len(back) == made.pages.count()
    assert "[b-1](./b-1/index.md)" in (tmp_path / "review/index.md").read_text() and "- 页数: 5" in (tmp_path / "review/b-1/index.md").read_text()
    confirmed = spark.createDataFrame([("b", 1, True, "（九）糖醋鱼 / x", "", "[x]")], "book_id string, local_page int, confirmed boolean, correct_content string, notes string, confirm_mark string")
    triaged, anchors, titles = triage_pages(made, confirmed)
    counts = review.confirmation_counts(confirmed.join(made.pages.select("book_id", "local_page", "page_kind"), ["book_id", "local_page"]))
    export.export_report(triaged, anchors, titles, counts, f"file://{tmp_path}/report")
    said = (tmp_path / "report/review_priority.md").read_text()
    assert f"- 总页数: {made.pages.count()}" in said and "- 已读取确认页: 1" in said and "- b: 必看" in said and said.index("## 必看页") < said.index("## 可抽查页")
    related = {r.title: r.related for r in export.related_notes(made.records).collect()}
    assert len(related["红烧肉"]) == 1 and "清炖鸡" in related["红烧肉"][0]


def test_converge_runs_changed_books_only(spark, tmp_path):
    """The first triage says something of one book; only that one is built again, and then nothing changes."""
    from foliospark.plans.converge import converge

    said = spark.createDataFrame([("b", 1, True, "热菜类 / 红烧肉…(1) / 清炖鸡(2) / 没有菜(9)"), ("c", 1, False, "y")], "book_id string, local_page int, confirmed boolean, correct_content string")
    got = converge(corpus(spark), said, f"{tmp_path}/rounds")
    assert got.books == [2, 1, 0] and got.settled
    assert {r.book_id for r in spark.read.parquet(f"{tmp_path}/rounds/records/round=1").collect()} == {"b"}
    assert {r.book_id for r in got.tables["records"].collect()} == {"b", "c"}
    once = build(corpus(spark), said)
    _, anchors, titles = triage(once, said)
    again = build(corpus(spark), said, titles, anchors.select("book_id", "title", "local_page"))
    of = lambda df: sorted((r.book_id, r.title, tuple(r.local_pages), tuple(r.aliases)) for r in df.collect())
    assert of(got.tables["records"]) == of(again.records)


def test_build_takes_fixes_and_given_aliases(spark):
    fixes = spark.createDataFrame([("b", 2, "葱 一两", "ingredient", "主料：猪肉 一斤")], "book_id string, page int, item string, grp string, after string")
    given = spark.createDataFrame([("b", 2, "红烧肉", "又名肉")], "book_id string, local_page int, title string, alias string")
    contents = spark.createDataFrame([("b", "红烧内", 2), ("b", "清汤鸡", 3)], "book_id string, title string, local_page int")
    named = spark.createDataFrame([("b", 3, "清汤鸡", "清炖鸡")], "book_id string, local_page int, alias string, title string")
    r = {x.title: x for x in build(corpus(spark), contents=contents, fixes=fixes, named=named, given=given).records.collect()}
    assert r["红烧肉"].ingredients == ["主料：猪肉 一斤", "葱 一两"] and r["红烧肉"].seasonings == ["调料：盐 二钱"]
    assert r["红烧肉"].aliases == ["红烧内", "又名肉"] and r["清炖鸡"].aliases == ["清汤鸡"]
