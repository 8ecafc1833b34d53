"""Scalar functions and the line grammar, literal in and out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.grammar import extract_terms, grammar, join_aligned, parse_line


def one(spark, value, f, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(f(F.col("c")).alias("x")).first().x


def normal(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n").translate({0x3000: " ", 9: " ", 0x25CB: "〇", 0x25EF: "〇"})
    return "\n".join(x for x in (re.sub(r"\s+", " ", y).strip() for y in text.split("\n")) if x)


def test_normalize(spark):
    r = random.Random(1)
    rows = ["", " \n ", "a\r\nb\rc", "○ ◯　x\ty", "a \n \n b", "  x y\x0bz\x85 \n"] + ["".join(r.choice("ab \n\t\r　 ") for _ in range(30)) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in rows], "c string")
    for x in df.select("c", T.normalize_text(F.col("c")).alias("n"), T.normalize_text(T.normalize_text(F.col("c"))).alias("nn")).collect():
        assert x.n == normal(x.c) == x.nn


@pytest.mark.parametrize(
    ("given", "want"),
    [("  a b/c:d?  ", "a-b-c-d"), ("...", "untitled"), ("ＡＢ　Ｃ", "AB-C"), ("x" * 90, "x" * 80), ("a--b  c_", "a-b-c")],
)
def test_filename(spark, given, want):
    assert one(spark, given, T.safe_filename) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("（一二）红烧 肉", True), ("(12) 清炖鸡", True), ("红烧肉", False), ("（一）用料", False), ("（三）凉菜类", False), ("（1）干馍：", False), ("目录", False), ("（二）鸡蛋 三两", False), (None, False)]
    + [("（Ab Cdef Ghi）明月红松鸡", True), ("（一一〇）酱爆鸡丁", True), ("（35）石子馍", True), ("三一）干炉馍", True), ("（八）八块鸡", True), ("（九）两头烧", True)]
    + [("（Abc）", False), ("（Abc）一、原料：", False), ("（Abc）净猪肉 三两", False), ("（一一〇 Abc）明月红松鸡", False), ("Abc）明月", False), ("（三）糖醋“鱼”", False), ("（三）佐料鸡", False), ("（三）书目录", False)],
)
def test_record_title(spark, given, want):
    assert one(spark, given, T.record_title) is want


def test_titles(spark):
    for given, want in (("（一二）红烧 肉：", "红烧肉"), ("（Ab Cdef）明月 鸡", "明月鸡"), ("12）馍", "馍"), ("三一）馍", "馍"), ("（一a）馍", "（一a）馍"), ("12 馍", "12馍")):
        assert one(spark, given, T.strip_enumerator) == want
    for given, want in (("八块鸡", True), ("两头烧", True), ("糖醋“鱼”", False), ("佐料鸡", False), ("鸡", False), ("（二）鸡", False), ("螺旋油饼（原名金钱油饼）", True), ("净肉三两", False), ("净肉（三", False)):
        assert one(spark, given, T.plausible_title, "string") is want, given
    assert one(spark, "红烧肉（附汤）", T.core_title) == "红烧肉"
    assert one(spark, "豆腐（清素）", T.strip_notes) == "豆腐"
    assert one(spark, "a(b)", T.fullwidth_parens) == "a（b）"
    assert one(spark, "红—烧·肉（注）", T.fold_title) == "红烧肉"
    assert one(spark, "x【补行前:y】z【整页】", T.strip_markers) == "xz"
    assert one(spark, "（一）红／烧 肉...", T.canonical_title) == "红/烧肉"
    df = spark.createDataFrame([("abc", "abd", True), ("abc", "abc", False), ("abc", "abcd", False), ("abc", "xbd", False), ("", "", False)], "a string, b string, w boolean")
    assert all(r.x is r.w for r in df.select("w", T.one_char_apart(F.col("a"), F.col("b")).alias("x")).collect())


def test_rules(spark):
    rules = T.rules_of([{"pattern": "ab"}, {"pattern": r"(\d+)\s+(\d+)", "replacement": r"\2 \1"}, {"pattern": "b(?!c)", "replacement": "$"}, {"pattern": r"x\Z", "replacement": "!"}])
    assert [r.literal for r in rules] == [True, False, False, False]
    assert one(spark, "abcabbc 1　2 b x\nx", lambda c: T.apply_rules(c, rules)) == "cbc 2 1 $ x\n!"


def test_lists(spark):
    assert one(spark, "1. 切。2. 炒；三、装", T.numbered_steps) == ["1. 切", "。2. 炒", "；三、装"]
    assert one(spark, "1、切\n2、炒 百、x 零、y", T.numbered_steps) == ["1、切", "2、炒 百、x 零、y"] and one(spark, " ", T.numbered_steps) == []
    assert one(spark, "切 炒", T.numbered_steps) == ["切 炒"]
    assert one(spark, ["a ", "", "b"], T.bullets, "array<string>") == "- a\n- b\n"
    assert one(spark, [], T.bullets, "array<string>") == "- 无\n"
    assert one(spark, [3, 5, 4], T.page_range, "array<int>") == "第 3–5 页"
    assert one(spark, "a / b /  / c", T.split_tokens) == ["a", "b", "c"]
    assert one(spark, "<a href=\"x\">'&", T.escape_html) == "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;"
    assert one(spark, None, T.escape_html) == ""
    html = "<table><tr><td>a &amp;</td><th> b</th></tr><!-- <tr><td>no</td></tr> --><script>'<tr><td>x</td></tr>'</script><tr><td> </td></tr></table>"
    assert one(spark, html, T.table_rows) == ["a & b"]
    assert one(spark, "&eacute;&nbsp;", T.unescape_html) == "é "


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("主料：猪肉 一斤 调料：盐 二钱", [("ingredient", "主料：猪肉 一斤"), ("seasoning", "调料：盐 二钱")]),
        ("面粉 二斤五两 猪板油 一斤", [(None, "面粉 二斤五两"), (None, "猪板油 一斤")]),
        ("活鲤鱼（一条）约二斤", [(None, "活鲤鱼（一条）约 二斤")]),
        ("盐少许粉面 四两", [(None, "盐 少许"), (None, "粉面 四两")]),
        ("调料面 二分", [(None, "调料面 二分")]),
        ("味 精 少许", [(None, "味精 少许")]),
        ("米醋 适量 蒜水 适量", [(None, "米醋 适量"), (None, "蒜水 适量")]),
        ("葱 一两 酱油 少许", [(None, "葱 一两"), (None, "酱油 少许")]),
        ("盐 一钱二", [(None, "盐 一钱二")]),
        ("适量酱油 五钱", [(None, "适量酱油 五钱")]),
        ("", []),
    ],
)
def test_line(line, want):
    assert grammar().line(line)[0] == want


def test_grammar_parts():
    g = grammar()
    assert join_aligned("味 精 少许") == "味精 少许" and join_aligned("椒 草 果") == "椒 草 果"
    assert g.head_amount("二 钱 酱油") == ("二 钱", "酱油") and g.head_amount("酱油") == ("", "酱油")
    assert g.bare_name("盐") and not g.bare_name("盐 二钱") and not g.bare_name("调料：")
    assert g.terms(["味 精 三分 八 角 一只", "（切丝）盐 少许", "先炒。再煮", "水木耳 水玉兰片 适量"]) == ["味精", "八角", "盐", "水木耳", "水玉兰片"]
    assert g.clean_name("活鲤鱼约") == "活鲤鱼" and g.clean_name("三") is None and g.clean_name("五香粉") == "五香粉"


def test_grammar_columns(spark):
    df = spark.createDataFrame([("调料：盐 二钱",), (None,)], "t string")
    rows = [r.p for r in df.select(parse_line(F.col("t")).alias("p")).collect()]
    assert [tuple(x) for x in rows[0].items] == [("seasoning", "调料：盐 二钱")] and rows[0].last == "seasoning" and rows[1].items == []
    df = spark.createDataFrame([(["盐 二钱", "盐 少许"],), (None,)], "t array<string>")
    assert [r.t for r in df.select(extract_terms(F.col("t")).alias("t")).collect()] == [["盐"], []]
