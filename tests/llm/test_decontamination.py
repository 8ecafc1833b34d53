"""Decontamination against a brute force over all word windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark.llm import decontamination
from foliospark.llm.decontamination import contamination, decontaminate, op11_decontamination

DOCS = "doc_id long, text string, rid long, spans int, items string, n_words int, `end` string"
ITEMS = "item_id long, text string, name string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - k + 1)) if w else ():
            windows.setdefault(tuple(w[a : a + k]), set()).add("" if i is None else str(i))
    sizes = {len(x) for x in windows}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if names := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    found |= names
        out.append((i, len(w), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def corpus(seed=5):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["Élan", "ß", "naïve", "ÀB", "東京", "É"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, say(r.choice([3, 9, 10, 11, 40]))) for i in range(12)]
    items += [(3, say(15)), (None, say(12)), (None, say(14)), (50, None), (51, ""), (52, " .,! "), (53, "Solo-Word"), (54, items[0][1]), (7, "é" * 5 + " " + say(20))]
    docs = [None, "", " \n\t", "...", "solo", "word solo word solo-word", say(5), say(200)]
    for k, (_, t) in enumerate(items):
        if t:
            docs += [f"{say(6)}; {t.upper() if k % 2 else t.replace(' ', ', ')}! {say(4)}", t, t[: len(t) // 2]]
    docs += [" ".join(t for _, t in items if t), "w1 " * 300, items[0][1] + " " + items[0][1], items[4][1].replace(" ", "\x00"), "x" + items[4][1]]
    return list(enumerate(docs)), items


@pytest.mark.parametrize("most", [300_000, 30])
def test_brute_force(spark, most):
    docs, items = corpus()
    rows = [(i, t, 1, 2, "x", 3, "y") for i, t in docs]
    rows += [rows[9], rows[9], (None, docs[9][1], 1, 2, "x", 3, "y"), (8, "w1 w2", 1, 2, "x", 3, "y")]  # repeated, without an id, one id twice
    out = contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(*x, "n") for x in items], ITEMS), most=most).collect()
    want = brute([r[:2] for r in rows], items)
    got = []
    for r in out:
        hit = [w for s in r["spans"] for w in range(s["first_word"], s["end_word"])]
        assert len(hit) == len(set(hit)) == r["n_hit"]
        got.append((r["id"], r["n_words"], sorted(hit), r["items"]))
    assert sorted(got, key=str) == want
    texts = {(r[0], len(words(r[1]))): r[1] for r in rows}
    for r in out:  # spans lie on the original text's words
        text = texts[r["id"], r["n_words"]]
        for s in r["spans"]:
            assert words(text[s["start"] : s["end"]]) == words(text)[s["first_word"] : s["end_word"]]
            assert len(words(text[: s["start"]])) == s["first_word"]
    assert any(r["n_hit"] for r in out) and any(not r["n_hit"] and r["n_words"] for r in out)


def test_hot_passage_and_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    long = "filler " * 400_000 + passage + " end" * 1000
    rows = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("start "), F.lit(passage), F.lit(" "), F.col("id").cast("string")).alias("text"))
    rows = rows.union(spark.createDataFrame([(1000, long)], "doc_id long, text string"))
    out = contamination(rows, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert {(r["id"] == 1000, r["n_words"], r["n_hit"]) for r in out.collect()} == {(False, 32, 30), (True, 401_030, 30)}


def test_clean_texts(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"Keep this. {passage}! And that."), (2, "clean"), (3, None), (4, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(9, passage)], "item_id long, text string")
    got = {r["id"]: (r["n_hit"], r["items"], r["clean_text"]) for r in decontaminate(docs, items).collect()}
    assert got == {1: (12, ["9"], "Keep this.  ! And that."), 2: (0, [], "clean"), 3: (0, [], None), 4: (12, ["9"], " ")}


def test_questions_and_answers(spark):
    docs = spark.createDataFrame([(1, "the answer is a b c d e f g h i j indeed"), (2, "q1 q2 q3")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "Q1 q2, q3?", "a b c d e f g h i j"), ("y", None, None)], "item string, question string, answer string")
    out = contamination(docs, items, item_col="item", item_texts=("question", "answer"))
    assert {r["id"]: (r["n_hit"], r["items"]) for r in out.collect()} == {1: (10, ["x"]), 2: (3, ["x"])}


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert contamination(docs, items).count() == 0
    some = contamination(spark.createDataFrame([(1, "a b", 1, 2, "x", 3, "y")], DOCS), items).collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in some] == [(2, 0, [])]


def test_query(spark, tmp_path):
    docs, items = corpus(7)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = [(i, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)) for i, n, hit, found in brute(docs, items)]
    assert sorted(map(tuple, op11_decontamination(spark, str(tmp_path)).collect())) == sorted(want)
    assert decontamination.WINDOW == 10
