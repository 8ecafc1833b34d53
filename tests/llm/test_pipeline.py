"""The pipeline's stages, each against brute force on its own input."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.test_llm import brute_lines, near_classes, rows_of, words


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    r = random.Random(6)
    vocabulary = ["t%d" % i for i in range(3000)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    lines = lambda n: [say(r.randint(8, 16)) for _ in range(n)]
    texts = [None, "", "short text", "a b " * 80]
    for _ in range(25):
        texts.append("\n".join(lines(r.randint(6, 20))))
    texts += [texts[5], texts[6]]
    for k in (7, 8, 9):
        copy = texts[k].split("\n")
        copy[2] = say(9)
        texts.append("\n".join(copy))
        w = texts[k].split(" ")
        w[3] = "changed"
        texts.append(" ".join(w[5:] + [say(4)]).replace("\n", " "))
    rows = [(i, t, s, l, len(t or "")) for i, t, s, l, *_ in rows_of(texts)]
    out = [spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")]
    folder = tmp_path_factory.mktemp("stages")
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, out[-1], "").write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return [x.collect() for x in out], out


def test_columns(stages):
    _, frames = stages
    for f in frames[1:-1]:
        assert f.columns == frames[0].columns


def test_quality_keeps_clean(stages):
    rows, _ = stages
    kept = {r.doc_id for r in rows[1]}
    assert kept == {r.doc_id for r in rows[0] if len(words(r.text)) >= 50 and r.doc_id != 3}


def test_lines(stages):
    rows, _ = stages
    want = brute_lines(rows[1])
    left = {i: kept for (i, _), (n, gone, kept) in want.items() if gone == 0 or gone < n}
    assert {r.doc_id: r.text for r in rows[2]} == left
    assert all(r.n_chars == len(r.text) for r in rows[2])
    assert len(rows[2]) < len(rows[1])


def test_near(stages):
    rows, _ = stages
    want = {i for i, (_, c) in near_classes(rows[2]).items() if i == c}
    assert {r.doc_id for r in rows[3]} == want


def test_mix_and_bpe(stages):
    rows, frames = stages
    kept = {r.doc_id: r.text for r in rows[3]}
    assert all(kept[r.doc_id] == r.text for r in rows[4])
    assert len(rows[5]) == len(rows[4]) == frames[4].select(F.col("doc_id")).count()
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].encode()).hexdigest() for r in rows[5])


CLASHES = ["id", "rid", "rv", "z", "_id", "_copies", "_copy", "row", "class", "own_id", "own_text", "host", "at", "gone", "key", "a.b", "n_removed", "kept", "lot", "source_size"]


def through(spark, df, folder):
    """The tables before the first and after each stage."""
    out = [df]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, out[-1], "").write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def test_any_columns_nulls_and_repeats(spark, tmp_path):
    """Columns named like the operators' own pass with their values; null ids, repeated ids and rows, and a very long text have defined results."""
    r = random.Random(11)
    say = lambda n: " ".join("k%d" % r.randrange(20000) for _ in range(n))
    long, plain, twice = say(60000), say(80), say(90)
    texts = [(1, long), (2, plain), (2, twice), (None, say(70)), (None, say(75)), (3, None), (4, ""), (5, plain), (6, twice), (6, twice), (7, say(100))]
    rows = [(i, t, None if k % 4 == 0 else "s", "en", len(t or ""), *(f"{c}{k}" for c in CLASHES)) for k, (i, t) in enumerate(texts)]
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    tables = through(spark, spark.createDataFrame(rows, schema), tmp_path)
    for t in tables[:-1]:
        assert t.columns == tables[0].columns
    near = tables[3].collect()
    assert sorted((x.doc_id is None, x.doc_id, x.text) for x in near) == sorted((i is None, i, t) for i, t in [texts[0], texts[1], texts[2], texts[3], texts[4], texts[10]])
    own = {r[1]: r[5:] for r in rows[:3]}  # of equal texts, the first one's
    for x in near:
        assert x.text not in own or tuple(x[5:]) == own[x.text]
    assert tables[5].count() == tables[4].count() > 0


def test_near_rows(spark):
    """Of a class one row stays, that of the smallest id; ids that are null come last, repeated rows stay once."""
    r = random.Random(13)
    say = lambda n: " ".join("g%d" % r.randrange(20000) for _ in range(n))
    a, b = say(90), say(90)
    near = lambda t: t + " more"
    rows = [(1, a), (1, b), (7, near(a)), (9, near(b)), (None, a), (None, say(90)), (8, say(20)), (8, None), (8, None)]
    df = spark.createDataFrame([(*x, "y", "z") for x in rows], "doc_id long, text string, id string, class string")
    got = [tuple(x)[:2] for x in corpus_pipeline.near_dedup(spark, df, "").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, a), (1, b), rows[5], rows[6], (8, None)]))


def test_empty_table(spark, tmp_path):
    tables = through(spark, spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long, id long"), tmp_path)
    assert [t.count() for t in tables] == [0] * 6
