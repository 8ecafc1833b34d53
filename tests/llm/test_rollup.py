"""Deliveries beside compactions, compactions that are cut off, and rows without an id."""

from pyspark.sql import functions as F

from foliospark.llm import token_counts
from foliospark.llm.token_counts import Rollup


def rows(spark, n, source="s"):
    return token_counts.inserted(spark.range(n).select(F.lit(source).alias("source"), F.lit("en").alias("lang"), F.lit("v").alias("tokenizer"), F.lit(2).cast("long").alias("tokens")))


def docs(store):
    return {r.source: (r.docs, r.tokens) for r in store.totals().collect()}


def test_cut_off_compactions(spark, tmp_path, monkeypatch):
    """A compaction that ends before it has emptied the folders counts nothing twice, nor does the next one."""
    store = Rollup(spark, f"file://{tmp_path}/r")
    for k in range(3):
        assert store.commit(f"b{k}", rows(spark, k + 1))
    with monkeypatch.context() as m:
        m.setattr(Rollup, "_empty", lambda self, batches: None)
        assert store.compact()
        assert docs(store) == {"s": (6, 12)}
        assert store.commit("b9", rows(spark, 4, "t"))
        assert store.compact()
        assert docs(store) == {"s": (6, 12), "t": (4, 8)}
    assert store.compact() and store.compact()
    assert docs(store) == {"s": (6, 12), "t": (4, 8)}
    assert not list(tmp_path.glob("r/batch=*/*.parquet")) and store.batches() == ["b0", "b1", "b2", "b9"]
    assert not store.commit("b1", rows(spark, 2)) and docs(store) == {"s": (6, 12), "t": (4, 8)}


def test_commits_beside_a_compaction(spark, tmp_path, monkeypatch):
    """A new batch and a second delivery that arrive while a snapshot is being written."""
    store, other = Rollup(spark, f"file://{tmp_path}/r"), Rollup(spark, f"file://{tmp_path}/r")
    assert store.commit("b0", rows(spark, 3))
    commit, told = Rollup._commit, []

    def late(self, aside, final):
        if self is store and "snapshot" in final:
            told.extend([other.commit("b0", rows(spark, 3)), other.commit("b1", rows(spark, 5))])
        return commit(self, aside, final)

    monkeypatch.setattr(Rollup, "_commit", late)
    assert store.compact() and told == [False, True]
    assert docs(store) == {"s": (8, 16)}
    assert store.compact() and docs(store) == {"s": (8, 16)}


def test_copies_without_an_id(spark, tmp_path):
    text = [(None, "a b"), (None, "a b"), (1, "a b"), (3, "a b"), (None, "c"), (None, "c"), (7, None), (8, None)]
    spark.createDataFrame([(i, t, "s", "en") for i, t in text], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sum(r.docs for r in token_counts.op10_token_counts(spark, str(tmp_path)).collect()) == 1 + 2 + 2
    spark.createDataFrame([], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert token_counts.op10_token_counts(spark, f"{tmp_path}/none").collect() == []
