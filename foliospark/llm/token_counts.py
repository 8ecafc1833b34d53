"""Token counts as delta-maintained rollups by source, language and tokenizer version.

A change row is signed: an insert adds a document's count, a delete takes it
away, a revised count takes the old one away and adds the new one.  A batch is
summed to one small delta and committed as a folder of its own: the delta is
written aside first and then renamed to ``batch=<id>``, which a file system with
atomic renames does for one writer only; on an object store without them the
folder needs one writer at a time.  A batch that is committed already - by an
earlier run, another driver, or the same one after it lost its answer - changes
nothing.  Totals are the sum of all committed deltas, so they cost the deltas
and never the documents; ``compact`` sums old deltas to one and leaves their
folders empty, so that a late second delivery still changes nothing.

Sums are pre-aggregated by Spark before the shuffle, so a hot source costs one
row a task.  Null texts count 0 tokens; null sources and languages are groups
of their own; repeated rows count each; empty batches commit an empty delta;
other columns are ignored.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import mapped, materialize, n_words_of, quoted, release, scratch_path, slices
from foliospark.llm.packing import tokenizer

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"
CHANGE = "sign int, source string, lang string, tokenizer string, tokens long"
VERSION, DRAFT = "byte_bpe_50k-1", "words-1"


def count_tokens(df: DataFrame, text_col: str, out: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` without the text but with its number of tokens."""
    import public_tokenizers

    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    keep = [c for c in df.columns if c != text_col]
    names = [*keep, out]

    def run(batches):
        encode = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, text_col):
                n = [len(encode.encode_to_numpy(t or "", disallowed_special=())) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(np.array(n, np.int64))], names)

    return mapped(df, run, f"{quoted(out)} long", keep)


def inserted(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    return docs.select(F.lit(1).alias("sign"), *KEYS, F.col(tokens).alias("tokens"))


def deleted(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    return docs.select(F.lit(-1).alias("sign"), *KEYS, (-F.col(tokens)).alias("tokens"))


def revised(docs: DataFrame, old: str, new: str, old_version: str | None = None) -> DataFrame:
    """The old count goes, the new one comes; with ``old_version`` the tokenizer changes too."""
    before = docs if old_version is None else docs.withColumn("tokenizer", F.lit(old_version))
    pair = F.array(
        F.struct(F.lit(-1).alias("sign"), before["tokenizer"].alias("t"), (-F.col(old)).alias("n")) if old_version is None
        else F.struct(F.lit(-1).alias("sign"), F.lit(old_version).alias("t"), (-F.col(old)).alias("n")),
        F.struct(F.lit(1).alias("sign"), F.col("tokenizer").alias("t"), F.col(new).alias("n")),
    )
    rows = docs.select("source", "lang", F.explode(pair).alias("c"))
    return rows.select("c.sign", "source", "lang", F.col("c.t").alias("tokenizer"), F.col("c.n").alias("tokens"))


class Rollup:
    """The committed deltas in one shared folder.

    ``batch=<id>`` is a batch's delta and, for ever, the mark that it is
    committed: ``compact`` empties the folder but leaves it.  So a commit is one
    rename, which a delivery that comes late, twice or beside a compaction
    loses against the folder that is there; no list of names is read.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = path
        self._fs = path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path(self.folder))

    def _names(self, kind: str) -> list[str]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)))
        return sorted(n.partition("=")[2] for n in names if n.startswith(f"{kind}="))

    def _snapshot(self) -> str | None:
        """The folder of the newest compaction: its sums, and the batches that it has emptied or was about to."""
        found = self._names("snapshot")
        return f"{self.folder}/snapshot={found[-1]}" if found else None

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        return self._names("batch")

    def _commit(self, aside: str, final: str) -> bool:
        """Renames what was written aside; False if another writer came first."""
        to = self._path(final)
        if not self._fs.exists(to) and self._fs.rename(self._path(aside), to):
            inside = self._path(f"{final}/{aside.rpartition('/')[2]}")
            if not self._fs.exists(inside):
                return True
            self._fs.delete(inside, True)  # the rename went below the other writer's folder
            return False
        self._fs.delete(self._path(aside), True)
        return False

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch's sums; False, and no change, if that batch is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError("a batch name is letters, digits, dots, dashes and underscores")
        final = f"{self.folder}/batch={batch}"
        if self._fs.exists(self._path(final)):
            return False
        aside = f"{self.folder}/_aside-{uuid.uuid4().hex}"
        delta = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
        delta.write.parquet(aside)
        return self._commit(aside, final)

    def _deltas(self) -> DataFrame:
        """The rows of all batches that the newest compaction does not have, with their batch."""
        schema = f"{DELTA}, batch string"
        if not self._names("batch"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.folder).parquet(f"{self.folder}/batch=*")
        last = self._snapshot()
        return rows.join(self.spark.read.schema("batch string").parquet(f"{last}/batches"), "batch", "left_anti").select(rows.columns) if last else rows

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all commits; groups without documents are gone."""
        rows, last = self._deltas().drop("batch"), self._snapshot()
        if last:
            rows = rows.unionByName(self.spark.read.schema(DELTA).parquet(f"{last}/sums"))
        sums = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs != 0 or tokens != 0")

    def compact(self) -> bool:
        """Sums all deltas so far to one snapshot and empties their folders; one caller at a time, commits beside it are safe.

        The snapshot says which batches are in it, so one that is cut off
        before their folders are empty counts none of them twice.
        """
        found = self._names("snapshot")
        rows, last = materialize(self._deltas(), "deltas"), self._snapshot()
        aside = f"{self.folder}/_aside-{uuid.uuid4().hex}"
        sums = rows.drop("batch")
        names = rows.select("batch").distinct()
        if last:
            sums = sums.unionByName(self.spark.read.schema(DELTA).parquet(f"{last}/sums"))
            # batches of the last compaction whose folders it had no time to empty stay in the list
            before = self.spark.read.schema("batch string").parquet(f"{last}/batches")
            full = self.spark.read.schema(f"{DELTA}, batch string").option("basePath", self.folder).parquet(f"{self.folder}/batch=*").select("batch").distinct()
            names = names.union(before.join(full, "batch", "left_semi"))
        names = materialize(names, "names")
        sums.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0 or tokens != 0").write.parquet(f"{aside}/sums")
        names.write.parquet(f"{aside}/batches")
        if not self._commit(aside, f"{self.folder}/snapshot={int(found[-1] if found else 0) + 1:012d}"):
            return False
        self._empty(row["batch"] for row in names.toLocalIterator())
        release(rows, names)
        return True

    def _empty(self, batches) -> None:
        """Deletes the files of batches; their folders stay."""
        for batch in batches:
            for file in self._fs.listStatus(self._path(f"{self.folder}/batch={batch}")):
                if not file.getPath().getName().startswith("_"):
                    self._fs.delete(file.getPath(), True)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents come with their word count, are revised to their token count, and later copies of a text leave again.

    A text's rows of the smallest id stay.  Rows without an id leave where
    another row of their text has one; where none has, they all stay.
    """
    read = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = read.select("doc_id", "source", "lang", "text", F.sha2("text", 256).alias("content"), n_words_of(F.col("text")).alias("words"))
    table = materialize(count_tokens(both, "text", "tokens"), "counted")
    counted = table.withColumn("tokenizer", F.lit(VERSION))
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit("0001-insert", inserted(counted.withColumn("tokenizer", F.lit(DRAFT)), "words"))
    rollup.commit("0002-revise", revised(counted, "words", "tokens", DRAFT))
    rollup.commit("0002-revise", revised(counted, "words", "tokens", DRAFT))  # delivered twice, counted once
    first = counted.groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).filter("c > 1")
    first = materialize(first.select("content", "first"), "first")
    copies = counted.join(first, "content").filter("doc_id > first or doc_id is null and first is not null")
    rollup.commit("0003-delete", deleted(copies))
    rollup.compact()
    release(first, table)
    return rollup.totals()
