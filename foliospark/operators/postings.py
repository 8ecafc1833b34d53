"""Substring search over a persisted index of trigrams that takes deltas.

Below one folder, a generation for each delivery: its rows by book, its postings
(lists of the rows that hold a trigram, made for a thousand rows at most at a
time) by hash bucket and then by trigram, and at last the list of its books, which makes it visible.  Of a book
that comes again the newest generation counts, so a delta costs what it brings;
``compact`` writes what counts as one generation.

A search reads the buckets of its term's trigrams alone, in them the row groups
that may hold one, counts by a map-side aggregate which rows have all of them,
and compares only those rows with the term.  A term of fewer than three
characters has no trigram and is compared with all rows of the given books.  No
posting list is one value: a trigram that all rows have is many lists.

Rows need a book ``b`` and a key ``u``; a null text is found by no term.
Repeated rows are found as often as they are there.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def distinct_codes(text: str, piece: int = 1 << 20) -> np.ndarray:
    """The distinct trigrams of a text as numbers of three code points, read in pieces, so that a long text needs no long arrays."""
    found = []
    for at in range(0, len(text) - 2, piece):
        c = np.frombuffer(text[at : at + piece + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        found.append(np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:]))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found or [np.zeros(0, np.int64)]))


def posting_lists(batches, rows: int = 1000):
    """(gram, b, us) of Arrow batches of (b, u, s): for each trigram and book the keys of the rows that hold it, of at most ``rows`` rows."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            books = batch.column("b").dictionary_encode(null_encoding="encode").indices.to_numpy()
            each = [distinct_codes(x.as_py() or "") for x in batch.column("s")]
            n = len(each)
            row = np.repeat(np.arange(n), [len(x) for x in each])
            code = np.concatenate(each)
            order = np.lexsort((row, books[row], code))
            code, row = code[order], row[order]
            if not len(code):
                continue
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (books[row[1:]] != books[row[:-1]])])
            points = code[starts]
            said = np.stack([points >> 42, points >> 21 & 0x1FFFFF, points & 0x1FFFFF], 1).astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(code)], pa.int32()), batch.column("u").take(pa.array(row)))
            yield pa.RecordBatch.from_arrays([pa.array([said[i : i + 3] for i in range(0, len(said), 3)]), batch.column("b").take(pa.array(row[starts])), lists], ["gram", "b", "us"])


class TrigramIndex:
    """Rows (b: book, u: key in its book, s: searched text, and others) below a folder that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.buckets)).cast("int")

    def _generations(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/books")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("gen=") and fs.exists(done(f"{self.folder}/books/{n}/_SUCCESS")))

    def put(self, rows: DataFrame) -> None:
        """Adds the books of ``rows``, or replaces them; all rows of a book come together, and one caller at a time."""
        found = self._generations()
        self._write(rows, found[-1] + 1 if found else 0)

    def _write(self, rows: DataFrame, gen: int) -> None:
        kept = f"{self.folder}/rows/gen={gen}"
        rows.write.mode("overwrite").partitionBy("b").parquet(kept)
        rows = self.spark.read.schema(rows.schema).parquet(kept)
        kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
        lists = rows.select("b", "u", "s").mapInArrow(posting_lists, f"gram string, b {kinds['b']}, us array<{kinds['u']}>").withColumn("bucket", self._bucket(F.col("gram")))
        dealt = lists.repartition("bucket", F.pmod(F.xxhash64("gram"), F.lit(4)))  # a trigram that all rows have is a key a row, in many lists
        dealt.sortWithinPartitions("bucket", "gram", "b").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/postings/gen={gen}")
        rows.select("b").distinct().write.mode("overwrite").parquet(f"{self.folder}/books/gen={gen}")

    def _read(self, kind: str, schema: str | None = None) -> DataFrame:
        reader = self.spark.read.option("basePath", f"{self.folder}/{kind}")
        return reader.parquet(*(f"{self.folder}/{kind}/gen={g}" for g in self._generations()))

    def _newest(self) -> DataFrame:
        return self._read("books").groupBy("b").agg(F.max("gen").alias("gen"))

    def rows(self) -> DataFrame:
        """What counts: every book's rows of its newest generation."""
        kept = self._read("rows")
        return kept.join(self._newest(), ["b", "gen"]).select(*(c for c in kept.columns if c != "gen"))

    def candidates(self, term: str, book: str | None = None) -> DataFrame | None:
        """(gen, b, u) of the rows that have all trigrams of a term; None if it has none."""
        grams = sorted({term[i : i + 3] for i in range(len(term) - 2)})
        if not grams:
            return None
        held = self._read("postings")
        held = held.filter(reduce(Column.__or__, (F.col("bucket") == self._bucket(F.lit(g)) for g in grams))).filter(F.col("gram").isin(grams))
        if book:
            held = held.filter(F.col("b") == book)
        each = held.select("gen", "b", "gram", F.explode("us").alias("u")).distinct().groupBy("gen", "b", "u").agg(F.count("*").alias("n"))
        return each.filter(F.col("n") == len(grams)).drop("n")

    def search(self, term: str = "", **equal: str) -> DataFrame:
        """Rows with equal facets whose text holds the trimmed term, case as typed, in (b, u) order."""
        term = term.strip()
        kept = self._read("rows")
        columns = [c for c in kept.columns if c != "gen"]
        for name, value in equal.items():
            if value:
                kept = kept.filter(F.col(name) == value)
        found = self.candidates(term, equal.get("b")) if term else None
        if found is not None:
            kept = kept.join(found, ["gen", "b", "u"], "left_semi")
        if term:
            kept = kept.filter(F.col("s").contains(term))
        return kept.join(self._newest(), ["b", "gen"]).select(*columns).orderBy("b", "u")

    def compact(self) -> None:
        """Writes what counts as one generation and deletes the older ones; one caller at a time."""
        old = self._generations()
        if len(old) < 2:
            return
        self._write(self.rows(), old[-1] + 1)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for kind in ("books", "postings", "rows"):  # a generation without its list of books does not count
            for gen in old:
                fs.delete(path(f"{self.folder}/{kind}/gen={gen}"), True)
