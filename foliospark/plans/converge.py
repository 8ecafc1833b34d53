"""Build and triage in turn until nothing changes: only changed books run again.

A round builds some books, and its triage gives their anchors and title
overrides, which are the next build's input.  A book runs again as long as the
digest of what triage now says differs from that of what its build was given.
Each table of a round goes to a folder of its own; of every book the newest
round counts.  What the driver sees is a number of books a round.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.plans.process import Build, build, triage

TABLES = (*Build._fields, "triaged", "anchors", "titles")


class Converged(NamedTuple):
    tables: dict[str, DataFrame]
    books: list[int]

    @property
    def settled(self) -> bool:
        return self.books[-1] == 0


def digests(*tables: DataFrame) -> DataFrame:
    """(book_id, digest): a digest of each book's rows, whatever their order."""
    rows = [df.select("book_id", F.xxhash64(F.lit(k), F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(20,0)").alias("h")) for k, df in enumerate(tables)]
    return reduce(DataFrame.unionByName, rows).groupBy("book_id").agg(F.concat_ws(":", F.count("*").cast("string"), F.sum("h").cast("string")).alias("digest"))


def converge(
    parsed: DataFrame, confirmations: DataFrame, folder: str, rules: list[T.Replacement] = (), v: Vocabulary = DEFAULT, most: int = 10, **given: DataFrame | None
) -> Converged:
    """All tables of the build and of the triage, and how many books each round has built, the last number 0 if nothing changes any more.

    ``folder`` is new and shared; ``given`` goes to ``build``.  A book that says
    something else in each of ``most`` rounds keeps the last.
    """
    spark, folder = parsed.sparkSession, folder.rstrip("/")
    done: list[int] = []
    wrote: dict[str, list[int]] = {}

    def put(name: str, df: DataFrame, k: int) -> DataFrame:
        path = f"{folder}/{name}/round={k}"
        df.write.parquet(path)
        wrote.setdefault(name, []).append(k)
        return spark.read.schema(df.schema).parquet(path)

    def newest() -> DataFrame:
        return read("books").groupBy("book_id").agg(F.max("round").alias("round"))

    def read(name: str) -> DataFrame:
        return spark.read.option("basePath", f"{folder}/{name}").parquet(*(f"{folder}/{name}/round={k}" for k in wrote[name]))

    def current(name: str) -> DataFrame:
        rows = read(name)
        return rows.join(newest(), ["book_id", "round"]).select(*(c for c in rows.columns if c != "round"))

    books = parsed.select("book_id").distinct()
    overrides, anchors = None, None
    for k in range(most):
        books = put("books", books, k)
        n = books.count()
        done.append(n)
        if not n:
            return Converged({name: current(name) for name in TABLES}, done)
        some = lambda df: None if df is None else df.join(books, "book_id", "left_semi")
        contents = None if anchors is None else anchors.select("book_id", "title", "local_page")
        made = build(some(parsed), some(confirmations), some(overrides), some(contents), rules, v, **{name: some(df) for name, df in given.items()})
        made = Build(*(put(name, df, k) for name, df in zip(Build._fields, made)))
        said = [put(name, df, k) for name, df in zip(TABLES[len(Build._fields) :], triage(made, some(confirmations), v))]
        used = put("used", digests(some(anchors), some(overrides)) if anchors is not None else spark.createDataFrame([], "book_id string, digest string"), k)
        now = put("now", digests(*said[1:]), k)
        # a book that triage says nothing about is like one that was given nothing
        told = books.join(used.withColumnRenamed("digest", "was"), "book_id", "left").join(now, "book_id", "left")
        books = told.filter(~F.col("was").eqNullSafe(F.col("digest"))).select("book_id")
        anchors, overrides = current("anchors"), current("titles")
    put("books", books.limit(0), most)
    return Converged({name: current(name) for name in TABLES}, [*done, books.count()])
