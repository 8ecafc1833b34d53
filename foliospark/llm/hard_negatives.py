"""Hard-negative mining by a full score sort for each anchor, in blocks of rows.

Rows are dealt by a hash into blocks of bounded size and anchors into blocks of
theirs; every anchor block meets every row block in an equi-join on the row
block's number.  A task computes the integer scores of one anchor block with one
row block, sorts each anchor's scores (ties by id: the block's rows are in the
order of their ids, and the sort is stable), finds a positive's upper limit by
binary search and reads the first different-label rows from there down to the
lower limit.  First entries of all blocks meet in a ranking by anchor that keeps
the first few of each task before the shuffle, so no task and no list holds more
than a block.  Two passes: positives first, then negatives.

Scores are exact: float products where every sum stays below 2**53, 64-bit ones
below 2**63, else unbounded integers; a score beyond a long is an error, and so
is a scaled component beyond 2**62.  Vectors of unequal lengths count as padded
with zeros.  Rows with a null label, a null vector or a null or non-finite
component take no part.  Exactly repeated rows count once; rows of one id with
different contents are different rows, ties among them by a hash of the content.
A row without an id may be a positive or a negative, after all others of its
score.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import mapped, materialize

SCALE, POSITIVES, NEGATIVES, LOWEST, HIGHEST = 256, 5, 5, 80, 100
#: Vector components of a row block, of an anchor block, and scores in memory at once.
BLOCK_VALUES, ANCHOR_VALUES, SCORES = 1 << 22, 1 << 20, 1 << 22
#: Blocks of smaller tables, so that all executors have some.
BLOCKS, LEAST_ROWS = 64, 512
LONG = 1 << 63


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * component) of each component."""

    def of(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) >= float(1 << 62), F.raise_error(F.lit("a vector component is too large")).cast("long")).otherwise(F.floor(y))

    return F.transform(vector, of)


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _blocks(rows: DataFrame, values: int, least: int, label: str, *fields: str) -> DataFrame:
    """(block, rows): ``rows`` dealt by ``rv`` into lists of about ``values`` components; the number of blocks is in column ``blocks``."""
    total, n = rows.agg(F.sum(F.greatest(F.size("q"), F.lit(1))).cast("long"), F.count("*")).first()
    blocks = max(1, -(-(total or 0) // values), min(least, -(-n // LEAST_ROWS)))
    dealt = rows.select(F.pmod(F.xxhash64("rv"), F.lit(blocks)).alias("block"), F.struct("vid", "rv", "label", "q", *fields).alias("r"))
    return dealt.groupBy("block").agg(F.collect_set("r").alias(label)).withColumn("blocks", F.lit(blocks))


class Rows:
    """A list of vectors in the order of (id, content), those without an id last."""

    def __init__(self, rows: pa.StructArray):
        vid, rv = rows.field("vid"), rows.field("rv").to_numpy()
        none = vid.is_null().to_numpy(zero_copy_only=False)
        ids = vid.fill_null(0).to_numpy()
        order = np.lexsort((rv, ids, none))
        self.vid, self.rv, self.none = ids[order], rv[order], none[order]
        self.label = rows.field("label").to_numpy()[order]
        q = rows.field("q")
        size = q.value_lengths().to_numpy().astype(np.int64)
        self.q = np.zeros((len(size), size.max(initial=0)), np.int64)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.q[np.repeat(np.arange(len(size)), size), at] = q.flatten().to_numpy()
        self.q = self.q[order]
        self.rows, self.order = rows, order
        # the largest possible sum of absolute products tells which arithmetic is exact
        self.peak = max((abs(int(x)) for x in (self.q.max(initial=0), self.q.min(initial=0))), default=0)


def scores(a: Rows, some: slice, b: Rows) -> np.ndarray:
    """Integer inner products of some anchors with all rows of a block."""
    d = min(a.q.shape[1], b.q.shape[1])
    left, right = a.q[some, :d], b.q[:, :d]
    bound = a.peak * b.peak * max(d, 1)
    if bound < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < LONG:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    if any(not -LONG <= x < LONG for x in exact.flat):
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def _sorted(score: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places ``which`` by descending score; equal scores stay in the order of ids."""
    return which[np.argsort(-score[which], kind="stable")] if score.min(initial=0) > -LONG else which[np.lexsort((which, ~score[which]))]


def _first_positives(a: Rows, b: Rows, k: int):
    """(anchor, row, score) of the first ``k`` other rows of an anchor's label in the block."""
    step = max(1, SCORES // max(1, len(b.vid)))
    for lo in range(0, len(a.vid), step):
        for i, score in enumerate(scores(a, slice(lo, lo + step), b), lo):
            same = np.flatnonzero((b.label == a.label[i]) & ~((b.vid == a.vid[i]) & (b.rv == a.rv[i]) & (b.none == a.none[i])))
            for j in _sorted(score, same)[:k]:
                yield i, int(j), int(score[j])


def _first_negatives(a: Rows, b: Rows, positives: list[list[int]], k: int, lowest: int, highest: int):
    """(anchor, positive score, row, score) of the first ``k`` rows of other labels between a positive's limits."""
    step = max(1, SCORES // max(1, len(b.vid)))
    for lo in range(0, len(a.vid), step):
        for i, score in enumerate(scores(a, slice(lo, lo + step), b), lo):
            other = _sorted(score, np.flatnonzero(b.label != a.label[i]))
            falling = ~score[other]  # ascending, without overflow at the smallest long
            for p in sorted(set(positives[i])):
                top, bottom = highest * p // 100, -(-lowest * p // 100)
                if top < bottom:
                    continue
                start, end = np.searchsorted(falling, ~top, "left"), np.searchsorted(falling, ~bottom, "right")
                for j in other[start : min(end, start + k)]:
                    yield i, p, int(j), int(score[j])


def _met(anchors: DataFrame, blocks: DataFrame, make, fields: str) -> DataFrame:
    """``make(anchor rows, block rows)`` for every pair of an anchor block and a row block."""
    n = blocks.select("blocks").first()
    dealt = anchors.select(F.explode(F.expr(f"sequence(0L, {n['blocks'] - 1 if n else 0}L)")).alias("block"), "anchors")
    pairs = dealt.join(blocks.select("block", "rows"), "block").select("anchors", "rows")
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                got = list(make(batch.column("anchors").slice(k, 1).flatten(), batch.column("rows").slice(k, 1).flatten()))
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], names)

    return mapped(pairs, run, fields)


def _ranked(found: DataFrame, by: list[str], prefix: str, most: int) -> DataFrame:
    """The first ``most`` of each group by score, id and content, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.col(f"{prefix}_score").desc(), F.col(f"{prefix}_vid").asc_nulls_last(), f"{prefix}_rv")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, anchor_rv, positive_id, positive_rv, rank, negative_id, negative_rv, positive_score, negative_score).

    ``anchor`` is a condition over the columns of ``df``; ``lowest`` and
    ``highest`` are percent of the positive's score.
    """
    label = df[label] if isinstance(label, str) else label
    fit = df.filter(usable(label, df[vector_col]))
    q = quantised(df[vector_col], scale)
    rows = fit.select(df[id_col].cast("long").alias("vid"), label.cast("long").alias("label"), q.alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.select("vid", F.xxhash64(F.col("vid").isNull(), "vid", "label", "q").alias("rv"), "label", "q", "anchor")
    blocks = materialize(_blocks(rows, BLOCK_VALUES, BLOCKS, "rows", "anchor"), "vectors")
    chosen = blocks.select(F.explode(F.filter("rows", lambda r: r["anchor"])).alias("r")).select("r.*").drop("anchor")

    def first(a: pa.StructArray, b: pa.StructArray):
        x, y = Rows(a), Rows(b)
        for i, j, s in _first_positives(x, y, positives):
            yield x.vid[i], x.rv[i], None if y.none[j] else y.vid[j], y.rv[j], s

    found = _met(_blocks(chosen, ANCHOR_VALUES, 1, "anchors"), blocks, first, "vid long, rv long, positive_vid long, positive_rv long, positive_score long")
    best = materialize(_ranked(found, ["vid", "rv"], "positive", positives).drop("rank"), "positives")

    def second(a: pa.StructArray, b: pa.StructArray):
        x, y = Rows(a), Rows(b)
        told = a.field("scores").to_pylist()
        for i, p, j, s in _first_negatives(x, y, [told[k] for k in x.order], negatives, lowest, highest):
            yield x.vid[i], x.rv[i], p, None if y.none[j] else y.vid[j], y.rv[j], s

    some = chosen.join(best.groupBy("vid", "rv").agg(F.sort_array(F.collect_set("positive_score")).alias("scores")), ["vid", "rv"])
    found = _met(_blocks(some, ANCHOR_VALUES, 1, "anchors", "scores"), blocks, second, "vid long, rv long, positive_score long, negative_vid long, negative_rv long, negative_score long")
    # positives of one score share their negatives
    ranked = _ranked(found, ["vid", "rv", "positive_score"], "negative", negatives)
    return best.join(ranked, ["vid", "rv", "positive_score"]).select(
        F.col("vid").alias("anchor_id"),
        F.col("rv").alias("anchor_rv"),
        F.col("positive_vid").alias("positive_id"),
        "positive_rv",
        "rank",
        F.col("negative_vid").alias("negative_id"),
        "negative_rv",
        "positive_score",
        "negative_score",
    )


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives(df, F.col("vec_id") % 100 == 0, label=moved)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER o)::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOWEST} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGHEST} * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER o <= {NEGATIVES}"""
