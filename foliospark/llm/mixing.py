"""Mixing sources to target weights by capped water-filling.

Each source weighs in the mix; its target is its weight's share of the total,
clamped at ``max_epochs`` times its own size.  What the clamp frees is shared
by weight among the others, again and again, until none is above: with
sources in order of cap / weight the clamped ones are a prefix, so the fixed
point is found by running sums instead of rounds.

A source then needs ``target / size`` repetitions: the whole ones of every
document, and one more of documents in seeded order until the fraction is
filled.  The order is the MD5 of seed and id.  Documents fall into 4,096 slots
by its first three digits; sums of slots tell which slots are taken whole and
which one is cut, and only the cut slot is sorted.  A source with a third of
all rows is thus spread over all tasks.

Null or wordless texts have size 0 and are never taken; a null source is a
source of its own, the last; rows without an id are drawn by their text.
Repeated rows each count and get the same copies: rows of one id and size are
drawn together.  An empty table gives an empty mix.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import keyed, materialize, n_words_of, quoted, with_row

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, "mix-1"


def water_fill(totals: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same and (weight, target).  One row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rated = totals.withColumn("weight", weight)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # source i is clamped when, with all before it clamped, its share still is above its cap
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sized = rated.select(
        "*",
        F.sum("source_size").over(everything).alias("whole"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
        F.row_number().over(order).alias("place"),
    )
    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  products of sizes and weights are wider than a long
    left, weight_left = wide("whole") - max_epochs * wide("size_before"), F.col("weights") - F.col("weight_before")
    sized = sized.select("*", left.cast("decimal(20,0)").alias("left"), weight_left.alias("weight_left"))
    free = wide("left") * F.col("weight") <= max_epochs * wide("source_size") * F.col("weight_left")
    first = F.min(F.when(free, F.struct("place", "left", "weight_left"))).over(everything)
    rest = sized.withColumn("first", first)
    share = (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.weight_left").cast("double")
    clamped = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return rest.select(
        "source", "source_size", "weight", F.when(clamped, (max_epochs * F.col("source_size")).cast("double")).otherwise(share).alias("target")
    )


def _wanted() -> Column:
    """Words of the fractional repetition: what the whole ones leave of the target."""
    return F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """(rid, rv, id, source, size, source_size, target, copies): how often the mix takes each row."""
    docs = keyed(df, id_col, text_col, df[quoted(source_col)].cast("string").alias("source"))
    lot = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null:"), F.md5("text")))))
    docs = docs.select("rid", "rv", "id", "source", n_words_of(F.col("text")).alias("size"), lot.alias("lot"))
    docs = materialize(docs.withColumn("slot", F.substring("lot", 1, 3)), "sizes")  # texts are read once
    slots = docs.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    totals = slots.groupBy("source").agg(F.sum("slot_size").alias("source_size"))
    plan = water_fill(totals, weights, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    plan = plan.withColumn("wanted", _wanted())
    upto = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("before", F.coalesce(F.sum("slot_size").over(upto), F.lit(0)))
    same = plan.select(F.col("source").alias("s"), "source_size", "target", "whole", "wanted")
    slots = slots.join(same, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    state = F.when(F.col("before") >= F.col("wanted"), "out").when(F.col("before") + F.col("slot_size") <= F.col("wanted"), "in").otherwise("cut")
    slots = slots.select(F.col("source").alias("s"), F.col("slot").alias("k"), "source_size", "target", "whole", "wanted", "before", state.alias("state"))
    slots = materialize(slots, "slots")
    placed = docs.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("slot") == F.col("k"))).drop("s", "k")
    columns = ["rid", "rv", "id", "source", "size", "source_size", "target"]
    sure = placed.filter("state != 'cut'").select(*columns, (F.col("whole") + F.when(F.col("state") == "in", 1).otherwise(0)).alias("copies"))
    inside, alike = Window.partitionBy("source", "slot").orderBy("lot", "size"), Window.partitionBy("source", "slot", "lot", "size")
    cut = placed.filter("state = 'cut'").withColumn("drawn", F.sum("size").over(alike))
    cut = cut.withColumn("ahead", F.col("before") + F.sum("size").over(inside) - F.col("drawn"))  # a range: equal rows are summed together
    # a document is taken while more than half of it still fits
    cut = cut.select(*columns, (F.col("whole") + F.when(2 * (F.col("wanted") - F.col("ahead")) > F.col("drawn"), 1).otherwise(0)).alias("copies"))
    return sure.unionByName(cut)


def mix_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as the mix takes it, with their own columns only."""
    copies = mix_sources(df, id_col, text_col, source_col, **how).filter("copies > 0")
    copies = materialize(copies.groupBy("rid", "rv", "source").agg(F.max("copies").alias("copies")), "mix")
    apart = with_row(df, id_col, text_col, source_col)
    own = {id_col: "own_id", text_col: "own_text", source_col: "own_source"}
    docs = keyed(apart, id_col, text_col, *(apart[quoted(c)].alias(n) for c, n in own.items()), "row").drop("text", "id")
    docs = docs.withColumn("source", F.col("own_source").cast("string"))
    on = (docs["rid"] == copies["rid"]) & (docs["rv"] == copies["rv"]) & docs["source"].eqNullSafe(copies["source"])
    mixed = docs.join(copies, on).select(docs["row"], *own.values(), "copies")
    mixed = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))))
    return mixed.select(*((F.col(own[c]) if c in own else F.col("row")[c]).alias(c) for c in df.columns))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS lot FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM s),
fill AS (
  SELECT 0 AS step, list(struct_pack(source := source, source_size := source_size, weight := weight, full := false) ORDER BY source NULLS LAST) AS l FROM w
  UNION ALL
  SELECT step + 1, list_transform(l, lambda x: struct_pack(source := x.source, source_size := x.source_size, weight := x.weight, full := x.full OR
      (list_sum(list_transform(l, lambda y: y.source_size)) - list_sum(list_transform(l, lambda y: CASE WHEN y.full THEN {MAX_EPOCHS} * y.source_size ELSE 0 END))) * x.weight
      > {MAX_EPOCHS} * x.source_size * list_sum(list_transform(l, lambda y: CASE WHEN y.full THEN 0 ELSE y.weight END))))
  FROM fill WHERE step < (SELECT count(*) FROM s)),
ended AS (SELECT l, (list_sum(list_transform(l, lambda y: y.source_size)) - list_sum(list_transform(l, lambda y: CASE WHEN y.full THEN {MAX_EPOCHS} * y.source_size ELSE 0 END)))::BIGINT AS rest,
  list_sum(list_transform(l, lambda y: CASE WHEN y.full THEN 0 ELSE y.weight END))::BIGINT AS weights FROM fill ORDER BY step DESC LIMIT 1),
t AS (SELECT x.source AS source, x.source_size AS source_size,
    CASE WHEN x.full THEN ({MAX_EPOCHS} * x.source_size)::DOUBLE ELSE (rest * x.weight)::DOUBLE / weights::DOUBLE END AS target
  FROM (SELECT unnest(l) AS x, rest, weights FROM ended)),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, round(target - whole * source_size)::BIGINT AS wanted FROM p),
a AS (SELECT d.*, source_size, target, whole, wanted,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY lot, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
    sum(size) OVER (PARTITION BY d.source, lot[1:3]) AS slot_size FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
b AS (SELECT *, min(ahead) OVER (PARTITION BY source, lot[1:3]) AS slot_before FROM a)
SELECT doc_id, size, source_size, target, (size * (whole + CASE
    WHEN slot_before >= wanted THEN 0 WHEN slot_before + slot_size <= wanted THEN 1 WHEN 2 * (wanted - ahead) > size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM b"""
