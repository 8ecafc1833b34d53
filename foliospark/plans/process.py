"""The batch build and the triage as whole plans.

Stages hand over DataFrames and nothing is collected; pages, blocks and
records are written to the shared folder between stages, so that plans stay
small and a lost executor costs one stage at most.  Triage gives anchors and title overrides that the next
build takes as input tables: two passes, never a cyclic plan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.operators import corrections, layout, order, pages, relate, review
from foliospark.sources.scratch import materialize


class Build(NamedTuple):
    pages: DataFrame
    blocks: DataFrame
    records: DataFrame
    fallbacks: DataFrame
    queue: DataFrame


def build(
    parsed: DataFrame,
    confirmations: DataFrame | None = None,
    overrides: DataFrame | None = None,
    contents: DataFrame | None = None,
    rules: list[T.Replacement] = (),
    v: Vocabulary = DEFAULT,
    fixes: DataFrame | None = None,
    named: DataFrame | None = None,
    given: DataFrame | None = None,
) -> Build:
    """Parsed pages to records: patch, clean, classify, mend, segment, parse, title - in this order, for block types need the patched text.

    Aliases come from overridden titles, then from ``contents`` (with ``named``
    entries, see ``relate.contents_aliases``), then from those ``given`` by hand
    (``relate.manual_aliases``); ``fixes`` move single items between a record's groups.
    """
    p = parsed
    if confirmations is not None:
        c = corrections.load_corrections(confirmations)
        p = p.join(c, ["book_id", "local_page"], "left")
        kept = F.transform("text_blocks", lambda b: F.struct(b["block_type"].alias("block_type"), b["text"].alias("text")))
        fixed = corrections.apply_corrections(kept, F.col("correct_content"))["blocks"]
        no_box = F.transform(fixed, lambda b: F.struct(b["block_type"].alias("block_type"), b["text"].alias("text"), F.lit(None).cast("array<double>").alias("bbox"), F.lit(None).cast("int").alias("index")))
        p = p.withColumn("text_blocks", F.when(F.col("correct_content").isNotNull(), no_box).otherwise(F.col("text_blocks"))).drop("correct_content")
        p = p.withColumn("raw_text", F.array_join(F.transform("text_blocks", lambda b: b["text"]), "\n"))
    p = materialize(pages.normalize_pages(p.select("book_id", "local_page", "raw_text", "text_blocks"), rules, v), "pages")
    b = materialize(mend_columns(layout.explode_blocks(p, ["book_id", "local_page"]), v), "blocks")
    inside, outside = layout.segment(p, b.select("book_id", "local_page", "ord", "block_type", "text"), v)
    records = layout.finalize_records(materialize(inside, "inside"), p, v, fixes).withColumn("aliases", F.array().cast("array<string>"))
    records = materialize(records, "records")
    queue = layout.review_items(records)
    if overrides is not None:
        r = records.withColumn("local_page", F.array_min("local_pages"))
        r = relate.unique_override(r, overrides, ["book_id", "local_page"], "title", T.plausible_title(T.strip_enumerator(F.col("_value")), v=v))
        old = F.when(F.col("applied"), F.concat("aliases", F.array("old_value"))).otherwise(F.col("aliases"))
        records = r.withColumn("aliases", old).select(*records.columns)
    records = relate.title_policy(records)
    if contents is not None:
        r = records.withColumn("rec_id", F.struct("rec_page", "rec_at"))
        extra = relate.contents_aliases(contents, r, named).groupBy("book_id", "rec_id").agg(F.sort_array(F.collect_set("alias")).alias("more"))
        r = r.join(extra, ["book_id", "rec_id"], "left")
        records = r.withColumn("aliases", F.array_distinct(F.concat("aliases", F.coalesce("more", F.array().cast("array<string>"))))).select(*records.columns)
    if given is not None:
        records = relate.manual_aliases(records, given)
    return Build(p, b, records, layout.fallback_rows(outside), queue)


def mend_columns(blocks: DataFrame, v: Vocabulary = DEFAULT) -> DataFrame:
    """Blocks of the item region that have a box are mended row by row; all others pass."""
    b = layout.region_mask(blocks, ["book_id"], v=v)
    boxed = F.col("in_region") & F.coalesce(F.size("bbox") == 4, F.lit(False))
    torn = b.filter(boxed).select("book_id", "local_page", "ord", "block_type", "text", "index", *(F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))
    rows = layout.printed_rows(torn, ["book_id", "local_page"])
    mended = layout.repair_columns(rows, ["book_id", "local_page"], v=v)
    mended = mended.select("book_id", "local_page", "ord", "block_type", "text", F.array("x0", "y0", "x1", "y1").alias("bbox"), "index")
    return b.filter(~boxed).select(*mended.columns).unionByName(mended)


def triage(build_: Build, confirmations: DataFrame, v: Vocabulary = DEFAULT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pages with reasons and bucket, contents anchors with local pages, title overrides)."""
    done = confirmations.filter("confirmed")
    entries = review.contents_entries(done, v=v)
    titles = relate.pages_of(build_.records.select("book_id", "title", "local_pages"), ["book_id", "title"])
    placed = relate.exact_then_folded(entries, titles.withColumnRenamed("local_page", "found"), "title", "found", ["book_id"])
    anchors = order.interpolate(placed, ["book_id"], ["printed_page", "pos"], "printed_page", "found", "at_page")
    anchors = anchors.select("book_id", F.col("at_page").alias("local_page"), "title", "category", "printed_page", F.col("matched_by").alias("page_source"))
    toc_pages = entries.select("book_id", "local_page").distinct()
    titled = done.join(toc_pages, ["book_id", "local_page"], "left_anti").select("book_id", "local_page", review.title_override(F.col("correct_content"), v=v).alias("value"))
    titled = titled.filter("value is not null")
    on = ["book_id", "local_page"]
    count = lambda df, name: df.groupBy(*on).agg(F.count("*").alias(name))
    marked = review.placeholder_lines(layout.region_mask(build_.blocks, ["book_id"], v=v)).select(*on, F.size("lines").alias("n"))
    linked = relate.pages_of(build_.records.select("book_id", "title", "local_pages"), ["book_id", "title"])
    p = relate.star(
        build_.pages.select(*on, "page_kind", "confidence", "warnings"), on,
        (count(linked, "n"), "r"), (count(anchors, "n"), "a"), (done.select(*on, "confirmed").distinct(), "c"), (titled.select(*on, "value"), "o"), (marked, "m"),
    )
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    p = p.select(
        *on, "page_kind", "confidence", "warnings", F.coalesce("c.confirmed", F.lit(False)).alias("confirmed"), zero("r.n").alias("n_records"),
        zero("a.n").alias("n_anchors"), F.col("o.value").isNotNull().alias("has_override"), zero("m.n").alias("n_placeholders"),
    )
    return review.triage(p), anchors, titled
