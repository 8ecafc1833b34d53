"""Whole plans over tables made from the driver's: sections that no header opens, a site, rounds of builds."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.operators import layout
from foliospark.plans.site import build_site
from foliospark.queries.registry import query
from foliospark.sources.scratch import scratch_path

KINDS = 5


@query(
    """WITH p AS (SELECT p_partkey, p_partkey % 5 AS k FROM part)
    SELECT p_partkey, 0 AS line, 'ingredients' AS section, '猪肉 一斤' AS text FROM p
    UNION ALL SELECT p_partkey, 1, CASE WHEN k = 3 THEN 'ingredients' ELSE 'steps' END, CASE k WHEN 0 THEN '炒熟' WHEN 4 THEN '上锅蒸' ELSE '1. 切' END FROM p
    UNION ALL SELECT p_partkey, 2, CASE WHEN k = 3 THEN 'ingredients' ELSE 'steps' END, CASE k WHEN 3 THEN '3. 炒' ELSE '2. 炒' END FROM p WHERE k IN (1, 2, 3)"""
)
def implied_sections(table):
    """A record for each part whose steps have a header (and its items none), a head that was misread, bare numbers, numbers out of turn, or a header each."""
    said = {
        0: ["（一）红烧肉", "猪肉 一斤", "制法：", "炒熟"],
        1: ["（一）红烧肉", "原料：", "猪肉 一斤", "二、制怯：", "1. 切", "2. 炒"],
        2: ["（一）红烧肉", "原料：", "猪肉 一斤", "1. 切", "2. 炒"],
        3: ["（一）红烧肉", "原料：", "猪肉 一斤", "1. 切", "3. 炒"],
        4: ["（一）红烧肉", "原料：", "猪肉 一斤", "制法：上锅蒸"],
    }
    lines = F.element_at(F.array(*(F.array(*map(F.lit, said[k])) for k in range(KINDS))), F.col("p_partkey").cast("int") % KINDS + 1)
    t = table("part").select(F.lit("p").alias("book_id"), F.col("p_partkey").alias("rec_page"), F.lit(0).alias("rec_at"), F.lit(1).alias("local_page"), F.posexplode(lines).alias("ord", "text"))
    t = layout.route_sections(t)
    no = F.row_number().over(Window.partitionBy(*layout.REC).orderBy("k")) - 1
    return t.select(F.col("rec_page").alias("p_partkey"), no.alias("line"), "section", "text")


@query(
    """WITH a AS (SELECT DISTINCT p_brand, p_size AS pg FROM part WHERE p_size % 10 = 0), r AS (SELECT p_partkey, p_size, (SELECT max(pg) FROM a WHERE a.p_brand = part.p_brand AND a.pg <= part.p_size) AS c FROM part),
    f AS (SELECT '盐' AS form, '盐' AS base FROM r WHERE p_size % 2 = 0 UNION SELECT '木耳', '木耳' FROM r WHERE p_size % 2 = 1 UNION SELECT '水木耳', '木耳' FROM r WHERE p_size % 5 = 0)
    SELECT (SELECT count(*) FROM r) AS records, 0 AS pruned, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 0) AS appendix_pages, 0 AS appendix_pruned, (SELECT count(*) FROM supplier WHERE s_suppkey % 3 <> 0) AS fallbacks_skipped,
      (SELECT count(DISTINCT base) FROM f) AS ingredient_pages, (SELECT count(*) FROM f) AS ingredient_variants, 0 AS ingredients_pruned, (SELECT count(DISTINCT coalesce(c, -1)) FROM r) AS categories, (SELECT count(*) FROM r WHERE c IS NULL) AS uncategorized,
      (SELECT count(*) FROM r WHERE p_partkey % 10 = 0) AS annotations, (SELECT count(*) FROM r WHERE p_partkey % 10 = 0 AND p_size % 2 = 0) AS annotations_rendered,
      (SELECT count(*) FROM r WHERE p_partkey % 10 = 0 AND p_size % 2 = 1) AS annotations_unmatched"""
)
def site_build(table):
    """A site of all parts, with suppliers as pages that no record has, and the counters that its writes have observed."""
    p, s = table("part"), table("supplier")
    none, size = F.array().cast("array<string>"), F.col("p_size")
    slug = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    records = p.select(
        F.col("p_brand").alias("book_id"), slug.alias("slug"), F.col("p_name").alias("title"), none.alias("aliases"), F.array("p_size").alias("local_pages"),
        F.array(F.when(size % 2 == 0, "盐 二钱").otherwise("木耳 一两")).alias("ingredients"), F.when(size % 5 == 0, F.array(F.lit("水木耳 二钱"))).otherwise(none).alias("seasonings"), F.array("p_type").alias("steps"), none.alias("tips"),
    )
    page = (F.col("s_suppkey") + 1000).cast("int").alias("local_page")
    fallbacks = s.select(F.lit("Brand#0").alias("book_id"), page, F.array("s_name").alias("body"))
    articles = s.filter("s_suppkey % 3 = 0").select(F.lit("Brand#0").alias("book_id"), page, F.concat(F.lit("a"), (F.col("s_suppkey") % 7).cast("string")).alias("article"), F.lit("x").alias("kind"), F.col("s_suppkey").alias("ord"))
    anchors = p.filter("p_size % 10 = 0").select(F.col("p_brand").alias("book_id"), F.col("p_size").alias("local_page"), F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("category"), F.lit(1).alias("ord")).distinct()
    notes = p.filter("p_partkey % 10 = 0").select(F.col("p_brand").alias("book_id"), F.col("p_size").alias("local_page"), F.lit("盐").alias("anchor"), F.lit("n").alias("note"), slug.alias("slug"))
    got = build_site(scratch_path(p.sparkSession, "site"), records, fallbacks, articles, anchors, notes)
    return p.sparkSession.createDataFrame([tuple(got.values())], ", ".join(f"{c} long" for c in got))
