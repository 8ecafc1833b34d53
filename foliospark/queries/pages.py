"""Page classification, sections, layout and corrections over the driver's tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from foliospark.functions.vocabulary import Vocabulary
from foliospark.operators import corrections, layout, pages
from foliospark.queries.registry import query

#: A vocabulary for the driver's invented prose.
LATIN = Vocabulary(
    numerals="0123456789", units="g", sizes="", vague=("some",), item_labels=("item",), seasoning_labels=("spice",), section_words=("zzz",), title_words=("zzz",),
    headers=(("ingredients", ("The", "Der", "La")), ("steps", ("And", "Und", "Et")), ("tips", ("Of", "Von", "De"))), contents="Licensed", category_suffix=".",
)

PLAIN = replace(LATIN, category_suffix="\n")

PAGE = r"""page AS (SELECT doc_id, text AS t, length(text) AS n, list_filter(string_split(text, chr(10)), lambda x: length(x) BETWEEN 1 AND 30) AS names,
  (contains(text, 'The') OR contains(text, 'Der') OR contains(text, 'La')) AS items, (contains(text, 'And') OR contains(text, 'Und') OR contains(text, 'Et')) AS steps FROM documents),
flag AS (SELECT *, (len(list_filter(names, lambda x: regexp_replace(x, '\s', '', 'g') = 'Licensed')) > 0 OR (contains(t, 'Licensed') AND contains(t, '…'))) AS toc FROM page),
kind AS (SELECT *, CASE WHEN toc THEN 'toc' WHEN doc_id <= 2 AND n <= 20 THEN 'front_matter'
  WHEN len(names) > 0 AND len(list_filter(names, lambda x: NOT (ends_with(regexp_replace(x, '\s', '', 'g'), '.') OR ends_with(regexp_replace(x, '\s', '', 'g'), 'Licensed')))) = 0 AND n <= 40 THEN 'category'
  WHEN len(names) = 0 AND (steps OR items) THEN 'continuation' WHEN len(names) = 0 THEN 'unresolved' ELSE 'recipe' END AS page_kind FROM flag)"""


def _structured(table):
    titles = F.filter(F.split("text", "\n"), lambda x: F.length(x).between(1, 30))
    return pages.with_structure(table("documents").withColumn("names", titles), "text", "names", "doc_id", v=LATIN)


def _kind():
    c = F.col
    return pages.page_kind(c("names"), c("has_steps_header"), c("has_ingredients_header"), c("is_toc"), c("is_front_matter"), c("is_category_page"))


@query(f"WITH {PAGE} SELECT doc_id, page_kind FROM kind")
def page_kind(table):
    return _structured(table).select("doc_id", _kind().alias("page_kind"))


@query(
    f"""WITH {PAGE} SELECT doc_id, CASE WHEN n = 0 THEN 'failed' WHEN len(names) > 0 AND steps AND items AND n >= 160 THEN 'high' WHEN len(names) > 0 AND n >= 80 THEN 'medium' ELSE 'low' END AS confidence,
    (n < 24 OR len(names) > 1 OR page_kind = 'unresolved' OR (page_kind = 'continuation' AND NOT steps)) AS review_needed FROM kind"""
)
def page_confidence(table):
    c = F.col
    t = _structured(table).withColumn("kind", _kind())
    return t.select(
        "doc_id", pages.confidence(c("text"), c("names"), c("has_steps_header"), c("has_ingredients_header")).alias("confidence"),
        pages.review_needed(c("text"), c("names"), c("kind"), c("has_steps_header")).alias("review_needed"),
    )


@query(
    f"""WITH {PAGE} SELECT doc_id, array_to_string(list_filter([CASE WHEN n < 24 THEN 'very sparse text' END, CASE WHEN len(names) > 1 THEN 'multiple recipe title candidates on one page' END, CASE WHEN n = 0 THEN 'empty cleaned text' END,
    CASE WHEN regexp_matches(t, '[*]{{3}}') THEN 'suspicious text pattern matched: [*]{{3}}' END, CASE WHEN regexp_matches(t, '[A-Za-z]{{12,}}') THEN 'suspicious text pattern matched: [A-Za-z]{{12,}}' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM kind"""
)
def suspicious_patterns(table):
    t = _structured(table)
    return t.select("doc_id", F.array_join(pages.warnings(F.col("text"), F.col("names"), patterns=("[*]{3}", "[A-Za-z]{12,}")), "; ").alias("warnings"))


LINES = "line AS (SELECT doc_id, unnest(range(0, len(l))) AS ord, unnest(l) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"


_HEADS = r"CASE WHEN regexp_matches(t, '^(The|Der|La)([：:；;。，,．.、·…！!？?\s]|$)') THEN 'ingredients' WHEN regexp_matches(t, '^(And|Und|Et)([：:；;。，,．.、·…！!？?\s]|$)') THEN 'steps' WHEN regexp_matches(t, '^(Of|Von|De)([：:；;。，,．.、·…！!？?\s]|$)') THEN 'tips' END"


@query(
    rf"""WITH {LINES}, n AS (SELECT doc_id, ord, trim(regexp_replace(x, '[\s\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g')) AS t FROM line), h AS (SELECT *, {_HEADS} AS head FROM n WHERE t <> ''),
    f AS (SELECT *, coalesce(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'other') AS section,
      CASE WHEN head IS NULL THEN t ELSE regexp_replace(t, '^(The|Der|La|And|Und|Et|Of|Von|De)([：:；;。，,．.、·…！!？?\s]+|$)', '') END AS said FROM h)
    SELECT doc_id, section, count(*) AS n_lines, sum(length(said))::BIGINT AS n_chars FROM f WHERE said <> '' GROUP BY doc_id, section"""
)
def sections_route(table):
    """Every document as a record whose blocks are its lines; the vocabulary has no titles and no numbers here."""
    lines = table("documents").select(F.lit("d").alias("book_id"), F.col("doc_id").alias("rec_page"), F.lit(-1).alias("rec_at"), F.lit(1).alias("local_page"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    t = layout.route_sections(lines, PLAIN)
    return t.groupBy(F.col("rec_page").alias("doc_id"), "section").agg(F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))


@query(
    """WITH s AS (SELECT *, CASE WHEN length(text) > 400 THEN 'on' WHEN length(text) < 120 THEN 'off' END AS v FROM conversations)
    SELECT conv_id, turn, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY role ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'off') AS state FROM s"""
)
def region_mask_carry(table):
    n = F.length("text")
    value = F.when(n > 400, "on").when(n < 120, "off")
    t = layout.carry_forward(table("conversations"), ["role"], "conv_id", "turn", value, "state")
    return t.select("conv_id", "turn", F.coalesce("state", F.lit("off")).alias("state"))


@query(
    rf"""WITH {LINES}, s AS (SELECT *, last_value(CASE WHEN contains(x, '%%%') THEN 1 WHEN contains(x, 'Licensed') THEN 0 END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r FROM line)
    SELECT doc_id, count(*) AS n, string_agg(ord, ',' ORDER BY ord) AS places FROM s WHERE r = 1 AND regexp_matches(x, '[&#]') GROUP BY doc_id"""
)
def placeholder_scan(table):
    from foliospark.operators.review import placeholder_lines

    lines = table("documents").select(F.col("doc_id").alias("book_id"), F.lit(1).alias("local_page"), F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    state = F.when(F.col("text").contains("%%%"), F.lit(True)).when(F.col("text").contains("Licensed"), F.lit(False))
    t = layout.fill_forward(lines, ["book_id"], ["ord"], state, "in_region").withColumn("in_region", F.coalesce("in_region", F.lit(False)))
    found = placeholder_lines(t.withColumn("text", F.when(F.col("text").rlike("[&#]"), F.concat(F.col("ord").cast("string"), F.lit("#")))), "#")
    return found.select(F.col("book_id").alias("doc_id"), F.size("lines").cast("long").alias("n"), F.array_join(F.transform("lines", lambda x: F.rtrim(x, F.lit("#"))), ",").alias("places"))


def _boxes(table):
    q, line = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    return table("lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("ord"), line.alias("x0"), q.alias("y0"), (q + 100 * F.col("l_discount") + 1).alias("y1"), F.col("l_partkey")
    )


@query(
    """WITH RECURSIVE b AS (SELECT l_orderkey, l_linenumber AS ord, l_linenumber::DOUBLE AS x0, l_quantity AS a, l_quantity + 100 * l_discount + 1 AS b, l_partkey FROM lineitem),
    o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (a + b) / 2, ord, a, b, l_partkey) AS i FROM b),
    f(l_orderkey, i, no, ra, rb) AS (
      SELECT l_orderkey, i, 1, a, b FROM o WHERE i = 1
      UNION ALL
      SELECT l_orderkey, i, CASE WHEN same THEN no ELSE no + 1 END, CASE WHEN same THEN ra ELSE a END, CASE WHEN same THEN rb ELSE b END
      FROM (SELECT o.l_orderkey, o.i, no, ra, rb, a, b, least(b - a, rb - ra) > 0 AND 2 * (least(rb, b) - greatest(ra, a)) >= least(b - a, rb - ra) AS same FROM f JOIN o ON o.l_orderkey = f.l_orderkey AND o.i = f.i + 1))
    SELECT l_orderkey, ord, no AS row_no, row_number() OVER (PARTITION BY l_orderkey, no ORDER BY x0, ord) AS col_no FROM f JOIN o USING (l_orderkey, i)"""
)
def printed_rows(table):
    return layout.printed_rows(_boxes(table), ["l_orderkey"]).select("l_orderkey", "ord", "row_no", "col_no")


@query()
def column_repair(table):
    part = table("part").select(F.col("p_partkey"), F.col("p_size"))
    cell = F.array(*(F.struct(F.lit(i).alias("ord"), F.lit(float(10 * i)).alias("x0"), F.lit(t).alias("text")) for i, t in enumerate(("调料：盐", "二钱 酱油", "三钱", "葱 一两"))))
    b = part.select("p_partkey", F.explode(cell).alias("c")).select("p_partkey", "c.*")
    b = b.withColumn("y0", 100.0 * F.floor(F.col("ord") / 4)).withColumn("y1", F.col("y0") + 20)
    rows = layout.printed_rows(b, ["p_partkey"])
    return layout.repair_columns(rows, ["p_partkey"]).select("p_partkey", "ord", "text")


def _paired(table):
    """Documents and benchmark items by their ids, modulo the smaller table's ids: all of both take part."""
    docs, items = table("documents"), table("benchmark").select("item_id", F.col("text").alias("item"))
    n = min((t.agg(F.max(i)).first()[0] or 0) + 1 for t, i in ((docs, "doc_id"), (items, "item_id")))
    return docs.withColumn("k", F.pmod("doc_id", F.lit(n))).join(items.withColumn("k", F.pmod("item_id", F.lit(n))), "k")


@query()
def best_match(table):
    t = _paired(table).select("doc_id", corrections.best_match(F.split("text", "\n"), F.col("item")).alias("m"))
    return t.select("doc_id", F.col("m.at").alias("line_no"), F.round("m.ratio", 6).alias("ratio"), (F.col("m.ratio") >= corrections.THRESHOLD).alias("accepted"))


@query()
def correction_apply(table):
    t = _paired(table)
    blocks = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit("text").alias("block_type"), x.alias("text")))
    first = F.get(F.split("text", "\n"), F.lit(0))
    content = F.concat(F.lit("【替行:"), F.replace(first, F.lit("】"), F.lit("")), F.lit("】replaced / 【补行】"), F.replace("item", F.lit(" / "), F.lit(" ")))
    r = t.select("doc_id", corrections.apply_corrections(blocks, content).alias("r"))
    return r.select("doc_id", F.size("r.blocks").alias("n_blocks"), F.col("r.patched").alias("patched"), F.size("r.unmatched").alias("n_unmatched"))


BLOCKS = """l AS (SELECT source AS book_id, doc_id AS local_page, text, unnest(range(0, len(p))) AS ord, unnest(p) AS x FROM (SELECT *, string_split(text, chr(10)) AS p FROM documents)),
  b AS (SELECT *, length(x) BETWEEN 10 AND 60 AND length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 2 AS is_title FROM l WHERE trim(x) <> ''),
  g AS (SELECT d.source AS book_id, d.doc_id AS local_page, CASE WHEN contains(text, 'Licensed') THEN 'toc' WHEN n_chars < 100 THEN 'continuation' ELSE 'recipe' END AS kind,
    coalesce((SELECT bool_or(is_title) FROM b WHERE b.local_page = d.doc_id), false) AS titled, trim(text) <> '' AS said FROM documents d),
  e AS (SELECT book_id, local_page, ord, CASE WHEN is_title THEN local_page || ':' || ord END AS ev FROM b UNION ALL SELECT book_id, local_page, -1, CASE WHEN NOT titled AND kind = 'toc' THEN 'break' END FROM g),
  s AS (SELECT *, last_value(ev IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY local_page, ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS op FROM e),
  j AS (SELECT g.*, NOT (NOT titled AND kind = 'toc') AND (titled OR (coalesce(s.op, 'break') <> 'break' AND (kind = 'continuation' OR said))) AS joins FROM g JOIN s ON s.local_page = g.local_page AND s.ord = -1)"""


def _segmented(table):
    d = table("documents")
    lines = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("local_page"), F.posexplode(F.split("text", "\n")).alias("ord", "x"))
    letters = F.regexp_replace("x", "[^A-Za-z]", "")
    title = F.length("x").between(10, 60) & (F.length(letters) >= 2)
    blocks = lines.select(
        "book_id", "local_page", "ord", F.when(title, "title").otherwise("text").alias("block_type"),
        F.when(title, F.concat(F.lit("（1）"), F.substring(letters, 1, 8))).otherwise(F.col("x")).alias("text"),
    )
    kind = F.when(F.col("text").contains("Licensed"), "toc").when(F.col("n_chars") < 100, "continuation").otherwise("recipe")
    book = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("local_page"), F.col("text").alias("cleaned_text"), kind.alias("page_kind"))
    return layout.segment(book, blocks)


@query(
    f"""WITH {BLOCKS} SELECT s.book_id, split_part(op, ':', 1)::BIGINT AS rec_page, split_part(op, ':', 2)::INT AS rec_at, count(*) AS n_blocks, count(DISTINCT s.local_page) AS n_pages, max(s.local_page) AS last_page
    FROM s JOIN j ON j.local_page = s.local_page AND j.joins WHERE s.ord >= 0 AND coalesce(op, 'break') <> 'break' GROUP BY ALL"""
)
def segment_records(table):
    records, _ = _segmented(table)
    return records.groupBy("book_id", "rec_page", "rec_at").agg(F.count("*").alias("n_blocks"), F.countDistinct("local_page").alias("n_pages"), F.max("local_page").alias("last_page"))


@query(f"WITH {BLOCKS} SELECT book_id, local_page, kind AS page_kind FROM j WHERE NOT joins")
def segment_fallbacks(table):
    _, fallbacks = _segmented(table)
    return fallbacks.select("book_id", "local_page", "page_kind")
