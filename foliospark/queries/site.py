"""Review files, confirmations, aliases, annotations and index pages over tables made from the driver's."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import order, relate, review, site
from foliospark.queries.registry import query
from foliospark.sources import io


@query(
    """SELECT 'sx-' || (doc_id % 7) AS book_id, doc_id::INT AS local_page, lang || ': ' || source AS notes, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'a / ' || n_chars END AS correct_content,
    doc_id % 2 = 0 AS confirmed, 'high' AS confidence FROM documents"""
)
def page_reviews(table):
    """A page file for each document: a key that stands twice, a colon in a value, another bullet mark, Windows line ends."""
    said = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("a / "), F.col("n_chars").cast("string")))
    mark = F.when(F.col("doc_id") % 2 == 0, "[X] ").otherwise("[ ]")
    parts = ["# sx-", F.col("doc_id") % 7, " p.", F.col("doc_id"), "\n\n## 校对记录\n- notes: old\r\n- 置信度: high\n* 正确内容: no\n- 正确内容: ", said, "\n- 确认勾: ", mark, "\n- notes: ", F.col("lang"), ": ", F.col("source"), " \n"]
    text = F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    files = table("documents").select(F.col("source").alias("path"), text.alias("value"))
    return io.read_page_reviews(files).select("book_id", "local_page", "notes", "correct_content", "confirmed", "confidence")


@query("SELECT source AS path, 'sx-1' AS book_id, doc_id::INT AS local_page, CASE WHEN doc_id % 2 = 0 THEN 'n' || doc_id ELSE '' END AS notes, doc_id % 5 = 0 AS confirmed FROM documents")
def review_queue(table):
    """A queue file for each source with a section for each document, behind text that is no section."""
    notes = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("- notes: n"), F.col("doc_id").cast("string"), F.lit("\n"))).otherwise("")
    mark = F.when(F.col("doc_id") % 5 == 0, "- 确认勾: [x]\n").otherwise("- 确认勾: x\n")
    section = F.concat(F.lit("## sx-1 p."), F.col("doc_id").cast("string"), F.lit(" \n"), notes, mark)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "section"))), lambda x: x["section"]), "")
    files = table("documents").withColumn("section", section).groupBy("source").agg(F.concat(F.lit("# Queue\n- notes: before\n\n"), body).alias("value"))
    return io.read_review_queue(files.withColumnRenamed("source", "path")).select("path", "book_id", "local_page", "notes", "confirmed")


CONTENTS = "【整页】目录 / 汤菜类 / 红烧肉…(1) / （五九）清炖鸡 (2) / 附:说明…(3) / 三不粘(4.)"
CONFIRMED = "c AS (SELECT 'b' || (p_size % 4) AS book_id, p_partkey::INT AS local_page, p_size % 2 = 0 AS confirmed, p_partkey % 4 AS k, p_size % 5 = 0 AS listed FROM part)"


def _confirmations(table):
    k = F.col("p_partkey") % 4
    said = F.when(k == 0, CONTENTS).when(k == 1, "（九）糖醋鱼 / x").when(k == 2, "").otherwise("2.取蒸碗 / y")
    kind = F.when(F.col("p_size") % 5 == 0, "category").otherwise("recipe")
    page = F.concat(F.lit("b"), (F.col("p_size") % 4).cast("string")).alias("book_id"), F.col("p_partkey").cast("int").alias("local_page")
    return table("part").select(*page, (F.col("p_size") % 2 == 0).alias("confirmed"), said.alias("correct_content"), kind.alias("page_kind"), "p_size")


@query(
    f"""WITH {CONFIRMED} SELECT count(*) AS confirmed_pages, count(*) FILTER (k = 0) AS confirmed_toc_pages, 3 * count(*) FILTER (k = 0) AS toc_entries, count(*) FILTER (k = 0) AS toc_entries_rejected,
    count(*) FILTER (k = 1 AND NOT listed) AS title_overrides FROM c WHERE confirmed"""
)
def confirmation_counts(table):
    return review.confirmation_counts(_confirmations(table))


@query(
    f"""WITH {CONFIRMED} SELECT book_id, local_page, '汤菜类' AS category, unnest(['红烧肉', '清炖鸡', '附:说明', '三不粘']) AS title, unnest([1, 2, 3, 4]) AS printed_page, unnest([false, false, true, false]) AS rejected FROM c WHERE k = 0"""
)
def contents_pages(table):
    return review.read_contents(_confirmations(table)).select("book_id", "local_page", "category", "title", "printed_page", "rejected")


NOTES = ("括号改成英文", "去除多余空格", "内容正确", "", "这页属于凉菜，内容正确")


@query(
    """WITH n AS (SELECT printf('b%d#p%04d', p_size % 4, p_partkey) AS page, (p_size // 2) % 5 AS k FROM part WHERE p_size % 2 = 0),
    r AS (SELECT * FROM n JOIN (VALUES ('normalize_brackets_to_ascii', 0, '括号改成英文'), ('remove_spurious_inner_spaces', 1, '去除多余空格'), ('accept_current_content', 2, '内容正确'),
      ('accept_current_content', 4, '这页属于凉菜，内容正确'), ('respect_category_boundaries', 4, '这页属于凉菜，内容正确')) v(rule, kk, note) ON k = kk),
    s AS (SELECT rule, string_agg(note, ' | ' ORDER BY p, note) AS sample_notes FROM (SELECT rule, note, min(page) AS p FROM r GROUP BY rule, note) GROUP BY rule)
    SELECT rule, count(*) AS evidence_count, string_agg(page, ', ' ORDER BY page) AS pages, any_value(sample_notes) AS sample_notes FROM r JOIN s USING (rule) GROUP BY rule"""
)
def learned_rules(table):
    notes = F.element_at(F.array(*map(F.lit, NOTES)), (F.floor(F.col("p_size") / 2) % 5 + 1).cast("int"))
    return review.learned_rules(_confirmations(table).withColumn("notes", notes)).select("rule", "evidence_count", "pages", "sample_notes")


def _titled(table):
    key = F.concat(F.lit("菜"), F.col("p_partkey").cast("string"), F.lit("甲"))
    own = table("part").select(
        F.col("p_brand").alias("book_id"), F.col("p_partkey").alias("rec_id"), F.concat(key, F.lit("乙")).alias("title"), F.array(F.col("p_partkey").cast("int")).alias("local_pages"), "p_size", key.alias("key")
    )
    return own.withColumn("aliases", F.when(F.col("p_size") == 3, F.array(F.concat("key", F.lit("丙")))).otherwise(F.array().cast("array<string>")))


@query(
    """SELECT p_brand AS book_id, p_partkey AS rec_id, CASE WHEN p_size < 10 THEN '菜' || p_partkey || '甲丙' WHEN p_size < 30 THEN '菜' || p_partkey || '甲乙（汤）' ELSE '另名' || p_partkey END AS alias
    FROM part WHERE (p_size < 10 AND p_size <> 3) OR (p_size >= 20 AND p_size < 30) OR (p_size >= 40 AND p_size < 45)"""
)
def contents_alias(table):
    """One character apart, the same core but for appended dishes, and entries that a list names; a known alias is none again."""
    r, n, title = _titled(table), F.col("p_size"), F.col("title")
    other = F.concat(F.lit("另名"), F.col("rec_id").cast("string"))
    said = F.when(n < 10, F.concat("key", F.lit("丙"))).when(n < 20, F.concat(title, F.lit("（附汤）"))).when(n < 30, F.concat(title, F.lit("(汤)"))).when(n < 40, title).otherwise(other)
    entries = r.select("book_id", said.alias("title"), F.col("rec_id").cast("int").alias("local_page"))
    named = r.filter("p_size >= 40 and p_size < 45").select("book_id", F.col("rec_id").cast("int").alias("local_page"), other.alias("alias"), "title")
    return relate.contents_aliases(entries, r.select("book_id", "rec_id", "title", "local_pages", "aliases"), named)


@query("SELECT p_partkey AS rec_id, CASE WHEN p_size = 3 THEN '菜' || p_partkey || '甲丙' WHEN p_size = 5 THEN '又名' || p_partkey ELSE '' END AS aliases FROM part")
def manual_alias(table):
    """Given aliases by title and first page; those with another page find no record."""
    r = _titled(table)
    page = (F.col("rec_id") + (F.col("p_size") == 6).cast("int")).cast("int")
    given = r.filter("p_size in (5, 6)").select("book_id", page.alias("local_page"), "title", F.concat(F.lit("又名"), F.col("rec_id").cast("string")).alias("alias"))
    return relate.manual_aliases(r, given).select("rec_id", F.array_join("aliases", "|").alias("aliases"))


ANCHORS = ("the ", "and", "tion", "zzz")


@query(
    f"""WITH a AS (SELECT doc_id, unnest(range(0, len(l))) AS line, unnest(l) AS x FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda y: trim(y) <> '') AS l FROM documents)),
    f AS (SELECT doc_id, k, line, strpos(replace(replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), anchor) AS pos
      FROM a, (VALUES {", ".join(f"({k}, '{a}')" for k, a in enumerate(ANCHORS))}) v(k, anchor)),
    m AS (SELECT doc_id, k, min(line * 1000000 + pos) AS p FROM f WHERE pos > 0 GROUP BY ALL)
    SELECT doc_id, string_agg(k, ',' ORDER BY p, k) AS numbered FROM m GROUP BY doc_id"""
)
def annotation_numbers(table):
    """Notes on every document by fixed anchors that never overlap, numbered as they are read."""
    lines = F.array(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), T.escape_html))
    t = table("documents").select("doc_id", site.annotate(lines, F.array(*map(F.lit, ANCHORS)))["matched"].alias("m")).filter(F.size("m") > 0)
    return t.select("doc_id", F.array_join(F.transform("m", lambda x: x.cast("string")), ",").alias("numbered"))


def grouped_sql(name: str, group: str, first: str, second: str, rows: str) -> str:
    """Lines of an index page: a heading, the rows' links and a blank line for each group."""
    return (
        f"SELECT '{name}' AS f, ({group})::VARCHAR AS g, 1 AS s, {first} AS a, {second} AS b, '- [[' || note || ']]' AS x FROM {rows} "
        f"UNION ALL SELECT DISTINCT '{name}', ({group})::VARCHAR, 0, '', '', '## ' || ({group}) FROM {rows} UNION ALL SELECT DISTINCT '{name}', ({group})::VARCHAR, 2, '', '', '' FROM {rows}"
    )


@query(
    f"""WITH r AS (SELECT 'n' || p_partkey AS note, p_size AS series, p_brand AS book_id, p_name AS title, printf('%06d', p_partkey) AS fp, p_partkey::VARCHAR AS pages, p_size % 10 = 0 AS rv FROM part),
    f AS (SELECT 's' || s_suppkey AS note, 'Brand#0' AS book_id, s_suppkey::VARCHAR AS pages, s_suppkey % 2 = 0 AS rv FROM supplier),
    t AS (SELECT unnest(string_split(title, ' ')) AS term, title, note FROM r),
    l AS ({grouped_sql("books", "book_id", "fp", "title", "r")} UNION ALL {grouped_sql("series", "series", "fp", "title", "r")} UNION ALL {grouped_sql("ingredients", "term", "title", "note", "t")}
      UNION ALL SELECT 'dishes', '', 1, title, note, '- ' || title || ' -> [[' || note || ']]' FROM r
      UNION ALL SELECT 'review', '', 1, k::VARCHAR, note, '- [[' || note || ']] | ' || book_id || ' | 页码 ' || pages || ' | 置信度 low' FROM (SELECT 0 AS k, note, book_id, pages, rv FROM r UNION ALL SELECT 1, note, book_id, pages, rv FROM f) WHERE rv
      UNION ALL SELECT 'total', '', 1, k::VARCHAR, '', x FROM (SELECT unnest(range(0, 9)) AS k, unnest(['- 菜谱笔记: ' || (SELECT count(*) FROM r), '- 页面回退笔记: ' || (SELECT count(*) FROM f),
        '- 待复核项目: ' || ((SELECT count(*) FROM r WHERE rv) + (SELECT count(*) FROM f WHERE rv)), '', '- [[系列索引]]', '- [[书目索引]]', '- [[菜名索引]]', '- [[食材索引]]', '- [[低置信度待复核]]']) AS x)
      UNION ALL SELECT unnest(['total', 'series', 'books', 'dishes', 'ingredients', 'review']), NULL, 0, '', '', unnest(['# 00 总索引', '# 系列索引', '# 书目索引', '# 菜名索引', '# 食材索引', '# 低置信度待复核']))
    SELECT f AS file_name, row_number() OVER (PARTITION BY f ORDER BY g NULLS FIRST, s, a, b) AS line_no, x AS line FROM l"""
)
def index_pages(table):
    p, s = table("part"), table("supplier")
    key = F.col("p_partkey").cast("string")
    records = p.select(
        F.col("p_size").alias("series"), F.col("p_brand").alias("book_id"), F.col("p_name").alias("title"), F.concat(F.lit("n"), key).alias("note"), F.format_string("%06d", "p_partkey").alias("first_page"),
        key.alias("pages"), F.lit("low").alias("confidence"), (F.col("p_size") % 10 == 0).alias("review_needed"),
    )
    own = F.col("s_suppkey").cast("string")
    fallbacks = s.select(F.concat(F.lit("s"), own).alias("note"), F.lit("Brand#0").alias("book_id"), own.alias("pages"), F.lit("low").alias("confidence"), (F.col("s_suppkey") % 2 == 0).alias("review_needed"))
    terms = records.select(F.explode(F.split("title", " ")).alias("term"), "title", "note")
    lines = site.index_lines(records, fallbacks, terms)
    placed = order.numbered(lines, ["file_name"], ["part", "at"])
    return placed.select("file_name", (F.col("place") + 1).alias("line_no"), "line")


@query(
    """WITH t AS (SELECT w AS base, count(DISTINCT p_partkey) AS n_records FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY w)
    SELECT base, n_records, n_records >= 30 AS common, row_number() OVER (ORDER BY n_records DESC, base) <= 4 AS top FROM t"""
)
def common_forms(table):
    t = table("part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("base")).groupBy("base").agg(F.count("*").alias("n_records"))
    return site.common_forms(t, least=30, top=4)


@query("SELECT conv_id::VARCHAR AS article, min(turn) AS first_turn, count(*) AS n FROM conversations GROUP BY conv_id")
def first_pages(table):
    t = table("conversations").select(F.col("conv_id").cast("string").alias("article"), "turn", F.col("turn").alias("ord"))
    return site.first_pages(t).select("article", F.col("first.turn").alias("first_turn"), "n")


@query(
    """SELECT (SELECT count(*) FROM documents) AS records, (SELECT count(*) FROM pages) AS pages, (SELECT count(DISTINCT source) FROM documents) AS categories,
    (SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL) AS uncategorized"""
)
def site_counts(table):
    d, known = table("documents"), table("labels")
    return site.table_counts(records=d, pages=table("pages"), categories=d.select("source").distinct(), uncategorized=d.join(known, "doc_id", "left_anti"))


@query(
    """SELECT p_partkey, '<!doctype html>' || chr(10) || '<html lang="zh-CN">' || chr(10) || '<head>' || chr(10) || '<meta charset="utf-8">' || chr(10) || '<title>' || p_name || ' &amp; co</title>' || chr(10) || '<link rel="stylesheet" href="../style.css">'
      || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '<main>' || chr(10) || '<h1>' || p_name || ' &amp; co</h1>' || CASE WHEN p_size % 2 = 0 THEN chr(10) || '<p class="aliases">又作：' || p_brand || '、' || p_type || '</p>' ELSE '' END
      || chr(10) || '<p class="place">第 ' || p_size || ' 页</p>' || chr(10) || '<section><h2>原料</h2><ul><li>' || split_part(p_name, ' ', 1) || '</li><li>' || split_part(p_name, ' ', 2) || '</li></ul></section>'
      || CASE WHEN p_size > 25 THEN chr(10) || '<section><h2>做法</h2><ol><li>' || p_type || '</li></ol></section>' ELSE '' END || CASE WHEN p_partkey > 1 THEN chr(10) || '<a class="prev" href="' || (p_partkey - 1) || '.html"></a>' ELSE '' END
      || chr(10) || '</main>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10) AS body FROM part"""
)
def record_pages(table):
    n, none = F.col("p_size"), F.array().cast("array<string>")
    names = F.when(n % 2 == 0, F.array("p_brand", "p_type")).otherwise(none)
    sections = {"原料": F.transform(F.split("p_name", " "), T.escape_html), "做法": F.when(n > 25, F.array(T.escape_html(F.col("p_type")))).otherwise(none), "特点": none}
    before = F.when(F.col("p_partkey") > 1, (F.col("p_partkey") - 1).cast("string"))
    body = site.record_page(F.concat("p_name", F.lit(" & co")), names, T.page_range(F.array(n)), sections, before=before)
    return table("part").select("p_partkey", body.alias("body"))
