"""Scalar text functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.grammar import extract_terms, parse_line
from foliospark.operators import indexes, links, pages
from foliospark.operators.postings import TrigramIndex
from foliospark.queries.registry import query
from foliospark.sources import io
from foliospark.sources.scratch import scratch_path

WS = r"[\s\x1c-\x1f\x{85}\p{Z}]"


def norm_sql(t: str) -> str:
    clean = f"translate(replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '　' || chr(9) || '○◯', '  〇〇')"
    return f"array_to_string(list_filter(list_transform(string_split({clean}, chr(10)), lambda x: trim(regexp_replace(x, '{WS}+', ' ', 'g'))), lambda x: x <> ''), chr(10))"



@query(f"SELECT doc_id, {norm_sql('text')} AS norm FROM documents")
def text_normalize(table):
    return table("documents").select("doc_id", T.normalize_text(F.col("text")).alias("norm"))


RULES = T.rules_of(
    [
        {"pattern": "Licensed under the", "replacement": "[license]"},
        {"pattern": "Licensed", "replacement": "[l]"},
        {"pattern": r"([0-9]+)-([0-9]+)", "replacement": r"\2_\1"},
        {"pattern": r"[*]{3}|[$]{3}", "replacement": ""},
        {"pattern": "&&&", "replacement": "&"},
        {"pattern": r"e(d|s)[.]", "replacement": r"e\1;"},
        {"pattern": r" {2,}", "replacement": " "},
    ]
)


@query(
    r"""SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(replace(replace(text, 'Licensed under the', '[license]'), 'Licensed', '[l]'),
      '([0-9]+)-([0-9]+)', '\2_\1', 'g'), '[*]{3}|[$]{3}', '', 'g'), '&&&', '&'), 'e(d|s)[.]', 'e\1;', 'g'), ' {2,}', ' ', 'g') AS cleaned FROM documents"""
)
def rule_replace_chain(table):
    return table("documents").select("doc_id", T.apply_rules(F.col("text"), RULES).alias("cleaned"))


@query(
    """SELECT p_partkey, slug, printf('%s-p%04d-%s.md', trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g'), '-'), p_size, slug) AS file_name
    FROM (SELECT *, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part)"""
)
def slug_build(table):
    slug = T.ascii_slug(F.col("p_name"))
    return table("part").select("p_partkey", slug.alias("slug"), T.record_filename(T.ascii_slug(F.col("p_brand")), F.col("p_size"), slug).alias("file_name"))


@query(
    r"""SELECT p_partkey, CASE WHEN n = '' THEN 'untitled' ELSE n END AS file_name FROM (
      SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(trim(p_type || ' / ' || p_name || ' ? '), '[<>:"/\\|?*\x00-\x1F]', '-', 'g'), '\s+', '-', 'g'), '-+', '-', 'g'), ' .-_') AS n FROM part)"""
)
def safe_filenames(table):
    return table("part").select("p_partkey", T.safe_filename(F.concat("p_type", F.lit(" / "), "p_name", F.lit(" ? "))).alias("file_name"))


NO_SCRIPT = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g')"


def cell_sql(x: str) -> str:
    for plain, entity in (("''", "&#x27;"), ('"', "&quot;"), (">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        x = f"replace({x}, '{entity}', '{plain}')" if entity != "&#x27;" else f"replace(regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g'), '{entity}', '{plain}')"
    return norm_sql(x)



@query(
    rf"""SELECT page_id, pos, item FROM (SELECT page_id, unnest(range(0, len(l))) AS pos, unnest(l) AS item FROM (
      SELECT page_id, list_transform(regexp_extract_all({NO_SCRIPT}, '(?is)<(?:li)\b[^>]*>(.*?)</(?:li)\s*>', 1), lambda y: {cell_sql("y")}) AS l FROM pages))"""
)
def html_item_rows(table):
    items = F.transform(T.elements(T.without_scripts(F.col("html")), "li"), lambda x: T.cell_text(x))
    return table("pages").select("page_id", F.posexplode(items).alias("pos", "item")).withColumn("pos", F.col("pos").cast("long"))


@query(f"SELECT page_id, {cell_sql(NO_SCRIPT)} AS body FROM pages")
def html_text(table):
    return table("pages").select("page_id", T.cell_text(T.without_scripts(F.col("html"))).alias("body"))


@query("SELECT page_id, replace(replace(replace(replace(replace(url || '\"', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages")
def escaped_urls(table):
    return table("pages").select("page_id", T.escape_html(F.concat("url", F.lit('"'))).alias("escaped"))


@query(
    f"""SELECT page_id, list_aggregate(r, 'string_agg', '|') AS row_texts FROM (SELECT page_id, list_filter(list_transform(
      regexp_extract_all(replace(replace({NO_SCRIPT}, '<p>', '<tr><td>'), '</p>', '</td></tr>'), '(?is)<(?:tr)\\b[^>]*>(.*?)</(?:tr)\\s*>', 1),
      lambda z: array_to_string(list_filter(list_transform(regexp_extract_all(z, '(?is)<(?:td|th)\\b[^>]*>(.*?)</(?:td|th)\\s*>', 1), lambda y: {cell_sql("y")}), lambda y: y <> ''), ' ')),
      lambda z: z <> '') AS r FROM pages) WHERE len(r) > 0"""
)
def table_row_texts(table):
    html = F.replace(F.replace(T.without_scripts(F.col("html")), F.lit("<p>"), F.lit("<tr><td>")), F.lit("</p>"), F.lit("</td></tr>"))
    rows = table("pages").select("page_id", T.table_rows(html).alias("r")).filter(F.size("r") > 0)
    return rows.select("page_id", F.array_join("r", "|").alias("row_texts"))


STEPPED = "'1. ' || replace(text, chr(10), chr(10) || '2. ') || '。三、' || source"


@query(
    rf"""WITH t AS (SELECT doc_id, {norm_sql(STEPPED)} AS n FROM documents),
    s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(n, '(^|[\n。；; ])((?:\p{{Nd}}+|[一二三四五六七八九十]+)[.、])', chr(1) || '\1\2', 'g'), chr(1)),
      lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS l FROM t)
    SELECT doc_id, unnest(range(1, len(l) + 1)) AS step_no, unnest(l) AS step FROM s"""
)
def numbered_steps(table):
    text = F.concat(F.lit("1. "), F.replace("text", F.lit("\n"), F.lit("\n2. ")), F.lit("。三、"), "source")
    return table("documents").select("doc_id", F.posexplode(T.numbered_steps(text)).alias("p", "step")).select("doc_id", (F.col("p") + 1).cast("long").alias("step_no"), "step")


# titles made from every part's name and number, in each form that the rules tell apart
TITLES = ("（一二〇）八块鸡", "（Ab c·D）明月", "（一〇 Ab）明月", "35）两头烧", "（3）糖 醋 “鱼”", "（四）佐料鸡", "（五）猪肉 三两", "（六）凉菜类", "(七）干 馍：", "（八）用料", "（九）烧饼（又名油饼", "三一）镇川", "八块鸡", "（十）汤\n第二行", "（十一）目录", "")
_ENUM = "^(?:[（(]?[一二三四五六七八九十百零〇0-9]+[）)]|[（(][A-Za-z][A-Za-z .·]*[）)])[ \n]*"
_BARE = f"trim(regexp_replace(regexp_replace(regexp_replace({{t}}, '{_ENUM}', ''), '[ \n]+([一-鿿（()）、])', '\\1', 'g'), '([一-鿿（()）、])[ \n]+', '\\1', 'g'), '：: ')"
_PLAUSIBLE = (
    "(length({b}) BETWEEN 2 AND 14 AND NOT regexp_matches({b}, '[\n。．，,；;：:！!？?…“”\"'']') AND NOT regexp_matches({b}, '[〇零一二三四五六七八九十百半]+[钱两斤克]')"
    " AND length(regexp_replace({b}, '[^（(]', '', 'g')) = length(regexp_replace({b}, '[^)）]', '', 'g')) AND NOT ends_with({b}, '类')"
    " AND NOT regexp_matches({b}, '原料|用料|材料|主料|配料|调料|佐料|辅料|制法|作法|做法|方法|制作|特点|说明|附注|目录'))"
)
_TITLE = f"{norm_sql('(CASE p_partkey % ' + str(len(TITLES)) + ' ' + ' '.join(f'WHEN {k} THEN {chr(39)}{t}{chr(39)}' for k, t in enumerate(TITLES)) + ' END) || CASE WHEN p_size > 40 THEN substr(p_name, 1, 4) ELSE chr(32) END')}"


@query(
    f"""WITH t AS (SELECT p_partkey, {_TITLE} AS t FROM part), w AS (SELECT p_partkey, t, trim(t, '：: ') AS w FROM t),
    r AS (SELECT p_partkey, t, w, {_BARE.format(t="t")} AS bare, trim(regexp_extract(w, '{_ENUM}([^\n]+)', 1), '：: ') AS rest FROM w),
    n AS (SELECT *, {_BARE.format(t="rest")} AS name FROM r)
    SELECT p_partkey, bare, {_PLAUSIBLE.format(b="bare")} AS plausible, regexp_matches(w, '{_ENUM}[^\n]') AS loose,
      (rest <> '' AND NOT ends_with(w, '类') AND NOT contains(w, '目录') AND NOT regexp_matches(t, '[：:][ \n]*$')
        AND NOT regexp_matches(rest, '^(?:用料|原料|材料|配料|主料|调料|作法|制法|做法|方法|制作|特点|说明|附注|注意|备注)') AND {_PLAUSIBLE.format(b="name")}) AS is_title FROM n"""
)
def plausible_title(table):
    made = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("p_partkey") % len(TITLES) + 1).cast("int"))
    t = F.concat(made, F.when(F.col("p_size") > 40, F.substring("p_name", 1, 4)).otherwise(" "))
    rows = table("part").select("p_partkey", t.alias("t"))
    return rows.select("p_partkey", T.strip_enumerator(F.col("t")).alias("bare"), T.plausible_title(F.col("t")).alias("plausible"), T.loose_title(F.col("t")).alias("loose"), T.record_title(F.col("t")).alias("is_title"))


@query(r"""SELECT p_partkey, replace(regexp_replace(replace(n, '(red)', ''), '^[、·. -]+|[、·. -]+$', '', 'g'), '()', '') AS core, regexp_replace(regexp_replace(n, '[(][^()]*[)]', '', 'g'), '[、—·,，/ -]', '', 'g') AS folded
    FROM (SELECT p_partkey, '- ' || p_name || ' (red)' AS n FROM part)""")
def title_keys(table):
    n = F.concat(F.lit("- "), "p_name", F.lit(" (red)"))
    return table("part").select("p_partkey", T.core_title(n).alias("core"), T.fold_title(n).alias("folded"))


#: An item line made from every part: a name spaced out, a counted and a vague amount, a note, a label in the middle.
ITEMS = ("猪肉", "味 精", "八角", "活鲤鱼（一条）", "水木耳")
_DIGIT, _ITEM = "substr('一二三四五六七八九', (p_size % 9 + 1)::INT, 1)", "list_extract(['猪肉', '味精', '八角', '活鲤鱼（一条）', '水木耳'], (p_partkey % 5 + 1)::INT)"


def _line(table):
    digit = F.element_at(F.array(*map(F.lit, "一二三四五六七八九")), F.col("p_size") % 9 + 1)
    item = F.element_at(F.array(*map(F.lit, ITEMS)), (F.col("p_partkey") % 5 + 1).cast("int"))
    return item, digit, table("part").select("p_partkey", "p_size", "p_brand", F.concat(item, F.lit(" "), digit, F.lit("斤盐少许葱 "), digit, F.lit("两。")).alias("line"))


@query(f"SELECT p_partkey, unnest([{_ITEM} || ' ' || {_DIGIT} || '斤', '盐 少许', '葱 ' || {_DIGIT} || '两']) AS pair FROM part")
def qty_pair_extract(table):
    _, _, t = _line(table)
    return t.select("p_partkey", F.explode(F.transform(parse_line(F.col("line"))["items"], lambda x: x["item"])).alias("pair"))


@query(f"SELECT p_partkey, replace({_ITEM}, '（一条）', '') || '|盐|葱' AS terms FROM part")
def term_extract(table):
    item, digit, t = _line(table)
    lines = F.array(F.concat(item, F.lit(" "), digit, F.lit("斤")), F.lit("盐 少许"), F.concat(F.lit("调料：葱 "), digit, F.lit("两 盐 一钱")), F.lit("料 二两 实耗 一两"), F.lit("先切。再炒 二分"))
    return table("part").select("p_partkey", F.array_join(extract_terms(F.transform(lines, lambda x: T.normalize_text(x))), "|").alias("terms"))


@query(
    """SELECT p_partkey, sub, coalesce(own, last_value(own IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey, sub ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'ingredient') AS grp, item
    FROM (SELECT p_partkey, p_brand, unnest([0, 1]) AS sub, unnest(CASE p_size % 4 WHEN 0 THEN ['seasoning', 'ingredient'] WHEN 1 THEN ['ingredient', 'ingredient'] ELSE [NULL, NULL] END) AS own,
      unnest(CASE p_size % 4 WHEN 0 THEN ['调料：盐 一钱', '配料：面 二斤'] WHEN 1 THEN ['主料：肉 一斤', '葱 二两'] ELSE ['糖 一钱', '醋 二钱'] END) AS item FROM part)"""
)
def group_label_inherit(table):
    from foliospark.operators import layout

    n = F.col("p_size") % 4
    text = F.when(n == 0, "调料：盐 一钱 配料：面 二斤").when(n == 1, "主料 肉 一斤 葱 二两").otherwise("糖 一钱 醋 二钱")
    t = table("part").select("p_partkey", "p_brand", text.alias("text"))
    return layout.inherit_groups(t, ["p_brand"], ["p_partkey"]).select("p_partkey", F.col("sub").cast("long").alias("sub"), "grp", "item")


@query(
    """SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10)) AS distinct_lines FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"""
)
def ordered_distinct(table):
    return table("documents").select("doc_id", F.array_join(F.array_distinct(F.split("text", "\n")), "\n").alias("distinct_lines"))


@query("SELECT term, count(*) AS n_docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '\\p{L}+'))) AS term FROM documents) GROUP BY term")
def inverted_index(table):
    return indexes.inverted_index(table("documents"), "doc_id", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0))


@query("SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS n_bytes FROM documents")
def file_hash_manifest(table):
    return io.file_hashes(table("documents"), "doc_id", "text")


@query(
    f"""SELECT conv_id, string_agg(b, '' ORDER BY turn) AS notes FROM (SELECT conv_id, turn, CASE WHEN len(l) = 0 THEN '- none' || chr(10) ELSE array_to_string(list_transform(l, lambda x: '- ' || x), chr(10)) || chr(10) END AS b
    FROM (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda y: {norm_sql('y')}), lambda y: y <> '') AS l FROM conversations)) GROUP BY conv_id"""
)
def bullet_notes(table):
    t = table("conversations").select("conv_id", "turn", T.bullets(F.split("text", "\n"), "- none\n").alias("b"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "b")))
    return t.groupBy("conv_id").agg(F.array_join(F.transform(listed, lambda x: x["b"]), "").alias("notes"))


@query("SELECT page_id, 'https://x.example/new?title=' || replace(url_encode(url || ' a'), '%2F', '/') || '&body=' || replace(url_encode('p ' || page_id), '%2F', '/') AS link FROM pages")
def issue_links(table):
    return table("pages").select("page_id", T.issue_url("https://x.example/new", F.concat("url", F.lit(" a")), F.concat(F.lit("p "), F.col("page_id").cast("string"))).alias("link"))


@query("""SELECT doc_id, source || ' ' || text AS blob FROM documents WHERE lang = 'en' AND contains(text, 'tion the')""")
def search(table):
    rows = table("documents").select(F.col("doc_id").alias("u"), F.col("lang").alias("b"), F.col("source").alias("c"), F.col("text").alias("s"))
    found = indexes.search(rows, " tion the ", b="en")
    return found.select(F.col("u").alias("doc_id"), T.search_blob(F.col("c"), F.col("s")).alias("blob"))


@query("""SELECT doc_id, lang, source FROM documents WHERE lang <> 'de' AND contains(text, 'tion the') UNION ALL SELECT doc_id, lang, source FROM documents WHERE lang = 'de' AND contains(text, 'tion the')
    UNION ALL SELECT -doc_id, lang, source FROM documents WHERE lang = 'de' AND contains(text, 'sch')""")
def search_index(table):
    """The same search over a trigram index that takes all books at first, one of them again, and is read for two terms."""
    rows = table("documents").select(F.col("doc_id").alias("u"), F.col("lang").alias("b"), F.col("source").alias("c"), F.col("text").alias("s"))
    index = TrigramIndex(rows.sparkSession, scratch_path(rows.sparkSession, "index"))
    index.put(rows.withColumn("s", F.when(F.col("b") == "de", F.reverse("s")).otherwise(F.col("s"))))
    index.put(rows.filter("b = 'de'"))
    found = index.search(" tion the ").select(F.col("u").alias("doc_id"), F.col("b").alias("lang"), F.col("c").alias("source"))
    return found.unionByName(index.search("sch", b="de").select((-F.col("u")).alias("doc_id"), F.col("b").alias("lang"), F.col("c").alias("source")))


FORMS = r"""SELECT DISTINCT x AS form FROM (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM (SELECT regexp_extract_all(text, '\p{L}{4,}') AS w FROM benchmark))"""


@query(
    rf"""SELECT doc_id, regexp_replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'),
    (SELECT '(' || string_agg(form, '|' ORDER BY length(form) DESC, form) || ')' FROM ({FORMS})), '<a href="#\1">\1</a>', 'g') AS html FROM documents"""
)
def link_dictionary(table):
    """All words of four letters and more of the benchmark, and all pairs of neighbours, are the forms; the longest at a place is linked."""
    words = F.regexp_extract_all("text", F.lit(r"\p{L}{4,}"), 0)
    pairs = lambda w: F.transform(F.filter(F.sequence(F.lit(0), F.size(w)), lambda i: i < F.size(w) - 1), lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)))
    forms = table("benchmark").select(F.explode(T.let(words, lambda w: F.concat(w, pairs(w)))).alias("form")).distinct()
    link = F.concat(F.lit('<a href="#'), "form", F.lit('">'), "form", F.lit("</a>"))
    return links.link_table(table("documents").select("doc_id", T.escape_html(F.col("text")).alias("html")), "html", forms.select("form", link.alias("link")))


@query()
def linkify(table):
    forms = {w: f"#{w}" for w in ("the", "theon", "tion", "reau", "sch", "licensed under")}
    return table("documents").select("doc_id", links.linkify(T.escape_html(F.col("text")), forms).alias("html"))


@query(
    """SELECT p_partkey, '调料：酱油 ' || d || '钱' || CASE WHEN p_size % 2 = 0 THEN '|盐 少许|葱姜 适量' ELSE '（切丝）|葱姜 适量' END || '|配料：面粉 ' || d || '钱|面粉' AS items
    FROM (SELECT p_partkey, p_size, substr('一二三四五六七八九', (p_size % 9 + 1)::INT, 1) AS d FROM part)"""
)
def residue_items(table):
    size, digits = F.col("p_size"), F.array(*map(F.lit, "一二三四五六七八九"))
    amount = F.concat(F.element_at(digits, size % 9 + 1), F.lit("钱"))
    line = F.concat(F.lit("调料：酱油"), amount, F.when(size % 2 == 0, " 盐少许 ").otherwise("（切丝）"), F.lit("葱 姜 适量 配料：面粉"), amount, F.lit("，面粉。"))
    return table("part").select("p_partkey", F.array_join(F.transform(parse_line(line)["items"], lambda x: x["item"]), "|").alias("items"))


CONTENTS = r"""list_transform(list_filter(list_transform(string_split(text, '.'), lambda x: trim(x)), lambda x: x <> ''), lambda x, i: x || ' … (' || i || ')')"""


@query(
    r"""SELECT doc_id, count(*) AS n_entries, sum(length(regexp_extract(e, '^(.+?)[.·…．\s]*[（(]\s*([0-9]+)\s*[)）]\s*[.。]?$', 1)))::BIGINT AS title_chars, max(regexp_extract(e, '[(]([0-9]+)[)]$', 1)::INT) AS last_page
    FROM (SELECT doc_id, unnest(list_filter(list_transform(string_split(replace(text, chr(10), ' '), '.'), lambda x: trim(x)), lambda x: x <> '')) || ' … (7)' AS e FROM documents)
    WHERE regexp_matches(e, '^(.+?)[.·…．\s]*[（(]\s*([0-9]+)\s*[)）]\s*[.。]?$') GROUP BY doc_id"""
)
def contents_entry(table):
    from foliospark.operators.review import entry_of

    parts = F.filter(F.transform(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), "\\."), lambda x: F.btrim(x, F.lit(" "))), lambda x: x != "")
    t = table("documents").select("doc_id", F.explode(parts).alias("x")).select("doc_id", entry_of(F.concat("x", F.lit(" … (7)"))).alias("e")).filter("e is not null")
    return t.groupBy("doc_id").agg(F.count("*").alias("n_entries"), F.sum(F.length("e.title")).alias("title_chars"), F.max("e.printed_page").alias("last_page"))


@query("SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY'")
def select_enabled(table):
    t = table("customer").withColumn("enabled", F.col("c_acctbal") > 0)
    return pages.select_groups(t, "c_custkey", None, "enabled", "c_mktsegment").filter("c_mktsegment != 'MACHINERY'").select("c_custkey")
