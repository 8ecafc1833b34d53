"""Joins, counts, canonical forms and triage over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from foliospark.functions.vocabulary import Vocabulary
from foliospark.operators import indexes, relate, review
from foliospark.queries.registry import query
from foliospark.sources import io
from foliospark.sources.files import seen_by


@query("SELECT o_orderkey, coalesce(c_name, 'nobody') AS c_name, coalesce(c_mktsegment, 'none') AS c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey")
def left_lookup(table):
    c = table("customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return relate.lookup(table("orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"], {"c_name": "nobody", "c_mktsegment": "none"}).drop("o_custkey")


@query(
    """WITH o AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders), j AS (SELECT o.*, c_mktsegment AS v FROM o LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 2000)
    SELECT o_orderkey, CASE WHEN n = 1 AND v IS NOT NULL AND v <> 'BUILDING' AND v <> o_orderpriority THEN v ELSE o_orderpriority END AS o_orderpriority,
      coalesce(n = 1 AND v <> 'BUILDING' AND v <> o_orderpriority, false) AS applied, (v IS NOT NULL AND NOT coalesce(n = 1 AND v <> 'BUILDING' AND v <> o_orderpriority, false)) AS refused FROM j"""
)
def unique_start_override(table):
    over = table("customer").filter("c_acctbal > 2000").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("value"))
    out = relate.unique_override(table("orders").select("o_orderkey", "o_custkey", "o_orderpriority"), over, ["o_custkey"], "o_orderpriority", F.col("_value") != "BUILDING")
    return out.select("o_orderkey", "o_orderpriority", "applied", "refused")


@query(
    """SELECT d.doc_id, l.quality, l.toxic, c.n AS n_turns, b.chars AS item_chars, p.url FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) c ON c.conv_id = d.doc_id LEFT JOIN (SELECT item_id, length(text) AS chars FROM benchmark) b ON b.item_id = d.doc_id
    LEFT JOIN pages p ON p.page_id = d.doc_id"""
)
def anchor_star_join(table):
    turns = table("conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count("*").alias("n"))
    items = table("benchmark").select(F.col("item_id").alias("doc_id"), F.length("text").cast("long").alias("chars"))
    p = table("pages").select(F.col("page_id").alias("doc_id"), "url")
    t = relate.star(table("documents").select("doc_id"), ["doc_id"], (table("labels"), "l"), (turns, "c"), (items, "b"), (p, "p"))
    return t.select("doc_id", "l.quality", "l.toxic", F.col("c.n").alias("n_turns"), F.col("b.chars").alias("item_chars"), "p.url")


@query(
    """WITH r AS (SELECT p_brand, p_name AS name, p_partkey FROM part WHERE p_size > 25), l AS (SELECT p_partkey AS k, p_brand, CASE WHEN p_size < 10 THEN replace(p_name, ' ', '-') ELSE p_name END AS name FROM part),
    a AS (SELECT p_brand, name, min(p_partkey) AS e FROM r GROUP BY ALL), b AS (SELECT p_brand, regexp_replace(name, '[、—·,，/ -]', '', 'g') AS f, min(p_partkey) AS s FROM r GROUP BY ALL)
    SELECT k, coalesce(e, s) AS p_partkey, CASE WHEN e IS NOT NULL THEN 'exact' WHEN s IS NOT NULL THEN 'folded' ELSE 'none' END AS matched_by
    FROM l LEFT JOIN a USING (p_brand, name) LEFT JOIN b ON b.p_brand = l.p_brand AND b.f = regexp_replace(l.name, '[、—·,，/ -]', '', 'g')"""
)
def exact_then_folded(table):
    p = table("part")
    right = p.filter("p_size > 25").select("p_brand", F.col("p_name").alias("name"), "p_partkey")
    left = p.select(F.col("p_partkey").alias("k"), "p_brand", F.when(F.col("p_size") < 10, F.replace("p_name", F.lit(" "), F.lit("-"))).otherwise(F.col("p_name")).alias("name"))
    return relate.exact_then_folded(left, right, "name", "p_partkey", ["p_brand"]).select("k", "p_partkey", "matched_by")


LETTERS = r"\p{L}{4,}"


@query(
    rf"""WITH v AS (SELECT DISTINCT unnest(list_distinct(regexp_extract_all(lower(text), '{LETTERS}'))) AS w FROM documents UNION SELECT DISTINCT unnest(string_split(p_name, ' ')) FROM part),
    m AS (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM v), k AS (SELECT w, i, substr(w, 1, i - 1) || chr(1) || substr(w, i + 1) AS b FROM m)
    SELECT x.w AS word, y.w AS other FROM k x JOIN k y ON x.b = y.b AND x.i = y.i AND x.w <> y.w"""
)
def one_char_alias(table):
    words = table("documents").select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), 0))).alias("word"))
    words = words.union(table("part").select(F.explode(F.split("p_name", " ")).alias("word"))).distinct().withColumn("g", F.lit(0))
    return relate.one_char_pairs(words, words, "word", ["g"]).select("word", "other")


@query(
    """SELECT v.event_id, coalesce(s.k, 'none') AS category FROM (SELECT * FROM events WHERE event_type IN ('view', 'click', 'error', 'signup')) v
    ASOF LEFT JOIN (SELECT user_id, ts, arg_min(props, event_id) AS k FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) s ON v.user_id = s.user_id AND v.ts >= s.ts"""
)
def asof_category(table):
    e = table("events")
    right = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("ord"), F.col("props").alias("category"))
    left = e.filter("event_type in ('view', 'click', 'error', 'signup')").select("user_id", "ts", "event_id")
    return relate.asof(left, right, ["user_id"], "ts", "category", "none").select("event_id", "category")


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT o_orderkey, o_custkey, 'new' FROM orders WHERE o_orderstatus = 'P'"""
)
def incremental_queue(table):
    o = table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    done = o.filter("o_orderstatus = 'P'")
    return relate.replace_groups(o.filter("o_orderstatus = 'F'"), done, done.withColumn("o_orderstatus", F.lit("new")), "o_custkey")


@query(
    """SELECT item_id, doc_id FROM (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS r FROM (SELECT item_id, string_split(text, '.')[1] AS a FROM benchmark) b
      JOIN (SELECT DISTINCT doc_id, unnest(string_split(replace(text, chr(10), '.'), '.')) AS a FROM documents) d USING (a)) WHERE r = 1"""
)
def claim_once(table):
    wanted = table("benchmark").select("item_id", F.get(F.split("text", "\\."), F.lit(0)).alias("anchor"))
    lines = table("documents").select("doc_id", F.explode(F.array_distinct(F.split("text", "[\n.]"))).alias("line"))
    return relate.claim_once(wanted, lines, F.col("anchor") == F.col("line"), ["item_id"], ["doc_id"]).select("item_id", "doc_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def unmatched_anti(table):
    c = table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return relate.unmatched(c, table("orders").filter("o_totalprice > 400000"), ["o_custkey"]).select(F.col("o_custkey").alias("c_custkey"), "c_name")


@query(
    """SELECT conv_id, turn, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS total, lag(turn) OVER w AS prev_turn, lead(turn) OVER w AS next_turn
    FROM conversations WHERE role = 'assistant' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
)
def article_plan(table):
    c = table("conversations")
    listed = c.filter("role = 'assistant'").select("conv_id", "turn", F.col("conv_id").alias("article"), F.col("turn").alias("ord"))
    plan, _ = relate.article_plan(listed, c.select("conv_id", "turn"), ["conv_id", "turn"])
    return plan.select("conv_id", "turn", F.col("place").cast("long").alias("place"), "total", F.col("prev.turn").alias("prev_turn"), F.col("next.turn").alias("next_turn"))


@query("SELECT conv_id, turn FROM conversations WHERE role <> 'assistant'")
def article_rest(table):
    c = table("conversations")
    listed = c.filter("role = 'assistant'").select("conv_id", "turn", F.col("conv_id").alias("article"), F.col("turn").alias("ord"))
    return relate.article_plan(listed, c.select("conv_id", "turn"), ["conv_id", "turn"])[1]


TRIAGE = """t AS (SELECT d.doc_id, d.lang, CASE WHEN d.n_chars = 0 THEN 'failed' WHEN d.n_chars >= 2000 THEN 'high' WHEN d.n_chars >= 500 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN d.n_chars < 100 THEN 'unresolved' WHEN contains(d.text, 'Licensed') THEN 'continuation' ELSE 'recipe' END AS page_kind, coalesce(l.quality = 1, false) AS confirmed,
  CASE WHEN l.toxic IS NULL THEN 0 ELSE 1 + doc_id % 2 END AS n_records, coalesce(c.n, 0) AS n_anchors, contains(d.text, '###')::INT AS n_placeholders, doc_id % 11 = 0 AS has_override,
  doc_id % 3 = 0 AS several, d.n_chars < 60 AS sparse, contains(d.text, '$$$') AS odd
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN (SELECT conv_id, least(count(*), 2) AS n FROM conversations GROUP BY conv_id) c ON c.conv_id = d.doc_id),
s AS (SELECT *, list_filter([CASE WHEN several AND NOT (confirmed OR n_anchors >= 2 OR n_records >= 2) THEN 'multiple title candidates without stable anchor evidence' END, CASE WHEN sparse THEN 'very sparse text' END,
  CASE WHEN odd THEN 'suspicious text pattern matched: x' END, CASE WHEN confidence = 'failed' THEN 'failed confidence' END, CASE WHEN NOT confirmed AND page_kind = 'unresolved' THEN 'unresolved page kind' END,
  CASE WHEN NOT confirmed AND page_kind = 'continuation' AND n_records = 0 THEN 'continuation page not linked to a recipe candidate' END], lambda x: x IS NOT NULL) AS reasons, n_records >= 2 OR n_anchors >= 1 OR has_override AS anchored FROM t),
b AS (SELECT *, len(reasons) > 0 AS severe, CASE WHEN confirmed THEN 'safe_to_skip' WHEN len(reasons) > 0 THEN 'must_review' WHEN confidence = 'medium' THEN 'optional_sample' WHEN page_kind = 'continuation' AND n_records > 0 THEN 'optional_sample'
  WHEN confidence = 'high' AND anchored THEN 'safe_to_skip' WHEN anchored THEN 'optional_sample' ELSE 'safe_to_skip' END AS b0 FROM s),
r AS (SELECT *, CASE WHEN b0 = 'safe_to_skip' AND n_placeholders > 0 THEN 'optional_sample' ELSE b0 END AS bucket FROM b)"""


def _triaged(table):
    d = table("documents")
    n = F.col("n_chars")
    turns = table("conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.least(F.count("*"), F.lit(2)).alias("n"))
    t = relate.star(d, ["doc_id"], (table("labels"), "l"), (turns, "c"))
    said = {"multiple recipe title candidates on one page": F.col("doc_id") % 3 == 0, "very sparse text": n < 60, "suspicious text pattern matched: x": F.col("text").contains("$$$"), "something else": n > 60}
    t = t.select(
        "doc_id", "lang",
        F.when(n == 0, "failed").when(n >= 2000, "high").when(n >= 500, "medium").otherwise("low").alias("confidence"),
        F.when(n < 100, "unresolved").when(F.col("text").contains("Licensed"), "continuation").otherwise("recipe").alias("page_kind"),
        F.coalesce(F.col("l.quality") == 1, F.lit(False)).alias("confirmed"), F.when(F.col("l.toxic").isNull(), 0).otherwise(1 + F.col("doc_id") % 2).alias("n_records"),
        F.coalesce("c.n", F.lit(0)).alias("n_anchors"), (F.col("doc_id") % 11 == 0).alias("has_override"), F.col("text").contains("###").cast("int").alias("n_placeholders"),
        F.array_compact(F.array(*(F.when(c, w) for w, c in said.items()))).alias("warnings"),
    )
    return review.triage(t)


@query(f"WITH {TRIAGE} SELECT doc_id, severe, bucket, array_to_string(reasons, '; ') AS reasons FROM r")
def triage_buckets(table):
    return _triaged(table).select("doc_id", "severe", "bucket", F.array_join("reasons", "; ").alias("reasons"))


@query(f"WITH {TRIAGE} SELECT lang, bucket, confidence, page_kind, count(*) AS n FROM r GROUP BY GROUPING SETS ((lang, bucket), (confidence), (page_kind))")
def bucket_counts(table):
    return indexes.grouped_counts(_triaged(table), ["lang", "bucket"], ["confidence"], ["page_kind"])


@query(
    """WITH p AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderstatus = 'F' AS done, o_orderpriority LIKE '1%' AS fixed FROM orders), d AS (SELECT c, k, k - row_number() OVER (PARTITION BY c ORDER BY k) AS g FROM p WHERE NOT done),
    r AS (SELECT c, min(k) AS a, max(k) AS b FROM d GROUP BY c, g), t AS (SELECT c, string_agg(CASE WHEN a = b THEN printf('p%04d', a) ELSE printf('p%04d-p%04d', a, b) END, ', ' ORDER BY a) AS remaining FROM r GROUP BY c)
    SELECT s.c AS o_custkey, pages, confirmed, corrected, coalesce(remaining, '') AS remaining FROM (SELECT c, grouping(c) AS g, count(*) AS pages, sum(done::INT)::BIGINT AS confirmed, sum(fixed::INT)::BIGINT AS corrected FROM p GROUP BY ROLLUP (c)) s
    LEFT JOIN t ON t.c = s.c AND s.g = 0"""
)
def progress_rollup(table):
    o = table("orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("done"), F.col("o_orderpriority").startswith("1").alias("fixed"))
    return review.progress(o, "o_custkey", "o_orderkey", "done", "fixed")


@query("SELECT x AS value, count(*) AS n, min(doc_id) AS first_seen FROM (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)))) AS x FROM documents) GROUP BY x")
def note_frequency(table):
    t = table("documents").select("doc_id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("x"))
    return indexes.frequencies(t, F.col("x"), F.col("doc_id"))


EVIDENCE = {"stars": "[*]{3}", "licence": "Licensed", "amp": "&&&", "digits": "[0-9]{5}"}


@query(
    "WITH l AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)))) AS x FROM documents), h AS ("
    + " UNION ALL ".join(f"SELECT '{k}' AS rule, doc_id, x FROM l WHERE regexp_matches(x, '{p}')" for k, p in EVIDENCE.items())
    + """), f AS (SELECT rule, x, min(doc_id) AS d FROM h GROUP BY rule, x), r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY d, x) AS k FROM f)
    SELECT rule, (SELECT count(*) FROM h WHERE h.rule = r.rule) AS n, string_agg(x, '|' ORDER BY k) AS samples FROM r WHERE k <= 5 GROUP BY rule"""
)
def rule_evidence(table):
    t = table("documents").select("doc_id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("x"))
    return indexes.rule_evidence(t, F.col("x"), EVIDENCE, F.col("doc_id")).select("rule", "n", F.array_join("samples", "|").alias("samples"))


AFFIXES = Vocabulary(
    numerals="", units="", sizes="", vague=(), item_labels=(), seasoning_labels=(), section_words=(), title_words=(), headers=(), contents="", category_suffix="",
    prefixes=("th", "er", "on", "in"), suffixes=("ed", "tion", "es", "er"),
)
WORD = r"\p{L}{3,}"
WORDS = f"SELECT DISTINCT unnest(list_distinct(regexp_extract_all(lower(text), '{WORD}'))) AS w FROM documents"
CUTS = """pre(w, i) AS (SELECT w, 0 FROM f UNION SELECT w, i + length(p) FROM pre, (VALUES ('th'), ('er'), ('on'), ('in')) v(p) WHERE substr(w, i + 1, length(p)) = p AND i + length(p) < length(w)),
    suf(w, j) AS (SELECT w, 0 FROM f UNION SELECT w, j + length(s) FROM suf, (VALUES ('ed'), ('tion'), ('es'), ('er')) v(s) WHERE length(w) - j - length(s) > 0 AND substr(w, length(w) - j - length(s) + 1, length(s)) = s),
    res AS (SELECT w, substr(w, i + 1, length(w) - i - j) AS r, bool_or(j = 0) AS po FROM pre JOIN suf USING (w) WHERE i + j > 0 AND i + j < length(w) GROUP BY ALL),
    sup AS (SELECT r, count(*) AS n FROM res WHERE po GROUP BY r),
    ok AS (SELECT w, r FROM res LEFT JOIN sup USING (r) WHERE r IN (SELECT w FROM f) OR (length(r) >= 2 AND n >= 2)),
    best AS (SELECT w, arg_max(r, lpad(length(r)::VARCHAR, 4, '0') || r) AS t FROM ok GROUP BY w),
    walk(form, base, k) AS (SELECT w, w, 0 FROM f UNION ALL SELECT form, t, k + 1 FROM walk JOIN best ON best.w = base),
    bases AS (SELECT form, arg_max(base, k) AS base FROM walk GROUP BY form)"""


def _words(table):
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))


@query(f"WITH RECURSIVE f AS ({WORDS}), {CUTS} SELECT form, base FROM bases")
def base_forms(table):
    d = table("documents")
    return indexes.base_forms(d.select(F.explode(_words(table)).alias("form")), AFFIXES)


@query(
    f"""WITH RECURSIVE f AS ({WORDS}), {CUTS}, post AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '{WORD}'))) AS form FROM documents),
    j AS (SELECT base, form, doc_id FROM post JOIN bases USING (form)), v AS (SELECT base, form, count(DISTINCT doc_id) AS n FROM j GROUP BY ALL)
    SELECT base, (SELECT count(DISTINCT doc_id) FROM j WHERE j.base = v.base) AS n_records, count(*) AS n_forms, string_agg(form || ':' || n, ',' ORDER BY n DESC, form) AS variants FROM v GROUP BY base"""
)
def form_index(table):
    d = table("documents")
    p = indexes.postings(d, "doc_id", _words(table))
    seen = Observation()  # by the pass that takes the forms
    bases = indexes.base_forms(p.observe(seen, F.count(F.lit(1)).alias("n")).select(F.col("term").alias("form")), AFFIXES)
    return indexes.form_index(p, bases, "doc_id", seen_by(seen))


@query(
    """SELECT doc_id, coalesce(l.quality, -1) AS quality, CASE WHEN l.doc_id IS NOT NULL THEN 2 ELSE 1 END AS priority FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels) k LEFT JOIN labels l USING (doc_id)"""
)
def override_union(table):
    base = table("documents").select("doc_id", F.lit(-1).alias("quality"))
    return relate.override_union((base, 1), (table("labels").select("doc_id", "quality"), 2), keys=["doc_id"]).select("doc_id", "quality", "priority")


@query("SELECT n_nationkey, CASE WHEN r_name IS NOT NULL THEN r_name ELSE n_name END AS n_name, n_regionkey FROM nation LEFT JOIN region ON r_regionkey = n_nationkey")
def upsert_dim(table):
    over = table("region").select(F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name")).union(table("region").select(F.lit(999), F.lit("unknown")))
    return relate.upsert(table("nation"), over, "n_nationkey")


@query("SELECT p_partkey, replace(replace(p_name, '(', '（'), ')', '）') AS title, CASE WHEN p_size % 2 = 0 THEN replace(p_name, ' ', '') || '（清素）' ELSE '' END AS aliases FROM (SELECT p_partkey, p_size, replace(p_name, ' ', '') AS p_name FROM part)")
def title_policy(table):
    name = F.replace("p_name", F.lit(" "), F.lit(""))
    t = table("part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.concat(name, F.lit("(清素)"))).otherwise(name).alias("title"), F.array(name).alias("aliases"))
    return relate.title_policy(t).select("p_partkey", "title", F.array_join("aliases", "|").alias("aliases"))


@query(
    """SELECT b.source AS book_id, (SELECT count(*) FROM documents d WHERE d.source = b.source) AS documents,
    (SELECT count(*) FROM documents d JOIN labels l USING (doc_id) WHERE d.source = b.source AND l.toxic = 1) AS toxic FROM (SELECT DISTINCT source FROM documents) b"""
)
def counts_by_group(table):
    d = table("documents").select(F.col("source").alias("book_id"), "doc_id")
    return io.manifest(d.select("book_id").distinct(), (d, "documents"), (d.join(table("labels").filter("toxic = 1"), "doc_id"), "toxic"))
