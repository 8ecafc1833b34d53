"""Sessions, runs, interpolation, numbering and top-k over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import order
from foliospark.queries.registry import query
from foliospark.sources import io


@query(
    """WITH s AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS n,
      last_value(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN 0 END IGNORE NULLS) OVER w AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT user_id, (CASE WHEN st = 1 THEN n ELSE 0 END)::BIGINT AS session, count(*) AS n_events, min(event_id) AS first_event FROM s GROUP BY ALL"""
)
def segment_sessions(table):
    e = F.col("event_type")
    t = order.sessions(table("events"), ["user_id"], ["ts", "event_id"], e == "signup", e == "error")
    return t.groupBy("user_id", "session").agg(F.count("*").alias("n_events"), F.min("event_id").alias("first_event"))


@query(
    """SELECT o_orderkey, concat_ws('|', lag(o_orderkey) OVER w, lead(o_orderkey) OVER w) AS related FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
)
def neighbours(table):
    t = order.neighbours(table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderkey").cast("string"))
    return t.select("o_orderkey", F.array_join("related", "|").alias("related"))


@query(
    """WITH t AS (SELECT *, count(*) FILTER (l_returnflag <> 'R') OVER (PARTITION BY l_suppkey, l_orderkey) AS n FROM lineitem),
    f AS (SELECT * FROM t WHERE n >= 2),
    c AS (SELECT *, last_value(CASE WHEN l_returnflag = 'R' THEN l_linestatus || l_partkey END IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS category FROM f)
    SELECT l_orderkey, l_linenumber, l_suppkey, category FROM c WHERE l_returnflag <> 'R'"""
)
def category_carry(table):
    flag = F.col("l_returnflag")
    name = F.concat("l_linestatus", F.col("l_partkey").cast("string"))
    t = order.carry_category(table("lineitem"), ["l_suppkey"], ["l_orderkey"], ["l_orderkey", "l_linenumber", "l_partkey"], flag == "R", name, flag != "R", 2)
    return t.select("l_orderkey", "l_linenumber", "l_suppkey", "category")


@query(
    """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, event_id, 2 * (row_number() OVER (PARTITION BY user_id ORDER BY event_id)) AS printed,
      CASE WHEN event_type = 'purchase' THEN floor(value * 3)::BIGINT % 50 + 1 END AS known FROM events),
    n AS (SELECT *, (SELECT min(i) FROM e f WHERE f.user_id = e.user_id AND f.i > e.i AND f.known IS NOT NULL) AS ni FROM e),
    m AS (SELECT n.*, f.known AS nk, f.printed AS np FROM n LEFT JOIN e f ON f.user_id = n.user_id AND f.i = n.ni),
    r AS (SELECT user_id, i, event_id, printed AS pp, coalesce(known, CASE WHEN nk IS NOT NULL THEN greatest(1, nk - (np - printed)) ELSE printed END) AS resolved FROM m WHERE i = 1
      UNION ALL SELECT m.user_id, m.i, m.event_id, m.printed, coalesce(m.known, CASE WHEN m.nk IS NOT NULL THEN greatest(r.resolved, least(r.resolved + m.printed - r.pp, m.nk)) ELSE r.resolved + m.printed - r.pp END)
      FROM r JOIN m ON m.user_id = r.user_id AND m.i = r.i + 1)
    SELECT event_id, resolved::BIGINT AS resolved FROM r"""
)
def anchor_interpolate(table):
    t = order.number_within(table("events"), ["user_id"], ["event_id"], "i")
    t = t.select("user_id", "event_id", (2 * F.col("i")).cast("long").alias("printed"), F.when(F.col("event_type") == "purchase", F.floor(F.col("value") * 3).cast("long") % 50 + 1).alias("known"))
    return order.interpolate(t, ["user_id"], ["event_id"], "printed", "known").select("event_id", F.col("resolved").cast("long").alias("resolved"))


@query(
    """WITH d AS (SELECT DISTINCT o_custkey, month(o_orderdate) + 12 * (year(o_orderdate) - 1990) AS m FROM orders),
    g AS (SELECT *, m - row_number() OVER (PARTITION BY o_custkey ORDER BY m) AS g FROM d), r AS (SELECT o_custkey, min(m) AS a, max(m) AS b FROM g GROUP BY o_custkey, g)
    SELECT o_custkey, string_agg(CASE WHEN a = b THEN printf('p%04d', a) ELSE printf('p%04d-p%04d', a, b) END, ', ' ORDER BY a) AS ranges FROM r GROUP BY o_custkey"""
)
def page_ranges(table):
    m = F.month("o_orderdate") + 12 * (F.year("o_orderdate") - 1990)
    return order.run_texts(table("orders").select("o_custkey", m.alias("m")), ["o_custkey"], "m")


@query(
    """SELECT conv_id, count(*) AS n, bool_and(ok) AS monotone FROM (SELECT conv_id, turn + (turn = 3)::INT = row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ok FROM conversations) GROUP BY conv_id"""
)
def step_monotone(table):
    t = table("conversations").withColumn("k", F.col("turn") + (F.col("turn") == 3).cast("int") + 1)
    return order.counts_up(t, ["conv_id"], ["turn"], "k")


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3")
def topk_per_group(table):
    return order.top_per_group(table("orders"), ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "o_totalprice", "rank")


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, min(l_orderkey) OVER (PARTITION BY l_suppkey) AS f FROM lineitem) ORDER BY f, l_suppkey, l_orderkey, l_linenumber LIMIT 80")
def topk_limit(table):
    return order.limit_over_groups(table("lineitem"), "l_suppkey", "l_orderkey", ["l_orderkey", "l_linenumber"], 80).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS c_mktsegment FROM customer GROUP BY c_nationkey")
def first_category(table):
    return order.first_by_place(table("customer"), ["c_nationkey"], ["c_custkey"], "c_mktsegment")


@query(
    """WITH RECURSIVE s AS (SELECT l_suppkey, l_orderkey * 8 + l_linenumber AS page, sum(trunc(l_extendedprice)::BIGINT)::BIGINT AS size FROM lineitem GROUP BY ALL),
    b AS (SELECT l_suppkey, list(page ORDER BY page) AS pages, list_prepend(0::HUGEINT, list(total ORDER BY page)) AS sums, count(*) AS n FROM (SELECT *, sum(size) OVER (PARTITION BY l_suppkey ORDER BY page) AS total FROM s) GROUP BY l_suppkey),
    w(l_suppkey, start, k, done) AS (
      SELECT l_suppkey, 0::BIGINT, least(200, n)::BIGINT, false FROM b
      UNION ALL
      SELECT l_suppkey, CASE WHEN fits THEN start + k ELSE start END, CASE WHEN fits THEN least(200, n - start - k) ELSE greatest(1, least(k - 1, trunc((k * 1048576)::DOUBLE / size * 0.97)::BIGINT)) END, fits
      FROM (SELECT w.l_suppkey, start, k, n, sums[start + k + 1] - sums[start + 1] AS size, k = 1 OR sums[start + k + 1] - sums[start + 1] <= 1048576 AS fits FROM w JOIN b USING (l_suppkey) WHERE start < n)),
    c AS (SELECT l_suppkey, start, min(k) AS k FROM w WHERE k > 0 GROUP BY ALL)
    SELECT l_suppkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY start))::INTEGER AS part, pages[start + 1] AS first_page, pages[start + k] AS last_page, k AS n_pages FROM c JOIN b USING (l_suppkey)"""
)
def page_packing(table):
    sizes = table("lineitem").groupBy("l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("page")).agg(F.sum(F.col("l_extendedprice").cast("long")).alias("size"))
    return io.part_ranges(sizes, ["l_suppkey"], "page", "size", 200, 1 << 20)
