"""Quality rules with cross-document line frequency, in native expressions only.

Per document: word, symbol, repeated-line and repeated-window counts, all
linear or n log n in the text.  Across documents: lines are normalised (edges
trimmed, lower-cased, inner blanks to one, digits to 0) and hashed; for each
host the distinct documents that hold a line are counted.  A line in more than
``max(least_docs, min(most_docs, line_share * documents of the host))`` of them,
which are more than ``least_docs`` different texts - copies of one clean text
don't make its lines boilerplate - is removed from the text that is returned; a
document is depleted, and rejected, when fewer than ``keep_share`` of its words
are left.  ``most_docs`` ends the share, so a line in that many documents is
boilerplate on a host of any size.

The frequent lines of a host number fewer than its average lines a document
divided by ``line_share``; they are still broadcast only where Spark measures
their size to be below its own limit, else joined by a shuffle on the line.

Null text: no words, base_failed.  Null host: a host of its own.  Repeated
rows share one result; one id and text in two hosts lose each what their own
host's limit takes; no row is dropped.  Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import WORD_SPLIT, keyed, materialize, n_words_of, quoted, release

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
HAS_WORD = "[^\\x20\\x09-\\x0D]"
LEAST_DOCS, LINE_SHARE, MOST_DOCS, KEEP_SHARE = 20, 0.001, 1000, 0.5


def let(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _deleted(text: Column, chars: str) -> Column:
    """One fast byte search for each character; ``translate`` looks every character of the text up in a map."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text)


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that occur at least twice in the list.

    The 64-bit window hashes are sorted; only a list with an equal pair pays
    for the second sort, by hash and position.
    """
    span = F.size(words) - (width - 1)
    window = lambda w, i: F.xxhash64(*(F.get(w, i + k) for k in range(width)))

    def covered(w: Column, hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def marks(s: Column) -> Column:
            n = F.size(s)
            same = F.zip_with(F.slice(s, 1, n - 1), F.slice(s, 2, n - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
            return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))

        def total(p: Column) -> Column:
            n = F.size(p)
            gaps = F.zip_with(F.slice(p, 1, n - 1), F.slice(p, 2, n - 1), lambda a, b: F.least(b - a, F.lit(width)))
            return F.aggregate(gaps, F.lit(width), lambda acc, g: acc + g)

        return let(let(pairs, marks), total)

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: window(w, i))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(w, h)).otherwise(F.lit(0)))

    return F.when(span >= 2, let(words, of)).otherwise(F.lit(0)).cast("long")


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANKS))), WORD_SPLIT, " "), "[0-9]", "0")


def with_base(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to ``df``."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    parts = df.select(
        "*",
        F.filter(F.split(t, WORD_SPLIT), lambda w: w != "").alias("_words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD)).alias("_lines"),
    )
    return parts.select(
        *df.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(_deleted(t, BLANKS)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_deleted(t, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_words")).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def frequent_lines(docs: DataFrame, least_docs: int, line_share: float, most_docs: int) -> DataFrame:
    """(rid, rv, host, removed_words, at) of the rows of (rid, rv, host, text) that have lines to remove, ``at`` being their places.

    Lines are counted by occurrence first, with map-side sums; only the few
    that pass are counted exactly, by distinct document and text.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    lines = F.filter(lines, lambda l: l["x"].rlike(HAS_WORD))
    hashed = F.transform(lines, lambda l: F.struct(F.xxhash64(normalised(l["x"])).alias("h"), n_words_of(l["x"]).alias("w"), l["i"].alias("i")))
    each = docs.select("rid", "rv", "host", F.xxhash64("text").alias("content"), F.explode(hashed).alias("l"))
    each = materialize(each.select("rid", "rv", "host", "content", "l.i", "l.h", "l.w"), "lines")
    limit = each.select("host", "rid", "rv").distinct().groupBy("host").agg(F.greatest(F.lit(float(least_docs)), F.least(F.lit(float(most_docs)), line_share * F.count("*"))).alias("limit"))
    often = each.groupBy("host", "h").agg(F.count("*").alias("c")).filter(F.col("c") > least_docs)
    often = materialize(often.join(limit, "host").filter("c > limit").select("host", "h", "limit"), "often")
    held = materialize(each.join(often, ["host", "h"]), "held")
    release(each, often)
    by_text = held.select("host", "h", "rid", "rv", "content", "limit").distinct().groupBy("host", "h", "content").agg(F.count("*").alias("n"), F.first("limit").alias("limit"))
    above = by_text.groupBy("host", "h").agg(((F.sum("n") > F.first("limit")) & (F.count("*") > least_docs)).alias("above"))
    above = materialize(above.filter("above").select("host", "h"), "above")  # like ``often``: a join of an aggregate itself could not be split where a line is hot
    gone = held.join(above, ["host", "h"]).select("rid", "rv", "host", "h", "i", "w").distinct()
    gone = materialize(gone.groupBy("rid", "rv", "host").agg(F.sum("w").alias("removed_words"), F.collect_list("i").alias("at")), "gone")
    release(held, above)
    return gone


def without_lines(text: Column, at: Column) -> Column:
    """``text`` without the lines at the places ``at``; null places leave it as it is."""
    kept = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), at)
    cut = let(F.split(text, "\n"), lambda x: F.array_join(F.transform(kept(x), lambda i: F.get(x, i)), "\n"))
    return F.when(at.isNull(), text).otherwise(cut)


def apply_quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least_docs: int = LEAST_DOCS,
    line_share: float = LINE_SHARE,
    keep_share: float = KEEP_SHARE,
    most_docs: int = MOST_DOCS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(rid, rv, id, *keep, n_words .. base_failed, removed_words, kept, kept_text): the verdict on every row, and its text without frequent lines."""
    docs = keyed(df, id_col, text_col, F.xxhash64(df[quoted(host_col)].isNull(), df[quoted(host_col)].cast("string")).alias("host"), *keep)
    gone = frequent_lines(docs.select("rid", "rv", "host", "text"), least_docs, line_share, most_docs)
    base = with_base(docs)
    out = base.join(gone, ["rid", "rv", "host"], "left")
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    kept = ~F.col("base_failed") & (F.col("n_words") - removed >= keep_share * F.col("n_words"))
    text = without_lines(F.col("text"), F.col("at")).alias("kept_text")
    return out.select(*(c for c in base.columns if c not in ("host", "text")), removed.alias("removed_words"), kept.alias("kept"), text)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_quality_rules(docs).withColumnRenamed("id", "doc_id").drop("rid", "rv", "kept_text")


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, chr(0)) AS host FROM documents),
b AS (
  SELECT doc_id, t, host, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM b)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS k(k) GROUP BY doc_id),
line AS (
  SELECT doc_id, t, host, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n,
    regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(x, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')), '[\\x20\\x09-\\x0D]+', ' ', 'g'), '[0-9]', '0', 'g') AS norm
  FROM (SELECT doc_id, t, host, unnest(l) AS x FROM b)),
lim AS (SELECT host, greatest({LEAST_DOCS}, least({MOST_DOCS}, {LINE_SHARE} * count(DISTINCT doc_id))) AS lim FROM line GROUP BY host),
freq AS (SELECT line.host, norm FROM line JOIN lim USING (host) GROUP BY line.host, norm HAVING count(DISTINCT doc_id) > max(lim) AND count(DISTINCT t) > {LEAST_DOCS}),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n FROM line JOIN freq USING (host, norm) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
  (len(w) < 50 OR 100 * coalesce(cov.n, 0) > 50 * len(w)) AS base_failed,
  coalesce(gone.n, 0)::BIGINT AS removed_words,
  NOT (len(w) < 50 OR 100 * coalesce(cov.n, 0) > 50 * len(w)) AND len(w) - coalesce(gone.n, 0) >= {KEEP_SHARE} * len(w) AS kept
FROM b LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)"""
