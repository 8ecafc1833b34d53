"""Inverted indexes, canonical forms, evidence counts, rollups and the link dictionary."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions.text import let
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.sources.scratch import materialize


def inverted_index(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(term, n_docs, first_doc, last_doc); the terms of a document are made distinct in its own row, before any shuffle."""
    t = docs.select(key, F.explode(F.array_distinct(terms)).alias("term"))
    return t.groupBy("term").agg(F.count("*").alias("n_docs"), F.min(key).alias("first_doc"), F.max(key).alias("last_doc"))


def postings(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(term, key), distinct: the index itself, one row a posting, so that a common term is no single value."""
    return docs.select(F.explode(F.array_distinct(terms)).alias("term"), key)


def residuals(word: Column, v: Vocabulary = DEFAULT) -> Column:
    """array<struct<r, prefix_only>>: proper parts of a word by cutting known prefixes and suffixes, any number of each.

    Cut places reachable from the left times cut places reachable from the
    right; ``prefix_only`` where some way cuts nothing on the right.
    """
    n = F.length(word)
    some = lambda parts: "^(?:" + "|".join(map(re.escape, parts)) + ")*$" if parts else "^$"
    left = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring(word, F.lit(1), i).rlike(some(v.prefixes)))
    right = F.filter(F.sequence(F.lit(0), n), lambda j: F.substring(word, n - j + 1, j).rlike(some(v.suffixes)))
    # ``let`` computes each list of cuts once, not once for each element that a lambda sees
    both = lambda l, r: F.flatten(F.transform(l, lambda i: F.transform(r, lambda j: F.struct(i.alias("i"), j.alias("j")))))
    pairs = let(left, lambda l: let(right, lambda r: both(l, r)))
    proper = F.filter(pairs, lambda p: (p["i"] + p["j"] > 0) & (p["i"] + p["j"] < n))
    return F.transform(proper, lambda p: F.struct(F.substring(word, p["i"] + 1, n - p["i"] - p["j"]).alias("r"), (p["j"] == 0).alias("prefix_only")))


def base_forms(forms: DataFrame, v: Vocabulary = DEFAULT, black: tuple[str, ...] = (), atomic: tuple[str, ...] = ()) -> DataFrame:
    """(form, base).  A form steps to its longest usable residual and on, as long as that is a form itself.

    Usable is what is a form, or has two characters or more and is left over
    in two forms or more by prefixes alone.  Each round doubles the steps
    taken and the last one changes nothing, so a word that is cut n times needs
    about log n rounds.
    """
    f = materialize(forms.select("form").distinct(), "forms")
    r = f.filter(F.length("form") > 1).select("form", F.explode(residuals(F.col("form"), v)).alias("x")).select("form", "x.*")
    r = r.groupBy("form", "r").agg(F.max("prefix_only").alias("prefix_only"))
    r = materialize(r, "residuals")
    support = r.filter("prefix_only").groupBy("r").agg(F.count("*").alias("support"))
    usable = r.join(support, "r", "left").join(f.select(F.col("form").alias("r"), F.lit(True).alias("attested")), "r", "left")
    usable = usable.filter(~F.col("r").isin(*black or ("",)) & (F.col("attested") | ((F.length("r") >= 2) & (F.col("support") >= 2))))
    usable = usable.filter(~F.col("form").isin(*atomic or ("",)))
    best = usable.groupBy("form").agg(F.max(F.struct(F.length("r").alias("n"), F.col("r"))).alias("m")).select("form", F.col("m.r").alias("to"))
    step = materialize(f.join(best, "form", "left").select("form", F.coalesce("to", "form").alias("base")), "steps")
    while True:
        onward = step.select(F.col("form").alias("was"), F.col("base").alias("next"))
        step = materialize(step.join(onward, F.col("base") == F.col("was"), "left").select("form", F.col("base").alias("was"), F.coalesce("next", "base").alias("base")), "steps")
        more = step.filter("was != base").limit(1).count()
        step = step.select("form", "base")
        if not more:
            return step


#: Postings that a task makes distinct.
PART = 1 << 20


def form_index(postings_: DataFrame, bases: DataFrame, record: str, n_postings: int | None = None) -> DataFrame:
    """(base, n_records, n_forms, variants): records are counted once a base; variants by falling count, then name.

    All forms that a record has of a base meet in one row, of which the first
    form counts the record for the base.  Postings are dealt by base and record
    with no map before it, ``PART`` to a task; ``n_postings`` is counted where
    it is not known.  A null record is none.
    """
    n = postings_.count() if n_postings is None else n_postings
    usual = int(postings_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, -(-n // PART))
    if parts > usual:  # so that a merge sorts no more of them at a time either
        postings_ = postings_.repartition(parts, "term")
    p = postings_.join(bases, postings_["term"] == bases["form"]).select("base", "form", record)
    own = p.repartition(parts, "base", record).groupBy("base", record).agg(F.collect_set("form").alias("forms"))
    each = own.select("base", record, F.posexplode("forms").alias("_i", "form"))
    per_form = each.groupBy("base", "form").agg(F.count(record).alias("n"), F.count(F.when(F.col("_i") == 0, F.col(record))).alias("_first"))
    t = per_form.groupBy("base").agg(F.sum("_first").alias("n_records"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "form"))).alias("v"))
    listed = F.array_join(F.transform("v", lambda x: F.concat_ws(":", x["form"], (-x["k"]).cast("string"))), ",")
    return t.select("base", "n_records", F.size("v").cast("long").alias("n_forms"), listed.alias("variants"))


def rule_evidence(df: DataFrame, text: Column, rules: dict[str, str], page: Column, samples: int = 5) -> DataFrame:
    """(rule, n, samples): how many rows each pattern finds, and its first distinct texts."""
    hits = F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(n)) for n, p in rules.items())))
    t = df.select(F.explode(hits).alias("rule"), page.alias("_page"), text.alias("_text"))
    n = t.groupBy("rule").agg(F.count("*").alias("n"))
    # the first page of each distinct text, and the first few of those by a bounded window
    first = t.groupBy("rule", "_text").agg(F.min("_page").alias("_page"))
    top = first.withColumn("_r", F.row_number().over(Window.partitionBy("rule").orderBy("_page", "_text"))).filter(F.col("_r") <= samples)
    s = top.groupBy("rule").agg(F.sort_array(F.collect_list(F.struct("_r", "_text"))).alias("s"))
    return n.join(s, "rule").select("rule", "n", F.transform("s", lambda x: x["_text"]).alias("samples"))


def frequencies(df: DataFrame, value: Column, seen: Column) -> DataFrame:
    """(value, n, first_seen); order by n descending and first_seen for the report."""
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"), F.min(seen).alias("first_seen"))


def grouped_counts(df: DataFrame, *sets: list[str]) -> DataFrame:
    """Counts of several groupings in one pass: grouping sets; other columns are null."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in cols)).agg(F.count("*").alias("n"))


# --- search -------------------------------------------------------------------------


def search(rows: DataFrame, term: str = "", **equal: str) -> DataFrame:
    """Rows with equal facets whose blob holds the trimmed term, case as typed, in (b, u) order."""
    for name, value in equal.items():
        if value:
            rows = rows.filter(F.col(name) == value)
    return (rows.filter(F.col("s").contains(term.strip())) if term.strip() else rows).orderBy("b", "u")
