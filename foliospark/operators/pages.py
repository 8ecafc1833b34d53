"""Page classification: structure flags, kind, confidence, warnings and section headers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.vocabulary import DEFAULT, Vocabulary

SPARSE, FAIR, FULL = 24, 80, 160
SUSPICIOUS = ("�", "[A-Za-z]{6,}")

# The warnings as published results word them.
SAYS = {
    "sparse": "very sparse text",
    "titles": "multiple recipe title candidates on one page",
    "empty": "empty cleaned text",
    "pattern": "suspicious text pattern matched: ",
}


def select_groups(df: DataFrame, key: str, wanted: list | None = None, enabled: str = "enabled", status: str = "status") -> DataFrame:
    """Named groups, or by default those that are enabled and not pending.  Both filters reach the scan."""
    return df.filter(F.col(key).isin(*wanted)) if wanted else df.filter(F.col(enabled) & (F.col(status) != "pending"))


def _any(c: Column, words) -> Column:
    return reduce(lambda a, w: a | c.contains(w), words, F.lit(False))


def with_structure(
    pages: DataFrame, raw: str = "raw_text", titles: str = "title_candidates", page_no: str = "local_page", cleaned: str | None = None, v: Vocabulary = DEFAULT
) -> DataFrame:
    """Adds has_<section>_header, is_toc, is_front_matter and is_category_page.

    Header words and contents are looked for anywhere in the raw text, lengths
    are the ``cleaned`` text's.
    """
    t, n, names = F.col(raw), F.length(cleaned or raw), F.transform(titles, lambda x: F.btrim(T.normalize_text(x), F.lit("：: ")))
    toc = F.exists(names, lambda x: F.replace(x, F.lit(" "), F.lit("")) == v.contents) | (t.contains(v.contents) & t.contains("…"))
    category = ~toc & (F.size(titles) > 0) & F.forall(names, lambda x: x.endswith(v.category_suffix) | x.endswith(v.contents)) & (n <= 40)
    return pages.select(
        "*",
        *(_any(t, words).alias(f"has_{section}_header") for section, words in (v.page_words or v.headers)),
        toc.alias("is_toc"),
        ((F.col(page_no) <= 2) & (n <= 20)).alias("is_front_matter"),
        category.alias("is_category_page"),
    )


def page_kind(titles: Column, has_steps: Column, has_items: Column, toc: Column, front: Column, category: Column) -> Column:
    none = F.size(titles) == 0
    return (
        F.when(toc, "toc").when(front, "front_matter").when(category, "category")
        .when(none & (has_steps | has_items), "continuation").when(none, "unresolved").otherwise("recipe")
    )


def confidence(text: Column, titles: Column, has_steps: Column, has_items: Column, fair: int = FAIR, full: int = FULL) -> Column:
    n, titled = F.length(text), F.size(titles) > 0
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "failed").when(titled & has_steps & has_items & (n >= full), "high")
        .when(titled & (n >= fair), "medium").otherwise("low")
    )


def warnings(text: Column, titles: Column, sparse: int = SPARSE, patterns=SUSPICIOUS) -> Column:
    """array<string> of what is odd about a page, each once, in a fixed order."""
    n = F.length(text)
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.when(n < sparse, SAYS["sparse"]),
                F.when(F.size(titles) > 1, SAYS["titles"]),
                F.when(n == 0, SAYS["empty"]),
                *(F.when(text.rlike(T.java_pattern(p)), SAYS["pattern"] + p) for p in patterns),
            )
        )
    )


def review_needed(text: Column, titles: Column, kind: Column, has_steps: Column, sparse: int = SPARSE) -> Column:
    return (F.length(text) < sparse) | (F.size(titles) > 1) | (kind == "unresolved") | ((kind == "continuation") & ~has_steps)


def normalize_pages(pages: DataFrame, rules: list[T.Replacement] = (), v: Vocabulary = DEFAULT) -> DataFrame:
    """Cleans page texts and all their blocks, finds titles again and classifies.

    ``pages`` has book_id, local_page, raw_text and text_blocks.
    """
    clean = lambda c: T.normalize_text(T.apply_rules(T.normalize_text(c), list(rules)))
    blocks = F.transform("text_blocks", lambda b: b.withField("text", clean(b["text"])))
    p = pages.withColumn("cleaned_text", clean(F.col("raw_text"))).withColumn("text_blocks", blocks)
    titles = F.transform(F.filter("text_blocks", lambda b: (b["block_type"] == "title") & (b["text"] != "")), lambda b: b["text"])
    p = with_structure(p.withColumn("title_candidates", titles), cleaned="cleaned_text", v=v)
    p = p.withColumn("record_titles", F.filter("title_candidates", lambda x: T.loose_title(x)))
    names, t = F.col("record_titles"), F.col("cleaned_text")
    steps, items = F.col("has_steps_header"), F.col("has_ingredients_header")
    p = p.withColumn("page_kind", page_kind(names, steps, items, F.col("is_toc"), F.col("is_front_matter"), F.col("is_category_page")))
    return p.select(
        "*",
        confidence(t, names, steps, items).alias("confidence"),
        warnings(t, names).alias("warnings"),
        review_needed(t, names, F.col("page_kind"), steps).alias("review_needed"),
    )


# The numbers a section header may have before it, and the marks behind it.
_ENUM = "^(?:[（(]\\s*[一二三四五六七八九十\\d]+\\s*[）)]|[一二三四五六七八九十]\\s*[、，,．.。:：]?)\\s*"
_TAIL = "[：:；;。，,．.、·…！!？?\\s]"


def section_header(c: Column, v: Vocabulary = DEFAULT) -> Column:
    """struct(section, rest) where a line is a header: an optional number, a header word, then punctuation or nothing.

    Header words are tried as they stand and without the number; the list's order decides.
    """
    kind = "struct<section:string,rest:string>"

    def of(candidate: Column) -> Column:
        found = F.lit(None).cast(kind)
        for section, words in reversed(v.headers):
            head = f"^(?:{'|'.join(map(re.escape, words))})(?:{_TAIL}+|$)"
            found = F.when(candidate.rlike(head), F.struct(F.lit(section).alias("section"), F.regexp_replace(candidate, head, "").alias("rest"))).otherwise(found)
        return found

    return T.let(T.normalize_text(c), lambda t: F.coalesce(of(t), T.let(F.regexp_replace(t, _ENUM, ""), of)))


def appendix_page(titles: Column, head: str = "附", v: Vocabulary = DEFAULT) -> Column:
    """Whether some title opens an appendix: the head word with a colon, and no plausible name behind it."""
    pattern = f"^{re.escape(head)}\\s*[：:]\\s*"
    opens = lambda t: t.rlike(pattern) & ~T.let(F.regexp_replace(t, pattern, ""), lambda x: T.plausible_title(x, v=v))
    return F.exists(titles, lambda x: T.let(T.normalize_text(x), opens))
