"""Triage: contents entries, title overrides, page buckets, progress."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.operators.layout import fill_forward
from foliospark.operators.order import run_texts
from foliospark.operators.pages import SAYS
from foliospark.sources.scratch import materialize

# The forms of a contents entry, of a reference to a printed page, and of the enumerators that a confirmed title has.
ENTRY = "^(.+?)\\s*[.…·]*\\s*[（(]\\s*(\\d+)\\s*[.)）]+\\s*$"
PAGE_REF = "[（(]\\s*\\d+\\s*[.)）]"
TITLE_NUMBER = "^[（(]?[一二三四五六七八九十百千零〇\\d]+[)）]\\s*"


def entry_of(token: Column) -> Column:
    """struct(title, printed_page) of a contents entry ``title … (12)``, else null."""
    return F.when(token.rlike(ENTRY), F.struct(F.regexp_extract(token, ENTRY, 1).alias("title"), F.regexp_extract(token, ENTRY, 2).cast("int").alias("printed_page")))


def content_tokens(content: Column) -> Column:
    """array<string> of a confirmed page's content: without control marks, cut at any slash."""
    said = F.split(T.strip_markers(T.canonical_text(content)), "/|\n")
    return F.filter(F.transform(said, lambda x: T.strip(x)), lambda x: x != "")


def read_contents(pages: DataFrame, content: str = "correct_content", least: int = 3, rules: list[T.Replacement] = (), v: Vocabulary = DEFAULT) -> DataFrame:
    """(book_id, local_page, pos, category, title, printed_page, rejected) of contents pages.

    A page is one of contents if ``least`` tokens refer to a page.  A token that
    ends like a category sets it, also for the pages behind.  An entry whose
    title, without notes, can name no record is rejected.
    """
    t = pages.select("book_id", "local_page", content_tokens(F.col(content)).alias("tokens"))
    t = t.filter(F.size(F.filter("tokens", lambda x: x.rlike(PAGE_REF))) >= least)
    t = t.select("book_id", "local_page", F.posexplode("tokens").alias("pos", "token"))
    head = F.when((F.col("token") != v.contents) & F.col("token").endswith(v.category_suffix), F.col("token"))
    t = fill_forward(t.withColumn("head", head), ["book_id"], ["local_page", "pos"], F.col("head"), "category")
    entry = F.when(F.col("head").isNull() & (F.col("token") != v.contents), entry_of(F.col("token")))
    t = t.withColumn("e", entry).filter("e is not null")
    t = t.select("book_id", "local_page", "pos", F.coalesce("category", F.lit("")).alias("category"), T.canonical_title(F.col("e.title"), rules).alias("title"), "e.printed_page")
    core = F.regexp_replace(F.col("title"), "[（(][^（()）]*[）)]", "")
    core = F.coalesce(F.nullif(T.strip(core, ".-· "), F.lit("")), F.col("title"))
    return t.filter("title != ''").withColumn("rejected", ~T.plausible_title(core, v=v))


def contents_entries(pages: DataFrame, content: str = "correct_content", least: int = 3, rules: list[T.Replacement] = (), v: Vocabulary = DEFAULT) -> DataFrame:
    """(book_id, local_page, pos, category, title, printed_page): the entries that can name a record."""
    return read_contents(pages, content, least, rules, v).filter("not rejected").drop("rejected")


def title_override(content: Column, longest: int = 30, v: Vocabulary = DEFAULT) -> Column:
    """The first token of a confirmed page, without its number, if it is an enumerated, plausible title; else null."""
    words = "|".join(map(re.escape, ("原料", "制法", "特点")))

    def of(first: Column) -> Column:
        plain = ~first.rlike(f"{PAGE_REF}|{words}|[：:]") & (first != v.contents) & ~first.endswith(v.category_suffix)
        title = T.canonical_title(first)
        return F.when(plain & (F.length(first) <= longest) & first.rlike(TITLE_NUMBER) & T.plausible_title(title, v=v), title)

    return of(F.get(content_tokens(content), F.lit(0)))


def confirmation_counts(pages: DataFrame, rules: list[T.Replacement] = (), v: Vocabulary = DEFAULT) -> DataFrame:
    """One row of counts over pages with confirmed, correct_content and page_kind; contents pages never give a title."""
    done = pages.filter("confirmed")
    entries = read_contents(done.filter("correct_content != ''"), rules=rules, v=v)
    per_page = entries.groupBy("book_id", "local_page").agg(F.count(F.when(~F.col("rejected"), 1)).alias("good"), F.count(F.when(F.col("rejected"), 1)).alias("bad"))
    t = done.join(per_page, ["book_id", "local_page"], "left")
    good, bad = F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0))
    titled = (good == 0) & ~F.coalesce("page_kind", F.lit("")).isin("toc", "category") & title_override(F.col("correct_content"), v=v).isNotNull()
    one = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return t.agg(
        F.count("*").alias("confirmed_pages"), one(good > 0).alias("confirmed_toc_pages"), one(good).alias("toc_entries"),
        one(bad).alias("toc_entries_rejected"), one(titled).alias("title_overrides"),
    )


def placeholder_lines(blocks: DataFrame, marks: str = "▢□", region: str = "in_region") -> DataFrame:
    """(book_id, local_page, lines): blocks of a region that hold a placeholder of an unreadable character."""
    hit = blocks.filter(F.col(region) & F.col("text").rlike(f"[{marks}]"))
    listed = F.sort_array(F.collect_list(F.struct("ord", "text")))
    return hit.groupBy("book_id", "local_page").agg(F.transform(listed, lambda x: x["text"]).alias("lines"))


def triage(p: DataFrame) -> DataFrame:
    """Adds reasons (what makes a page severe), notes, severe and bucket (must_review, optional_sample, safe_to_skip).

    ``p`` has page_kind, confidence, warnings, confirmed, n_records, n_anchors,
    has_override and n_placeholders, as a star of left joins on the page gives
    them.  Several titles are no fault where the page is confirmed or two
    records or two contents entries start on it; what only the layout leaves
    open counts on unconfirmed pages; an unreadable character lifts a page that
    could be skipped.
    """
    c = F.col
    linked, several = c("n_records") > 0, F.array_contains("warnings", SAYS["titles"])
    stable = c("confirmed") | (c("n_anchors") >= 2) | (c("n_records") >= 2)
    grave = lambda w: w.startswith(SAYS["pattern"]) | w.isin(SAYS["sparse"], SAYS["empty"])
    say = lambda when, text: F.when(F.coalesce(when, F.lit(False)), F.lit(text))
    reasons = F.concat(
        F.array(say(several & ~stable, "multiple title candidates without stable anchor evidence")),
        F.filter("warnings", grave),
        F.array(
            say(c("confidence") == "failed", "failed confidence"),
            say(~c("confirmed") & (c("page_kind") == "unresolved"), "unresolved page kind"),
            say(~c("confirmed") & (c("page_kind") == "continuation") & ~linked, "continuation page not linked to a recipe candidate"),
        ),
    )
    notes = F.concat(
        F.array(
            say(c("confirmed"), "confirmed by user review"),
            say(c("n_placeholders") > 0, "unreadable-glyph placeholder in ingredient region"),
            say(c("has_override"), "title override available"),
            say(c("n_anchors") > 0, "confirmed toc starts on this page"),
            say(c("n_records") >= 2, "recipe anchors detected on this page"),
            say(several & stable, "multiple title candidates treated as a valid multi-anchor page"),
        ),
        F.filter("warnings", lambda w: ~grave(w) & (w != SAYS["titles"])),
        F.array(say(~c("confirmed") & (c("page_kind") == "continuation") & linked, "continuation page already linked to recipe candidate")),
    )
    t = p.withColumn("reasons", F.array_compact(reasons)).withColumn("severe", F.size("reasons") > 0)
    anchored = (c("n_records") >= 2) | (c("n_anchors") >= 1) | c("has_override")
    medium = ~c("confirmed") & ~c("severe") & (c("confidence") == "medium")
    base = (
        F.when(c("confirmed"), "safe_to_skip").when(c("severe"), "must_review").when(medium, "optional_sample")
        .when((c("page_kind") == "continuation") & linked, "optional_sample").when((c("confidence") == "high") & anchored, "safe_to_skip")
        .when(anchored, "optional_sample").otherwise("safe_to_skip")
    )
    lifted = F.when((base == "safe_to_skip") & (c("n_placeholders") > 0), "optional_sample").otherwise(base)
    return t.withColumn("notes", F.array_compact(F.concat(notes, F.array(say(medium, "medium confidence page"))))).withColumn("bucket", lifted)


def progress(pages: DataFrame, by: str = "book_id", page: str = "local_page", confirmed: str = "confirmed", corrected: str = "corrected") -> DataFrame:
    """(by, pages, confirmed, corrected, remaining): a line a group with the ranges still to do, and one total with a null group."""
    sums = pages.rollup(by).agg(
        F.count("*").alias("pages"), F.sum(F.col(confirmed).cast("long")).alias("confirmed"), F.sum(F.col(corrected).cast("long")).alias("corrected"),
        F.grouping(by).alias("g"),
    )
    left = run_texts(pages.filter(~F.col(confirmed)), [by], page).withColumnRenamed("ranges", "remaining")
    total = sums.filter("g = 1").select(F.lit(None).cast(pages.schema[by].dataType).alias(by), "pages", "confirmed", "corrected", F.lit("").alias("remaining"))
    return sums.filter("g = 0").join(left, by, "left").select(by, "pages", "confirmed", "corrected", F.coalesce("remaining", F.lit("")).alias("remaining")).unionByName(total)


# What a note says for each rule that reviewers teach, as expressions that must all be found.
TAUGHT = {
    "normalize_brackets_to_ascii": ("括号", "英文"),
    "remove_spurious_inner_spaces": ("空格", "去除|去掉"),
    "accept_current_content": ("内容正确",),
    "respect_category_boundaries": ("属于|开始",),
    "multi_recipe_anchor_page_is_valid": ("两个菜谱标题|三个菜谱",),
    "apply_title_override": ("通假字|其实是",),
}


def learned_rules(confirmations: DataFrame, taught: dict[str, tuple[str, ...]] = TAUGHT, samples: int = 5) -> DataFrame:
    """(rule, evidence_count, pages, sample_notes) of confirmed rows, most evidence first."""
    done = confirmations.filter("confirmed").withColumn("note", T.normalize_text(F.col("notes")))
    every = lambda parts: reduce(lambda a, p: a & F.col("note").rlike(p), parts, F.lit(True))
    hits = F.array_compact(F.array(*(F.when(every(parts), F.lit(n)) for n, parts in taught.items())))
    t = done.select(F.explode(hits).alias("rule"), F.format_string("%s#p%04d", "book_id", "local_page").alias("page"), "notes")
    pages = t.groupBy("rule").agg(F.count("*").alias("evidence_count"), F.array_join(F.sort_array(F.collect_list("page")), ", ").alias("pages"))
    first = t.filter("notes != ''").groupBy("rule", "notes").agg(F.min("page").alias("page"))
    top = first.withColumn("n", F.row_number().over(Window.partitionBy("rule").orderBy("page", "notes"))).filter(F.col("n") <= samples)
    said = top.groupBy("rule").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "notes"))), lambda x: x["notes"]), " | ").alias("sample_notes"))
    return pages.join(said, "rule", "left").orderBy(F.desc("evidence_count"), "rule")


def write_learning(confirmations: DataFrame, folder: str) -> None:
    """Three outputs of what reviewers taught: confirmed rows and rules as JSON, and a Markdown report."""
    rules = materialize(learned_rules(confirmations), "rules")
    confirmations.filter("confirmed").write.mode("overwrite").json(f"{folder}/confirmation_records")
    rules.write.mode("overwrite").json(f"{folder}/learned_confirmation_rules")
    n = confirmations.agg(F.count(F.when(F.col("confirmed"), 1)).alias("done"), F.count("*").alias("all")).select(
        F.format_string("# Learned Confirmation Rules\n\n- Confirmed entries read: %d\n- Total queue entries parsed: %d\n\n## Learned Rules", "done", "all").alias("line"), F.lit(0).alias("part"), F.lit("").alias("at")
    )
    notes = F.when(F.col("sample_notes").isNotNull(), F.concat(F.lit("\n  notes: "), "sample_notes")).otherwise("")
    line = F.concat(F.format_string("- %s: %d pages\n  pages: %s", "rule", "evidence_count", "pages"), notes)
    said = rules.select(line.alias("line"), F.lit(1).alias("part"), F.format_string("%09d%s", F.lit(10**8) - F.col("evidence_count"), "rule").alias("at"))
    either = lambda c, text: F.when(F.col(c) != "", text).otherwise("无")
    pages = confirmations.filter("confirmed").select(
        F.concat(F.format_string("- %s p.%d: notes=", "book_id", "local_page"), either("notes", F.col("notes")), F.lit(" | correct_content="), either("correct_content", F.lit("有"))).alias("line"),
        F.lit(3).alias("part"), F.format_string("%s%09d", "book_id", "local_page").alias("at"),
    )
    head = n.select(F.lit("\n## Confirmed Pages").alias("line"), F.lit(2).alias("part"), F.lit("").alias("at"))
    lines = n.unionByName(said).unionByName(head).unionByName(pages)
    lines.orderBy("part", "at").coalesce(1).select(F.col("line").alias("value")).write.mode("overwrite").text(f"{folder}/learned_confirmation_rules_md")
