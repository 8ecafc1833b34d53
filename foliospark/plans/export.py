"""What a build writes for readers and reviewers: notes, index pages, page reviews, and the review report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators import order, relate, site
from foliospark.operators.pages import SAYS
from foliospark.sources import io

# Fixed value: headings of a record's note by section.
NOTE_SECTIONS = {"原料": "ingredients", "调料": "seasonings", "做法": "steps", "特点": "tips"}
BUCKETS = ("must_review", "optional_sample", "safe_to_skip")


def named_records(records: DataFrame) -> DataFrame:
    """Records with their file name: by book, first page and title."""
    return records.withColumn("file_name", T.record_filename(F.col("book_id"), F.array_min("local_pages"), T.safe_filename(F.col("title"))))


def named_fallbacks(fallbacks: DataFrame) -> DataFrame:
    return fallbacks.withColumn("file_name", T.fallback_filename(F.col("book_id"), F.col("local_page")))


def export_notes(records: DataFrame, fallbacks: DataFrame, folder: str) -> tuple[int, int, int]:
    """Writes notes to ``recipes`` and ``page_fallbacks`` below a folder and deletes files of notes that are no more: (records, fallbacks, deleted)."""
    r, f = named_records(records), named_fallbacks(fallbacks)
    n = io.write_files(r.select("file_name", io.render_record(NOTE_SECTIONS).alias("body")), f"{folder}/recipes")
    m = io.write_files(f.select("file_name", io.render_fallback().alias("body")), f"{folder}/page_fallbacks")
    spark = records.sparkSession
    gone = sum(io.prune(spark, f"{folder}/{part}", notes) for part, notes, there in (("recipes", r, n), ("page_fallbacks", f, m)) if there)
    return n, m, gone


def export_indexes(lines: DataFrame, folder: str) -> int:
    """Writes the lines of ``site.index_lines`` as one file an index page; a page is as long as its index."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "at", "line"))), lambda x: x["line"]), "\n")
    return io.write_files(lines.groupBy("file_name").agg(body.alias("body")).withColumn("file_name", F.concat("file_name", F.lit(".md"))), folder)


def page_reviews(pages: DataFrame, records: DataFrame, fallbacks: DataFrame, in_file: DataFrame | None = None, queue: DataFrame | None = None) -> DataFrame:
    """(file_name, body, and the manifest's columns): one review file a page, with what reviewers have said before.

    What a page's own file says goes before the queue.  ``pages``: book_id,
    local_page, confidence, review_needed, title_candidates, warnings, cleaned_text, raw_text.
    """
    on = ["book_id", "local_page"]
    titles = lambda df, name: df.groupBy(*on).agg(F.sort_array(F.collect_list("title")).alias(name))
    p = pages.join(titles(relate.pages_of(records.select("book_id", "title", "local_pages"), ["book_id", "title"]), "records"), on, "left")
    named = fallbacks.select(*on, F.format_string("%s p.%d", "book_id", "local_page").alias("title"))
    p = p.join(titles(named, "fallbacks"), on, "left")
    cols = [*on, "notes", "correct_content", "confirm_mark"]
    said = [(df.select(*cols), k) for df, k in ((queue, 1), (in_file.filter(F.col("confirmed") | (F.col("notes") != "") | (F.col("correct_content") != "")) if in_file is not None else None, 2)) if df is not None]
    if said:
        p = p.join(relate.override_union(*said, keys=on).select(*cols), on, "left")
    else:
        p = p.withColumns({c: F.lit(None).cast("string") for c in cols[2:]})
    listed = lambda c: F.to_json(F.coalesce(F.col(c), F.array().cast("array<string>")))
    text = lambda c, other="": F.when(F.coalesce(F.col(c), F.lit("")) == "", other).otherwise(F.col(c))
    head = F.format_string("# %s p.%d", *on)
    lines = [
        head, F.lit("\n## 页面信息"), F.format_string("- 本地页码: %d", "local_page"), F.concat(F.lit("- 置信度: "), text("confidence")), F.concat(F.lit("- 需要复核: "), F.col("review_needed").cast("string")),
        F.lit("\n## 当前候选"), F.concat(F.lit("- 标题候选: "), listed("title_candidates")), F.concat(F.lit("- 菜谱候选: "), listed("records")), F.concat(F.lit("- 回退候选: "), listed("fallbacks")),
        F.lit("\n## 警告"), F.concat(F.lit("- "), listed("warnings")), F.lit("\n## 采集文字"), text("cleaned_text", "无"), F.lit("\n## 校正文字"), text("raw_text", "无"),
        F.lit("\n## 校对记录"), F.concat(F.lit("- notes: "), text("notes")), F.concat(F.lit("- 正确内容: "), text("correct_content")), F.concat(F.lit("- 确认勾: "), text("confirm_mark", "[ ]")),
    ]
    name = F.format_string("%s/p%04d.md", *on)
    return p.select(*on, "confidence", "review_needed", "title_candidates", "warnings", name.alias("file_name"), F.concat_ws("\n", *lines).alias("body"))


def export_page_reviews(reviews: DataFrame, folder: str) -> int:
    """Writes the review files, an index a book and one of the books; the manifest goes beside them as JSON."""
    n = io.write_files(reviews, folder)
    link = F.format_string("- [p.%04d](./p%04d.md)", "local_page", "local_page")
    per_book = reviews.groupBy("book_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("local_page", link.alias("x")))).alias("links"))
    body = F.concat(F.format_string("# %s Page Review\n\n- 页数: %d\n\n## 页面列表\n", "book_id", "n"), F.array_join(F.transform("links", lambda x: x["x"]), "\n"))
    io.write_files(per_book.select(F.concat("book_id", F.lit("/index.md")).alias("file_name"), body.alias("body")), folder)
    books = reviews.select("book_id").distinct().groupBy().agg(F.sort_array(F.collect_set("book_id")).alias("b"))
    root = F.concat(F.lit("# Page Review Index\n\n## Books\n"), F.array_join(F.transform("b", lambda x: F.concat(F.lit("- ["), x, F.lit("](./"), x, F.lit("/index.md)"))), "\n"))
    io.write_files(books.select(F.lit("index.md").alias("file_name"), root.alias("body")), folder)
    io.write_json(reviews.drop("body"), f"{folder}/_manifest")
    return n


def report_lines(triaged: DataFrame, counts: DataFrame, top: int = 80) -> DataFrame:
    """(part, at, line) of the review report: sums, a line a book, and the first pages of the buckets that want a look.

    ``triaged`` is ``review.triage``'s result with book_id and local_page;
    ``counts`` is the one row of ``review.confirmation_counts``.  ``top`` is the report's length, not the triage's.
    """
    sums = triaged.groupBy().agg(
        F.count("*").alias("总页数"), *(F.count(F.when(F.col("confidence") == k, 1)).alias(n) for n, k in (("高置信页", "high"), ("中置信页", "medium"), ("低置信页", "low"))),
        *(F.count(F.when(F.col("bucket") == b, 1)).alias(n) for n, b in zip(("必看页", "可抽查页", "可暂时跳过页"), BUCKETS)),
        F.count(F.when(F.array_contains("warnings", SAYS["titles"]) & (F.col("n_records") >= 2), 1)).alias("已识别多菜谱锚点页"), F.count(F.when(F.col("n_placeholders") > 0, 1)).alias("原料区含不可识字占位符的页"),
    )
    row = lambda df, part: df.select(F.lit(part).alias("part"), F.posexplode(F.array(*(F.format_string(f"- {c}: %d", f"`{c}`") for c in df.columns))).alias("k", "line")).select("part", F.lpad(F.col("k").cast("string"), 9, "0").alias("at"), "line")
    names = {"confirmed_pages": "已读取确认页", "confirmed_toc_pages": "已确认目录页", "toc_entries": "已提取目录锚点", "toc_entries_rejected": "目录条目判为非菜名而剔除", "title_overrides": "已提取单页标题修正"}
    out = row(sums, 1).unionByName(row(counts.select(*(F.col(c).alias(n) for c, n in names.items())), 3))
    books = triaged.groupBy("book_id").agg(*(F.count(F.when(F.col("bucket") == b, 1)).alias(b) for b in BUCKETS))
    out = out.unionByName(books.select(F.lit(5).alias("part"), F.col("book_id").alias("at"), F.format_string("- %s: 必看 %d / 可抽查 %d / 可暂时跳过 %d", "book_id", *BUCKETS).alias("line")))
    heads = [(0, "# Review Priority"), (2, "## 本次纳入的人工校对信号"), (4, "## 分书统计"), (6, "## 必看页 Top 80"), (8, "## 可抽查页 Top 80")]
    out = out.unionByName(triaged.sparkSession.createDataFrame([(k, "", h) for k, h in heads], "part int, at string, line string"))
    detail = {6: (F.col("reasons"), "no explicit reason"), 8: (F.when(F.size("notes") > 0, F.col("notes")).otherwise(F.col("reasons")), "sample page")}
    for part, bucket in ((6, BUCKETS[0]), (8, BUCKETS[1])):
        said, none = detail[part]
        why = F.when(F.size(said) > 0, F.array_join(said, " | ")).otherwise(none)
        first = triaged.filter(F.col("bucket") == bucket).orderBy("book_id", "local_page").limit(top)
        line = F.concat(F.format_string("- %s p.%04d | ", "book_id", "local_page"), "page_kind", F.lit(" | "), "confidence", F.lit(" | "), why)
        out = out.unionByName(first.select(F.lit(part + 1).alias("part"), F.format_string("%s%09d", "book_id", "local_page").alias("at"), line.alias("line")))
    return out


def export_report(triaged: DataFrame, anchors: DataFrame, titles: DataFrame, counts: DataFrame, folder: str) -> None:
    """Writes the report as Markdown, all triaged pages as JSON, and the two tables that the next build reads."""
    lines = report_lines(triaged, counts)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "at", "line"))), lambda x: x["line"]), "\n")
    io.write_files(lines.groupBy().agg(body.alias("body")).select(F.lit("review_priority.md").alias("file_name"), "body"), folder)
    io.write_json(triaged, f"{folder}/review_priority")
    io.write_json(anchors, f"{folder}/toc_anchor_map")
    io.write_json(titles, f"{folder}/title_override_map")


def related_notes(records: DataFrame) -> DataFrame:
    """Named records with ``related``: the notes before and behind each in its book, by first page and title."""
    r = named_records(records).withColumn("first_page", F.array_min("local_pages"))
    return order.neighbours(r, ["book_id"], ["first_page", "title"], F.col("file_name")).drop("first_page")


def site_counts(records: DataFrame, appendix: DataFrame, forms: DataFrame, categories: DataFrame, notes: DataFrame, left: DataFrame, **more: DataFrame) -> DataFrame:
    """One row: records, appendix pages, index entries and their written forms, categories, records without one, annotations and those without a place."""
    return site.table_counts(
        recipes=records, appendix_pages=appendix, ingredient_pages=forms.select("base").distinct(), ingredient_variants=forms, categories=categories.filter("category is not null").select("category").distinct(),
        uncategorized=categories.filter("category is null"), annotations=notes, annotations_unmatched=left, **more,
    )
