"""A whole site in one build: pages of records, of the appendix and of written forms, indexes, search data - and thirteen counters.

Each folder is written by ``sources.files`` and swapped, so readers see the old
site or the new one and files of records that are no more go with the old
folder.  Counters are observed by the writes themselves; only what goes is
counted by names, from a listing.  No page is as long as an index: lists are cut
into files of ``per_page`` lines that link to each other, and search data into
files of ``per_data`` entries.  Pages are dealt over tasks by their number, since
a record is a file and few bytes.

Empty tables give a site without records; records without pages or category are
in none; a record's null lists are empty; names of records must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.grammar import extract_terms
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.operators import indexes, links, order, relate, site
from foliospark.sources import io
from foliospark.sources.files import seen_by
from foliospark.sources.scratch import materialize

# Headings and labels of the pages.
HEADINGS = {"食材": "ingredients", "调料": "seasonings", "做法": "steps", "特点": "tips"}
NO_CATEGORY, APPENDIX, FORMS, HOME = "未分类", "专文与附录", "食材索引", "全部菜谱"
FOLDERS = ("records", "appendix", "ingredients", "data")


def _anchor(href: Column, text: Column) -> Column:
    return F.concat(F.lit('<a href="'), T.escape_html(href), F.lit('">'), T.escape_html(text), F.lit("</a>"))


def _file(key: Column, part: Column) -> Column:
    """A list's file: its name, and from the second part on the part's number."""
    return F.concat(key, F.when(part > 0, F.concat(F.lit("-"), (part + 1).cast("string"))).otherwise(""), F.lit(".html"))


def paged(entries: DataFrame, order_by: list[str], per: int, head: Column | None = None) -> DataFrame:
    """(file_name, body, n): lists of (key, title, x, sums) as files of at most ``per`` lines.

    Lines of a key are in order; ``head`` says under which heading a line
    stands, which is said again where a file begins.
    """
    rows = entries.withColumn("head", head if head is not None else F.lit(None).cast("string"))
    rows = order.numbered(rows, ["key"], order_by)
    part = F.floor(F.col("place") / per)
    cut = rows.withColumn("part", part).withColumn("last", F.floor((F.col("n") - 1) / per))
    cut = cut.groupBy("key", "part").agg(F.first("title").alias("title"), F.first("last").alias("last"), F.sort_array(F.collect_list(F.struct("place", "head", "x"))).alias("rows"))

    def said(rows: Column) -> Column:
        opens = lambda x, i: (i == 0) | ~F.get(rows, i - 1)["head"].eqNullSafe(x["head"])
        heading = lambda x: F.coalesce(F.concat(F.lit("<h2>"), x["head"], F.lit("</h2>")), F.lit(""))
        return F.transform(rows, lambda x, i: F.concat(F.when(opens(x, i), F.concat(F.when(i > 0, "</ul>").otherwise(""), heading(x), F.lit("<ul>"))).otherwise(""), F.lit("<li>"), x["x"], F.lit("</li>")))

    pager = F.concat(
        F.when(F.col("part") > 0, F.concat(F.lit('\n<a class="prev" href="'), T.escape_html(_file(F.col("key"), F.col("part") - 1)), F.lit('"></a>'))).otherwise(""),
        F.when(F.col("part") < F.col("last"), F.concat(F.lit('\n<a class="next" href="'), T.escape_html(_file(F.col("key"), F.col("part") + 1)), F.lit('"></a>'))).otherwise(""),
    )
    body = F.concat(F.lit("<main>\n<h1>"), T.escape_html(F.col("title")), F.lit("</h1>\n"), T.let(F.col("rows"), lambda r: F.array_join(said(r), "\n")), F.lit("</ul>"), pager, F.lit("\n</main>"))
    return cut.select(_file(F.col("key"), F.col("part")).alias("file_name"), site.layout_page(F.col("title"), body).alias("body"), F.size("rows").alias("n"))


def written_forms(records: DataFrame, v: Vocabulary = DEFAULT, not_items: tuple[str, ...] = ()) -> DataFrame:
    """(base, form, book_id, slug, title): which record writes which form of what."""
    none = F.array().cast("array<string>")
    lines = F.transform(F.concat(F.coalesce("ingredients", none), F.coalesce("seasonings", none)), T.normalize_text)
    used = records.select("book_id", "slug", "title", F.explode(F.array_distinct(extract_terms(lines, v))).alias("form"))
    used = materialize(used.filter(~F.col("form").isin(*not_items)) if not_items else used, "used")
    return materialize(used.join(indexes.base_forms(used.select("form"), v), "form"), "forms")


def _marked(rows: DataFrame, sections: tuple[str, ...], done: DataFrame, kind: int, forms: DataFrame) -> DataFrame:
    """``rows``, written and dealt, with ``html``, the marked and linked lines of each section, and ``numbers``, its notes."""
    none = F.array().cast("array<string>")
    plain = F.array(*(F.transform(F.filter(F.coalesce(c, none), lambda x: F.trim(x) != ""), T.escape_html) for c in sections))
    own = done.filter(F.col("kind") == kind).select("book_id", "slug", F.col("html").alias("_html"), "numbers")
    t = order.dealt(rows, ["book_id", "slug"]).join(own.hint("merge"), ["book_id", "slug"], "left").withColumn("html", F.coalesce("_html", plain)).drop("_html")
    t = t.withColumn("numbers", F.coalesce("numbers", F.array().cast("array<long>")))
    t = t.withColumn("_sizes", F.transform("html", F.size)).withColumn("_flat", F.flatten("html"))
    t = links.link_table(t, "_flat", forms)
    start = lambda i: F.aggregate(F.slice("_sizes", 1, i), F.lit(1), lambda a, x: a + x) if i else F.lit(1)
    return t.withColumn("html", F.array(*(F.slice("_flat", start(i), F.get("_sizes", F.lit(i))) for i in range(len(sections))))).drop("_sizes", "_flat")


def _stale(spark, folder: str, names: DataFrame) -> int:
    """How many pages of a folder the new build does not have; a folder that is not there has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0
    return io.stale_files(io.list_files(spark, folder, "*.html"), names).count()


def build_site(
    folder: str,
    records: DataFrame,
    fallbacks: DataFrame,
    articles: DataFrame,
    anchors: DataFrame,
    notes: DataFrame,
    v: Vocabulary = DEFAULT,
    not_items: tuple[str, ...] = (),
    per_page: int = 500,
    per_data: int = 2000,
) -> dict[str, int]:
    """Writes the site below a folder and gives its counters.

    ``records``: book_id, slug, title, aliases, local_pages and the four lists;
    ``fallbacks``: book_id, local_page, body (lines); ``articles``: book_id,
    local_page, article, kind, ord; ``anchors``: book_id, local_page, category,
    ord; ``notes`` as ``io.annotations`` gives them.
    """
    spark = records.sparkSession
    counter = {name: Observation() for name in ("records", "appendix", "skipped", "forms", "categories", "notes", "left")}
    count = F.count(F.lit(1))

    # what belongs where
    first = records.select("book_id", "slug", F.array_min("local_pages").alias("local_page"))
    category = relate.asof(first, anchors.filter(F.trim("category") != ""), ["book_id"], "local_page", "category", NO_CATEGORY)
    r = records.join(category.select("book_id", "slug", "category").hint("merge"), ["book_id", "slug"])
    r = materialize(r.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "book_id", "slug"), "records")
    on = ["book_id", "local_page"]
    plan, skipped = relate.article_plan(articles, fallbacks, on)
    name = lambda book, page: F.format_string("%s-p%04d", book, page)
    title = F.when(F.col("total") == 1, F.col("article")).otherwise(F.format_string("%s（%d/%d）", "article", "place", "total"))
    beside = lambda c: F.when(F.col(c).isNotNull(), name(F.col(f"{c}.book_id"), F.col(f"{c}.local_page")))
    pages = plan.select(*on, "body", "article", "kind", "ord", "place", "total", name(*map(F.col, on)).alias("slug"), F.array("local_page").alias("local_pages"), title.alias("title"), beside("prev").alias("before"), beside("next").alias("behind"))
    pages = materialize(pages, "appendix")
    used = written_forms(r, v, not_items)
    forms = materialize(used.groupBy("base", "form").agg(F.countDistinct("book_id", "slug").alias("n")), "variants")
    linked = links.form_links(forms)
    done, left = site.annotated(r, notes.observe(counter["notes"], count.alias("n")), then=pages)
    done = materialize(done, "done")

    # records
    gone = {"records": _stale(spark, f"{folder}/records", r.select(F.concat("slug", F.lit(".html")).alias("file_name")))}
    t = _marked(r, tuple(HEADINGS.values()), done, 0, linked)
    t = t.observe(counter["records"], count.alias("n"), F.sum((F.col("category") == NO_CATEGORY).cast("long")).alias("none"), F.sum(F.size("numbers").cast("long")).alias("marks"))
    place = F.concat_ws(" · ", "book_id", F.nullif(T.page_range(F.col("local_pages")), F.lit("")), "category")
    body = site.record_page(F.col("title"), F.coalesce("aliases", F.array().cast("array<string>")), place, {h: F.get("html", F.lit(i)) for i, h in enumerate(HEADINGS)})
    io.write_files(t.select(F.concat("slug", F.lit(".html")).alias("file_name"), body.alias("body")), f"{folder}/records", overwrite=True)

    # the appendix, and what is in no article
    cards = pages.select(F.lit("index").alias("key"), F.lit(APPENDIX).alias("title"), F.lit(0).alias("o"), F.struct("article", "book_id").alias("g"), F.col("ord").cast("string").alias("k"), T.escape_html(F.col("article")).alias("head"), _anchor(F.concat("slug", F.lit(".html")), F.col("title")).alias("x"))
    rest = skipped.select(F.lit("index"), F.lit(APPENDIX), F.lit(1), F.struct(F.lit("").alias("article"), "book_id"), F.format_string("%010d", "local_page"), F.lit(None).cast("string"), T.escape_html(name(*map(F.col, on))))
    listed = materialize(paged(cards.unionAll(rest), ["o", "g", "k"], per_page, F.col("head")), "appendix_index")
    names = pages.select(F.concat("slug", F.lit(".html")).alias("file_name")).unionByName(listed.select("file_name")).unionByName(spark.createDataFrame([("index.html",)], "file_name string"))
    gone["appendix"] = _stale(spark, f"{folder}/appendix", names)
    a = _marked(pages, ("body",), done, 1, linked).observe(counter["appendix"], count.alias("n"), F.sum(F.size("numbers").cast("long")).alias("marks"))
    paragraphs = F.array_join(F.transform(F.get("html", F.lit(0)), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "\n")
    pager = F.concat(*(F.when(F.col(c).isNotNull(), F.concat(F.lit(f'\n<a class="{mark}" href="'), T.escape_html(F.col(c)), F.lit('.html"></a>'))).otherwise("") for c, mark in (("before", "prev"), ("behind", "next"))))
    said = F.concat(F.lit("<main>\n<h1>"), T.escape_html(F.col("title")), F.lit("</h1>\n"), paragraphs, pager, F.lit("\n</main>"))
    io.write_files(a.select(F.concat("slug", F.lit(".html")).alias("file_name"), site.layout_page(F.col("title"), said).alias("body")).unionByName(listed.drop("n")), f"{folder}/appendix", overwrite=True)
    io.write_json(skipped.select(*on).observe(counter["skipped"], count.alias("n")), f"{folder}/reports/fallbacks_skipped")

    # written forms: a list for each base, by form, and one of the bases
    uses = used.join(forms, ["base", "form"])
    lines = uses.select(F.col("base").alias("key"), F.col("base").alias("title"), (-F.col("n")).alias("o"), "form", "book_id", "slug", F.concat(F.lit('<span id="v-'), T.escape_html(F.col("form")), F.lit('">'), T.escape_html(F.col("form")), F.format_string("</span> · %d", "n")).alias("head"), _anchor(F.concat(F.lit("../records/"), "slug", F.lit(".html")), F.col("title")).alias("x")).distinct()
    bases = uses.select("base", "form", "book_id", "slug").distinct().groupBy("base").agg(F.countDistinct("book_id", "slug").alias("n"), F.countDistinct("form").alias("forms"))
    bases = materialize(bases, "bases")
    entries = bases.select(F.lit("index").alias("key"), F.lit(FORMS).alias("title"), (-F.col("n")).alias("o"), "base", F.concat(_anchor(F.concat("base", F.lit(".html")), F.col("base")), F.format_string(" %d · %d", "n", "forms")).alias("x"))
    lists = materialize(paged(lines, ["o", "form", "book_id", "slug"], per_page, F.col("head")).unionByName(paged(entries, ["o", "base"], per_page)), "form_pages")
    gone["ingredients"] = _stale(spark, f"{folder}/ingredients", lists.select("file_name").unionByName(spark.createDataFrame([("index.html",)], "file_name string")))
    io.write_files(lists, f"{folder}/ingredients", overwrite=True)
    io.write_json(bases.observe(counter["forms"], count.alias("n"), F.sum("forms").alias("forms")), f"{folder}/reports/ingredients")

    # search data, categories, home, what no page has taken
    blob = T.search_blob("title", *(F.coalesce(c, F.array().cast("array<string>")) for c in map(F.col, ("aliases", *HEADINGS.values()))))
    found = r.select(F.lit("data").alias("key"), F.col("book_id").alias("b"), F.col("slug").alias("u"), F.to_json(F.struct(F.col("slug").alias("u"), F.col("title").alias("t"), F.col("book_id").alias("b"), T.page_range(F.col("local_pages")).alias("p"), F.col("category").alias("c"), blob.alias("s"))).alias("x"))
    found = order.numbered(found, ["key"], ["b", "u"]).withColumn("part", F.floor(F.col("place") / per_data))
    data = found.groupBy("part").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "x"))), lambda y: y["x"]).alias("rows"))
    io.write_files(data.select(F.format_string("data-%05d.js", "part").alias("file_name"), F.concat(F.lit("SITE_DATA.push("), F.array_join("rows", ",\n"), F.lit(");")).alias("body")), f"{folder}/data", overwrite=True)
    kinds = materialize(r.groupBy("category").agg(F.count("*").alias("n")), "categories")
    io.write_json(kinds.observe(counter["categories"], count.alias("n")), f"{folder}/reports/categories")
    io.write_json(left.observe(counter["left"], count.alias("n")), f"{folder}/reports/annotations_unmatched")
    chips = kinds.select(F.lit("index").alias("key"), F.lit(HOME).alias("title"), F.when(F.col("category") == NO_CATEGORY, 1).otherwise(0).alias("o"), "category", F.concat(T.escape_html(F.col("category")), F.format_string(" %d", "n")).alias("x"))
    io.write_files(paged(chips, ["o", "category"], per_page), folder)

    got = lambda name, what="n": seen_by(counter[name], what)
    return {
        "records": got("records"), "pruned": gone["records"], "appendix_pages": got("appendix"), "appendix_pruned": gone["appendix"], "fallbacks_skipped": got("skipped"),
        "ingredient_pages": got("forms"), "ingredient_variants": got("forms", "forms"), "ingredients_pruned": gone["ingredients"], "categories": got("categories"), "uncategorized": got("records", "none"),
        "annotations": got("notes"), "annotations_rendered": got("records", "marks") + got("appendix", "marks"), "annotations_unmatched": got("left"),
    }
