"""What a site of records shows: numbered annotations, index pages, counts of everything."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.sources.scratch import materialize, release

#: Sections of a record in reading order.
SECTIONS = ("ingredients", "seasonings", "steps", "tips")
NOTED = "struct<rows:array<array<string>>,matched:array<int>>"


def annotate(sections: Column, anchors: Column, mark: str = '<sup class="fn"><a id="fnref-{n}" href="#fn-{n}">{n}</a></sup>') -> Column:
    """NOTED of array<array<string>> of escaped rows, by section, and the escaped anchors of a record's notes.

    Each note's mark goes behind the first place that its anchor has in reading
    order, once; marks are numbered as they are read, in a row from the left,
    of notes at one place the first.  ``matched`` lists the notes by number.
    """

    def place(rows: list[str], left: list[tuple[int, str]], matched: list[int]) -> list[str]:
        out = []
        for row in rows:
            while at := [(found, k, anchor) for k, anchor in left if anchor and (found := row.find(anchor)) >= 0]:
                found, k, anchor = min(at, key=lambda x: x[0])
                matched.append(k)
                left[:] = [x for x in left if x[0] != k]
                cut = found + len(anchor)
                row = row[:cut] + mark.format(n=len(matched)) + row[cut:]
            out.append(row)
        return out

    @F.pandas_udf(NOTED)
    def run(s: pd.Series, a: pd.Series) -> pd.DataFrame:
        rows, found = [], []
        for own, notes in zip(s, a):
            matched: list[int] = []
            left = list(enumerate([] if notes is None else notes))
            rows.append([place([r or "" for r in part] if part is not None else [], left, matched) for part in (own if own is not None else [])])
            found.append(matched)
        return pd.DataFrame({"rows": rows, "matched": found})

    return run(sections, anchors)


def annotated(records: DataFrame, notes: DataFrame, sections: tuple[str, ...] = SECTIONS, then: DataFrame | None = None, then_sections: tuple[str, ...] = ("body",)) -> tuple[DataFrame, DataFrame]:
    """(book_id, slug, html, numbers) of records, and the notes that no record has taken.

    A note names its record by slug or else by book and page.  Records are asked
    in the order of their slugs, and after them the rows of ``then`` (appendix
    pages, say, with ``then_sections``); a note is taken by the first in which
    its anchor is still whole once the marks of the notes before it are set, so
    one whose anchor another mark parts goes on to the next.  Equal notes are
    notes of their own.

    What a record takes hangs on what those before it have taken, so all records
    with candidates are asked again until nothing changes: as many rounds as the
    longest chain of records that share notes, and one.  Joins are by merge: a
    small file of records that compress well is no small table.
    ``records``: book_id, slug, local_pages and the sections; ``notes`` as ``sources.io.annotations`` gives them.
    """
    nth = F.row_number().over(Window.partitionBy(*notes.columns).orderBy(F.lit(1)))
    n = materialize(notes.withColumn("_nth", nth).withColumn("note_id", F.xxhash64(*notes.columns, "_nth")).drop("_nth").withColumn("_a", T.escape_html(F.col("anchor"))), "notes")
    lines = lambda names: F.array(*(F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x) != ""), T.escape_html) for c in map(F.col, names)))
    r = records.select(F.lit(0).alias("kind"), "slug", "book_id", "local_pages", lines(sections).alias("rows"))
    if then is not None:
        r = r.unionByName(then.select(F.lit(1).alias("kind"), "slug", "book_id", "local_pages", lines(then_sections).alias("rows")))
    on = ["kind", "slug", "book_id"]
    by_page = r.select(*on, "rows", F.explode(F.array_distinct("local_pages")).alias("local_page"))
    own = n.filter("slug is null").drop("slug").join(by_page.hint("merge"), ["book_id", "local_page"]).select("note_id", "_a", *on, "rows")
    named = n.filter("slug is not null").drop("book_id").join(r.hint("merge"), "slug").select("note_id", "_a", *on, "rows")
    held = F.exists(F.flatten("rows"), lambda x: x.contains(F.col("_a")))
    pairs = materialize(own.unionByName(named).filter(held).select("note_id", "_a", *on).distinct(), "candidates")
    rows = materialize(r.join(pairs.select(*on).distinct().hint("merge"), on), "asked")
    place = F.struct(*on)
    taken, before = None, None
    while True:
        left = pairs
        if taken is not None:  # a note that an earlier record has is no candidate of later ones
            first = taken.groupBy("note_id").agg(F.min("at").alias("first"))
            left = pairs.join(first.hint("merge"), "note_id", "left").filter(F.col("first").isNull() | (place <= F.col("first"))).drop("first")
        per = left.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("note_id", "_a"))).alias("own"))
        asked = rows.join(per.hint("merge"), on).withColumn("x", annotate(F.col("rows"), F.transform("own", lambda o: o["_a"])))
        asked = materialize(asked.select(*on, F.col("x.rows").alias("html"), F.transform("x.matched", lambda k: F.get("own", k)["note_id"]).alias("numbers")), "annotated")
        now = asked.select(F.explode("numbers").alias("note_id"), place.alias("at"))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("note_id", "at.kind", "at.slug", "at.book_id").cast("decimal(38,0)"))).first()
        if taken is not None:
            release(last)
        if seen == before:
            break
        taken, last, before = now, asked, seen
    release(pairs, rows)
    done = asked.filter(F.size("numbers") > 0).select("book_id", "slug", "html", "numbers", "kind")
    return (done if then is not None else done.drop("kind")), n.join(now.select("note_id").distinct().hint("merge"), "note_id", "left_anti").drop("note_id", "_a")


# --- index pages --------------------------------------------------------------------


def _page(rows: DataFrame, name: str, title: str, order: list, group: Column | None, line: Column) -> DataFrame:
    """(file_name, part, at, line): a heading, then lines below a heading of each group, a blank line behind it."""
    first = rows.sparkSession.createDataFrame([(name, 0, f"# {title}")], "file_name string, part int, line string").withColumn("at", F.struct(*(F.lit(None).cast("string").alias(f"o{i}") for i in range(4))))
    key = [F.lit(""), F.lit("1")] if group is None else [group.cast("string"), F.lit("1")]
    at = lambda k, o: F.struct(*(c.cast("string").alias(f"o{i}") for i, c in enumerate([*k, *o, *([F.lit("")] * (2 - len(o)))])))
    out = rows.select(F.lit(name).alias("file_name"), F.lit(1).alias("part"), line.alias("line"), at(key, order).alias("at"))
    if group is not None:
        heads = rows.select(group.alias("g")).distinct()
        for mark, said in (("0", F.concat(F.lit("## "), F.col("g").cast("string"))), ("2", F.lit(""))):
            out = out.unionByName(heads.select(F.lit(name).alias("file_name"), F.lit(1).alias("part"), said.alias("line"), at([F.col("g"), F.lit(mark)], []).alias("at")))
    return first.unionByName(out)


def index_lines(records: DataFrame, fallbacks: DataFrame, terms: DataFrame) -> DataFrame:
    """(file_name, part, at, line): the six index pages, a row a line, so that no page is one value.

    ``records``: series, book_id, title, note, first_page (padded text), pages
    (text), confidence, review_needed; ``fallbacks``: note, book_id, pages,
    confidence, review_needed; ``terms``: term, title, note.
    """
    link = F.concat(F.lit("- [["), "note", F.lit("]]"))
    cols = ["note", "book_id", "pages", "confidence", "review_needed"]
    review = records.select(*cols, F.lit(0).alias("kind")).unionByName(fallbacks.select(*cols, F.lit(1).alias("kind"))).filter("review_needed")
    said = F.concat(link, F.lit(" | "), "book_id", F.lit(" | 页码 "), "pages", F.lit(" | 置信度 "), "confidence")
    counts = table_counts(r=records, f=fallbacks, v=review)
    totals = counts.select(F.posexplode(F.array(
        F.concat(F.lit("- 菜谱笔记: "), "r"), F.concat(F.lit("- 页面回退笔记: "), "f"), F.concat(F.lit("- 待复核项目: "), "v"), F.lit(""),
        *(F.lit(f"- [[{x}]]") for x in ("系列索引", "书目索引", "菜名索引", "食材索引", "低置信度待复核")),
    )).alias("k", "note"))
    pages = [
        _page(totals, "total", "00 总索引", [F.col("k")], None, F.col("note")),
        _page(records, "series", "系列索引", [F.col("first_page"), F.col("title")], F.col("series"), link),
        _page(records, "books", "书目索引", [F.col("first_page"), F.col("title")], F.col("book_id"), link),
        _page(records, "dishes", "菜名索引", [F.col("title"), F.col("note")], None, F.concat(F.lit("- "), "title", F.lit(" -> [["), "note", F.lit("]]"))),
        _page(terms, "ingredients", "食材索引", [F.col("title"), F.col("note")], F.col("term"), link),
        _page(review, "review", "低置信度待复核", [F.col("kind"), F.col("note")], None, said),
    ]
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out


def common_forms(index: DataFrame, count: str = "n_records", least: int = 5, top: int = 12) -> DataFrame:
    """Adds common (``least`` records or more) and place, by falling count and then name; ``top`` marks the first ones."""
    ranked = index.orderBy(F.desc(count), "base").limit(top).select("base", F.lit(True).alias("top"))
    return index.join(ranked, "base", "left").select(*index.columns, (F.col(count) >= least).alias("common"), F.coalesce("top", F.lit(False)).alias("top"))


def first_pages(pages: DataFrame, article: str = "article", order: str = "ord") -> DataFrame:
    """(article, first, n): an appendix article's first page, as a struct, and how many it has."""
    rest = [c for c in pages.columns if c != article]
    return pages.filter(F.col(article) != "").groupBy(article).agg(F.min_by(F.struct(*rest), order).alias("first"), F.count("*").alias("n"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each table."""
    each = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in tables.items()]
    rows = each[0]
    for n in each[1:]:
        rows = rows.unionByName(n)
    return rows.groupBy().agg(*(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables))


# --- pages ----------------------------------------------------------------------------


def layout_page(title: Column, body: Column, root: str = "../") -> Column:
    """A whole HTML page around a body."""
    head = F.concat(F.lit('<!doctype html>\n<html lang="zh-CN">\n<head>\n<meta charset="utf-8">\n<title>'), T.escape_html(title), F.lit(f'</title>\n<link rel="stylesheet" href="{root}style.css">\n</head>\n<body>\n'))
    return F.concat(head, body, F.lit("\n</body>\n</html>\n"))


def html_list(rows: Column, ordered: bool = False) -> Column:
    """A list of rows that are markup already; no rows are no list."""
    tag = "ol" if ordered else "ul"
    return F.when(F.size(rows) > 0, F.concat(F.lit(f"<{tag}>"), F.array_join(F.transform(rows, lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), ""), F.lit(f"</{tag}>"))).otherwise("")


def record_page(title: Column, aliases: Column, place: Column, sections: dict[str, Column], ordered: tuple[str, ...] = ("做法",), before: Column | None = None, behind: Column | None = None) -> Column:
    """A record's page: its title, other names and place, a list for each section that has rows, and links to its neighbours.

    ``sections`` has arrays of rows that are escaped, annotated or linked markup already, by heading.
    """
    other = F.when(F.size(aliases) > 0, F.concat(F.lit('\n<p class="aliases">又作：'), F.array_join(F.transform(aliases, T.escape_html), "、"), F.lit("</p>"))).otherwise("")
    parts = [F.when(F.size(rows) > 0, F.concat(F.lit(f"\n<section><h2>{head}</h2>"), html_list(rows, head in ordered), F.lit("</section>"))).otherwise("") for head, rows in sections.items()]
    link = lambda c, mark: F.lit("") if c is None else F.when(c.isNotNull(), F.concat(F.lit(f'\n<a class="{mark}" href="'), T.escape_html(c), F.lit('.html"></a>'))).otherwise("")
    body = F.concat(F.lit("<main>\n<h1>"), T.escape_html(title), F.lit("</h1>"), other, F.lit('\n<p class="place">'), T.escape_html(place), F.lit("</p>"), *parts, link(before, "prev"), link(behind, "next"), F.lit("\n</main>"))
    return layout_page(title, body)


def index_page(title: str, links: DataFrame, name: str = "name", href: str = "href", sub: str = "sub", order: str = "ord") -> DataFrame:
    """(body): one page with a card for each row of ``links``, in order."""
    card = F.concat(F.lit('<li class="card"><a href="'), T.escape_html(F.col(href)), F.lit('">'), T.escape_html(F.col(name)), F.lit('</a><div class="sub">'), T.escape_html(F.col(sub)), F.lit("</div></li>"))
    rows = links.select(F.col(order).alias("o"), card.alias("card")).groupBy().agg(F.sort_array(F.collect_list(F.struct("o", "card"))).alias("x"))
    body = F.concat(F.lit("<main>\n<h1>"), T.escape_html(F.lit(title)), F.lit('</h1>\n<ul class="grid">'), F.array_join(F.transform("x", lambda x: x["card"]), ""), F.lit("</ul>\n</main>"))
    return rows.select(layout_page(F.lit(title), body, "").alias("body"))
