"""Ordered operators: carrying state forward, segmenting blocks into records, routing sections, mending columns.

State machines over ordered blocks become events that are filled forward.  A
fill runs in two levels: inside a page on its blocks, and over pages on one
narrow row a page, so that a book with a third of all blocks does not bring
its texts into one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.grammar import grammar, parse_line
from foliospark.functions.vocabulary import DEFAULT, Vocabulary
from foliospark.operators.pages import appendix_page, section_header
from foliospark.sources.scratch import materialize

BREAKS = ("toc", "front_matter", "category")


def carry_forward(df: DataFrame, group: list[str], major: str, minor: str, value: Column, out: str, before: bool = False) -> DataFrame:
    """Adds ``out``: the last non-null ``value`` at or before a row (``before``: strictly before), by (major, minor) within a group."""
    inner = Window.partitionBy(*group, major).orderBy(minor)
    inner = inner.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
    rows = df.withColumn("_v", value)
    last = rows.filter(F.col("_v").isNotNull()).groupBy(*group, major).agg(F.max_by("_v", minor).alias("_last"))
    pages = rows.select(*group, major).distinct().join(last, [*group, major], "left")
    over = Window.partitionBy(*group).orderBy(major).rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select(*group, major, F.last("_last", ignorenulls=True).over(over).alias("_carried"))
    rows = rows.withColumn("_own", F.last("_v", ignorenulls=True).over(inner)).join(pages, [*group, major], "left")
    return rows.select(*df.columns, F.coalesce("_own", "_carried").alias(out))


def fill_forward(df: DataFrame, group: list[str], order: list, value: Column, out: str) -> DataFrame:
    """The same in one window, for groups that are bounded."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


# --- blocks --------------------------------------------------------------------

SPANS = "array<struct<spans:array<struct<content:string,html:string>>>>"
RAW_BLOCK = f"struct<type:string,lines:{SPANS},bbox:array<double>,index:int,blocks:array<struct<type:string,lines:{SPANS},bbox:array<double>,index:int>>>"


def extract_blocks(raw: Column) -> Column:
    """array<struct<block_type, text, bbox, index>> of an array of RAW_BLOCK.

    Inner blocks stand where their parent stands and take its type only if
    they have none.  A block's content spans are one text; each row of its
    HTML spans is a block of type table behind it.
    """

    def flat(type_, b):
        spans = F.flatten(F.transform(F.coalesce(b["lines"], F.array().cast(SPANS)), lambda x: x["spans"]))
        said = T.normalize_text(F.array_join(F.transform(spans, lambda s: F.coalesce(s["content"], F.lit(""))), ""))
        rows = F.flatten(F.transform(F.filter(spans, lambda s: s["html"].isNotNull()), lambda s: T.table_rows(s["html"], decode=lambda c: c)))
        block = lambda kind, text: F.struct(kind.alias("block_type"), text.alias("text"), b["bbox"].alias("bbox"), b["index"].alias("index"))
        own = F.filter(F.array(block(type_, said)), lambda x: x["text"] != "")
        return F.concat(own, F.transform(rows, lambda r: block(F.lit("table"), r)))

    def one(b):
        inner = F.flatten(F.transform(F.coalesce(b["blocks"], F.array().cast("array<struct<type:string,lines:%s,bbox:array<double>,index:int>>" % SPANS)), lambda x: flat(F.coalesce(x["type"], b["type"]), x)))
        return F.concat(flat(b["type"], b), inner)

    return F.flatten(F.transform(raw, one))


def unescape_tables(blocks: Column) -> Column:
    """``blocks`` with all HTML entities of table rows decoded; rows that are blank then are left out.

    Only pages that have an ampersand in a table row go through the Arrow UDF.
    """

    @F.pandas_udf("array<struct<block_type:string,text:string,bbox:array<double>,index:int>>")
    def run(s: pd.Series) -> pd.Series:
        import html

        def one(own):
            if own is None:
                return None
            said = [dict(b) for b in own]
            for b in said:
                b["bbox"] = None if b["bbox"] is None else list(b["bbox"])
                if b["block_type"] == "table":
                    b["text"] = " ".join(html.unescape(b["text"]).split())
            return [b for b in said if b["text"]]

        return s.map(one)

    held = F.exists(blocks, lambda b: (b["block_type"] == "table") & b["text"].contains("&"))
    return F.coalesce(run(F.when(held, blocks)), blocks)


def explode_blocks(pages: DataFrame, keys: list[str], blocks: str = "text_blocks") -> DataFrame:
    """One row a block with its place ``ord``; place and page are kept to every sink."""
    return pages.select(*keys, F.posexplode(blocks).alias("ord", "b")).select(*keys, "ord", "b.*")


# --- records ------------------------------------------------------------------------


def segment(pages: DataFrame, blocks: DataFrame, v: Vocabulary = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Blocks of records, and fallback pages.

    A title opens a record that runs to the next title.  A page without a
    title that is contents, front matter, a category or an appendix closes it
    and is a fallback; any other page without a title goes to the open record
    unless it is empty and no continuation; with none open it is a fallback.
    Blocks before the first title of a page go to the open record or are
    dropped.
    """
    b = blocks.filter(F.trim("text") != "").withColumn("is_title", (F.col("block_type") == "title") & T.record_title(F.col("text"), v))
    titled = b.groupBy("book_id", "local_page").agg(
        F.max("is_title").alias("titled"), F.collect_list(F.when(F.col("block_type") == "title", F.col("text"))).alias("titles")
    )
    p = pages.join(titled, ["book_id", "local_page"], "left").withColumn("titled", F.coalesce("titled", F.lit(False)))
    closes = ~F.col("titled") & (F.col("page_kind").isin(*BREAKS) | F.coalesce(appendix_page(F.col("titles"), v=v), F.lit(False)))
    p = p.withColumn("closes", closes)
    event = F.struct(F.lit("title").alias("kind"), F.col("local_page").alias("page"), F.col("ord").alias("at"))
    events = b.select("book_id", "local_page", "ord", F.when(F.col("is_title"), event).alias("event"))
    end = F.struct(F.lit("break").alias("kind"), F.col("local_page").alias("page"), F.lit(-1).alias("at"))
    # each page has a row of its own before its blocks: the event that closes, or nothing
    events = events.unionByName(p.select("book_id", "local_page", F.lit(-1).alias("ord"), F.when(F.col("closes"), end).alias("event")))
    state = carry_forward(events, ["book_id"], "local_page", "ord", F.col("event"), "open").drop("event")
    page_state = state.filter("ord = -1").select("book_id", "local_page", F.col("open").alias("page_open"))
    p = p.join(page_state, ["book_id", "local_page"], "left")
    active = F.coalesce(F.col("page_open.kind") == "title", F.lit(False))
    joins = ~F.col("closes") & (F.col("titled") | (active & ((F.col("page_kind") == "continuation") | (F.trim(F.coalesce("cleaned_text", F.lit(""))) != ""))))
    p = p.withColumn("joins", joins)
    inside = b.join(p.filter("joins").select("book_id", "local_page"), ["book_id", "local_page"], "left_semi")
    inside = inside.join(state.filter("ord >= 0"), ["book_id", "local_page", "ord"]).filter("open.kind = 'title'")
    records = inside.select("book_id", F.col("open.page").alias("rec_page"), F.col("open.at").alias("rec_at"), "local_page", *(c for c in b.columns if c not in ("book_id", "local_page")))
    return records, p.filter(~F.col("joins")).select(*pages.columns)


REC = ["book_id", "rec_page", "rec_at"]


def region_mask(blocks: DataFrame, group: list[str], region: str = "ingredients", v: Vocabulary = DEFAULT) -> DataFrame:
    """Adds in_region: whether a block stands below a header of ``region``, over page ends too; titles and headers are outside."""
    head = section_header(F.col("text"), v)
    title = T.record_title(F.col("text"), v)
    state = F.when(title, F.lit(False)).when(head.isNotNull(), head["section"] == region)
    rows = carry_forward(blocks.withColumn("_s", state), group, "local_page", "ord", F.col("_s"), "in_region")
    return rows.withColumn("in_region", F.coalesce("in_region", F.lit(False)) & F.col("_s").isNull()).drop("_s")


def inherit_groups(lines: DataFrame, group: list[str], order: list, first: str = "ingredient", v: Vocabulary = DEFAULT) -> DataFrame:
    """Exploded items (…, sub, grp, item): a line without a label takes the group of the line before."""
    parsed = lines.withColumn("_p", parse_line(T.normalize_text(F.col("text")), v))
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parsed = parsed.withColumn("_g", F.coalesce(F.last("_p.last", ignorenulls=True).over(w), F.lit(first)))
    out = parsed.select(*lines.columns, "_g", F.posexplode("_p.items").alias("sub", "_i"))
    return out.select(*lines.columns, "sub", F.coalesce("_i.grp", "_g").alias("grp"), "_i.item")


# A numbered head that was read badly, and the number of a step.
_IMPLIED_HEAD = "^[二2]\\s*[、，,．.。:：]\\s*([\\u4e00-\\u9fff]{1,4}?)[：:。.]?$"
# Fixed value: a garbled line that a scan makes of a numbered header.
_GARBLED = "^(?:[（(]\\s*[一二三四五六七八九十\\d]+\\s*[）)]|[一二三四五六七八九十]\\s*[、，,．.。:：])\\s*\\S{0,4}[：:。.]?$"
_NUMBER = "^\\s*(\\d+)\\s*[.、．]"


def route_sections(records: DataFrame, v: Vocabulary = DEFAULT) -> DataFrame:
    """(record, k, section, text): the section of each block of a record; headers, titles and their like are gone.

    Where a record starts with its title and its first header is "steps", what
    stands before is ingredients.  Where it has no steps header at all, a
    garbled second head in the ingredients, or bare numbers 1, 2, 3 …, open
    the steps if ingredients stand before.
    """
    at = Window.partitionBy(*REC).orderBy("local_page", "ord")
    whole = Window.partitionBy(*REC)
    t = records.withColumn("text", T.normalize_text(F.col("text"))).withColumn("k", F.row_number().over(at) - 1)
    t = t.withColumn("title", T.record_title(F.col("text"), v)).withColumn("head", F.when(~F.col("title"), section_header(F.col("text"), v)))
    t = t.filter("text != ''")
    first = F.min(F.when(F.col("head").isNotNull() & (F.col("k") >= 1), F.struct(F.col("k"), F.col("head.section").alias("s")))).over(whole)
    t = t.withColumn("first", first).withColumn("opens", F.max(F.when(F.col("k") == 0, F.col("title"))).over(whole))
    t = t.withColumn("implied_end", F.when(F.col("opens") & (F.col("first.s") == "steps"), F.col("first.k")).otherwise(0))
    order = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.when(F.col("implied_end") > 0, "ingredients").otherwise("other")
    t = t.withColumn("section", F.coalesce(F.last("head.section", ignorenulls=True).over(order), start))
    region = (F.col("section") == "ingredients") & F.col("head").isNull() & ~F.col("title")
    number = F.when(region & F.col("text").rlike(_NUMBER), F.regexp_extract("text", _NUMBER, 1).cast("int"))
    name = F.regexp_extract("text", _IMPLIED_HEAD, 1)
    garbled = region & F.col("text").rlike(_IMPLIED_HEAD) & name.rlike(f"[^{v.numerals}{v.units}]")
    t = t.withColumn("region", region).withColumn("number", number).withColumn("garbled", garbled)
    t = t.withColumn("n1", F.min(F.when(F.col("number").isNotNull(), F.col("k"))).over(whole))
    t = t.withColumn("h", F.min(F.when(F.col("garbled") & (F.col("n1").isNull() | (F.col("k") < F.col("n1"))), F.col("k"))).over(whole))
    counted = F.count("number").over(order)
    t = t.withColumn("in_turn", F.when(F.col("number").isNotNull(), F.col("number") == counted))
    t = t.withColumn("in_turn", F.min("in_turn").over(whole))
    t = t.withColumn("n_items", F.count(F.when(F.col("region") & F.col("number").isNull() & (F.col("h").isNull() | (F.col("k") < F.col("h"))), 1)).over(whole))
    t = t.withColumn("has_steps", F.max(F.coalesce(F.col("head.section") == "steps", F.lit(False))).over(whole))
    begin = F.when(~F.col("has_steps") & (F.col("n_items") > 0), F.coalesce("h", F.when(F.col("in_turn"), F.col("n1"))))
    t = t.withColumn("steps_at", begin)
    mark = F.coalesce(F.col("head.section"), F.when(F.col("k") == F.col("steps_at"), "steps"))
    t = t.withColumn("section", F.coalesce(F.last(mark, ignorenulls=True).over(order), start))
    t = t.filter(~F.col("title") & ~F.coalesce((F.col("k") == F.col("steps_at")) & F.col("garbled"), F.lit(False)))
    t = t.withColumn("text", F.when(F.col("head").isNotNull(), F.col("head.rest")).otherwise(F.col("text"))).filter("text != ''")
    t = t.filter(~(F.col("head").isNull() & (F.col("k") < F.col("implied_end")) & F.col("text").rlike(_GARBLED)))
    return t.select(*REC, "k", "local_page", "section", "text")


def _listed(row: Column, when: Column) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.when(when, row))), lambda x: x["x"])


def finalize_records(records: DataFrame, pages: DataFrame, v: Vocabulary = DEFAULT, fixes: DataFrame | None = None) -> DataFrame:
    """One row a record: title, pages, ingredients, seasonings, steps, tips, excerpt, confidence and status.

    Ingredients keep repeats, for an amount may stand alone; steps and tips do
    not.  ``fixes`` are those of ``apply_group_fixes``, on what the lines say
    and not on what fills an empty list.
    """
    routed = materialize(route_sections(records, v), "routed")
    items = inherit_groups(routed.filter("section = 'ingredients'"), REC, ["k"], v=v)
    items = items.select(*REC, "k", "sub", F.when(F.col("grp") == "seasoning", "seasonings").otherwise("ingredients").alias("section"), F.col("item").alias("x"))
    steps = routed.filter("section = 'steps'").select(*REC, "k", F.posexplode(T.numbered_steps(F.col("text"))).alias("sub", "x"), F.lit("steps").alias("section"))
    rest = routed.filter("section not in ('ingredients', 'steps')").select(*REC, "k", F.lit(0).alias("sub"), "section", F.col("text").alias("x"))
    rows = items.unionByName(steps).unionByName(rest).withColumn("row", F.struct("k", "sub", "x"))
    sections = ("ingredients", "seasonings", "steps", "tips", "other")
    parts = rows.groupBy(*REC).agg(*(_listed(F.col("row"), F.col("section") == s).alias(s) for s in sections))
    order = F.sort_array(F.collect_list(F.struct("local_page", "ord", "text")))
    own = records.groupBy(*REC).agg(
        F.array_sort(F.collect_set("local_page")).alias("local_pages"),
        T.excerpt(T.normalize_text(F.array_join(F.transform(order, lambda x: x["text"]), "\n"))).alias("raw_excerpt"),
        F.min_by("text", F.struct("local_page", "ord")).alias("title"),
    )
    on_page = records.select(*REC, "local_page").distinct().join(pages.select("book_id", "local_page", "review_needed", "warnings"), ["book_id", "local_page"])
    flags = on_page.groupBy(*REC).agg(
        F.max("review_needed").alias("flagged"),
        F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("local_page", "warnings"))), lambda x: x["warnings"]))).alias("warnings"),
    )
    out = own.join(parts, REC, "left").join(flags, REC, "left")
    none = F.array().cast("array<string>")
    out = out.select(*REC, "local_pages", "raw_excerpt", "title", "flagged", "warnings", *(F.coalesce(s, none).alias(s) for s in sections))
    if fixes is not None:
        out = apply_group_fixes(out, fixes)
    first = lambda n: F.slice("other", 1, n)
    out = out.withColumn("title", T.strip_enumerator(F.col("title")))
    out = out.withColumn("ingredients", F.when(F.size("ingredients") == 0, first(2)).otherwise(F.col("ingredients")))
    out = out.withColumn("steps", F.array_distinct(F.when(F.size("steps") == 0, first(3)).otherwise(F.col("steps")))).withColumn("tips", F.array_distinct("tips"))
    low = F.coalesce("flagged", F.lit(False)) | (F.size("local_pages") > 3) | (F.length("title") <= 1)
    level = F.when(low, "low").when((F.size("ingredients") == 0) | (F.size("steps") == 0), "medium").otherwise("high")
    out = out.withColumn("confidence", level).withColumn("review_needed", level == "low")
    links = F.transform("local_pages", lambda p: F.format_string("%s#p%04d", F.col("book_id"), p))
    return out.withColumn("status", F.when(F.col("confidence") == "low", "review").otherwise("recipe")).withColumn("source_links", links).drop("other", "flagged")


def review_items(records: DataFrame, reason: str = "recipe boundary or structure needs manual verification") -> DataFrame:
    """(book_id, local_page, reason) of every page of a record that needs review."""
    return records.filter("review_needed").select("book_id", F.explode("local_pages").alias("local_page"), F.lit(reason).alias("reason"))


def fallback_rows(pages: DataFrame) -> DataFrame:
    """Pages of no record: text, excerpt, kind as status, and whether they need review."""
    return pages.select(
        "book_id", "local_page", "cleaned_text", T.excerpt(F.col("cleaned_text"), 800).alias("raw_excerpt"), F.col("page_kind").alias("status"),
        (F.col("review_needed") | F.col("confidence").isin("low", "failed")).alias("review_needed"),
    )


def apply_group_fixes(records: DataFrame, fixes: DataFrame) -> DataFrame:
    """Moves single items between ingredients and seasonings: (book_id, page, item, grp, after), one fix a record.

    A fix whose item or anchor is not there changes nothing.
    """
    f = fixes.select("book_id", F.col("page").alias("_page"), "item", "grp", "after")
    r = records.join(f, [records["book_id"] == f["book_id"], F.array_min("local_pages") == f["_page"]], "left").drop(f["book_id"])
    to_items = F.col("grp") == "ingredient"
    source, target = (F.when(to_items, F.col(a)).otherwise(F.col(b)) for a, b in (("seasonings", "ingredients"), ("ingredients", "seasonings")))
    at, behind = F.array_position(source, F.col("item")).cast("int"), F.array_position(target, F.col("after")).cast("int")
    fits = F.coalesce((at > 0) & (behind > 0), F.lit(False))
    less = F.concat(F.slice(source, F.lit(1), at - 1), F.slice(source, at + 1, F.size(source)))
    more = F.concat(F.slice(target, F.lit(1), behind), F.array("item"), F.slice(target, behind + 1, F.size(target)))
    r = r.withColumn("_i", F.when(fits, F.when(to_items, more).otherwise(less)).otherwise(F.col("ingredients")))
    r = r.withColumn("_s", F.when(fits, F.when(to_items, less).otherwise(more)).otherwise(F.col("seasonings")))
    return r.withColumn("ingredients", F.col("_i")).withColumn("seasonings", F.col("_s")).select(*records.columns)


# --- printed rows ----------------------------------------------------------------------


def row_numbers(top: list[float], bottom: list[float]) -> list[int]:
    """The printed row of each block of a page, in the order of their middles: one sweep that looks at the row's first block alone."""
    out, no, first, last = [], 0, 0.0, 0.0
    for a, b in zip(top, bottom):
        low = min(b - a, last - first)
        if not (no and low > 0 and 2 * (min(last, b) - max(first, a)) >= low):
            no, first, last = no + 1, a, b
        out.append(no)
    return out


def printed_rows(blocks: DataFrame, group: list[str], top: str = "y0", bottom: str = "y1", left: str = "x0", place: str = "ord") -> DataFrame:
    """Adds row_no and col_no.  A block joins the current row if it overlaps the row's first block by half the lower height.

    The comparison is with the row's head, so it is a sweep over the blocks of
    one page by their middles, linear in their number; only edges go through it.
    """
    a, b = F.col(top).cast("double"), F.col(bottom).cast("double")
    edges = F.sort_array(F.collect_list(F.struct(((a + b) / 2).alias("m"), F.col(place).alias("k"), a.alias("a"), b.alias("b"), F.struct(*blocks.columns).alias("row"))))

    @F.pandas_udf("array<int>")
    def swept(tops: pd.Series, bottoms: pd.Series) -> pd.Series:
        return pd.Series([row_numbers(list(x), list(y)) for x, y in zip(tops, bottoms)])

    page = blocks.groupBy(*group).agg(edges.alias("p"))
    nos = swept(F.transform("p", lambda x: x["a"]), F.transform("p", lambda x: x["b"]))
    rows = page.select(F.transform("p", lambda x: x["row"]).alias("row"), nos.alias("row_no")).select(F.explode(F.arrays_zip("row", "row_no")).alias("x")).select("x.row.*", "x.row_no")
    return rows.withColumn("col_no", F.row_number().over(Window.partitionBy(*group, "row_no").orderBy(left, place)))


def repair_columns(blocks: DataFrame, group: list[str], text: str = "text", v: Vocabulary = DEFAULT) -> DataFrame:
    """Within a printed row, an amount without a name goes to the name without an amount on its left; emptied blocks go.

    ``blocks`` has row_no and col_no of ``printed_rows`` and only blocks of the region.
    """

    @F.pandas_udf("array<string>")
    def mended(rows: pd.Series, texts: pd.Series) -> pd.Series:
        """The new texts of a page in order; null for a block that goes."""
        g = grammar(v)

        def one(nos, said):
            said, before = list(said), -1
            for i in range(len(said)):
                if before >= 0 and nos[i] == nos[before]:
                    amount, rest = g.head_amount(said[i])
                    if amount and g.bare_name(said[before]):
                        said[before], said[i] = f"{said[before]} {amount}", rest or None
                        if not rest:
                            continue
                before = i
            return said

        return pd.Series([one(a, b) for a, b in zip(rows, texts)])

    row = F.struct("row_no", "col_no", F.col(text).alias("_t"), F.struct(*blocks.columns).alias("row"))
    page = blocks.groupBy(*group).agg(F.sort_array(F.collect_list(row)).alias("p"))
    new = mended(F.transform("p", lambda x: x["row_no"]), F.transform("p", lambda x: x["_t"]))
    out = page.withColumn("_new", new).select(F.explode(F.arrays_zip(F.transform("p", lambda x: x["row"]).alias("row"), F.col("_new").alias("new"))).alias("x"))
    out = out.select("x.*").filter("new is not null")
    return out.select(*(F.col("new").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in blocks.columns))
