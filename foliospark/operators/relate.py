"""Joins: lookups with guards, folded and near keys, as-of, exclusive claims, incremental queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T


def lookup(left: DataFrame, right: DataFrame, on: list[str], values: dict[str, object]) -> DataFrame:
    """Left join that adds ``values`` (column -> default where nothing matches)."""
    r = right.select(*on, *(F.col(c).alias(f"_{c}") for c in values))
    joined = left.join(r, on, "left")
    return joined.select(*left.columns, *(F.coalesce(F.col(f"_{c}"), F.lit(d)).alias(c) for c, d in values.items()))


def unique_override(df: DataFrame, overrides: DataFrame, on: list[str], column: str, accept: Column | None = None) -> DataFrame:
    """Replaces ``column`` by the override of a key that exactly one row has; adds applied, refused and the old value.

    ``overrides`` has the keys and ``value``; ``accept`` is a predicate on it.
    """
    n = F.count("*").over(Window.partitionBy(*on))
    o = overrides.select(*on, F.col("value").alias("_value"))
    j = df.withColumn("_n", n).join(o, on, "left")
    fits = F.col("_value").isNotNull() & (F.col("_n") == 1)
    good = fits & (accept if accept is not None else F.lit(True)) & (F.col("_value") != F.col(column))
    return j.select(
        *(F.when(good, F.col("_value")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns),
        F.coalesce(good, F.lit(False)).alias("applied"),
        (F.col("_value").isNotNull() & ~F.coalesce(good, F.lit(False))).alias("refused"),
        F.when(good, F.col(column)).alias("old_value"),
    )


def pages_of(records: DataFrame, keys: list[str], pages: str = "local_pages") -> DataFrame:
    """One row a page of each record."""
    return records.select(*keys, F.explode(pages).alias("local_page"))


def star(base: DataFrame, on: list[str], *sides: tuple[DataFrame, str]) -> DataFrame:
    """Left joins of many sides on the same keys: each side becomes one struct column, null where it has no row.

    All exchanges are on the same keys, so the base is shuffled once.
    """
    out = base
    for side, name in sides:
        out = out.join(side.select(*on, F.struct(*(c for c in side.columns if c not in on)).alias(name)), on, "left")
    return out


def exact_then_folded(left: DataFrame, right: DataFrame, key: str, value: str, within: list[str], fold=T.fold_title) -> DataFrame:
    """Adds ``value``: of equal keys the least, else of equal folded keys the least; and how it was found."""
    exact = right.groupBy(*within, key).agg(F.min(value).alias("_exact"))
    loose = right.withColumn("_fold", fold(F.col(key))).groupBy(*within, "_fold").agg(F.min(value).alias("_loose"))
    j = left.withColumn("_fold", fold(F.col(key))).join(exact, [*within, key], "left").join(loose, [*within, "_fold"], "left")
    how = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_loose").isNotNull(), "folded").otherwise("none")
    return j.select(*left.columns, F.coalesce("_exact", "_loose").alias(value), how.alias("matched_by"))


def neighbour_keys(c: Column) -> Column:
    """array<long>: for every position a hash of the text without the character there, and of the position.

    A character and its position have one hash, and those of a text are
    combined by exclusive or, so leaving a position out is one operation: n
    numbers for n characters.
    """
    chars = F.split(c, "")
    each = F.transform(chars, lambda x, i: F.xxhash64(x, i))
    whole = lambda h: F.aggregate(h, F.size(h).cast("long"), lambda a, x: a.bitwiseXOR(x))
    return T.let(each, lambda h: T.let(whole(h), lambda w: F.transform(h, lambda x, i: F.xxhash64(i, w.bitwiseXOR(x)))))


def one_char_pairs(left: DataFrame, right: DataFrame, key: str, within: list[str]) -> DataFrame:
    """Pairs whose keys differ in exactly one character: an equi-join on hashes of the keys without one position.

    The hashes travel with a key's own 64-bit hash; keys come back for the
    pairs that were found, and are compared.  Each different key is hashed
    once, however many rows have it.  Null and empty keys have no pairs.  Joins
    are by merge: a small file of keys that compress well is no small table.
    """

    def keys(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.length(key) > 0).select(*within, F.col(key).alias(name), F.xxhash64(key).alias(f"_{name}")).distinct()

    a, b = keys(left, "one"), keys(right, "two")
    places = lambda df, name: df.select(*within, f"_{name}", F.explode(neighbour_keys(F.col(name))).alias("_b"))
    near = places(a, "one").join(places(b, "two").hint("merge"), [*within, "_b"]).filter("_one != _two").select(*within, "_one", "_two").distinct()
    pairs = near.join(a.hint("merge"), [*within, "_one"]).join(b.hint("merge"), [*within, "_two"]).filter(T.one_char_apart(F.col("one"), F.col("two")))
    rows = right.select(*within, F.col(key).alias("two"), F.col(key).alias("other"), *(c for c in right.columns if c not in (*within, key)))
    found = left.join(pairs.select(*within, F.col("one").alias(key), "two").hint("merge"), [*within, key])
    return found.join(rows.hint("merge"), [*within, "two"]).drop("two")


def contents_aliases(entries: DataFrame, records: DataFrame, named: DataFrame | None = None, appended: str = "[（(]\\s*附") -> DataFrame:
    """(book_id, rec_id, alias): contents titles that name exactly one record in other words.

    ``named`` (book_id, local_page, alias, title) says for some entries which
    record they mean, and then nothing else counts for them.  Other pairs are
    one character apart, or have the same core title - not for entries with an
    appended dish.  Of several records those whose pages hold the entry's page
    win; the one that is left, if it is one, gets the alias.  No side is sent to
    all executors: each has as many rows as there are entries or records.
    ``entries``: book_id, title, local_page; ``records``: book_id, rec_id, title, local_pages, and aliases where they have them.
    """
    e = entries.select("book_id", T.strip(T.fullwidth_parens(F.col("title")), "、·-—. ").alias("title"), "local_page").filter("title != ''").distinct()
    known = records.select("book_id", "title")
    if "aliases" in records.columns:
        known = known.union(records.select("book_id", F.explode("aliases").alias("title"))).distinct()
    e = e.join(known.hint("merge"), ["book_id", "title"], "left_anti")
    own = records.select("book_id", "title", "rec_id", "local_pages")
    told = None
    if named is not None:
        names = named.select("book_id", "local_page", F.col("alias").alias("title"), F.col("title").alias("_named"))
        said = e.join(names.hint("merge"), ["book_id", "local_page", "title"])
        e = e.join(names.hint("merge"), ["book_id", "local_page", "title"], "left_anti")
        one = own.groupBy("book_id", "title").agg(F.count("*").alias("_n"), F.first("rec_id").alias("rec_id")).filter("_n = 1")
        told = said.join(one.select("book_id", F.col("title").alias("_named"), "rec_id").hint("merge"), ["book_id", "_named"]).select("book_id", "rec_id", F.col("title").alias("alias"))
    near = one_char_pairs(e, own, "title", ["book_id"])
    core = e.filter(~F.col("title").rlike(appended)).withColumn("_core", T.core_title(F.col("title"))).filter("_core != ''")
    same = core.join(own.select("book_id", F.col("title").alias("other"), "rec_id", "local_pages", T.core_title(F.col("title")).alias("_core")).hint("merge"), ["book_id", "_core"]).drop("_core")
    pairs = near.select("book_id", "title", "local_page", "rec_id", "local_pages").unionByName(same.select("book_id", "title", "local_page", "rec_id", "local_pages"))
    pairs = pairs.dropDuplicates(["book_id", "title", "local_page", "rec_id"])
    w = Window.partitionBy("book_id", "title", "local_page")
    on_page = F.coalesce(F.array_contains("local_pages", F.col("local_page")), F.lit(False))
    pairs = pairs.withColumn("_n", F.count("*").over(w)).withColumn("_here", F.sum(on_page.cast("int")).over(w))
    sure = (F.col("_n") == 1) | ((F.col("_here") == 1) & on_page)
    found = pairs.filter(sure).select("book_id", "rec_id", F.col("title").alias("alias"))
    return (found if told is None else found.union(told)).distinct()


def manual_aliases(records: DataFrame, given: DataFrame) -> DataFrame:
    """Adds the aliases that ``given`` (book_id, local_page, title, alias) has for a record, by its title and first page."""
    own = given.groupBy("book_id", F.col("local_page").alias("_first"), "title").agg(F.sort_array(F.collect_set("alias")).alias("_given"))
    r = records.withColumn("_first", F.array_min("local_pages")).join(own.hint("merge"), ["book_id", "_first", "title"], "left")
    more = F.concat("aliases", F.transform(F.coalesce("_given", F.array().cast("array<string>")), T.fullwidth_parens))
    return r.withColumn("aliases", F.array_distinct(F.filter(more, lambda x: (x != "") & (x != F.col("title"))))).select(*records.columns)


def title_policy(records: DataFrame, title: str = "title", aliases: str = "aliases") -> DataFrame:
    """Titles in full-width brackets without allowed notes; what was really stripped becomes an alias; aliases distinct, not the title."""
    wide = T.strip(T.fullwidth_parens(F.col(title)), "、·-—. ")
    new = T.strip(T.strip_notes(wide), "、·-—. ")
    old = F.transform(F.col(aliases), T.fullwidth_parens)
    all_ = F.when(new != wide, F.concat(old, F.array(wide))).otherwise(old)
    r = records.withColumn("_new", new).withColumn("_all", all_)
    return r.withColumn(aliases, F.array_distinct(F.filter("_all", lambda x: (x != F.col("_new")) & (x != "")))).withColumn(title, F.col("_new")).drop("_new", "_all")


def asof(left: DataFrame, right: DataFrame, by: list[str], at: str, value: str, default: str) -> DataFrame:
    """Adds ``value`` of the last right row at or before a left row: a union and one window fill, no range join.

    The fill runs over the distinct places of both sides, which join the whole
    left rows again by equality.  Of right rows at one place the first by
    ``ord`` holds.
    """
    places = left.select(*by, at).distinct().withColumn("_v", F.lit(None).cast(right.schema[value].dataType)).withColumn("_side", F.lit(1))
    known = right.groupBy(*by, at).agg(F.min_by(F.struct(F.col(value).alias("v")), "ord").alias("_r"))
    known = known.select(*by, at, F.col("_r.v").alias("_v"), F.lit(0).alias("_side"))
    w = Window.partitionBy(*by).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = places.unionByName(known).withColumn("_f", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select(*by, at, "_f")
    return left.join(filled, [*by, at], "left").select(*left.columns, F.coalesce("_f", F.lit(default)).alias(value))


def claim_once(wanted: DataFrame, candidates: DataFrame, on: Column, claim: list[str], rank: list) -> DataFrame:
    """Each wanted row goes to the first candidate in order, to nobody else."""
    w = Window.partitionBy(*claim).orderBy(*rank)
    return wanted.join(candidates, on).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def unmatched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_anti")


def replace_groups(old: DataFrame, done: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The old queue without the groups that were processed again, and their new rows."""
    return old.join(done.select(key).distinct(), key, "left_anti").unionByName(new)


def upsert(defaults: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Defaults with every non-null override; overrides of unknown keys are dropped."""
    cols = [c for c in defaults.columns if c != key]
    o = overrides.select(key, *((F.col(c) if c in overrides.columns else F.lit(None)).alias(f"_{c}") for c in cols))
    return defaults.join(o, key, "left").select(key, *(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in cols))


def override_union(*sources: tuple[DataFrame, int], keys: list[str]) -> DataFrame:
    """Of several tables with one schema, the row of the highest priority for each key: a map-side aggregate, no window."""
    rows = None
    for df, priority in sources:
        d = df.select(*keys, F.struct(F.lit(priority).alias("priority"), F.struct(*(c for c in df.columns if c not in keys)).alias("row")).alias("x"))
        rows = d if rows is None else rows.unionByName(d)
    return rows.groupBy(*keys).agg(F.max_by("x", "x.priority").alias("x")).select(*keys, "x.priority", "x.row.*")


def article_plan(articles: DataFrame, pages: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pages of listed articles with place, total and neighbours; and the pages that no article lists.

    ``articles`` has the keys, ``article`` and ``ord``.
    """
    j = articles.join(pages.hint("merge"), on)
    w = Window.partitionBy("article").orderBy("ord")
    page = F.struct(*on)
    plan = j.select(
        "*", F.row_number().over(w).alias("place"), F.count("*").over(Window.partitionBy("article")).alias("total"), F.lag(page).over(w).alias("prev"), F.lead(page).over(w).alias("next")
    )
    return plan, pages.join(articles.select(*on).hint("merge"), on, "left_anti")
