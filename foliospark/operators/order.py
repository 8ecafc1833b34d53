"""Window-like operators: neighbours, carried categories, interpolation, runs, numbering, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.scratch import materialize


def neighbours(df: DataFrame, by: list[str], order: list, link: Column, out: str = "related") -> DataFrame:
    """Adds the links of the rows before and after, as far as there are any."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.array_compact(F.array(F.lag(link).over(w), F.lead(link).over(w))))


def carry_category(tokens: DataFrame, by: list[str], page: list[str], order: list, is_head: Column, name: Column, is_entry: Column, least: int) -> DataFrame:
    """Entries with the last category before them, over page ends; pages with fewer than ``least`` entries count for nothing."""
    per_page = Window.partitionBy(*by, *page)
    t = tokens.withColumn("_e", is_entry).withColumn("_n", F.sum(F.col("_e").cast("int")).over(per_page)).filter(F.col("_n") >= least)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.withColumn("category", F.last(F.when(is_head, name), ignorenulls=True).over(w)).filter("_e").drop("_e", "_n")


def interpolate(df: DataFrame, by: list[str], order: list[str], printed: str, known: str, out: str = "resolved") -> DataFrame:
    """Places of rows without one, from printed numbers: the last known place plus the printed difference, within the next known one.

    The run before the first known place starts from the next one, never
    below 1, and then goes on from its own first row; where nothing is known
    the printed number is the place.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    past, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    pair = F.when(F.col(known).isNotNull(), F.struct(F.col(known).alias("p"), F.col(printed).alias("n")))
    t = df.select(
        "*",
        F.last(pair, ignorenulls=True).over(past).alias("_last"),
        F.first(pair, ignorenulls=True).over(ahead).alias("_next"),
        F.first(F.col(printed)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_n0"),
        F.row_number().over(w).alias("_i"),
    )
    # what the group's first row itself resolves to; only the leading run reads it
    g0 = F.when(F.col("_next").isNotNull(), F.greatest(F.lit(1), F.col("_next.p") - (F.col("_next.n") - F.col("_n0")))).otherwise(F.col("_n0"))
    base, base_n = F.coalesce(F.col("_last.p"), g0), F.coalesce(F.col("_last.n"), F.col("_n0"))
    guess = base + (F.col(printed) - base_n)
    inside = F.when(F.col("_next").isNotNull(), F.greatest(base, F.least(guess, F.col("_next.p")))).otherwise(guess)
    first = (F.col("_i") == 1) & F.col("_last").isNull()
    return t.select(*df.columns, F.coalesce(F.col(known), F.when(first, g0).otherwise(inside)).alias(out))


def runs(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, first, last, size) of runs of consecutive numbers: gaps and islands."""
    t = df.select(*by, number).distinct()
    t = t.withColumn("_g", F.col(number) - F.row_number().over(Window.partitionBy(*by).orderBy(number)))
    return t.groupBy(*by, "_g").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count("*").alias("size")).drop("_g")


def run_texts(df: DataFrame, by: list[str], number: str, form: str = "p%04d") -> DataFrame:
    """(by, ranges): ``p0001-p0003, p0007``."""
    r = runs(df, by, number)
    one = F.when(F.col("first") == F.col("last"), F.format_string(form, "first")).otherwise(F.format_string(f"{form}-{form}", "first", "last"))
    listed = F.sort_array(F.collect_list(F.struct(F.col("first"), one.alias("t"))))
    return r.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x["t"]), ", ").alias("ranges"))


def counts_up(df: DataFrame, by: list[str], order: list, number: str) -> DataFrame:
    """(by, n, monotone): whether a group's numbers are 1, 2, 3 … in order."""
    t = df.withColumn("_ok", F.col(number) == F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return t.groupBy(*by).agg(F.count("*").alias("n"), F.min("_ok").alias("monotone"))


def number_within(df: DataFrame, by: list[str], order: list, out: str) -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def first_by_place(df: DataFrame, by: list[str], place: list, value: str) -> DataFrame:
    """(by, value): the value at a group's first place, as a map-side aggregate."""
    return df.groupBy(*by).agg(F.min_by(value, F.struct(*place)).alias(value))


def top_per_group(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    return number_within(df, by, order, "rank").filter(F.col("rank") <= k)


def limit_over_groups(df: DataFrame, group: str, seen: str, order: list[str], limit: int) -> DataFrame:
    """A global limit: groups in the order they were first seen, rows in order inside them."""
    first = df.groupBy(group).agg(F.min(seen).alias("_first"))
    return df.join(first, group).orderBy("_first", group, *order).limit(limit).drop("_first")


def sessions(df: DataFrame, by: list[str], order: list, opens: Column, closes: Column) -> DataFrame:
    """Adds session: the number of openings so far, 0 for rows of none.  A closing row is the last of no session."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = df.withColumn("_n", F.sum(opens.cast("int")).over(w))
    state = F.last(F.when(opens, F.lit(True)).when(closes, F.lit(False)), ignorenulls=True).over(w)
    return t.withColumn("session", F.when(F.coalesce(state, F.lit(False)), F.col("_n")).otherwise(F.lit(0)).cast("long")).drop("_n")


#: Rows of which a task makes something, at most.
ROWS = 1 << 14


def dealt(df: DataFrame, by: list[str], per: int | None = None) -> DataFrame:
    """A written table by key over tasks, about ``per`` rows to one: for work that goes with the rows and not with their bytes.

    Files are cut into tasks by bytes, and what is shuffled is put together by
    bytes too, so a million short rows could be one task.  The table is counted.
    """
    n, usual = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, -(-n // (per or ROWS)), min(usual, -(-n // 1000))), *by)


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df``, written, with ``place`` from 0 in its group by ``order``, nulls first, and the group's size ``n``.

    Rows are partitioned by range of group and order and written once; a place
    is a row's number in its partition plus the counts of those before it, so a
    group of any size is spread over tasks.  Equal rows are dealt over them too.
    """
    df = df.withColumn("_nth", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (*group, *order, "_nth")]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    dealt = materialize(dealt.drop("_nth").withColumn("_part", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()).withColumn("_of", F.xxhash64(*[F.struct(F.col(c).isNull(), c) for c in group], F.lit(0))), "numbered")
    counts = dealt.groupBy("_of", "_part").agg(F.count("*").alias("_c"), F.min("_m").alias("_first"))
    counts = materialize(counts, "counts")  # a row a partition and group
    before = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_of", "_part", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_c").over(Window.partitionBy("_of")).alias("n"))
    out = dealt.join(shift, ["_of", "_part"]).withColumn("place", F.col("_m") + F.col("_shift"))
    return out.drop("_part", "_m", "_of", "_shift")
