"""Readers and writers: layout JSON, review Markdown, notes, rule and annotation files, manifests.

Readers work on columns of whole files, so they run wherever Spark reads: no
path is opened on the driver but small configuration.
"""

from __future__ import annotations

import json
import re
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.functions import text as T
from foliospark.operators.layout import RAW_BLOCK, extract_blocks, unescape_tables
from foliospark.operators.links import small_batches
from foliospark.operators.order import numbered
from foliospark.operators.relate import override_union
from foliospark.sources.files import save_files, seen_by
from foliospark.sources.scratch import materialize

PAGE = f"array<struct<page_idx:int,page_size:array<double>,para_blocks:array<{RAW_BLOCK}>>>"


def whole_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, value): one row a file."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def page_container(payload: Column) -> Column:
    """The JSON of the first value that is a non-empty list whose first item has page_idx and para_blocks; null if none is."""
    keys = F.json_object_keys(payload)
    values = F.from_json(payload, "map<string,string>")
    inner = F.transform(keys, lambda k: F.element_at(values, k))
    found = F.filter(inner, lambda x: F.get_json_object(x, "$[0].page_idx").isNotNull() & F.get_json_object(x, "$[0].para_blocks").isNotNull())
    return F.get(found, F.lit(0))


def read_layout(files: DataFrame, book: Column) -> DataFrame:
    """Pages of layout JSON files (path, value): blocks, texts, titles and hints; pages count from 1.  A file without pages is an error."""
    engine = F.concat_ws("::", *(F.nullif(F.get_json_object("value", f"$.{k}"), F.lit("")) for k in ("_backend", "_version_name")))
    pages = F.coalesce(page_container(F.col("value")), F.raise_error(F.concat(F.lit("no page container in "), F.col("path"))).cast("string"))
    p = files.select(book.alias("book_id"), engine.alias("ocr_engine"), F.explode(F.from_json(pages, PAGE)).alias("p"))
    p = p.select("book_id", "ocr_engine", (F.col("p.page_idx") + 1).alias("local_page"), "p.page_size", extract_blocks(F.col("p.para_blocks")).alias("text_blocks"))
    p = p.withColumn("text_blocks", unescape_tables(F.col("text_blocks")))
    raw = F.array_join(F.transform("text_blocks", lambda b: b["text"]), "\n")
    p = p.withColumn("raw_text", raw)
    return p.select(
        "*",
        F.transform(F.filter("text_blocks", lambda b: b["block_type"] == "title"), lambda b: b["text"]).alias("title_candidates"),
        F.array_sort(F.array_distinct(F.transform("text_blocks", lambda b: b["block_type"]))).alias("block_types"),
        F.when(F.trim("raw_text") == "", F.array(F.lit("empty page"))).otherwise(F.array().cast("array<string>")).alias("parse_warnings"),
    )


# --- configuration -------------------------------------------------------------------


def load_config(text: str) -> dict:
    """JSON, or YAML where PyYAML is installed; an empty text is an empty configuration."""
    if not text.strip():
        return {}
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text) or {}


def annotations(spark: SparkSession, text: str | list | dict, key: str = "annotations") -> DataFrame:
    """Annotations that have a book, a page, an anchor and a note; anything else is dropped, and a text that can't be read has none."""
    schema = "book_id string, local_page int, anchor string, note string, slug string"
    try:
        found = load_config(text) if isinstance(text, str) else text
    except Exception:  # whatever reads the text says so in its own way
        found = {}
    rows = (found.get(key) or []) if isinstance(found, dict) else found
    good = [r for r in rows if isinstance(r, dict) and all(r.get(k) for k in ("book_id", "local_page", "anchor", "note"))]
    return spark.createDataFrame([(str(r["book_id"]), int(r["local_page"]), str(r["anchor"]), str(r["note"]), r.get("slug")) for r in good], schema)


def nested_lists(payload: Column, item: str = "string") -> Column:
    """array<struct<book_id, local_page, value>> of JSON book -> page -> value or list, blank values dropped, distinct in order."""
    one = F.from_json(payload, f"map<string,map<string,array<{item}>>>")
    books = F.map_entries(one)
    rows = F.flatten(F.transform(books, lambda b: F.flatten(F.transform(F.map_entries(b["value"]), lambda p: F.transform(p["value"], lambda x: F.struct(b["key"].alias("book_id"), p["key"].cast("int").alias("local_page"), x.alias("value")))))))
    return F.array_distinct(F.filter(rows, lambda r: F.trim(r["value"].cast("string")) != ""))


# --- Markdown ----------------------------------------------------------------------------

# The keys that review files use, with the ones that stand for them; the first present counts.
REVIEW_KEYS = {
    "confidence": ("置信度", "confidence"),
    "reasons": ("reasons",),
    "title_candidates_raw": ("标题候选", "title_candidates"),
    "rendered_page_path": ("image_path", "rendered_page_path"),
    "current_recipe_candidates_raw": ("菜谱候选", "current_recipe_candidates"),
    "current_fallback_candidates_raw": ("回退候选", "current_fallback_candidates"),
    "content_preview": ("content_preview",),
    "notes": ("notes",),
    "correct_content": ("正确内容", "????"),
    "confirm_mark": ("确认勾", "???"),
}
CONFIRMED = "[x]"
_PAGE_HEAD = "(\\S+-\\d+)\\s+p\\.(\\d+)"


def bullet_map(lines: Column) -> Column:
    """map<string,string> of ``- key: value`` lines, split at the first colon; of a key that stands again the last value holds."""
    hits = F.filter(lines, lambda x: x.startswith("- ") & F.substring(x, 3, 1 << 30).contains(":"))
    key = lambda x: T.normalize_text(F.substring_index(F.substring(x, 3, 1 << 30), ":", 1))
    value = lambda x: T.strip(F.regexp_replace(x, "^- [^:]*:", ""))
    pairs = F.transform(hits, lambda x: F.struct(key(x).alias("key"), value(x).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def _review(files: DataFrame, book: Column, page: Column, lines: Column, **other: Column) -> DataFrame:
    """One row a review entry; keys that are missing are empty texts."""
    t = files.select("path", book.alias("book_id"), F.coalesce(page.cast("int"), F.lit(0)).alias("local_page"), bullet_map(lines).alias("m"))
    get = lambda keys: F.coalesce(*(F.element_at("m", k) for k in keys), F.lit(""))
    values = {name: other.get(name, get(keys)) for name, keys in REVIEW_KEYS.items()}
    return t.select("path", "book_id", "local_page", *(c.alias(n) for n, c in values.items())).withColumn("confirmed", F.lower("confirm_mark").contains(CONFIRMED))


def _lines(body: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(body, "\\r\\n?", "\n"), "\n"), lambda x: F.regexp_replace(x, f"{T.SPACE}+$", ""))


def read_review_queue(files: DataFrame) -> DataFrame:
    """Entries of files (path, value) with many ``## <book> p.<n>`` sections; what stands before the first one is not read."""
    heading = f"^##\\s+{_PAGE_HEAD}\\s*$"
    lines = _lines(F.col("value"))
    starts = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(heading), i)), lambda i: i.isNotNull())
    t = files.select("path", lines.alias("lines"), starts.alias("starts"))
    t = t.select("path", "lines", "starts", F.posexplode("starts").alias("k", "at"))
    end = F.coalesce(F.get("starts", F.col("k") + 1), F.size("lines"))
    t = t.select("path", F.get("lines", F.col("at")).alias("head"), F.slice("lines", F.col("at") + 2, end - F.col("at") - 1).alias("body"))
    return _review(t, F.regexp_extract("head", heading, 1), F.regexp_extract("head", heading, 2), F.col("body"))


def read_page_reviews(files: DataFrame) -> DataFrame:
    """One entry a file (path, value): its page is the first ``# <book> p.<n>`` line's, its bullets stand anywhere; without such a line the book is empty."""
    heading = f"^#\\s+{_PAGE_HEAD}\\s*$"
    t = files.select("path", _lines(F.col("value")).alias("lines"))
    first = F.get(F.filter(F.transform("lines", lambda x: T.strip(x)), lambda x: x.rlike(heading)), F.lit(0))
    t = t.select("path", "lines", F.coalesce(first, F.lit("")).alias("head"))
    return _review(t, F.regexp_extract("head", heading, 1), F.nullif(F.regexp_extract("head", heading, 2), F.lit("")), F.col("lines"), content_preview=F.lit(""))


def read_confirmations(spark: SparkSession, path: str) -> DataFrame:
    """Review entries of a folder of page files ``*/p*.md``, or of one queue file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        files = spark.read.text(f"{path.rstrip('/')}/*/p*.md", wholetext=True)
        return read_page_reviews(files.select(F.col("_metadata.file_path").alias("path"), "value"))
    return read_review_queue(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value"))


def merged_confirmations(in_file: DataFrame, queue: DataFrame) -> DataFrame:
    """A page's own file overrides the queue where it is confirmed or says something."""
    cols = ["book_id", "local_page", "confirmed", "correct_content", "notes"]
    own = in_file.filter(F.col("confirmed") | (F.trim("correct_content") != "")).select(*cols)
    return override_union((queue.select(*cols), 1), (own, 2), keys=["book_id", "local_page"])


def read_notes(files: DataFrame, section: str) -> DataFrame:
    """(path, meta, body): front matter as a map, and one ``## section`` as an array of lines; files without front matter are left out."""
    front = F.regexp_extract("value", "(?s)^---\\n(.*?)\\n---", 1)
    inner = F.regexp_extract("value", f"(?s)(?:^|\\n)##\\s+{re.escape(section)}\\s*\\n(.*?)(?=\\n##\\s|\\z)", 1)
    pairs = F.transform(F.filter(F.split(front, "\n"), lambda x: x.rlike("^[A-Za-z_]\\w*:")), lambda x: F.struct(F.regexp_extract(x, "^(\\w+):", 1).alias("key"), T.strip(F.regexp_extract(x, "^\\w+:\\s*(.*)$", 1), "\"' ").alias("value")))
    lines = F.filter(F.transform(F.split(inner, "\n"), lambda x: T.strip(x)), lambda x: (x != "") & (x != "无"))
    return files.filter(F.col("value").rlike("(?s)^---\\n.*?\\n---")).select("path", F.map_from_entries(F.array_distinct(pairs)).alias("meta"), lines.alias("body"))


def front_matter(**fields: Column) -> Column:
    """A YAML block of scalars and of arrays of strings."""
    quoted = lambda c: F.to_json(F.struct(c.cast("string").alias("x")))
    scalar = lambda c: F.regexp_extract(quoted(c), '^\\{"x":(.*)\\}$', 1)
    out = [F.lit("---")]
    for name, (c, many) in ((k, v if isinstance(v, tuple) else (v, False)) for k, v in fields.items()):
        out.append(F.concat(F.lit(f"{name}:"), F.array_join(F.transform(c, lambda x: F.concat(F.lit("\n- "), scalar(x))), "")) if many else F.concat(F.lit(f"{name}: "), F.coalesce(scalar(c), F.lit("null"))))
    return F.concat_ws("\n", *out, F.lit("---"))


def render_record(sections: dict[str, str]) -> Column:
    """A record as a note: front matter and one ``## heading`` with bullets for each array column."""
    head = front_matter(title=F.col("title"), book_id=F.col("book_id"), local_pages=(F.col("local_pages"), True), confidence=F.col("confidence"), status=F.col("status"), review_needed=F.col("review_needed"))
    return F.concat(head, F.lit("\n\n# "), F.col("title"), *(F.concat(F.lit(f"\n\n## {h}\n\n"), T.bullets(F.col(c))) for h, c in sections.items()))


def render_fallback() -> Column:
    head = front_matter(book_id=F.col("book_id"), local_page=F.col("local_page"), status=F.col("status"), review_needed=F.col("review_needed"))
    return F.concat(head, F.lit("\n\n## 页面文本\n\n"), T.bullets(F.split("cleaned_text", "\n")))


# --- sinks ------------------------------------------------------------------------------------


def _each_file(files: DataFrame, folder: str, act) -> int:
    """``act(store, folder, row)`` for every row, by the executors, through a file system that pyarrow opens from the folder's URI; how many there were."""

    def run(batches):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                act(store, top.rstrip("/"), row)
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["n"])

    return files.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_files(files: DataFrame, folder: str, name: str = "file_name", body: str = "body", overwrite: bool = False) -> int:
    """One text file a row, with a line end, by ``sources.files``: all become visible together; how many there were is observed on the way.

    With ``overwrite`` the folder holds nothing else afterwards.
    """
    seen = Observation()
    save_files(files.observe(seen, F.count(F.lit(1)).alias("n")), folder, name, body, overwrite)
    return seen_by(seen)


def list_files(spark: SparkSession, folder: str, glob: str = "*.md", name: str = "file_name") -> DataFrame:
    """The names of a folder's files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select(F.url_decode(F.substring_index("path", "/", -1)).alias(name))


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row and line; what was there is replaced."""
    df.write.mode("overwrite").json(path)


def json_document(df: DataFrame, *order: str) -> DataFrame:
    """(value): all rows as one indented JSON array, for a small report."""
    rows = F.sort_array(F.collect_list(F.struct(*(F.col(c) for c in order), F.to_json(F.struct(*df.columns)).alias("_json"))))
    one = df.agg(F.transform(rows, lambda x: x["_json"]).alias("rows"))
    return one.select(F.when(F.size("rows") == 0, "[]").otherwise(F.concat(F.lit("[\n  "), F.array_join("rows", ",\n  "), F.lit("\n]"))).alias("value"))


def write_yaml(df: DataFrame, path: str) -> None:
    """Each row as a YAML list entry: scalars as JSON writes them, which YAML reads; what was there is replaced."""
    said = [F.concat(F.lit("- " if i == 0 else "  "), F.lit(f"{c}: "), F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), '^\\{"x":(.*)\\}$', 1), F.lit("null"))) for i, c in enumerate(df.columns)]
    shown = [F.when(F.col(c).isNull(), F.lit(("- " if i == 0 else "  ") + f"{c}: null")).otherwise(x) for i, (c, x) in enumerate(zip(df.columns, said))]
    df.select(F.concat_ws("\n", *shown).alias("value")).write.mode("overwrite").text(path)


def stale_files(existing: DataFrame, expected: DataFrame, name: str = "file_name") -> DataFrame:
    return existing.join(expected.select(name).hint("merge"), name, "left_anti")


def prune(spark: SparkSession, folder: str, expected: DataFrame, glob: str = "*.md", name: str = "file_name") -> int:
    """Executors delete the files that are not expected; how many those were."""
    gone = stale_files(list_files(spark, folder, glob, name), expected, name).select(F.col(name).alias("name"))
    return _each_file(gone, folder, lambda store, top, row: store.delete_file(f"{top}/{row['name']}"))


def read_outputs(spark: SparkSession, path: str, books: list[str] | None = None, key: str = "book_id") -> DataFrame:
    """What ``write_partitioned`` has written, of some books or of all; only their folders are read."""
    rows = spark.read.parquet(path)
    return rows.filter(F.col(key).isin(*books)) if books else rows


def write_partitioned(df: DataFrame, path: str, key: str = "book_id") -> None:
    """Only the partitions that ``df`` has are replaced: an import of one book leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def manifest(books: DataFrame, *counted: tuple[DataFrame, str]) -> DataFrame:
    """Books with a count of each table's rows."""
    out = books
    for df, name in counted:
        out = out.join(df.groupBy("book_id").agg(F.count("*").alias(name)), "book_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def file_hashes(df: DataFrame, key: str, body: str) -> DataFrame:
    return df.select(key, F.sha2(F.col(body), 256).alias("sha256"), F.octet_length(body).cast("long").alias("n_bytes"))


def shrunk(pages: int, size: int, most_bytes: int, margin: float = 0.97) -> int:
    """How many pages to try next for a part that came out too large: by the ratio of sizes, at least one fewer, at least one."""
    return max(1, min(pages - 1, int(pages * most_bytes / size * margin)))


def part_end(sums: list[int], start: int, most_pages: int, most_bytes: int) -> int:
    """Where a part ends that begins at ``start``: as many pages as may be, fewer as long as they are too large, one at least."""
    n = min(most_pages, len(sums) - 1 - start)
    while n > 1 and (size := sums[start + n] - sums[start]) > most_bytes:
        n = shrunk(n, size, most_bytes)
    return start + n


def part_starts(sizes: list[int], own: int, start: int, most_pages: int, most_bytes: int) -> list[tuple[int, int]]:
    """(start, end) of the parts from ``start`` on that begin in the first ``own`` pages; the last may end behind them."""
    sums, out = [0, *accumulate(sizes)], []
    while start < min(own, len(sizes)):
        out.append((start, part_end(sums, start, most_pages, most_bytes)))
        start = out[-1][1]
    return out


def part_exits(sizes: list[int], own: int, most_pages: int, most_bytes: int) -> tuple[list[int], list[int]]:
    """For a first part at each of ``most_pages`` places: the first place behind ``own`` pages where a part begins, counted from there, and how many begin before it."""
    sums, known = [0, *accumulate(sizes)], {}
    for at in range(most_pages):
        path = []
        while at < own and at not in known:
            path.append(at)
            at = part_end(sums, at, most_pages, most_bytes)
        to, n = known[at] if at < own else (at - own, 0)
        for k, x in enumerate(reversed(path), 1):
            known[x] = to, n + k
    return [known[k][0] for k in range(most_pages)], [known[k][1] for k in range(most_pages)]


#: So many pages are walked through together, at least, and the exits of so many runs of pages put together.
RUN, FAN = 4096, 64


def _entries(exits: DataFrame, by: list[str]) -> DataFrame:
    """(by, _c, _at, _before): where each run's first part begins, and how many parts are before it, from (by, _c, to, n), the ``part_exits`` of all runs.

    The exits of ``FAN`` runs are put together to those of one, and so on until
    a group has one; then the first entry, which is known, goes down again.
    """
    level = exits.withColumn("_up", F.floor(F.col("_c") / FAN))
    keys = [exits.schema[c] for c in by]

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_c")
        at, n = np.arange(len(rows["to"].iloc[0])), 0
        for to, counts in zip(rows["to"], rows["n"]):
            at, n = np.asarray(to)[at], n + np.asarray(counts)[at]
        return rows.iloc[:1][by].assign(_c=rows["_up"].iloc[0], to=[at.tolist()], n=[n.tolist()])

    def entered(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_c")
        at, before, found = int(rows["_at"].iloc[0]), int(rows["_before"].iloc[0]), []
        for to, counts in zip(rows["to"], rows["n"]):
            found.append((at, before))
            at, before = int(to[at]), before + int(counts[at])
        return rows[[*by, "_c"]].assign(_at=[a for a, _ in found], _before=[b for _, b in found])

    if level.filter("_up > 0").limit(1).count():
        above = materialize(level.groupBy(*by, "_up").applyInPandas(joined, exits.schema), "exits")
        level = level.join(_entries(above, by).withColumnRenamed("_c", "_up"), [*by, "_up"])
    else:
        level = level.withColumn("_at", F.lit(0)).withColumn("_before", F.lit(0).cast("long"))
    return level.groupBy(*by, "_up").applyInPandas(entered, StructType([*keys, *StructType.fromDDL("_c long, _at int, _before long").fields]))


def _parts(placed: DataFrame, group: list[str], page: str, size: str, most_pages: int, most_bytes: int) -> DataFrame:
    """(group, part, first_page, last_page, n_pages, place) of ``numbered`` pages.

    Pages are dealt once into runs, each with the first ``most_pages`` pages of
    the next one.  A document of one run is walked through; of a longer one each
    run says, for all places where its first part may begin, where the next
    run's does, and these answers are put together.
    """
    small_batches()
    run = max(RUN, most_pages)
    c = F.floor(F.col("place") / run)
    also = F.when((c > 0) & (F.col("place") % run < most_pages), F.array(c, c - 1)).otherwise(F.array(c))
    t = placed.select(*group, F.col("n").alias("_n"), F.explode(also).alias("_c"), F.struct("place", F.col(page).alias("p"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("s")).alias("_x"))
    t = t.groupBy(*group, "_n", "_c").agg(F.sort_array(F.collect_list("_x")).alias("_x"))
    t = materialize(t.select(*group, "_n", "_c", F.transform("_x", lambda x: x["p"]).alias("_pages"), F.transform("_x", lambda x: x["s"]).alias("_sizes")), "runs")

    @F.pandas_udf("struct<to:array<int>,n:array<long>>")
    def exits(sizes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([part_exits(x.tolist(), run, most_pages, most_bytes) for x in sizes], columns=["to", "n"])

    @F.pandas_udf("array<struct<a:int,b:int>>")
    def starts(sizes: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in part_starts(x.tolist(), run, k, most_pages, most_bytes)] for x, k in zip(sizes, at)], dtype=object)

    long = t.filter(F.col("_n") > run)
    rows = t.filter(F.col("_n") <= run).withColumn("_at", F.lit(0)).withColumn("_before", F.lit(0).cast("long"))
    if long.limit(1).count():
        none = F.array_repeat(F.lit(0), most_pages)  # behind the last run is nothing
        last = (F.col("_c") + 1) * run >= F.col("_n")
        out = long.filter(~last).select(*group, "_c", exits("_sizes").alias("e")).select(*group, "_c", "e.to", "e.n")
        out = materialize(out.unionByName(long.filter(last).select(*group, "_c", none.alias("to"), none.cast("array<long>").alias("n"))), "exits")
        rows = rows.unionByName(long.join(_entries(out, group), [*group, "_c"]).select(*rows.columns))
    rows = rows.select(*group, "_c", "_before", "_pages", F.posexplode(starts("_sizes", "_at")).alias("_i", "_x"))
    return rows.select(
        *group, (F.col("_before") + F.col("_i") + 1).cast("int").alias("part"), F.get("_pages", F.col("_x.a")).alias("first_page"), F.get("_pages", F.col("_x.b") - 1).alias("last_page"),
        (F.col("_x.b") - F.col("_x.a")).cast("long").alias("n_pages"), (F.col("_c") * run + F.col("_x.a")).alias("place"),
    )


def part_ranges(sizes: DataFrame, group: list[str], page: str, size: str, most_pages: int = 200, most_bytes: int = 100 << 20) -> DataFrame:
    """(group, part, first_page, last_page, n_pages): a document's pages, in order, in parts within limits, for documents of any length.

    Groups and pages are not null; a null size counts 0.
    """
    return _parts(numbered(sizes.select(*group, page, size), group, [page]), group, page, size, most_pages, most_bytes).drop("place")


def split_ranges(sizes: DataFrame, group: list[str], page: str, size: str, most_pages: int = 200, most_bytes: int = 100 << 20) -> DataFrame:
    """Adds part, from 1, to each page: its part of ``part_ranges``."""
    t = numbered(sizes, group, [page])
    parts = _parts(t, group, page, size, most_pages, most_bytes)
    held = parts.select(*group, "part", F.explode(F.sequence("place", F.col("place") + F.col("n_pages") - 1)).alias("place"))
    return t.join(held, [*group, "place"]).select(*sizes.columns, "part")
