"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, each text scanned once.

Words are runs of digits, letters and characters beyond ASCII, A-Z in lower
case.  Ten consecutive words of an item are a window; an item of fewer words,
but not none, is one window.  The automaton's alphabet is the items' words: a
batch of texts becomes one symbol a word, with a break between texts, and goes
through the automaton once.  Overlapping occurrences are all reported.  Word
places are kept beside the symbols, so hits map back to code points of the
original text.

The driver builds nothing: it reads the items' words (a shard of at most
``AUTOMATON_WINDOWS`` windows, whose number is measured first) and sends them to
the tasks, where each worker makes its automaton once.  Larger benchmarks are
dealt into more shards, one pass and one automaton each; the passes' hits are
written and merged by document.

Null or empty texts: no words, no hits.  Null or empty items: no window.  Items
with one id are one item; items without an id are together one, named by the
empty string.  Repeated rows each get their result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import keyed, mapped, materialize, release, slices

WINDOW = 10
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows of one automaton (ten nodes each at most), and of one row of an item's words.
AUTOMATON_WINDOWS, PART_WINDOWS = 300_000, 1000
#: Symbols: no word of any item, the break between texts, and the first of the items' words.
OTHER, BREAK, FIRST = 1, 2, 0x10000
SPANS = "array<struct<first_word: long, end_word: long, start: long, end: long>>"


def _folded() -> np.ndarray:
    """A byte of UTF-8 to the byte it counts as; separators become a space."""
    table = np.full(256, 32, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_FOLDED = _folded()


class Automaton:
    """The windows of a shard of items."""

    _made: dict = {}

    @classmethod
    def get(cls, key: str, parts: list[tuple[str, list[str]]], window: int) -> Automaton:
        if key not in cls._made:
            cls._made.clear()  # a worker scans for one shard at a time
            cls._made[key] = cls(parts, window)
        return cls._made[key]

    def __init__(self, parts: list[tuple[str, list[str]]], window: int):
        import ahocorasick

        self.symbols: dict[bytes, int] = {}
        holders: dict[str, set[int]] = defaultdict(set)
        self.names = sorted({name for name, _ in parts})
        number = {name: k for k, name in enumerate(self.names)}
        for name, said in parts:
            coded = "".join(chr(self.symbols.setdefault(w.encode(), FIRST + len(self.symbols))) for w in said)
            for i in range(max(1, len(coded) - window + 1)):
                holders[coded[i : i + window]].add(number[name])
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, w in enumerate(holders):
            self.find.add_word(w, k)
        if holders:
            self.find.make_automaton()
        self.length = np.array([len(w) for w in holders], np.int64)
        self.items = [np.array(sorted(x), np.int64) for x in holders.values()]

    def scan(self, texts: pa.Array) -> list[pa.Array]:
        """n_words, spans and item names of each text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        starts, ends, codes = self._words(raw, edges)
        first = np.searchsorted(starts, edges)  # the number of each text's first word, and of all words
        n_words = np.diff(first)
        place, hit = self._occurrences(codes, first[1:-1])
        spans, names = [[] for _ in range(len(texts))], [[] for _ in range(len(texts))]
        if len(place):
            length = self.length[hit]
            cover = np.zeros(len(codes) + 1, np.int64)
            np.add.at(cover, place, 1)
            np.add.at(cover, place + length, -1)
            step = np.diff(np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]]))
            left, right = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            inner = first[1:-1]  # texts may follow each other without a gap between hit words
            cut = inner[np.cumsum(cover[:-1])[np.minimum(inner, len(codes) - 1)] > 0] if len(codes) else inner
            cut = np.unique(cut[(cut > 0) & (cut < len(codes))])
            left, right = np.union1d(left, cut[_inside(cut, left, right)]), np.union1d(right, cut[_inside(cut, left, right)])
            point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before a byte
            of = np.searchsorted(first, left, "right") - 1
            base = point[edges[of]]
            for t, a, b, s, e in zip(of.tolist(), (left - first[of]).tolist(), (right - first[of]).tolist(), (point[starts[left]] - base).tolist(), (point[ends[right - 1]] - base).tolist()):
                spans[t].append({"first_word": a, "end_word": b, "start": s, "end": e})
            at = np.searchsorted(first, place, "right") - 1
            pairs = np.unique(np.stack([at, hit], 1), axis=0)
            found: dict[int, set[int]] = defaultdict(set)
            for t, k in pairs.tolist():
                found[t].update(self.items[k].tolist())
            for t, which in found.items():
                names[t] = [self.names[k] for k in sorted(which)]
        return [pa.array(n_words.astype(np.int64)), pa.array(spans, _SPANS), pa.array(names, pa.list_(pa.string()))]

    def _words(self, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the words of the joined texts start and end, and their symbols."""
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        folded = _FOLDED[raw]
        inside = folded != 32
        before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
        border = edges[(edges > 0) & (edges < len(raw))]
        before[border] = False
        after[border - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        said = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(folded[inside])])
        coded = said.dictionary_encode()
        table = np.fromiter((self.symbols.get(w, OTHER) for w in coded.dictionary.to_pylist()), np.uint32, len(coded.dictionary))
        return starts, ends, table[coded.indices.to_numpy()] if len(coded) else table

    def _occurrences(self, codes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence; none spans a break."""
        if not len(codes) or not len(self.length):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        told = np.insert(codes, breaks, BREAK).astype("<u4").tobytes().decode("utf-32-le")
        word = np.insert(np.arange(len(codes)), breaks, -1)
        found = np.array(list(self.find.iter(told)), np.int64).reshape(-1, 2)
        return word[found[:, 0]] - self.length[found[:, 1]] + 1, found[:, 1]


_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "start", "end")]))


def _inside(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of ``x`` are strictly within one of the runs."""
    at = np.searchsorted(left, x, "left") - 1
    return (at >= 0) & (x < right[np.maximum(at, 0)]) if len(left) else np.zeros(len(x), bool)


def item_parts(items: DataFrame, id_col: str, text_cols: tuple[str, ...], window: int = WINDOW) -> DataFrame:
    """(name, words, windows): the words of each text of each item, long ones in overlapping parts, so that no row is large."""
    name = F.coalesce(items[id_col].cast("string"), F.lit("")).alias("name")
    lowered = lambda c: F.translate(F.coalesce(items[c].cast("string"), F.lit("")), UPPER, LOWER)
    each = items.select(name, F.explode(F.array(*(F.regexp_extract_all(lowered(c), F.lit(f"({WORD})")) for c in text_cols))).alias("said")).filter(F.size("said") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("said") - window, F.lit(0)), F.lit(PART_WINDOWS))
    parts = each.select("name", F.explode(F.transform(starts, lambda i: F.slice("said", i + 1, PART_WINDOWS + window - 1))).alias("words"))
    return parts.select("name", "words", F.greatest(F.size("words") - window + 1, F.lit(1)).alias("windows"))


def _scanned(rows: DataFrame, parts: list[tuple[str, list[str]]], key: str, window: int, keep: list[str]) -> DataFrame:
    names = [*keep, "n_words", "spans", "items"]

    def run(batches):
        automaton = Automaton.get(key, parts, window)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), *automaton.scan(part.column("text"))], names)

    return mapped(rows.select(*keep, "text"), run, f"n_words long, spans {SPANS}, items array<string>", keep)


def _merged(spans: Column) -> Column:
    """Spans of several passes as one sorted list without overlaps."""

    def put(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        wider = F.when(last["end_word"] >= x["end_word"], last).otherwise(F.struct(last["first_word"].alias("first_word"), x["end_word"].alias("end_word"), last["start"].alias("start"), x["end"].alias("end")))
        touches = (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end_word"] >= x["first_word"])
        return F.when(touches, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.sort_array(spans), F.expr(f"cast(array() as {SPANS})"), put)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_texts: tuple[str, ...] = ("text",),
    window: int = WINDOW,
    most: int = AUTOMATON_WINDOWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(rid, rv, id, *keep, n_words, n_hit, items, spans): what of each text the items have.

    ``items`` are names in the order of their code points; ``spans`` are runs
    of hit words, in words and in code points of the original text, ends
    exclusive.
    """
    rows, parts = keyed(docs, id_col, text_col, *keep), item_parts(items, item_col, item_texts, window)
    shards = max(1, -(-(parts.agg(F.sum("windows")).first()[0] or 0) // most))
    names = ["rid", "rv", "id", *(c for c in rows.columns if c in keep)]

    def read(of: DataFrame) -> tuple[list, str]:
        got = sorted((r["name"], list(r["words"])) for r in of.select("name", "words").distinct().toLocalIterator())
        return got, hashlib.sha256(repr((window, got)).encode()).hexdigest()

    if shards == 1:
        out = _scanned(rows, *read(parts), window, names)
    else:
        parts = materialize(parts.withColumn("shard", F.pmod(F.xxhash64("name", "words"), F.lit(shards))), "item_parts")
        found = []
        for k in range(shards):
            hits = _scanned(rows, *read(parts.filter(F.col("shard") == k)), window, ["rid", "rv"]).filter("size(items) > 0")
            found.append(materialize(hits.dropDuplicates(["rid", "rv"]), "hits"))
        release(parts)
        every = found[0]
        for more in found[1:]:
            every = every.union(more)
        every = every.groupBy("rid", "rv").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        every = materialize(every.select("rid", "rv", _merged(F.col("spans")).alias("spans"), "items"), "hits")
        release(*found)
        counted = _scanned(rows, [], "none", window, names).drop("spans", "items")
        none = lambda c, t: F.coalesce(F.col(c), F.expr(f"cast(array() as {t})")).alias(c)
        out = counted.join(every, ["rid", "rv"], "left").select(*names, "n_words", none("spans", SPANS), none("items", "array<string>"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end_word"] - s["first_word"])
    return out.select(*names, "n_words", n_hit.alias("n_hit"), "items", "spans")


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without its hit spans, which stay apart as a space each."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    cut = F.zip_with(ends, starts, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(cut, " "))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", **more) -> DataFrame:
    """(id, n_hit, items, clean_text): every document, its text without the items' passages."""
    text = docs[text_col].cast("string").alias("clean_text")
    found = contamination(docs.withColumn("clean_text", text), items, id_col, text_col, keep=("clean_text",), **more)
    return found.select("id", "n_hit", "items", without_spans(F.col("clean_text"), F.col("spans")).alias("clean_text"))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
b AS (
  SELECT item_id, w, least(len(w), {WINDOW}) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS j FROM b)),
dw AS (SELECT doc_id, j, k, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM iw))),
h AS (SELECT doc_id, j, k, item_id FROM dw JOIN iw USING (k, g)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)"""
