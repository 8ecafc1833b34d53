"""Links from a table of forms: one Aho-Corasick automaton over all of them, built once a worker.

Of the forms that start at one place the longest is linked, places are taken
from the left, and links don't overlap.  Only text outside of tags and of
anchors is looked at; forms are matched as they are escaped.  Time goes with the
texts and their occurrences, not with the number of forms.

The driver reads forms up to ``FORM_CHARS`` characters, whose number is measured
first, and sends them to the tasks.  A larger table is dealt into more automata:
each adds its occurrences to the rows, which are written between two, and links
are set when all are known.

Null texts stay null; a null or empty form is none; of several links of a form
the least holds.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from foliospark.functions import text as T
from foliospark.sources.scratch import materialize, release

#: Characters of forms and links that one automaton takes.
FORM_CHARS = 4 << 20
#: Rows and bytes of an Arrow batch; sessions with larger batches are set to these.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
PLACES = "array<struct<text:int,start:int,end:int,link:string>>"
_TAG, _OPENS, _CLOSES = re.compile(r"<[^>]*>"), re.compile(r"<a[\s>]", re.I), re.compile(r"</a\s*>", re.I)


def open_text(html: str):
    """(start, end) of the runs of text outside of tags and anchors."""
    at, inside = 0, 0
    for tag in _TAG.finditer(html):
        if not inside and tag.start() > at:
            yield at, tag.start()
        if _OPENS.match(tag[0]):
            inside += 1
        elif _CLOSES.match(tag[0]):
            inside = max(0, inside - 1)
        at = tag.end()
    if not inside and at < len(html):
        yield at, len(html)


class Forms:
    """An automaton over forms, and each one's link."""

    _made: dict = {}

    @classmethod
    def get(cls, key: str, pairs: list[tuple[str, str]]) -> Forms:
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(pairs)
        return cls._made[key]

    def __init__(self, pairs: list[tuple[str, str]]):
        import ahocorasick

        self.links = [link for _, link in pairs]
        self.length = [len(form) for form, _ in pairs]
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, (form, _) in enumerate(pairs):
            self.find.add_word(form, k)
        if pairs:
            self.find.make_automaton()

    def found(self, html: str) -> list[tuple[int, int, int]]:
        """(start, end, form), the longest at each start."""
        best: dict[int, tuple[int, int]] = {}
        for a, b in open_text(html) if self.links else ():
            for last, k in self.find.iter(html, a, b):
                start = last + 1 - self.length[k]
                if start not in best or best[start][0] <= last:
                    best[start] = last + 1, k
        return [(s, e, k) for s, (e, k) in sorted(best.items())]


def with_links(html: str, found) -> str:
    """``html`` with (start, end, link) set from the left, the longest first, without overlaps."""
    out, at = [], 0
    for start, end, link in found:
        if start >= at:
            out += (html[at:start], link)
            at = end
    return "".join((*out, html[at:]))


def _dictionary(forms: DataFrame) -> tuple[str, list[tuple[str, str]]]:
    pairs = sorted((r["form"], r["link"]) for r in forms.toLocalIterator())
    return hashlib.sha256(repr(pairs).encode()).hexdigest(), pairs


def _each(value, one):
    """``one`` on a text, or on every text of a list; nulls stay."""
    if value is None:
        return None
    return one(value) if isinstance(value, str) else [None if x is None else one(x) for x in value]


def small_batches() -> None:
    """A worker holds its batch and what it makes of it, so what it needs does not grow with the table."""
    conf = SparkSession.active().conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            conf.set(key, str(most))


def _linker(key: str, pairs: list[tuple[str, str]], kind: str):
    small_batches()
    made = pa.string() if kind == "string" else pa.list_(pa.string())

    @F.arrow_udf(kind)
    def run(s: pa.Array) -> pa.Array:
        known = Forms.get(key, pairs)
        return pa.array((_each(v.as_py(), lambda x: with_links(x, ((a, b, known.links[k]) for a, b, k in known.found(x)))) for v in s), made)

    return run


def _finder(key: str, pairs: list[tuple[str, str]]):
    small_batches()

    @F.pandas_udf(PLACES)
    def find(s: pd.Series) -> pd.Series:
        known = Forms.get(key, pairs)
        return s.map(lambda v: [{"text": n, "start": a, "end": b, "link": known.links[k]} for n, x in enumerate(v) if x is not None for a, b, k in known.found(x)])

    return find


def linkify(html: Column, forms: dict[str, str], template: str = '<a href="{href}">{text}</a>') -> Column:
    """Links the forms of a small dictionary (form -> href) in escaped HTML."""
    pairs = sorted((f, template.format(href=href, text=f)) for f, href in forms.items() if f)
    return _linker(hashlib.sha256(repr(pairs).encode()).hexdigest(), pairs, "string")(html)


def link_table(df: DataFrame, column: str, forms: DataFrame, most: int = FORM_CHARS) -> DataFrame:
    """``df`` with links in ``column``, a text or an array of texts; ``forms`` has the escaped ``form`` and the markup ``link`` that takes its place."""
    known = forms.filter(F.length("form") > 0).groupBy("form").agg(F.min("link").alias("link")).filter("link is not null")
    known = materialize(known, "forms")
    shards = max(1, -(-(known.agg(F.sum(F.length("form") + F.length("link"))).first()[0] or 0) // most))
    many = isinstance(df.schema[column].dataType, ArrayType)
    if shards == 1:
        out = df.withColumn(column, _linker(*_dictionary(known), "array<string>" if many else "string")(F.col(column)))
        release(known)
        return out
    texts = F.coalesce(F.col(column), F.array().cast("array<string>")) if many else F.array(F.col(column))
    rows = df.withColumn("_found", F.expr(f"cast(array() as {PLACES})"))
    before = None
    for k in range(shards):
        find = _finder(*_dictionary(known.filter(F.pmod(F.xxhash64("form"), F.lit(shards)) == k)))
        rows = materialize(rows.withColumn("_found", F.concat("_found", find(texts))), "linked")
        if before is not None:
            release(before)
        before = rows
    release(known)

    def set_links(value, found):
        texts = [value] if isinstance(value, str) else value
        places = sorted(((f["text"], f["start"], -f["end"], f["link"]) for f in found))
        out = [None if x is None else with_links(x, ((a, -b, link) for k, a, b, link in places if k == n)) for n, x in enumerate(texts)]
        return out[0] if isinstance(value, str) else out

    @F.pandas_udf("array<string>" if many else "string")
    def put(s: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else set_links(v, own) for v, own in zip(s, found)])

    return rows.withColumn(column, put(F.col(column), F.col("_found"))).select(*df.columns)


def form_links(index: DataFrame, folder: str = "ingredients", depth: int = 1, unit: str = "道菜") -> DataFrame:
    """(form, link) for ``link_table`` of (base, form, n): to the form's place on its base's page, with its number of records."""
    form, base = T.escape_html(F.col("form")), T.escape_html(F.col("base"))
    opened = F.concat(F.lit(f'<a class="ing" href="{"../" * depth}{folder}/'), base, F.lit(".html#v-"), form, F.lit('" title="'), form, F.lit("·"), F.col("n").cast("string"), F.lit(f' {unit}">'))
    return index.select(form.alias("form"), F.concat(opened, form, F.lit("</a>")).alias("link"))
