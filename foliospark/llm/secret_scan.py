"""Secret scans over a trigram inverted index, in native expressions only.

From each rule's regular expression a Boolean trigram query is derived: an AND
of ORs of ANDs over three-character strings of the lower-cased text that every
match must hold.  The index is keyed by trigram: of each block of about
``BLOCK_ROWS`` rows it has one sorted posting list a trigram that any rule
mentions.  A rule's candidates are the intersections and unions of posting lists
that its query says, block by block, and only their texts are verified with the
expression itself.  What is found goes back by row to narrow rows, so whole texts
are shuffled for candidates only, and only where these are too many for Spark's
own broadcast limit.  A rule without mandatory trigrams scans every text where it
is read.  Lower-casing can only add candidates.

Matches are leftmost and non-overlapping for each rule; a match whose group is
shorter than ``least`` is dropped after matching, so it still takes its text.
Positions are code points, ends exclusive.  Null texts are empty; repeated
rows are each reported; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import keyed, materialize, release
from foliospark.llm.quality_rules import let


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


BASE_RULES = (
    Rule("assign", "(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run of these classes is matched whole, so the least length can stand in the expression
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("code_host", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{3,10}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._!$-]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES

# --- trigram queries --------------------------------------------------------

#: More strings than this in one place of an expression are not followed.
MOST_STRINGS = 64


def _choices(op, arg) -> set[str] | None:
    """The lower-cased characters an element stands for, where they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        found = {chr(a).lower() for _, a in arg}
        return found if len(found) <= 8 else None
    return None


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _close(strings: set[str], query: list) -> None:
    """Ends a run of known strings: one of them must occur."""
    if all(len(s) >= 3 for s in strings):
        options = {_grams(s) for s in strings}
        query.append(frozenset(o for o in options if not any(p < o for p in options)))


def _follow(seq, strings: set[str], query: list) -> set[str]:
    for op, arg in seq:
        name = str(op)
        if name == "SUBPATTERN":
            strings = _follow(arg[-1], strings, query)
            continue
        if (chars := _choices(op, arg)) is not None:
            new = {s + c for s in strings for c in chars}
        elif name == "BRANCH":
            new = set()
            for option in arg[1]:
                inner: list = []
                ends = _follow(option, {""}, inner)
                if inner:  # not a plain set of strings
                    new = set()
                    break
                new |= {s + e for s in strings for e in ends}
        elif name == "MAX_REPEAT" and arg[0] <= 1 and arg[1] == 1:
            inner = []
            ends = _follow(arg[2], {""}, inner)
            new = set() if inner else {s + e for s in strings for e in ends} | (strings if arg[0] == 0 else set())
        elif name == "MAX_REPEAT" and arg[0] == arg[1] and arg[0] <= 16:
            strings = _follow(list(arg[2]) * arg[0], strings, query)
            continue
        else:
            new = set()
        if not new or len(new) > MOST_STRINGS:
            _close(strings, query)
            new = {""}
        strings = new
    return strings


def trigram_query(pattern: str) -> list[frozenset[frozenset[str]]]:
    """AND over the list, OR over each set, AND over each inner set; an empty list is no condition."""
    query: list = []
    _close(_follow(re._parser.parse(pattern), {""}, query), query)
    return query


#: Rows of a block: what bounds a posting list.
BLOCK_ROWS = 4096
_ROW = "struct<rid:bigint,rv:bigint>"


class Index(NamedTuple):
    """The queries of rules, and the trigrams they mention."""

    grams: tuple[str, ...]
    queries: dict[str, list]

    @classmethod
    def of(cls, rules) -> Index:
        queries = {r.kind: trigram_query(r.pattern) for r in rules}
        return cls(tuple(sorted({g for q in queries.values() for some in q for every in some for g in every})), queries)

    def candidates(self, kind: str, lists: Column) -> Column:
        """Rows of a block that pass the rule's query; ``lists`` maps trigrams to posting lists."""
        of = lambda g: F.coalesce(F.element_at(lists, F.lit(self.grams.index(g))), F.array().cast(f"array<{_ROW}>"))
        both = lambda every: reduce(F.array_intersect, [of(g) for g in sorted(every)])
        return reduce(F.array_intersect, [reduce(F.array_union, map(both, some)) for some in self.queries[kind]])


def postings(docs: DataFrame, index: Index) -> DataFrame:
    """(block, gram, rows): the posting list of each trigram in each block of rows."""
    blocks = docs.count() // BLOCK_ROWS + 1
    low = docs.select("rid", "rv", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(k)) for k, g in enumerate(index.grams))))
    rows = low.select(F.pmod(F.xxhash64("rid", "rv"), F.lit(blocks)).alias("block"), F.struct("rid", "rv").alias("row"), F.explode(held).alias("gram"))
    return rows.groupBy("block", "gram").agg(F.sort_array(F.collect_set("row")).alias("rows"))


def candidates(docs: DataFrame, rules, index: Index) -> DataFrame:
    """(rid, rv, kinds): the indexed rules whose trigram query a row passes."""
    lists = materialize(postings(docs, index), "postings")
    blocks = lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "rows"))).alias("lists"))
    named = lambda kind: lambda x: F.struct(x.alias("row"), F.lit(kind).alias("kind"))
    found = [F.transform(index.candidates(r.kind, F.col("lists")), named(r.kind)) for r in rules if index.queries[r.kind]]
    rows = blocks.select(F.explode(F.flatten(F.array(*found))).alias("x")).select("x.row.*", "x.kind")
    out = materialize(rows.groupBy("rid", "rv").agg(F.collect_set("kind").alias("kinds")), "candidates")
    release(lists)
    return out


# --- verification -----------------------------------------------------------

_PART = 256


def matches(text: Column, rule: Rule, place: int) -> Column:
    """array<struct<start, place, end>> of the rule's matches: text between matches and matches take turns."""
    re_ = F.lit(rule.pattern)
    found, between = F.regexp_extract_all(text, re_, 0), F.split(text, rule.pattern)
    groups = F.regexp_extract_all(text, re_, rule.group) if rule.group else found
    steps = F.zip_with(
        F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, f: F.struct(F.length(b).alias("gap"), F.length(f).alias("n"))),
        groups,
        lambda x, g: F.struct(x["gap"].alias("gap"), x["n"].alias("n"), (F.length(g) >= rule.least).alias("ok")),
    )
    kind = "array<struct<start:int,place:int,end:int>>"

    def step(acc, x):
        start = acc["pos"] + x["gap"]
        one = F.array(F.struct(start.alias("start"), F.lit(place).alias("place"), (start + x["n"]).alias("end")))
        return F.struct((start + x["n"]).alias("pos"), F.when(x["ok"], F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def part(acc, some):
        inner = F.aggregate(some, F.struct(acc["pos"].alias("pos"), F.array().cast(kind).alias("out")), step)
        return let(inner, lambda i: F.struct(i["pos"].alias("pos"), F.concat(acc["out"], F.array(i["out"])).alias("out")))

    def whole(s):
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / _PART).cast("int")), lambda c: F.slice(s, c * _PART + 1, _PART))
        zero = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(parts, zero, part, lambda acc: F.flatten(acc["out"]))

    return let(steps, whole)


_FOUND = "array<struct<start:int,place:int,end:int>>"


def _found(text: Column, rules, chosen, sure: Column | None = None) -> list[Column]:
    """The matches of the rules at the places ``chosen``, where ``sure`` names a rule and its expression is in the text."""
    out = []
    for place in chosen:
        there = text.rlike(rules[place].pattern)
        if sure is not None:
            there = F.array_contains(sure, rules[place].kind) & there
        out.append(F.when(there, matches(text, rules[place], place)).otherwise(F.array().cast(_FOUND)))
    return out


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """(id, found) of every row: ``found`` has (start, place in ``rules``, end) of every span, in that order."""
    docs, index = keyed(df, id_col, text_col), Index.of(rules)
    indexed = [k for k, r in enumerate(rules) if index.queries[r.kind]]
    whole = [k for k in range(len(rules)) if k not in indexed]
    out = docs.select("rid", "rv", "id", F.concat(F.array().cast(_FOUND), *_found(F.col("text"), rules, whole)).alias("everywhere"))
    if indexed:
        some = docs.join(candidates(docs, rules, index), ["rid", "rv"])
        some = some.select("rid", "rv", F.concat(*_found(F.col("text"), rules, indexed, F.col("kinds"))).alias("verified")).filter(F.size("verified") > 0)
        some = materialize(some.dropDuplicates(["rid", "rv"]), "verified")
        out = out.join(some, ["rid", "rv"], "left")
        everything = F.concat("everywhere", F.coalesce("verified", F.array().cast(_FOUND)))
    else:
        everything = F.col("everywhere")
    return out.select("id", F.sort_array(everything).alias("found"))


def spans_text(found: Column, rules=RULES) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["place"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("found", lambda x: x["place"] == k)).cast("long")
    base = F.filter("found", lambda x: x["place"] < len(BASE_RULES))
    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    q = lambda s: s.replace("'", "''")
    parts = []
    for place, r in enumerate(RULES):
        parts.append(f"""SELECT doc_id, {place} AS place, '{r.kind}' AS kind, i,
          list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
        FROM (SELECT doc_id, m, g, b, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT doc_id, regexp_extract_all(t, '{q(r.pattern)}') AS m, regexp_extract_all(t, '{q(r.pattern)}', {r.group}) AS g,
            regexp_split_to_array(t, '{q(r.pattern)}') AS b FROM d)) WHERE length(g[i]) >= {r.least}""")
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ("
        + " UNION ALL ".join(parts)
        + f"""), a AS (SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
      string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, place) FILTER (place < {len(BASE_RULES)}) AS base,
      string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, place) AS spans FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""
    )


ORACLE_SQL = _oracle()
