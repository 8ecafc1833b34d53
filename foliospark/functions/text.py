"""Scalar text functions as Column builders.

All of them stay in generated code but ``nfkc`` and ``unescape_html``, which
Spark has no built-in for and which are Arrow UDFs.  ``SPACE`` is white space
as Unicode sees it; plain ``\\s`` of the JVM is ASCII only.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foliospark.functions.vocabulary import DEFAULT, Vocabulary

SPACE = "[\\s\\x1c-\\x1f\\x85\\p{Z}]"
OPEN, CLOSE = "（(", "）)"


def strip(c: Column, chars: str | None = None) -> Column:
    """Both ends without white space, or without any of ``chars``."""
    if chars is not None:
        return F.btrim(c, F.lit(chars))
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def normalize_text(c: Column) -> Column:
    """One blank between words, no blank lines, line ends as \\n, round marks as one character.

    Three passes over the text and no array: blanks, then line ends with
    what surrounds them, then the edges.
    """
    t = F.translate(F.regexp_replace(c, "\\r\\n?", "\n"), "\u3000\t○◯", "  〇〇")
    t = F.regexp_replace(t, "[\\s\\x1c-\\x1f\\x85\\p{Z}&&[^\\n]]+", " ")
    return F.btrim(F.regexp_replace(t, " ?\\n[ \\n]*", "\n"), F.lit(" \n"))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    import html

    return s.map(lambda x: None if x is None else html.unescape(x))


def dashed(c: Column) -> Column:
    """File-name part: reserved characters and blanks to dashes, runs of dashes to one, clean edges, 80 characters at most."""
    t = F.regexp_replace(strip(c), '[<>:"/\\\\|?*\\x00-\\x1F]', "-")
    t = F.btrim(F.regexp_replace(F.regexp_replace(t, f"{SPACE}+", "-"), "-+", "-"), F.lit(" .-_"))
    t = F.rtrim(F.substring(t, 1, 80), F.lit(" .-_"))
    return F.when(t == "", "untitled").otherwise(t)


def safe_filename(c: Column) -> Column:
    return dashed(nfkc(c))


def ascii_slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def record_filename(book: Column, page: Column, title: Column) -> Column:
    return F.format_string("%s-p%04d-%s.md", book, page, title)


def fallback_filename(book: Column, page: Column) -> Column:
    return F.format_string("%s-page-%04d-fallback.md", book, page)


def let(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- ordered replacement rules ------------------------------------------------


class Replacement(NamedTuple):
    pattern: str
    replacement: str = ""
    literal: bool = False


def java_pattern(pattern: str) -> str:
    """A Python expression as Java takes it: Unicode classes, absolute end, named groups."""
    p = re.sub(r"\\Z", r"\\z", pattern).replace("(?P<", "(?<")
    p = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", p)
    return "(?U)" + p if re.search(r"\\[sSdDwWbB]", p) else p


def java_replacement(text: str) -> str:
    """Back-references as $1; a dollar sign of the text stays one."""
    return re.sub(r"\\g?<?(\d+)>?", r"$\1", text.replace("$", "\\$"))


def rules_of(rows) -> list[Replacement]:
    """Rules from dictionaries with ``pattern`` and ``replacement``, in their order; plain literals are told apart."""
    return [Replacement(r["pattern"], r.get("replacement", ""), re.escape(r["pattern"]).replace("\\ ", " ") == r["pattern"]) for r in rows]


def apply_rules(c: Column, rules: list[Replacement]) -> Column:
    """The rules one after another; their order counts."""
    return reduce(
        lambda t, r: F.replace(t, F.lit(r.pattern), F.lit(r.replacement)) if r.literal else F.regexp_replace(t, java_pattern(r.pattern), java_replacement(r.replacement)),
        rules,
        c,
    )


# --- titles ---------------------------------------------------------------------

# The forms of an enumerator, what no title holds, and its lengths.
ENUMERATOR = "^(?:[（(]?[一二三四五六七八九十百零〇0-9]+[）)]|[（(][A-Za-z][A-Za-z .·]*[）)])\\s*"
TITLE_MARKS = "[。．，,；;：:！!？?…“”\"']"
TITLE_AMOUNT = "[〇零一二三四五六七八九十百半]+[钱两斤克]"
STEP_NUMBER = "(?:\\p{Nd}+|[一二三四五六七八九十]+)[.、]"
SHORTEST, LONGEST = 2, 14

_WIDE = "[\\u4e00-\\u9fff（()）、]"


def _bare_name(t: Column) -> Column:
    """Of a normalised text: no enumerator, no blanks beside wide characters."""
    return F.btrim(F.regexp_replace(F.regexp_replace(t, ENUMERATOR, ""), f"\\s+(?={_WIDE})|(?<={_WIDE})\\s+", ""), F.lit("：: "))


def strip_enumerator(c: Column) -> Column:
    return _bare_name(normalize_text(c))


def _occurrences(c: Column, chars: str) -> Column:
    return reduce(lambda n, x: n + F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))), chars, F.lit(0))


def plausible_title(c: Column, shortest: int = SHORTEST, longest: int = LONGEST, v: Vocabulary = DEFAULT) -> Column:
    """Whether a text, without its enumerator, can name a record."""

    def good(t: Column) -> Column:
        return (
            F.length(t).between(shortest, longest)
            & ~t.rlike(f"\\n|{TITLE_MARKS}|{TITLE_AMOUNT}")
            & (_occurrences(t, OPEN) == _occurrences(t, CLOSE))
            & ~t.endswith(v.category_suffix)
            & ~t.rlike("|".join(map(re.escape, v.title_words)))
        )

    return let(strip_enumerator(c), good)


def loose_title(c: Column) -> Column:
    """An enumerator with a name behind it, nothing else asked."""
    return F.btrim(normalize_text(c), F.lit("：: ")).rlike(ENUMERATOR + ".")


def record_title(c: Column, v: Vocabulary = DEFAULT) -> Column:
    """Whether a title block opens a record: an enumerator, and behind it a line that is neither a section nor anything but a name."""
    words = "|".join(map(re.escape, v.section_words))

    def good(t: Column) -> Column:
        whole = F.btrim(t, F.lit("：: "))
        other = whole.endswith(v.category_suffix) | whole.contains(v.contents) | whole.isin(*v.corpus_names)
        name = F.btrim(F.regexp_extract(whole, ENUMERATOR + "(.+)", 1), F.lit("：: "))
        return ~other & ~t.rlike("[：:]\\s*$") & let(name, lambda n: ~n.rlike(f"^(?:{words})") & plausible_title(n, v=v))

    return F.coalesce(let(normalize_text(c), good), F.lit(False))


def fullwidth_parens(c: Column) -> Column:
    return F.translate(c, "()", "（）")


def strip_notes(c: Column, allowed=DEFAULT.allowed_notes) -> Column:
    """Without bracket notes whose inner text is one of ``allowed``."""
    inner = "|".join(map(re.escape, allowed))
    return F.regexp_replace(c, f"[（(]\\s*(?:{inner})\\s*[)）]", "") if allowed else c


def core_title(c: Column) -> Column:
    """Without any bracket note and without separators at the edges."""
    return strip(F.regexp_replace(c, "[（(][^（()）]*[）)]", ""), "、·-—. ")


def fold_title(c: Column) -> Column:
    """Loose join key: NFKC, no notes, no separators, so that full and half width are alike."""
    return F.regexp_replace(F.regexp_replace(nfkc(c), "[（(][^（()）]*[）)]", ""), f"[、—\\-·,，/]|{SPACE}", "")


def strip_markers(c: Column) -> Column:
    return F.regexp_replace(c, "【(?:整页|补行前|补行|替行|删行)(?:[:：][^】]*)?】", "")


def canonical_text(c: Column) -> Column:
    return F.replace(nfkc(normalize_text(c)), F.lit("／"), F.lit("/"))


# Fixed value: the enumerators of contents entries; numerals of the script count only in brackets or before a mark, for titles begin with them.
ENTRY_NUMBER = "^(?:[（(]\\s*[一二三四五六七八九十百千零〇\\d]+\\s*[)）]|[一二三四五六七八九十百千零〇]+\\s*[、.]|\\d+\\s*[、.]?)\\s*"


def canonical_title(c: Column, rules: list[Replacement] = ()) -> Column:
    t = F.regexp_replace(canonical_text(c), ENTRY_NUMBER, "")
    t = F.replace(F.regexp_replace(t, "[.·…]+$", ""), F.lit(" "), F.lit(""))
    t = strip(fullwidth_parens(apply_rules(t, list(rules))), ".-· ")
    return F.when(_occurrences(t, OPEN) != _occurrences(t, CLOSE), strip(strip(t, "（）()"), ".-· ")).otherwise(t)


def one_char_apart(a: Column, b: Column) -> Column:
    """Equal length and exactly one position that differs; linear in the length."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y)
    return (F.length(a) == F.length(b)) & (F.length(a) > 0) & (F.size(F.filter(same, lambda x: ~F.coalesce(x, F.lit(False)))) == 1)


# --- lists and markup -------------------------------------------------------------


def numbered_steps(c: Column) -> Column:
    """array<string>: cut before the mark or blank that a step number follows; a blank text has no steps."""
    parts = F.split(normalize_text(c), f"(?=(?:^|[\\n。；; ]){STEP_NUMBER})")
    return F.filter(F.transform(parts, lambda x: F.btrim(x, F.lit(" \n"))), lambda x: x != "")


def split_tokens(c: Column, separator: str = " / ") -> Column:
    """array<string> between separators, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, "\\Q" + separator + "\\E"), lambda x: strip(x)), lambda x: x != "")


def bullets(items: Column, none: str = "- 无\n") -> Column:
    kept = F.filter(F.transform(items, normalize_text), lambda x: x != "")
    return F.when(F.size(kept) > 0, F.concat(F.array_join(F.transform(kept, lambda x: F.concat(F.lit("- "), x)), "\n"), F.lit("\n"))).otherwise(none)


#: Entities that texts are escaped with; & first when escaping, last when decoding.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def escape_html(c: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, F.coalesce(c, F.lit("")))


def unescape_basic(c: Column) -> Column:
    """The five XML entities only, natively; ``unescape_html`` knows them all."""
    return reduce(lambda t, e: F.replace(t, F.lit(e[1]), F.lit(e[0])), reversed(ENTITIES), c)


def without_scripts(html: Column) -> Column:
    """Comments, scripts and styles go first: they may hold what looks like tags."""
    return F.regexp_replace(html, "(?is)<!--.*?-->|<(script|style)\\b[^>]*>.*?</\\1\\s*>", "")


def tags_off(html: Column) -> Column:
    return F.regexp_replace(html, "(?s)<[^>]*>", " ")


def elements(html: Column, tag: str) -> Column:
    """array<string>: the inner markup of each element of a kind that does not nest."""
    return F.regexp_extract_all(html, F.lit(f"(?is)<(?:{tag})\\b[^>]*>(.*?)</(?:{tag})\\s*>"), 1)


def cell_text(markup: Column, decode=unescape_basic) -> Column:
    return normalize_text(decode(tags_off(markup)))


def table_rows(html: Column, decode=unescape_basic) -> Column:
    """array<string>: one text a table row, its cells joined by a blank, rows without text left out."""
    row = lambda r: F.array_join(F.filter(F.transform(elements(r, "td|th"), lambda x: cell_text(x, decode)), lambda x: x != ""), " ")
    return F.filter(F.transform(elements(without_scripts(html), "tr"), row), lambda x: x != "")


def repo_relative(path: Column, root: Column) -> Column:
    """A path below ``root`` relative to it; any other with forward slashes."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    top = F.concat(F.rtrim(F.replace(root, F.lit("\\"), F.lit("/")), F.lit("/")), F.lit("/"))
    return F.when(p.startswith(top), F.substring(p, F.length(top) + 1, F.length(p))).otherwise(p)


def page_range(pages: Column) -> Column:
    """第 a 页 or 第 a–b 页 of an array of page numbers."""
    lo, hi = F.array_min(pages).cast("string"), F.array_max(pages).cast("string")
    return F.when(F.size(pages) > 0, F.when(lo == hi, F.concat(F.lit("第 "), lo, F.lit(" 页"))).otherwise(F.concat(F.lit("第 "), lo, F.lit("–"), hi, F.lit(" 页")))).otherwise("")


def issue_url(base: str, title: Column, body: Column) -> Column:
    """A prefilled link; blanks as %20 and slashes kept, as path quoting does."""
    quote = lambda c: F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit(base + "?title="), quote(title), F.lit("&body="), quote(body))


def excerpt(c: Column, n: int = 600) -> Column:
    return F.substring(c, 1, n)


def search_blob(*parts: Column) -> Column:
    """What search looks into: texts and arrays of texts, joined by blanks."""
    return F.concat_ws(" ", *parts)
