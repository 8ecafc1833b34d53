"""Human corrections: fuzzy patches of a page's blocks, and the closest block of a line.

The similarity is difflib's ratio, which edit distance is not; one Arrow batch
of pages is patched at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.vocabulary import DEFAULT, Vocabulary

THRESHOLD = 0.6
FULL, FIRST = "【整页】", "【补行】"
_REPLACE = re.compile("^【替行[:：](?P<anchor>[^】]+)】(?P<text>.*)$", re.S)
_BEFORE = re.compile("^【补行前[:：](?P<anchor>[^】]+)】(?P<text>.*)$", re.S)


def load_corrections(confirmations: DataFrame) -> DataFrame:
    """(book_id, local_page, correct_content) of confirmed rows that say something."""
    return confirmations.filter(F.col("confirmed") & (F.trim("correct_content") != "")).select("book_id", "local_page", "correct_content")


def similarity(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def upper_bounds(blocks: list[str], line: str) -> np.ndarray:
    """For each block the largest ratio that its characters allow: twice those it shares with the line over all of both."""
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    points = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    own, n = np.unique(points(line), return_counts=True)
    said = points("".join(blocks))
    shared = np.zeros(len(blocks), np.int64)
    if len(own) and len(said):
        at = np.minimum(np.searchsorted(own, said), len(own) - 1)
        hit = own[at] == said
        of = np.repeat(np.arange(len(blocks)), sizes)[hit]
        shared = np.minimum(np.bincount(of * len(own) + at[hit], minlength=len(blocks) * len(own)).reshape(len(blocks), -1), n).sum(1)
    total = sizes + len(line)
    return np.where(total > 0, 2.0 * shared / np.maximum(total, 1), 1.0)


class Line:
    """A line that blocks are compared with: difflib's ratio, by searches for substrings.

    difflib's longest match consists of characters that are not popular in the
    line, and grows by any equal neighbours; a popular character stands masked
    here.  The first substring found that is longer than the best is the one
    that difflib takes, from the left of the block and then of the line.
    """

    def __init__(self, text: str):
        self.text, self.popular, self._made = text, SequenceMatcher(None, "", text).bpopular, {}
        self.seeds = set(text) - self.popular

    def _masked(self, block: str) -> str:
        if not self.popular:
            return self.text
        mark = next(c for c in map(chr, range(0x110000)) if c not in block and c not in self.text)
        if mark not in self._made:
            self._made[mark] = self.text.translate(dict.fromkeys(map(ord, self.popular), mark))
        return self._made[mark]

    def ratio(self, block: str, least: float = 0.0) -> float | None:
        """The ratio, or None as soon as it must be below ``least``."""
        a, b, total = block, self.text, len(block) + len(self.text)
        if not total:
            return 1.0
        find, same = self._masked(block).find, 0
        seeds = [k for k, c in enumerate(a) if c in self.seeds]
        todo, left = [(0, len(a), 0, len(b))], min(len(a), len(b))
        while todo:
            if 2.0 * (same + left) / total < least:
                return None
            alo, ahi, blo, bhi = todo.pop()
            left -= min(ahi - alo, bhi - blo)
            i, j, n = alo, blo, 0
            for at in seeds[bisect_left(seeds, alo) : bisect_left(seeds, ahi)]:
                if at + n >= ahi or n >= bhi - blo:
                    break
                k = find(a[at : at + n + 1], blo, bhi)
                while k >= 0:
                    i, j, n = at, k, n + 1
                    k = find(a[at : at + n + 1], k, bhi) if at + n < ahi else -1
            while i > alo and j > blo and a[i - 1] == b[j - 1]:
                i, j, n = i - 1, j - 1, n + 1
            while i + n < ahi and j + n < bhi and a[i + n] == b[j + n]:
                n += 1
            if n:
                same += n
                for x in ((alo, i, blo, j), (i + n, ahi, j + n, bhi)):
                    if (most := min(x[1] - x[0], x[3] - x[2])) > 0:
                        todo.append(x)
                        left += most
        return 2.0 * same / total


def closest(blocks: list[str], line: str, skip=frozenset(), known: Line | None = None) -> tuple[int, float]:
    """The block most like a line; of equal ones the first; (-1, 0.0) if none has anything of it.

    Blocks are compared by falling upper bound, and those whose bound is below
    the best so far are not; a comparison ends when it can't reach the best any
    more.  ``known`` is the line's, where it is made already.
    """
    known = known or Line(line)
    bound = upper_bounds(blocks, line)
    best, top = -1, 0.0
    for i in np.argsort(-bound, kind="stable").tolist():
        if bound[i] < top or not bound[i]:
            break
        if i in skip or bound[i] == top and i > best:
            continue
        r = known.ratio(blocks[i], top)
        if r is not None and (r > top or r == top > 0 and i < best):
            best, top = i, r
    return best, top


def _clean(text: str) -> str:
    text = text.replace("\r\n", "\n").replace("\r", "\n").translate({0x3000: " ", 9: " ", 0x25CB: "〇", 0x25EF: "〇"})
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def patch(blocks: list[dict], content: str, is_title=lambda t: False, kind_of=lambda t: "text", threshold: float = THRESHOLD) -> tuple[list[dict], int, list[str]]:
    """The patched blocks, how many lines took effect, and the lines that found no block.

    A line replaces the unused block most like it (or like its anchor), goes
    before its anchor's block, or to the top of the page; a whole page can be
    replaced.  Blocks may become titles and never stop being titles.
    """
    lines = lambda s: [x.strip() for x in s.split(" / ") if x.strip()]
    made = lambda t: {"block_type": kind_of(t), "text": t}
    if content.startswith(FULL):
        new = [made(_clean(x)) for x in lines(content[len(FULL) :])]
        return new, len(new), []
    out, texts = [dict(b) for b in blocks], [b["text"] or "" for b in blocks]
    used: set[int] = set()
    top: list[dict] = []
    before: list[tuple[int, dict]] = []
    patched, lost = 0, []
    for line in lines(content):
        replace, ahead = _REPLACE.match(line), _BEFORE.match(line)
        if not replace and not ahead and line.startswith(FIRST):
            if said := _clean(line[len(FIRST) :]):
                top.append(made(said))
                patched += 1
            continue
        found = replace or ahead
        said = _clean(found["text"] if found else line)
        at, ratio = closest(texts, _clean(found["anchor"]) if found else said, frozenset() if ahead else used)
        if at < 0 or ratio < threshold or found and not said:
            lost.append(line)
            continue
        patched += 1
        if ahead:
            before.append((at, made(said)))
        else:
            used.add(at)
            texts[at] = out[at]["text"] = said
            if is_title(said):
                out[at]["block_type"] = "title"
    for at, block in sorted(before, key=lambda x: -x[0]):  # stable: two at one block come out in reverse
        out.insert(at, block)
    return top + out, patched, lost


RESULT = "struct<blocks:array<struct<block_type:string,text:string>>,patched:int,unmatched:array<string>>"


_BLANK = " \n"


def _bare(t: str) -> str:
    wide = "[\u4e00-\u9fff（()）、]"
    return re.sub(f"(?<={wide})\\s+|\\s+(?={wide})", "", re.sub(T.ENUMERATOR, "", t, count=1)).strip("：: ")


def opens_record(text: str, v: Vocabulary = DEFAULT) -> bool:
    """``functions.text.record_title`` for one text in Python."""
    whole = (t := _clean(text)).strip("：: ")
    found = re.match(f"{T.ENUMERATOR}(.+)", whole)
    if not found or whole.endswith(v.category_suffix) or v.contents in whole or whole in v.corpus_names or t.rstrip(_BLANK).endswith(("：", ":")):
        return False
    name = found[1].strip("：: ")
    bare = _bare(_clean(name))
    same = sum(bare.count(c) for c in T.OPEN) == sum(bare.count(c) for c in T.CLOSE)
    plain = not re.search(f"\n|{T.TITLE_MARKS}|{T.TITLE_AMOUNT}", bare) and not any(w in bare for w in v.title_words)
    return not name.startswith(v.section_words) and T.SHORTEST <= len(bare) <= T.LONGEST and plain and same and not bare.endswith(v.category_suffix)


_ENTRY = re.compile(r"[（(]\s*\d+\s*[)）]\s*$")


def is_title(text: str, v: Vocabulary = DEFAULT) -> bool:
    """Whether a corrected text makes its block a title: a record's, and no contents entry."""
    return not _ENTRY.search(text) and opens_record(text, v)


def block_kind(text: str, v: Vocabulary = DEFAULT) -> str:
    """title or text: categories and the word for contents are titles, contents entries are not, record titles are."""
    said = _clean(text).strip("：: ")
    if said.endswith(v.category_suffix) or said == v.contents:
        return "title"
    return "title" if is_title(said, v) else "text"


def apply_corrections(blocks: Column, content: Column, threshold: float = THRESHOLD, v: Vocabulary = DEFAULT) -> Column:
    """RESULT of patching array<struct<block_type, text>> with a correction; a null correction changes nothing."""

    @F.pandas_udf(RESULT)
    def run(b: pd.Series, c: pd.Series) -> pd.DataFrame:
        rows = []
        for own, said in zip(b, c):
            own = [dict(x) for x in own] if own is not None else []
            rows.append((own, 0, []) if not said else patch(own, said, lambda t: is_title(t, v), lambda t: block_kind(t, v), threshold))
        return pd.DataFrame({"blocks": [r[0] for r in rows], "patched": [r[1] for r in rows], "unmatched": [r[2] for r in rows]})

    return run(blocks, content)


def best_match(lines: Column, target: Column) -> Column:
    """struct(at, ratio): the 0-based place of the line most like ``target``; at is -1 if none is like it at all."""

    @F.pandas_udf("struct<at:int,ratio:double>")
    def run(a: pd.Series, t: pd.Series) -> pd.DataFrame:
        known = {said: Line(said or "") for said in t.unique()}
        rows = [closest([x or "" for x in own] if own is not None else [], said or "", known=known[said]) for own, said in zip(a, t)]
        return pd.DataFrame({"at": [r[0] for r in rows], "ratio": [r[1] for r in rows]})

    return run(lines, target)
