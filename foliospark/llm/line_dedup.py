"""Line dedup by pairwise alignment.

Lines with a word are hashed.  The *owner* of a line, or of a *run* of
consecutive lines, is the earliest document that holds it (smallest id).  Owners
only find the pairs: a later document is paired with the owners of its lines and
of its runs of ``MIN_WORDS`` words, so pairs never outnumber lines and runs, and
a line that a million documents share makes a million rows, not their squares.
A pair is then aligned on all lines that the two share, whoever owns them.

Runs are the shortest ones from each line on and back from each line, so that
every line of a block of ``MIN_WORDS`` words lies in a run of that block, and
the block's runs have owners also where its lines have owners elsewhere.

A line brings a pair together if it is *rare*: in at most ``RARE_DOCS``
documents, however large the table is, or hardly more common than the later
document's rarest line - so members of a group of copies find their
first however large the group is, while a line that is common among otherwise
unlike documents brings nobody together.  A run does if it has a rare line, and
a run of ``RUN_WORDS`` words does however frequent its lines are, so a long
passage goes from all documents but its earliest holder.

Alignment is patience diff: lines that occur once on either side, in their
longest increasing order, are anchors; before, between and behind anchors the
same is done again, with equal ends matched first.  Runs of matches that are
consecutive in both documents are blocks; blocks of at least ``MIN_WORDS``
words are deleted from the later document.  ``n_blocks`` counts the stretches of
consecutive lines that are deleted, from whichever partners.

Blank lines stay.  Null and empty texts have no lines.  Rows that repeat id and
text are one document and don't delete each other; repeated ids with different
texts are told apart by a hash of the text.  An empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import SLICE_BYTES, compress_text, keyed, mapped, materialize, quoted, release, slices, unpacked

MIN_WORDS, RUN_WORDS, RARE_DOCS, RARER = 10, 50, 100, 10


def _lines():
    names = ["h", "rid", "rv", "kinds", "words", "at"]

    def run(batches):
        import xxhash

        for batch in batches:
            for part in slices(batch):
                h, doc, kinds, words, places = [], [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    own: dict = {}
                    k = 0
                    for line in text.encode().split(b"\n"):
                        if n := len(line.split()):
                            own.setdefault(line, (n, []))[1].append(k)
                            k += 1
                    for line, (n, at) in own.items():
                        h.append(xxhash.xxh3_64_intdigest(line))
                        words.append(n)
                        places.append(at)
                    doc += [row] * len(own)
                    kinds += [len(own)] * len(own)
                of = pa.array(doc, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(h, np.uint64).view(np.int64)),
                        part.column("rid").take(of),
                        part.column("rv").take(of),
                        pa.array(kinds, pa.int32()),
                        pa.array(words, pa.int32()),
                        pa.array(places, pa.list_(pa.int32())),
                    ],
                    names,
                )

    return run, "h long, rid long, rv long, kinds int, words int, at array<int>"


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of equal elements that patience diff aligns, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        both = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        tails: list[int] = []
        last: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(both):
            k = bisect.bisect_left(tails, j)
            back.append(last[k - 1] if k else -1)
            if k == len(tails):
                tails.append(j)
                last.append(n)
            else:
                tails[k], last[k] = j, n
        if not last:
            continue
        chain, n = [], last[-1]
        while n >= 0:
            chain.append(both[n])
            n = back[n]
        chain.reverse()
        out += chain
        for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)]):
            if i + 1 < i2 and j + 1 < j2:
                todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def runs_of(at: list[int], words: list[int], least: int) -> set[tuple[int, int]]:
    """(first, last) of the shortest runs of consecutive places with ``least`` words, from each place on and back from it."""
    out, first = set(), 0
    while first < len(at):
        end = first + 1
        while end < len(at) and at[end] == at[end - 1] + 1:
            end += 1
        j, total = first, 0  # words of first..j-1
        for i in range(first, end):
            while j < end and total < least:
                total += words[j]
                j += 1
            if total < least:
                break
            out.add((i, j - 1))
            total -= words[i]
        i, total = first, 0  # words of i..j
        for j in range(first, end):
            total += words[j]
            while total - words[i] >= least:
                total -= words[i]
                i += 1
            if total >= least:
                out.add((i, j))
        first = end
    return out


def _in_runs(rows: list[tuple], least: int) -> dict[tuple, tuple[int, int]]:
    """The runs of (place, line, words) rows, by their lines: first and last index of one of each."""
    spans = runs_of([x[0] for x in rows], [x[2] for x in rows], least)
    return {tuple(x[1] for x in rows[i : j + 1]): (i, j) for i, j in sorted(spans, reverse=True)}


def blocks_of(a: list[tuple], b: list[tuple], min_words: int) -> set[int]:
    """Places of ``a`` in blocks that it shares with ``b``; both are (place, line, words) in order.

    Only lines in runs that both sides have are aligned, for others can be in no
    block and would only stand in the way.  What an alignment leaves, as blocks
    in another order, is aligned again until no run is left that both have.
    """
    gone: set[int] = set()
    while True:
        own, other = _in_runs(a, min_words), _in_runs(b, min_words)
        both = own.keys() & other.keys()
        if not both:
            return gone
        lines = {x for run in both for x in run}
        left, right = [x for x in a if x[1] in lines], [x for x in b if x[1] in lines]
        pairs = [(left[i], right[j]) for i, j in patience([x[1] for x in left], [x[1] for x in right])]
        used: list[tuple] = []
        start = 0
        for i in range(1, len(pairs) + 1):
            if i < len(pairs) and all(x[0] == y[0] + 1 for x, y in zip(pairs[i], pairs[i - 1])):
                continue
            if sum(x[2] for x, _ in pairs[start:i]) >= min_words:
                used += pairs[start:i]
            start = i
        if not used:
            (i, j), (k, _) = min((own[run], other[run]) for run in both)
            used = list(zip(a[i : j + 1], b[k:]))
        spent, taken = {x[0] for x, _ in used}, {y[0] for _, y in used}
        gone |= spent
        a, b = [x for x in a if x[0] not in spent], [x for x in b if x[0] not in taken]


def _shared():
    """A document's lines that others have too, in order, and which of them are rare."""
    names = ["rid", "rv", "at", "h", "words", "rare", "orid", "orv"]

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names[2:]]
            for kinds, matches in zip(batch.column("kinds").to_pylist(), batch.column("matches").to_pylist()):
                rarest = 1 if len(matches) < kinds else min(m["df"] for m in matches)
                limit = max(RARE_DOCS, RARER * rarest)
                rows = sorted((p, m["h"], m["words"], m["df"] <= limit, m["orid"], m["orv"]) for m in matches for p in m["at"])
                for o, x in zip(out, zip(*rows)):
                    o.append(list(x))
            types = [pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("rv"), *(pa.array(o, pa.list_(t)) for o, t in zip(out, types))], names)

    return run, "rid long, rv long, at array<int>, h array<long>, words array<int>, rare array<boolean>, orid array<long>, orv array<long>"


def _keys(min_words: int):
    """Rows of runs (key, and whether the run brings pairs together), and of rare lines with their owner (no key)."""
    names = ["rid", "rv", "key", "joins", "orid", "orv"]

    def run(batches):
        import xxhash

        for batch in batches:
            rows = []
            cols = [batch.column(c).to_pylist() for c in ("rid", "rv", "at", "h", "words", "rare", "orid", "orv")]
            for rid, rv, at, h, words, rare, orid, orv in zip(*cols):
                rows += {(rid, rv, None, True, o, v) for r, o, v in zip(rare, orid, orv) if r and (o, v) != (rid, rv)}
                raw, seen = np.array(h, np.int64), np.cumsum([0, *rare])
                keys: dict = {}
                long = runs_of(at, words, max(RUN_WORDS, min_words))
                for i, j in runs_of(at, words, min_words) | long:
                    if i < j or (i, j) in long:  # a shorter line alone has its owner
                        key = xxhash.xxh3_64_intdigest(raw[i : j + 1].tobytes())
                        keys[key] = keys.get(key, False) or (i, j) in long or bool(seen[j + 1] > seen[i])
                rows += [(rid, rv, key - (1 << 63), joins, None, None) for key, joins in keys.items()]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return run, "rid long, rv long, key long, joins boolean, orid long, orv long"


def _align(min_words: int):
    names = ["rid", "rv", "gone"]

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("at", "h", "words", "o_at", "o_h", "o_words")]
            gone = [sorted(blocks_of(list(zip(a, h, w)), list(zip(p, q, v)), min_words)) for a, h, w, p, q, v in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("rv"), pa.array(gone, pa.list_(pa.int32()))], names)

    return run, "rid long, rv long, gone array<int>"


def _cut(keep: list[str]):
    names = [*keep, "n_lines", "n_removed", "n_blocks", "kept_text"]

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            done = size = 0

            def part(upto: int):
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                some = batch.slice(done, upto - done)
                made = pa.RecordBatch.from_arrays([*(some.column(c) for c in keep), *(pa.array(o, t) for o, t in zip(out, types))], names)
                for o in out:
                    o.clear()
                return made

            for row, text in unpacked(batch):
                gone = set(batch.column("gone")[row].as_py() or ())
                blocks = sum(p - 1 not in gone for p in gone)
                kept, k = [], 0
                for line in text.split(b"\n"):
                    full = bool(line.split())
                    if not (full and k in gone):
                        kept.append(line)
                    k += full
                for o, x in zip(out, (k, len(gone), blocks, b"\n".join(kept).decode())):
                    o.append(x)
                size += len(text)
                if size > SLICE_BYTES:
                    yield part(row + 1)
                    done, size = row + 1, 0
            if done < batch.num_rows:
                yield part(batch.num_rows)

    return run, "n_lines long, n_removed long, n_blocks long, kept_text string"


def line_pairs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """The shared lines of each document, and the pairs (rid, rv, orid, orv) of later and earlier documents to align."""
    rows = materialize(mapped(docs.select("rid", "rv", "text"), *_lines()), "lines")
    owners = rows.groupBy("h").agg(F.count("*").alias("df"), F.min(F.struct("rid", "rv")).alias("o"))
    owners = materialize(owners.filter("df > 1").select("h", "df", F.col("o.rid").alias("orid"), F.col("o.rv").alias("orv")), "owners")
    # a set, for repeated rows; distinct rows by h would keep the join's partitions and so keep a hot line in one task
    held = F.collect_set(F.struct("h", "at", "words", "df", "orid", "orv")).alias("matches")
    held = rows.join(owners, "h").groupBy("rid", "rv").agg(F.first("kinds").alias("kinds"), held)
    shared = materialize(mapped(held, *_shared()), "shared")
    release(rows, owners)
    keys = materialize(mapped(shared, *_keys(min_words)), "keys")
    runs = keys.filter("key is not null").select("key", "rid", "rv", "joins")
    first = runs.groupBy("key").agg(F.min(F.struct("rid", "rv")).alias("o"), F.max("joins").alias("any"), F.count("*").alias("c")).filter("c > 1 and any")
    first = materialize(first.select("key", F.col("o.rid").alias("orid"), F.col("o.rv").alias("orv")), "runs")
    by_run = runs.filter("joins").join(first, "key").filter("rid != orid or rv != orv").select("rid", "rv", "orid", "orv")
    pairs = materialize(keys.filter("key is null").select("rid", "rv", "orid", "orv").union(by_run).distinct(), "pairs")
    release(keys, first)
    return shared, pairs


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(rid, rv, gone): places, among lines with words, that go from a document."""
    shared, pairs = line_pairs(docs, min_words)
    lines = shared.select("rid", "rv", "at", "h", "words")
    earlier = lines.select(*(F.col(c).alias(f"o{c}" if c in ("rid", "rv") else f"o_{c}") for c in lines.columns))
    both = pairs.join(earlier, ["orid", "orv"]).join(lines, ["rid", "rv"])
    aligned = materialize(mapped(both, *_align(min_words)).filter("size(gone) > 0"), "aligned")
    release(shared, pairs)
    gone = materialize(aligned.groupBy("rid", "rv").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")), "gone")
    release(aligned)
    return gone


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(id, *keep, n_lines, n_removed, n_blocks, kept_text) of every row; ``keep`` may not be named like these or the helpers."""
    docs = keyed(df, id_col, text_col, *keep)
    gone = removed_lines(docs, min_words)
    names = ["id", *keep]
    run, fields = _cut(names)
    # by a merge at any size: what is to go grows with the input
    joined = compress_text(docs, "rid", "rv", *names).join(gone.hint("merge"), ["rid", "rv"], "left").select(*map(quoted, names), "z", "gone")
    return mapped(joined, run, fields, names)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_blocks", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
