"""Substring dedup over a compacted De Bruijn graph of word k-mers.

An edge of the graph is a window of ``window`` consecutive words of one
document, a node the words that two neighbouring edges share.

1. Every document is cut into *chains*: runs of edges whose leftmost smallest
   ``seed``-word hash is the same one.  Equal edges have equal smallest hashes
   at equal offsets, so edges of chains with different hashes never match, and
   two edges of one chain never are equal.  A chain of about fifteen edges
   costs one row.
2. Chains whose hash occurs once in the corpus are out.  Of the others, chains
   whose hash has one content only are pieces as they are.  Where different
   contents share a hash, one chain of each is opened into its edges, edges meet
   by 128 bits of their words, and each content is cut into *segments*: longest
   runs of edges that the same contents have.  Edges of one content only are out,
   unless the content itself is repeated.  All chains of the content are cut like
   it, so every piece now has the same edges wherever it stands, at least twice.
3. Repeated pieces are compacted: joins give every piece the least and the
   greatest neighbour it has anywhere, the end of a run among them.  Between two
   pieces that have no other neighbour (nonbranching) nothing is cut, so a
   maximal path reads the same wherever it begins.
4. Paths are verified at their source coordinates: the words there are read from
   the text again, and a path counts where another one of its name has the very
   same words by a 128-bit BLAKE2 digest.  Words that verified paths cover go.

Work and shuffle grow with the words: no pair of documents is ever formed, and
a passage with a million copies costs a million rows.  Hot hashes are counted
with map-side sums; the joins that carry their rows are plain sort-merge joins
which adaptive execution splits.

Null texts have no words; documents shorter than a window keep everything;
repeated rows repeat each other; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import BASES, SLICE_BYTES, Rolling, compress_text, keyed, mapped, materialize, release, signed, slices, unpacked, word_hashes

WINDOW, SEED = 35, 8


def _leftmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost smallest of ``width`` consecutive values is, for each start."""
    v, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left = v[:-step] <= v[step:]
        v, at = np.where(left, v[:-step], v[step:]), np.where(left, at[:-step], at[step:])
        have += step
    return at


def _chains(window: int, seed: int):
    names = ["h", "d", "rid", "rv", "start", "n"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES // 2):
                words, off = word_hashes(part.column("text"))
                count = np.maximum(np.diff(off) - window + 1, 0)
                if not count.sum():
                    continue
                first, second = Rolling(words, BASES[0]), Rolling(words, BASES[1])
                seeds = first.at(np.arange(len(words) - seed + 1), seed)
                best = _leftmost_min(seeds, window - seed + 1)
                doc = np.repeat(np.arange(len(count)), count)
                at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + off[doc]
                low = best[at]
                new = np.ones(len(at), bool)
                new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
                begin = np.flatnonzero(new)
                n = np.diff(np.append(begin, len(at)))
                doc, start = doc[begin], at[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(seeds[low[begin]])),
                        pa.array(signed(second.at(start, n + window - 1))),
                        part.column("rid").take(pa.array(doc)),
                        part.column("rv").take(pa.array(doc)),
                        pa.array((start - off[doc]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    names,
                )

    return run, "h long, d long, rid long, rv long, start int, n int"


def _edges(window: int):
    """The edges (h, d, c, at, e1, e2) of the chains (start, n, h, d, c) that a row's document has, some thousand at a time."""
    names = ["h", "d", "c", "at", "e1", "e2"]

    def run(batches):
        for batch in batches:
            for row, text in unpacked(batch):
                words, _ = word_hashes(pa.array([text.decode()]))
                a, b = Rolling(words, BASES[1]), Rolling(words, BASES[2])
                chains = batch.column("chains")[row].values
                for part in (chains.slice(i, 2000) for i in range(0, len(chains), 2000)):
                    start, n = part.field("start").to_numpy(), part.field("n").to_numpy()
                    of = np.repeat(np.arange(len(n)), n)
                    at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                    place = (at + start[of]).astype(np.int64)
                    own = [part.field(c).take(pa.array(of)) for c in ("h", "d", "c")]
                    edges = [pa.array(signed(a.at(place, window))), pa.array(signed(b.at(place, window)))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(at.astype(np.int32)), *edges], names)

    return run, "h long, d long, c long, at int, e1 long, e2 long"


def _segments(edges: DataFrame) -> DataFrame:
    """(h, d, segments): each content's longest runs (at, n, piece) of repeated edges that the same contents have."""
    met = edges.groupBy("e1", "e2").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"), F.sum(F.xxhash64("h", "d").cast("decimal(38,0)")).alias("in"))
    met = materialize(met.filter("total > 1").select("e1", "e2", F.xxhash64("kinds", "in").alias("who")), "met")
    held = edges.join(met, ["e1", "e2"]).select("h", "d", "at", "who", F.xxhash64("e1", "e2", "who").alias("piece"))
    rows = held.groupBy("h", "d").agg(F.sort_array(F.collect_list(F.struct("at", "who", "piece"))).alias("x"))  # a chain has ``window`` edges at most
    opens = lambda x, i: (i == 0) | (F.get("x", i - 1)["who"] != x["who"]) | (F.get("x", i - 1)["at"] != x["at"] - 1)
    firsts = F.filter(F.transform("x", lambda x, i: F.when(opens(x, i), i)), lambda i: i.isNotNull())
    rows = rows.select("h", "d", "x", firsts.alias("f"))
    end = lambda k: F.coalesce(F.get("f", k + 1), F.size("x"))
    segments = F.transform("f", lambda i, k: F.struct(F.get("x", i)["at"].alias("at"), (end(k) - i).alias("n"), F.get("x", i)["piece"].alias("piece")))
    out = materialize(rows.select("h", "d", segments.alias("segments")), "segments")
    release(met)
    return out


def repeated_pieces(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(rid, rv, start, n, piece): n consecutive edges from word ``start``, the same wherever ``piece`` stands, and that in two places or more."""
    chains = materialize(mapped(docs.select("rid", "rv", "text"), *_chains(window, seed)), "chains")
    again = chains.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    again = materialize(again, "again")  # a join below its own aggregate could not be split where a hash is hot
    shared = materialize(chains.join(again, "h"), "shared")
    release(chains, again)
    by_content = shared.groupBy("h", "d").agg(F.count("*").alias("c"), F.min(F.struct("rid", "rv", "start", "n")).alias("rep"))
    contents = materialize(by_content, "contents")
    differ = materialize(contents.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("h"), "differ")
    opened = (
        contents.join(differ, "h")
        .groupBy("rep.rid", "rep.rv")
        .agg(F.collect_list(F.struct("rep.start", "rep.n", "h", "d", "c")).alias("chains"))
    )
    texts = compress_text(docs, "rid", "rv").join(opened, ["rid", "rv"]).dropDuplicates(["rid", "rv"])
    edges = materialize(mapped(texts.select("z", "chains"), *_edges(window)), "edges")
    segments = _segments(edges)
    release(edges, contents)
    cut = shared.join(segments, ["h", "d"]).select("rid", "rv", "start", F.explode("segments").alias("s"))
    cut = cut.select("rid", "rv", (F.col("start") + F.col("s.at")).alias("start"), "s.n", "s.piece")
    whole = shared.join(differ, "h", "left_anti").select("rid", "rv", "start", "n", F.xxhash64("h", "d", "n").alias("piece"))
    pieces = materialize(whole.unionByName(cut).distinct(), "pieces")  # repeated rows give equal pieces twice
    release(shared, differ, segments)
    return pieces


def compacted_paths(pieces: DataFrame) -> DataFrame:
    """(rid, rv, spans): each document's maximal nonbranching paths, as edges (start, n, path) in order; ``path`` is its first piece."""
    order = Window.partitionBy("rid", "rv").orderBy("start")
    near = F.col("start") + F.col("n")
    linked = materialize(
        pieces.select(
            "*",
            F.when(F.lead("start").over(order) == near, F.lead("piece").over(order)).alias("after"),
            F.when(F.lag(near).over(order) == F.col("start"), F.lag("piece").over(order)).alias("before"),
        ),
        "linked",
    )
    branches = lambda c: (F.min(c) != F.max(c)) | (F.count(c) < F.count("*"))
    ends = linked.groupBy("piece").agg(F.coalesce(branches("after"), F.lit(True)).alias("forks"), F.coalesce(branches("before"), F.lit(True)).alias("joins"))
    ends = materialize(ends.filter("forks or joins"), "ends")
    marked = linked.join(ends, "piece", "left").select(
        "rid", "rv", "start", "n", "piece", F.coalesce("joins", F.lit(False)).alias("opens"), F.coalesce("forks", F.lit(False)).alias("closes")
    )
    rows = marked.groupBy("rid", "rv").agg(F.sort_array(F.collect_list(F.struct("start", "n", "piece", "opens", "closes"))).alias("x"))
    begins = lambda x, i: (i == 0) | x["opens"] | F.get("x", i - 1)["closes"]
    firsts = F.filter(F.transform("x", lambda x, i: F.when(begins(x, i), i)), lambda i: i.isNotNull())
    rows = rows.select("rid", "rv", "x", firsts.alias("f"))
    last = lambda k: F.get("x", F.coalesce(F.get("f", k + 1), F.size("x")) - 1)
    span = lambda i, k: F.struct(F.get("x", i)["start"].alias("start"), (last(k)["start"] + last(k)["n"] - F.get("x", i)["start"]).alias("n"), F.get("x", i)["piece"].alias("path"))
    paths = materialize(rows.select("rid", "rv", F.transform("f", span).alias("spans")), "paths")
    release(linked, ends, pieces)
    return paths


def _digests(window: int):
    """(path, n, g1, g2, rid, rv, start) of every path, by the words that stand at its coordinates."""
    names = ["path", "n", "g1", "g2", "rid", "rv", "start"]

    def run(batches):
        for batch in batches:
            for row, text in unpacked(batch):
                words = text.split()
                spans = batch.column("spans")[row].values
                start, n, path = (spans.field(c).to_numpy() for c in ("start", "n", "path"))
                g = np.array([np.frombuffer(hashlib.blake2b(b" ".join(words[a : a + k + window - 1]), digest_size=16).digest(), np.int64) for a, k in zip(start, n)])
                own = [pa.array(np.full(len(n), batch.column(c)[row].as_py(), np.int64)) for c in ("rid", "rv")]
                yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(n), pa.array(g[:, 0].copy()), pa.array(g[:, 1].copy()), *own, pa.array(start)], names)

    return run, "path long, n int, g1 long, g2 long, rid long, rv long, start int"


def refuted_paths(rows: DataFrame, window: int) -> DataFrame:
    """(rid, rv, refuted): starts of the paths whose words no other path of that name has."""
    found = materialize(mapped(rows.filter("spans is not null").select("rid", "rv", "z", "spans"), *_digests(window)), "digests")
    single = found.groupBy("path", "n", "g1", "g2").agg(F.count("*").alias("c"), F.min(F.struct("rid", "rv", "start")).alias("at")).filter("c = 1")
    out = materialize(single.select("at.*").groupBy("rid", "rv").agg(F.collect_set("start").alias("refuted")), "refuted")
    release(found)
    return out


def _cut(window: int):
    names = ["doc_id", "n_words", "n_removed", "n_paths", "kept_sha256", "kept_text"]

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            out, size = [[] for _ in names], 0
            for row, text in unpacked(batch):
                words = text.split()
                gone, paths = np.zeros(len(words) + 1, np.int64), 0
                spans = batch.column("spans")[row].values
                if spans is not None and len(spans):
                    refuted = batch.column("refuted")[row].as_py() or []
                    sure = ~np.isin(spans.field("start").to_numpy(), refuted)
                    start, n = spans.field("start").to_numpy()[sure], spans.field("n").to_numpy()[sure]
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + n + window - 1, -1)
                    paths = len(start)
                gone = np.cumsum(gone)[:-1] > 0
                kept = b" ".join(words[i] for i in np.flatnonzero(~gone)) if gone.any() else b" ".join(words)
                for o, x in zip(out, (batch.column("id")[row].as_py(), len(words), int(gone.sum()), paths, hashlib.sha256(kept).hexdigest(), kept.decode())):
                    o.append(x)
                size += len(text)
                if size > SLICE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names)
                    out, size = [[] for _ in names], 0
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names)

    return run, "doc_id long, n_words long, n_removed long, n_paths long, kept_sha256 string, kept_text string"


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Texts without the words that a repeated window covers: (doc_id, n_words, n_removed, n_paths, kept_sha256, kept_text)."""
    docs = keyed(df, id_col, text_col)
    paths = compacted_paths(repeated_pieces(docs, window, seed))
    rows = materialize(compress_text(docs, "rid", "rv", "id").join(paths, ["rid", "rv"], "left"), "rows")
    release(paths)
    refuted = refuted_paths(rows, window)
    return mapped(rows.join(refuted, ["rid", "rv"], "left").select("id", "z", "spans", "refuted"), *_cut(window))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs).drop("kept_text")
