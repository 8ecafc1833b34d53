"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

Sets.  Words are lower-cased (A-Z) and shingled by five; a shorter text is one
shingle.  Shingles are 64-bit hashes.

Signature.  Shingles fall into ``BUCKETS`` buckets by hash; of each bucket's
smallest value only the number of leading zeros and ``MANTISSA`` following
bits are stored.  Registers are banded by as many rows as let a pair at the
threshold miss all bands with a probability of ``MISS`` at most: at 0.85 forty
bands of eight, (1 - 0.85**8)**40, and at 0.80 fifty-three of six; in small sets
one differing shingle spoils one band at most.

Candidates.  Documents with equal sets are one node.  A band key with several
nodes elects a *centre*, the node whose keys are shared most, and only pairs
(node, centre) are formed: rows grow with nodes, not with the squares of
groups.  Verified links are joined into components.  What a bucket then has
left - nodes of several components - is first peeled: a node with too many
shingles that no other left node has links with nobody and goes, which leaves
others with more such shingles, and so on.  The rest is compared among itself by
the join on its key, which passes a pair on only if a link is possible and only
in the first key the two share.  Possible means: sizes allow it; so do the
shingles that no other left node has; and the packed
registers (occupancy and four mantissa bits) agree in at least the threshold
less a slack that a link exceeds once in ``1 / DOUBT`` pairs (Hoeffding).  What leaves the join so are the links and
their close misses, not a group's pairs.  No cap on partners, buckets or pairs.

Verification.  A pair's registers give a Jaccard estimate corrected for
accidental collisions; pairs below the threshold less the same slack stop there,
all others are confirmed on their whole sets.

Documents without words link with nothing.  Null texts are empty.  A repeated id
with different texts, or a null one, is a node for each text, so no link is lost
or lent to another text; a component's id is its smallest id that is not null,
and null if it has none.  Repeated rows share one result; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import BASES, SLICE_BYTES, Rolling, compress_text, keyed, mapped, materialize, mix, quoted, release, signed, slices, unpacked, with_row, word_hashes

SHINGLE, PERCENT = 5, 85
BUCKETS, MANTISSA, MISS, DOUBT = 320, 26, 3e-6, 1e-9
_EMPTY = np.uint64(1 << 63)
#: Of the sketch: longs a bit plane, and planes of mantissa bits.
_WORDS, _PLANES = BUCKETS // 64, 4


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows a band, as many rows as ``MISS`` allows at a similarity of ``percent``."""
    for rows in range(16, 0, -1):
        if (1 - (percent / 100) ** rows) ** (BUCKETS // rows) <= MISS:
            return BUCKETS // rows, rows
    raise ValueError(f"{BUCKETS} registers are too few for a similarity of {percent} %")


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, off = word_hashes(texts, lower=True)
    n = np.diff(off)
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    first = np.cumsum(count) - count
    at = np.arange(len(doc)) - first[doc] + off[doc]
    hashes = Rolling(words, BASES[0]).at(at, np.minimum(size, n)[doc]) if len(doc) else np.zeros(0, np.uint64)
    return [np.unique(hashes[a : a + c]) for a, c in zip(first, count)]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BUCKETS registers a set: leading zeros and mantissa of each bucket's smallest value."""
    least = np.full((len(sets), BUCKETS), np.uint64(2**64 - 1))
    if sets:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        h = np.concatenate(sets)
        np.minimum.at(least, (row, (h % np.uint64(BUCKETS)).astype(np.int64)), mix(h ^ np.uint64(BASES[2])))
    zeros = (64 - np.frexp(least.astype(np.float64))[1]).clip(0, 63).astype(np.uint64)
    mantissa = ((least << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.where(least == np.uint64(2**64 - 1), _EMPTY, (zeros << np.uint64(MANTISSA)) | mantissa)


def band_keys(regs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bands, and which of them have a register that is not empty."""
    bands, rows = banding(percent)
    factors = mix(np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(BASES[0])) | np.uint64(1)
    banded = regs[:, : bands * rows].reshape(len(regs), bands, rows)
    keys = mix((mix(banded) * factors).sum(axis=2, dtype=np.uint64) + mix(np.arange(1, bands + 1, dtype=np.uint64)))
    return keys, (banded != _EMPTY).any(axis=2)


def sketches(regs: np.ndarray) -> np.ndarray:
    """Bit planes of the registers, a row of longs a set: which are occupied, then the mantissas' lowest bits."""
    full = regs != _EMPTY
    planes = [full, *(full & ((regs >> np.uint64(k)) & np.uint64(1)).astype(bool) for k in range(_PLANES))]
    return np.concatenate([np.packbits(p, axis=1, bitorder="little").view(np.int64) for p in planes], axis=1)


def estimate(a: np.ndarray, b: np.ndarray, n: int, m: int) -> float:
    """Jaccard similarity from registers, without what registers agree on by accident."""
    used = (a != _EMPTY) | (b != _EMPTY)
    equal = float((a == b)[used].mean()) if used.any() else 0.0
    least = [[1 - (1 - 2.0**-z) ** max(k / BUCKETS, 1e-9) for z in range(65)] for k in (n, m)]
    chance = sum((least[0][z] - least[0][z + 1]) * (least[1][z] - least[1][z + 1]) for z in range(64)) * 2.0**-MANTISSA
    return (equal - chance) / (1 - chance)


def _signatures(percent: int):
    names = ["rid", "rv", "id", "n_shingles", "d1", "d2", "bands", "sketch"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column("text"))
                regs = registers(sets)
                keys, valid = band_keys(regs, percent)
                sums = lambda base: pa.array([int(mix(s ^ np.uint64(base)).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64())
                offsets = np.concatenate([[0], np.cumsum(valid.sum(axis=1))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(keys[valid])))
                flat = sketches(regs)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32)), pa.array(flat.ravel()))
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:3]), sizes, sums(BASES[1]), sums(BASES[2]), bands, sketch], names)

    return run, "rid long, rv long, id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>"


def slack(used):
    """How far a link's registers fall below the threshold once in ``1 / DOUBT`` times at most, in registers: for columns and numbers."""
    root = F.sqrt if not isinstance(used, int) else math.sqrt
    return root(used * (-math.log(DOUBT) / 2))


def _sets_of(texts: dict, percent: int):
    """(set, registers) of each node, a slice of texts at a time."""
    some, size, out = [], 0, {}
    for node, text in [*texts.items(), (None, b"")]:
        if some and (node is None or size > SLICE_BYTES):
            sets = shingle_sets(pa.array([x.decode() for _, x in some], pa.string()))
            out.update(zip((k for k, _ in some), zip(sets, registers(sets))))
            some, size = [], 0
        some.append((node, text))
        size += len(text)
    return out


def _confirm(percent: int):
    """Of the rows (a, b, za, zb) the linked (a, b), some hundred pairs at a time."""

    def linked(x, y) -> bool:
        (s, r), (t, q) = x, y
        if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
            return False
        used = int(((r != _EMPTY) | (q != _EMPTY)).sum())
        if estimate(r, q, len(s), len(t)) * used < percent / 100 * used - slack(used):
            return False
        common = len(np.intersect1d(s, t, assume_unique=True))
        return 100 * common >= percent * (len(s) + len(t) - common)

    def run(batches):
        for whole in batches:
            for batch in (whole.slice(i, 200) for i in range(0, whole.num_rows, 200)):
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                texts = {}
                for nodes, side in ((a, "za"), (b, "zb")):
                    first = {}
                    for i, node in enumerate(nodes):
                        if node not in texts:
                            first.setdefault(node, i)
                    own = batch.column(side).take(pa.array(first.values(), pa.int32()))
                    texts |= {node: text for node, (_, text) in zip(first, unpacked(pa.RecordBatch.from_arrays([own], ["z"])))}
                seen = _sets_of(texts, percent)
                mask = pa.array([linked(seen[x], seen[y]) for x, y in zip(a, b)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run, "a long, b long"


def connected(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for all nodes that have a link.

    Every round takes the smallest label among neighbours and then the label's
    own label; only the number of changed labels goes to the driver.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("component").alias("was"), F.least("component", "least").alias("c"))
        root = labels.select(F.col("node").alias("c"), F.col("component").alias("up"))
        new = step.join(root, "c", "left").select("node", "was", F.least("c", "up").alias("component"))
        new = materialize(new, "labels")
        release(labels)
        if new.filter("was != component").limit(1).count() == 0:
            release(both)
            return new.select("node", "component")
        labels = new.drop("was")
        labels._scratch = new._scratch


def _star(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The centre of every key, and the pairs of its other nodes with it."""
    best = rows.groupBy("key").agg(F.max(F.struct("popular", "node", "n")).alias("x"))
    centres = materialize(best.select("key", F.col("x.node").alias("centre"), F.col("x.n").alias("cn")), "centres")
    near = 100 * F.least("n", "cn") >= percent * F.greatest("n", "cn")
    met = rows.join(centres, "key").filter("node != centre").filter(near)
    return centres, met.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def _apart(rows: DataFrame) -> DataFrame:
    """The rows of keys whose nodes are in several components."""
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    return rows.join(materialize(mixed.select("key"), "mixed"), "key")


def _shingles(texts: DataFrame) -> DataFrame:
    """(h, node): the sets of the nodes (node, z), a row a shingle."""

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                sets = shingle_sets(pa.array([text.decode() for _, text in unpacked(part)], pa.string()))
                of = np.repeat(part.column("node").to_numpy(), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(sets))), pa.array(of)], ["h", "node"])

    return mapped(texts.select("node", "z"), run, "h long, node long")


def _able(rest: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (key, node, n, component) that can still link, and (node, own): how many shingles no other such node has.

    A node's own shingles are in no intersection, so one with too many of them
    links with nobody and goes, and with it what others shared with it alone:
    again and again, until hardly a node goes.  Keys that are left with one
    component go too.
    """
    rows = materialize(_shingles(texts.join(rest.select("node").distinct(), "node")), "shingles")
    before = rest.select("node").distinct().count()
    while True:
        nodes = rest.groupBy("node").agg(F.first("n").alias("n"))
        alone = rows.groupBy("h").agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1").groupBy("node").agg(F.count("*").alias("own"))
        nodes = nodes.join(alone, "node", "left").select("node", "n", F.coalesce("own", F.lit(0)).alias("own"))
        nodes = materialize(nodes.filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")).select("node", "own"), "able")
        kept = materialize(_apart(rest.join(nodes.select("node"), "node").select(*rest.columns)), "kept")
        release(rest)
        now = kept.select("node").distinct().count()
        if now >= 0.9 * before:
            release(rows)
            return kept, nodes
        left = materialize(rows.join(kept.select("node").distinct(), "node").select("h", "node"), "shingles")
        release(rows, nodes)
        rows, rest, before = left, kept, now


def _possible(rest: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a key's nodes in different components that sizes, own shingles and registers allow to link.

    ``rest`` is (key, node); ``nodes`` has n, component, own, keys and sketch of each node.
    """
    x = rest.join(nodes, "node")
    y = x.select(F.col("key").alias("o_key"), *(F.col(c).alias(f"o_{c}") for c in nodes.columns))
    n, on, share = F.col("n"), F.col("o_n"), percent / 100
    most = F.least(n - F.col("own"), on - F.col("o_own"))
    word = lambda side, plane, i: F.get(F.col(side), F.lit(plane * _WORDS + i))
    used = equal = F.lit(0)
    for i in range(_WORDS):
        either = word("sketch", 0, i).bitwiseOR(word("o_sketch", 0, i))
        differ = F.lit(0).cast("long")
        for plane in range(_PLANES + 1):
            differ = differ.bitwiseOR(word("sketch", plane, i).bitwiseXOR(word("o_sketch", plane, i)))
        used = used + F.bit_count(either)
        equal = equal + F.bit_count(either.bitwiseAND(F.bitwise_not(differ)))
    met = (
        (F.col("node") < F.col("o_node"))
        & (F.col("component") != F.col("o_component"))
        & (100 * F.least(n, on) >= percent * F.greatest(n, on))
        & (100 * most >= percent * (n + on - most))
        & (equal + slack(used) >= share * used)
        & (F.array_min(F.array_intersect("keys", "o_keys")) == F.col("key"))
    )
    return x.join(y, (F.col("key") == F.col("o_key")) & met).select(F.col("node").alias("a"), F.col("o_node").alias("b"))


def _nodes(signed_docs: DataFrame) -> DataFrame:
    """(d1, d2, node, rid, rv, no_id): one node a content, with its first row; rows without an id come last.

    The node's number is that row's id, or a negative hash of the content where
    several contents have that id or there is none.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "rid", "rv")).alias("m")
    kinds = materialize(signed_docs.filter("n_shingles > 0").groupBy("d1", "d2").agg(first).select("d1", "d2", "m.*"), "kinds")
    several = materialize(kinds.groupBy("rid").agg(F.count("*").alias("c"), F.max("no_id").alias("any")).filter("c > 1 or any").select("rid", F.lit(True).alias("several")), "several")
    own = F.when(F.col("several"), F.xxhash64("d1", "d2").bitwiseOR(F.lit(-(2**63)))).otherwise(F.col("rid"))
    nodes = materialize(kinds.join(several, "rid", "left").select("d1", "d2", own.alias("node"), "rid", "rv", "no_id"), "nodes")
    release(kinds, several)
    return nodes


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(rid, rv, id, n_shingles, class, component_id) of every row; ``class`` numbers the components, null without words."""
    docs = keyed(df, id_col, text_col)
    signed_docs = materialize(mapped(docs, *_signatures(percent)), "signatures")
    nodes = _nodes(signed_docs)
    reps = signed_docs.select("rid", "rv", "d1", "d2", "n_shingles", "bands", "sketch").join(nodes, ["d1", "d2", "rid", "rv"])
    reps = materialize(reps.select("node", F.col("n_shingles").alias("n"), "bands", "sketch").dropDuplicates(["node"]), "reps")
    rows = reps.select("node", "n", F.explode("bands").alias("key"))
    shared = materialize(rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "keys")
    counted = materialize(rows.join(shared, "key"), "bands")
    popular = materialize(counted.groupBy("node").agg(F.sum("c").alias("popular")), "popular")
    rows = materialize(counted.drop("c").join(popular, "node"), "rows")
    wanted = popular.select("node").join(nodes.select("node", "rid", "rv"), "node")
    texts = materialize(compress_text(docs, "rid", "rv").join(wanted, ["rid", "rv"]).select("node", "z").dropDuplicates(["node"]), "texts")
    release(shared, counted, popular)

    def confirmed(pairs: DataFrame) -> DataFrame:
        with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("z").alias("zb")), "b")
        return materialize(mapped(with_b.join(texts.select(F.col("node").alias("a"), F.col("z").alias("za")), "a"), *_confirm(percent)), "confirmed")

    centres, tested = _star(rows, percent)
    tested = materialize(tested, "pairs")
    links = confirmed(tested)
    components = connected(links)
    spent = centres.select("key", F.col("centre").alias("node"))
    rest = rows.join(spent, ["key", "node"], "left_anti").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = materialize(_apart(rest).select("key", "node", "n", "component"), "rest")
    release(rows)
    rest, own = _able(rest, texts, percent)
    left = rest.groupBy("node").agg(F.first("n").alias("n"), F.first("component").alias("component"), F.collect_set("key").alias("keys"))
    left = left.join(own, "node").join(reps.select("node", "sketch"), "node")
    left = materialize(left, "left")
    more = materialize(_possible(rest.select("key", "node"), left, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
    release(reps, rest, own, left, tested, centres)
    more = confirmed(more)
    release(texts)
    if more.limit(1).count():
        components = connected(links.unionByName(more))
    release(links, more)

    linked = nodes.join(components, "node").select("d1", "d2", "component", F.struct("no_id", "rid").alias("own"))
    least = linked.groupBy("component").agg(F.min("own").alias("least"))
    linked = linked.join(materialize(least, "least"), "component").select("d1", "d2", "component", "least")
    of_class = nodes.join(linked, ["d1", "d2"], "left")
    least = F.coalesce("least", F.struct("no_id", "rid"))
    of_class = of_class.select("d1", "d2", F.coalesce("component", "node").alias("class"), F.when(~least["no_id"], least["rid"]).alias("component_id"))
    of_class = materialize(of_class, "classes")
    out = signed_docs.select("rid", "rv", "id", "n_shingles", "d1", "d2").join(of_class, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select("rid", "rv", "id", "n_shingles", "class", component.alias("component_id"))


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return near_classes(df, id_col, text_col, percent).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of each class, that of its smallest id, with all columns of ``df``; rows without words stay, a repeated one once."""
    apart = with_row(df, id_col, text_col)
    rows = near_classes(df, id_col, text_col, percent)
    order = F.struct(F.col("id").isNull().alias("no_id"), "rid", "rv")
    first = rows.filter("class is not null").groupBy("class").agg(F.min(order).alias("m")).select("m.rid", "m.rv")
    first = materialize(first.unionByName(rows.filter("class is null").select("rid", "rv").distinct()), "first")
    docs = keyed(apart, id_col, text_col, apart[quoted(id_col)].alias("own_id"), apart[quoted(text_col)].alias("own_text"), "row").drop("text")
    docs = docs.join(first.hint("merge"), ["rid", "rv"], "left_semi").dropDuplicates(["rid", "rv"])
    own = {id_col: F.col("own_id"), text_col: F.col("own_text")}
    return docs.select(*(own.get(c, F.col("row")[c]).alias(c) for c in df.columns))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
