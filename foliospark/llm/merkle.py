"""Merkle dataset manifest: a tree of digests over each group's rows, with a proof for every row.

A row's leaf is the SHA-256 of its encoded columns, computed natively.  Leaves of
a group (a language) ascend by id; ties go by leaf, and rows that are equal in
both are equal in all.  Places come from a range partitioning that is written
once: a row's place is its number in its partition, plus the counts of the
partitions before it.

Leaves lie in aligned buckets of 8**3 places, one row of a table each.  Inside
tasks DuckDB works on Arrow batches of whole buckets: a level is an ordered
``string_agg`` of every eight digests and its ``sha256``.  Spark takes the bucket
roots as the nodes of the next table, until each group has one; the group roots,
in the order of their names, are one more such tree.  From the top down, each
bucket gets by a join the siblings above it, and a second query per table walks
every node up to the root: it cuts the siblings out of its run's string and
folds the digest level by level.  A table is a 512th of the one below, so the
number of jobs grows with the logarithm of the rows.

Equal rows are leaves of their own.  Null ids come first, and a null group
before all others.  An empty table has no root and no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import mapped, materialize, release

FAN_BITS, LEVELS = 3, 3
FAN, BUCKET = 1 << FAN_BITS, 1 << (FAN_BITS * LEVELS)
#: Buckets that one DuckDB query takes.
BUCKETS = 32
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_RUNS = f"CREATE OR REPLACE TABLE runs AS SELECT b AS rb, i >> {FAN_BITS} AS r, string_agg(h, '' ORDER BY i) AS s FROM nodes WHERE deep > {{level}} GROUP BY b, r"
_UP = "CREATE OR REPLACE TABLE nodes AS SELECT b, r AS i, sha256(s) AS h, deep FROM runs JOIN (SELECT DISTINCT b, deep FROM nodes) ON rb = b UNION ALL FROM nodes WHERE deep <= {level}"
# a node's siblings are what its run's string has before and after it; ``told`` gathers them, ``now`` is the digest so far
_STEP = f"""
CREATE OR REPLACE TABLE walk AS
SELECT b, i, pos >> {FAN_BITS} AS pos,
  CASE WHEN s IS NULL THEN now ELSE sha256(s[1:{HEX} * (pos & {FAN - 1})] || now || s[{HEX} * (pos & {FAN - 1}) + {HEX + 1}:]) END AS now,
  CASE WHEN s IS NULL THEN told ELSE list_append(told, {{'left': s[1:{HEX} * (pos & {FAN - 1})], 'right': s[{HEX} * (pos & {FAN - 1}) + {HEX + 1}:]}}) END AS told
FROM walk LEFT JOIN runs ON b = rb AND pos >> {FAN_BITS} = r"""
# the levels above the bucket, the same for all its nodes
_ABOVE = """
CREATE OR REPLACE TABLE walk AS
SELECT b, i, pos, CASE WHEN len(up) > {level} THEN sha256(up[{level} + 1].left || now || up[{level} + 1].right) ELSE now END AS now, told
FROM walk JOIN above USING (b)"""
_PROOF = """
SELECT b, i, now, sha256(array_to_string(list_transform(list_concat(told, up), lambda x: x.left || x.right), '')) AS proof
FROM walk JOIN above USING (b) ORDER BY b, i"""
_PATHS = "SELECT b, i, list_concat(told, up) AS up FROM walk JOIN above USING (b) ORDER BY b, i"
_PATH = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """A column as ``-`` if null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, columns)).cast("binary"), 256)


def placed(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df``, written, with each row's place in its group from 0, and the group's size ``n``."""
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    ranged = materialize(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("m")), "ranged")
    counts = ranged.groupBy(group, "part").agg(F.count("*").alias("c"), F.min("m").alias("first"))
    counts = materialize(counts, "counts")  # a row a partition and group
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(group, "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("c").over(Window.partitionBy(group)).alias("n"))
    a, b = ranged.alias("a"), shift.alias("b")
    out = a.join(b, (F.col("a.part") == F.col("b.part")) & F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")))
    return out.select(*(F.col(f"a.{c}") for c in df.columns), (F.col("m") + F.col("shift")).alias("place"), "n")


def bucketed(nodes: DataFrame, group: str, *carried: str) -> DataFrame:
    """(group, bucket, n, nodes): whole aligned buckets of (place, h, *carried)."""
    each = nodes.select(group, F.shiftright("place", FAN_BITS * LEVELS).alias("bucket"), "n", F.struct("place", "h", *carried).alias("x"))
    return each.groupBy(group, "bucket").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("x")).alias("nodes"))


class Engine:
    """One DuckDB connection a worker; what it makes stays in memory or fails."""

    _made: list = []

    @classmethod
    def get(cls) -> Engine:
        if not cls._made:
            cls._made.append(cls())
        return cls._made[0]

    def __init__(self):
        import duckdb

        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})

    def load(self, part: pa.RecordBatch) -> None:
        lists = part.column("nodes")
        size = lists.value_lengths().to_numpy().astype(np.int64)
        b = np.repeat(np.arange(len(size)), size)
        flat = lists.flatten()
        n = part.column("n").to_numpy()
        deep = np.zeros(len(n), np.int64)
        for level in range(LEVELS):
            deep += n > FAN**level
        self.db.register("fresh", pa.table({"b": b, "i": flat.field("place").to_numpy() & (BUCKET - 1), "h": flat.field("h"), "deep": deep[b]}))
        self.db.execute("CREATE OR REPLACE TABLE nodes AS FROM fresh")
        self.db.unregister("fresh")

    def roots(self, part: pa.RecordBatch) -> list:
        self.load(part)
        for level in range(LEVELS):
            self.db.execute(_RUNS.replace("{level}", str(level)))
            self.db.execute(_UP.replace("{level}", str(level)))
        return self.db.sql("SELECT h FROM nodes ORDER BY b").to_arrow_table().column("h").combine_chunks()

    def walk(self, part: pa.RecordBatch, now: pa.Array, end: str) -> pa.Table:
        """Every node from the digest ``now`` to the root, with the siblings on its way."""
        self.load(part)
        self.db.register("above_", pa.table({"b": np.arange(part.num_rows), "up": part.column("up")}))
        self.db.execute("CREATE OR REPLACE TABLE above AS FROM above_")
        self.db.unregister("above_")
        size = part.column("nodes").value_lengths().to_numpy()
        start = pa.table({"b": np.repeat(np.arange(len(size)), size), "i": part.column("nodes").flatten().field("place").to_numpy() & (BUCKET - 1), "now": now})
        self.db.register("start", start)
        self.db.execute("CREATE OR REPLACE TABLE walk AS SELECT b, i, i AS pos, now, []::STRUCT(\"left\" VARCHAR, \"right\" VARCHAR)[] AS told FROM start")
        self.db.unregister("start")
        for level in range(LEVELS):
            self.db.execute(_RUNS.replace("{level}", str(level)))
            self.db.execute(_STEP)
            self.db.execute(_UP.replace("{level}", str(level)))
        for level in range(max(map(len, part.column("up").to_pylist()), default=0)):
            self.db.execute(_ABOVE.replace("{level}", str(level)))
        return self.db.sql(end).to_arrow_table()


def _parts(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, BUCKETS):
            yield batch.slice(k, BUCKETS)


def bucket_roots(buckets: DataFrame, group: str) -> DataFrame:
    """(group, place, n, h): the buckets' roots, nodes of the next table."""

    def run(batches):
        engine = Engine.get()
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column(group), part.column("bucket"), part.column("n"), engine.roots(part)], [group, "bucket", "n", "h"])

    roots = mapped(buckets.select(group, "bucket", "n", "nodes"), run, "h string", [group, "bucket", "n"])
    return roots.select(group, F.col("bucket").alias("place"), F.expr(f"(n + {BUCKET - 1}) div {BUCKET}").alias("n"), "h")


def with_paths(buckets: DataFrame, group: str) -> DataFrame:
    """(group, place, up) of all nodes of buckets (.., nodes, up): the siblings from the node to the top, level by level."""

    def run(batches):
        engine = Engine.get()
        for part in _parts(batches):
            flat = part.column("nodes").flatten()
            got = engine.walk(part, flat.field("h"), _PATHS)
            owner = pa.array(np.repeat(np.arange(part.num_rows), part.column("nodes").value_lengths().to_numpy()))
            yield pa.RecordBatch.from_arrays([part.column(group).take(owner), flat.field("place"), got.column("up").combine_chunks()], [group, "place", "up"])

    return mapped(buckets, run, f"place long, up {_PATH}", [group]).select(group, "place", "up")


def _beside(left: DataFrame, right: DataFrame, group: str, *on: tuple[str, str]) -> DataFrame:
    """``left`` with the other columns of ``right``, joined on the group, null or not, and pairs of equal columns."""
    a, b = left.alias("a"), right.alias("b")
    same = F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}"))
    for x, y in on:
        same &= F.col(f"a.{x}") == F.col(f"b.{y}")
    rest = [F.col(f"b.{c}") for c in right.columns if c != group and c not in [y for _, y in on]]
    return a.join(b, same).select(*(F.col(f"a.{c}") for c in left.columns), *rest)


def tables_of(nodes: DataFrame, group: str, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Bucket tables from (group, place, n, h, *carried) up, and (group, h): each group's root."""
    tables = []
    while True:
        buckets = materialize(bucketed(nodes, group, *(carried if not tables else ())), "buckets")
        tables.append(buckets)
        nodes = materialize(bucket_roots(buckets, group), "nodes")
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return tables, nodes.select(group, "h")


def paths_down(tables: list[DataFrame], tops: DataFrame, group: str) -> DataFrame:
    """The lowest buckets with ``up``, the siblings above each, from (group, up) of the roots."""
    above = tops
    for k, buckets in enumerate(reversed(tables)):
        buckets = _beside(buckets, above, group, *([("bucket", "place")] if k else []))
        if k == len(tables) - 1:
            return buckets
        above = materialize(with_paths(buckets, group), "paths")
    raise AssertionError("no table")


def manifest(leaves: DataFrame, group: str = "grp") -> DataFrame:
    """(group, place, *carried, leaf, subroot, root, proof_sha256, folded_root, verified) of (group, place, n, h, other, *carried).

    ``other`` is a digest to fold in place of the leaf, null for the leaf itself.
    """
    carried = [c for c in leaves.columns if c not in (group, "place", "n", "h")]
    tables, subroots = tables_of(leaves, group, *carried)
    subroots = materialize(subroots, "subroots")
    # the group roots are one more tree, of a group of its own
    tops = materialize(placed(subroots.withColumn("all", F.lit(0)), "all", group), "tops")
    outer, root = tables_of(tops.select("all", "place", "n", "h"), "all")
    start = root.select("all", F.expr(f"cast(array() as {_PATH})").alias("up"))
    outer = with_paths(paths_down(outer, start, "all"), "all")
    known = _beside(tops, outer, "all", ("place", "place")).join(root.withColumnRenamed("h", "root"), "all")
    known = materialize(known.select(group, "up", F.col("h").alias("subroot"), "root"), "known")
    low = paths_down(tables, known.select(group, "up"), group)
    low = _beside(low, known.select(group, "subroot", "root"), group)
    kinds = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    fields = ", ".join(f"`{c}` {kinds[c]}" for c in carried)
    names = ["place", *carried, "leaf", "proof_sha256", "folded_root"]

    def run(batches):
        engine = Engine.get()
        for part in _parts(batches):
            flat = part.column("nodes").flatten()
            other = flat.field("other").to_numpy(zero_copy_only=False)
            own = flat.field("h").to_numpy(zero_copy_only=False)
            got = engine.walk(part, pa.array([o or h for o, h in zip(other, own)], pa.string()), _PROOF)
            owner = pa.array(np.repeat(np.arange(part.num_rows), part.column("nodes").value_lengths().to_numpy()))
            keep = [part.column(c).take(owner) for c in (group, "subroot", "root")]
            each = [flat.field("place"), *(flat.field(c) for c in carried), flat.field("h"), got.column("proof").combine_chunks(), got.column("now").combine_chunks()]
            yield pa.RecordBatch.from_arrays([*keep, *each], [group, "subroot", "root", *names])

    out = mapped(low, run, f"place long, {fields}, leaf string, proof_sha256 string, folded_root string", [group, "subroot", "root"])
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def leaves_of(df: DataFrame, id_col: str, group_col: str, columns: list[str], tampered: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """(grp, place, n, h, id, other): the rows' leaves in their places; ``other`` where ``when`` is the leaf with ``tampered`` columns."""
    own = leaf(*(df[c] for c in columns))
    other = F.when(when, leaf(*((tampered or {}).get(c, df[c]) for c in columns))) if when is not None else F.lit(None).cast("string")
    each = df.select(df[group_col].cast("string").alias("grp"), df[id_col].cast("long").alias("id"), own.alias("h"), other.alias("other"))
    each = materialize(each.withColumn("nth", F.monotonically_increasing_id()), "leaves")  # equal rows too are dealt over partitions
    out = materialize(placed(each, "grp", "id", "h", "nth").drop("nth"), "placed")
    release(each)
    return out


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lowered = F.translate("text", UPPER, LOWER)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = leaves_of(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], {"text": lowered}, hit)
    out = manifest(leaves)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_ENCODED = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, c:
    list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, c)), 4294967295::BIGINT))"""
ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({_ENCODED.replace("{text}", "text")}) AS leaf,
    sha256({_ENCODED.replace("{text}", f"translate(text, '{UPPER}', '{LOWER}')")}) AS changed, {_CRC} % 3 = 0 AS hit FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
t(lang, lvl, i, h, n) AS (
  SELECT lang, 0, i, leaf, n FROM l
  UNION ALL SELECT lang, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY lang, lvl, i // 8, n),
sub AS (SELECT lang, lvl, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(lvl, i, h, n) AS (
  SELECT 0, i, h, n FROM sub
  UNION ALL SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY lvl, i // 8, n),
top AS (SELECT lvl, h FROM u WHERE n = 1),
tr AS (SELECT coalesce(lang, chr(0)) AS g, lvl, i // 8 AS r, string_agg(h, '' ORDER BY i) AS s FROM t WHERE n > 1 GROUP BY g, lvl, i // 8),
ur AS (SELECT lvl, i // 8 AS r, string_agg(h, '' ORDER BY i) AS s FROM u WHERE n > 1 GROUP BY lvl, i // 8),
w(doc_id, leaf, g, lvl, pos, now, told) AS (
  SELECT doc_id, leaf, coalesce(lang, chr(0)), 0::BIGINT, i, CASE WHEN hit AND changed IS NOT NULL THEN changed ELSE leaf END, '' FROM l
  UNION ALL
  SELECT doc_id, leaf, g, w.lvl + 1, pos // 8, sha256(s[1:64 * (pos % 8)] || now || s[64 * (pos % 8) + 65:]), told || s[1:64 * (pos % 8)] || s[64 * (pos % 8) + 65:]
  FROM w JOIN tr USING (g, lvl) WHERE tr.r = pos // 8),
w1 AS (SELECT w.*, sub.h AS subroot, sub.i FROM w JOIN sub ON g = coalesce(sub.lang, chr(0)) AND w.lvl = sub.lvl),
x(doc_id, leaf, subroot, lvl, pos, now, told) AS (
  SELECT doc_id, leaf, subroot, 0::BIGINT, i, now, told FROM w1
  UNION ALL
  SELECT doc_id, leaf, subroot, x.lvl + 1, pos // 8, sha256(s[1:64 * (pos % 8)] || now || s[64 * (pos % 8) + 65:]), told || s[1:64 * (pos % 8)] || s[64 * (pos % 8) + 65:]
  FROM x JOIN ur USING (lvl) WHERE ur.r = pos // 8)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(told) AS proof_sha256, now AS folded_root, now = top.h AS verified FROM x JOIN top USING (lvl)"""
