"""Packed token ids by best-fit decreasing over the whole table.

Documents are tokenized, ended with ``end_id`` and cut, where they are longer
than a row, into pieces, none of them lost: whole rows first, the rest packed
with others.  Best fit decreasing needs only how many pieces there are of each
size, so the histogram of sizes - ``length`` numbers at most, whatever the table
- gives the plan for all rows at once: longest first, a piece goes into the row
with the least room that still holds it, and as many rows as have the same room
are filled in one step.  That room is found by a segment tree over the
capacities 0 to ``length``, which knows below which node a row is open.

A piece is then placed by its number among the pieces of its size: the pieces of
a size in a slot (a hash of document and place) are numbered, after those of
all slots before.  Every piece so knows its row, and a shuffle by row brings a
row's pieces together, ``length`` tokens at most; on the way ids are zstd bytes.  The result doesn't depend on
how the table is split.

A packed row has its ids as a matrix row of ``length`` little-endian 16- or
32-bit integers, filled up with ``end_id``; the cumulative segment lengths; the
places where positions start again at 0, and the positions themselves; and for
each segment its document and the place of its first token in it.
``save_matrices`` writes them as .npy files.

Null and empty texts are one end token.  Repeated rows are packed each; a null
id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import keyed, mapped, materialize, slices

LENGTH, END_ID = 2048, 50256
#: Pieces of one size in a slot, about.
SLOT_PIECES = 1 << 10


class Capacities:
    """Ranges of open rows by their room; a tree over all rooms finds the least that is enough."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, rows: tuple[int, int]) -> None:
        if room and rows[1]:
            self.rows.setdefault(room, []).append(rows)
            self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, tuple[int, int]] | None:
        """A range of rows with the least room of at least ``need``, which are then no longer open."""
        node = need + self.leaves
        while not self.count[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


class Step:
    """Pieces ``rank`` .. of one size go, ``each`` a row, into rows ``row`` .. behind what is there."""

    def __init__(self, rank: int, each: int, row: int, used: int):
        self.rank, self.each, self.row, self.used = rank, each, row, used


def best_fit_plan(counts: dict[int, int], length: int) -> tuple[dict[int, list[Step]], int]:
    """The steps for the pieces of each size, in the order of their ranks, and the number of rows.

    A row that got a piece and can take another of that size then has the
    least room of all that can, so a row takes ``room // size`` pieces in turn.
    """
    open_, total, plan = Capacities(length), 0, {}
    for size in sorted(counts, reverse=True):
        steps, rank, left = [], 0, counts[size]
        while left:
            found = open_.take(size)
            room, (row, rows) = found if found else (length, (total, -(-left // (length // size))))
            each = room // size
            full = min(rows, left // each)
            if full:
                steps.append(Step(rank, each, row, length - room))
                open_.add(room - each * size, (row, full))
            rank, left = rank + full * each, left - full * each
            done = full
            if left and done < rows:  # fewer pieces are left than one more row takes
                steps.append(Step(rank, left, row + done, length - room))
                open_.add(room - left * size, (row + done, 1))
                rank, left, done = rank + left, 0, done + 1
            if found:
                open_.add(room, (row + done, rows - done))
            else:
                total += rows
        plan[size] = steps
    return plan, total


_encoders: dict = {}


def tokenizer(path: str, pattern: str):
    if (path, pattern) not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        _encoders[path, pattern] = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


SCHEMA = "row_no long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, positions binary, doc_ids array<long>, doc_starts array<int>"


def _width(end_id: int) -> np.dtype:
    return np.dtype("<u2") if end_id < 1 << 16 else np.dtype("<u4")


def _pieces(path: str, pattern: str, length: int, end_id: int):
    kind, names = _width(end_id), ["rid", "rv", "id", "at", "n", "ids"]

    def run(batches):
        import zstandard

        encode, pack = tokenizer(path, pattern), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch):
                rows, at, own = [], [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ids = np.append(encode.encode_to_numpy(text, disallowed_special=()).astype(kind), kind.type(end_id))
                    for a in range(0, len(ids), length):
                        rows.append(k)
                        at.append(a)
                        own.append(ids[a : a + length])
                of = pa.array(rows, pa.int32())
                sizes = pa.array([len(x) for x in own], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(of) for c in names[:3]), pa.array(at, pa.int32()), sizes, pa.array([pack(x.tobytes()) for x in own], pa.binary())], names
                )

    return run, "rid long, rv long, id long, at int, n int, ids binary"


def _placed(plan: dict[int, list[Step]]):
    """(row_no, used) of the pieces (n, rank): where each goes and how many tokens stand before it."""
    tables = {n: np.array([(s.rank, s.each, s.row, s.used) for s in steps], np.int64) for n, steps in plan.items()}

    def run(batches):
        for batch in batches:
            n, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "rank"))
            row, used = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for size in np.unique(n):
                of, steps = np.flatnonzero(n == size), tables[int(size)]
                first, each, to, before = steps[np.searchsorted(steps[:, 0], rank[of], side="right") - 1].T
                row[of], used[of] = to + (rank[of] - first) // each, before + (rank[of] - first) % each * size
            kept = [batch.column(c) for c in ("id", "at", "ids")]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(used.astype(np.int32)), *kept], ["row_no", "used", "id", "at", "ids"])

    return run, "row_no long, used int, id long, at int, ids binary"


def _assembled(length: int, end_id: int):
    kind, names = _width(end_id), [x.split()[0] for x in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row_no, pieces in zip(batch.column("row_no").to_pylist(), batch.column("pieces").to_pylist()):
                own = [np.frombuffer(unpack(p["ids"]), kind) for p in pieces]
                n = [len(x) for x in own]
                ends = np.cumsum(n)
                ids, at = np.full(length, end_id, kind), np.zeros(length, kind)
                ids[: ends[-1]] = np.concatenate(own)
                at[: ends[-1]] = np.concatenate([np.arange(k) for k in n])
                values = (row_no, int(ends[-1]), ids.tobytes(), [0, *ends.tolist()], [0, *ends[:-1].tolist()], at.tobytes(), [p["id"] for p in pieces], [p["at"] for p in pieces])
                for o, x in zip(out, values):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names)

    return run, SCHEMA


def pack_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    path: str | None = None,
    pattern: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """The packed rows of a table of texts."""
    import public_tokenizers

    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    pieces = materialize(mapped(keyed(df, id_col, text_col), *_pieces(path, pattern, length, end_id)), "pieces")
    counts = {r.n: r.c for r in pieces.groupBy("n").agg(F.count("*").alias("c")).collect()}  # a row a size, ``length`` at most
    plan, _ = best_fit_plan(counts, length)
    slots = F.lit(np.array([counts.get(n, 0) // SLOT_PIECES + 1 for n in range(length + 1)], np.int64))  # a frequent size has more of them
    slotted = pieces.withColumn("slot", F.pmod(F.xxhash64("rid", "rv", "at"), F.get(slots, F.col("n"))))
    sums = slotted.groupBy("n", "slot").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("n").orderBy("slot")) - F.col("c")
    sums = materialize(sums.select("n", "slot", before.alias("before")), "slots")
    numbered = slotted.withColumn("k", F.row_number().over(Window.partitionBy("n", "slot").orderBy("rid", "rv", "at")))
    ranked = numbered.join(sums, ["n", "slot"]).select("n", (F.col("before") + F.col("k") - 1).alias("rank"), "id", "at", "ids")
    rows = mapped(ranked, *_placed(plan)).groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("used", "id", "at", "ids"))).alias("pieces"))
    return mapped(rows, *_assembled(length, end_id))


def save_matrices(packed: DataFrame, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes rows as .npy files - ``ids`` and ``positions`` matrices, ``cu_seqlens`` and ``rows`` vectors - and gives (file, n_rows).

    ``folder`` is a URI that pyarrow can open on every executor.  A file is
    written aside and then moved, under a name of its own; the manifest that
    this returns says which ones count, so a task that runs again harms nothing.
    """
    kind = _width(end_id)

    def run(batches):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        for batch in batches:
            name = f"part-{uuid.uuid4().hex}"
            matrix = lambda c: np.stack([np.frombuffer(x.as_buffer(), kind) for x in batch.column(c)])
            cuts = [np.array(x, np.int32) for x in batch.column("cu_seqlens").to_pylist()]
            parts = {
                "ids": matrix("ids"), "positions": matrix("positions"), "cu_seqlens": np.concatenate(cuts),
                "rows": np.cumsum([0, *(len(x) for x in cuts)]), "doc_ids": np.array([-1 if d is None else d for x in batch.column("doc_ids").to_pylist() for d in x]),
            }
            for what, values in parts.items():
                data = io.BytesIO()
                np.save(data, values)
                with store.open_output_stream(f"{top}/_{name}.{what}") as out:
                    out.write(data.getvalue())
                store.move(f"{top}/_{name}.{what}", f"{top}/{name}.{what}.npy")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([batch.num_rows])], ["file", "n_rows"])

    return materialize(mapped(packed.select("ids", "positions", "cu_seqlens", "doc_ids"), run, "file string, n_rows long"), "manifest")


def unpack_tokens(packed: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): the token ids of every document again, without the end token.  Ids have to be unique."""
    width = 2 if end_id < 1 << 16 else 4

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{width}").astype(np.int32)
                cuts = r["cu_seqlens"]
                own = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["doc_starts"], pa.int32()), pa.array(own, pa.list_(pa.int32()))], ["doc_id", "start", "piece"]
                )

    pieces = packed.select("ids", "cu_seqlens", "doc_ids", "doc_starts").mapInArrow(run, "doc_id long, start int, piece array<int>")
    whole = pieces.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["piece"]))
    return whole.select("doc_id", F.slice(ids, 1, F.size(ids) - 1).alias("ids"))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
