"""Helpers that the training-data operators share.

Words are maximal runs of characters other than U+0020 and U+0009-U+000D.
Rows are told apart inside an operator by the 128 bits ``(rid, rv)``: the
integer id (null becomes the smallest long) and a 64-bit hash of the text and
of whether there is an id, so repeated ids with different texts stay apart, a
null id never is the smallest long's, and repeated rows share one result.

Python stages get small Arrow batches, work on slices of texts and give memory
back when a task ends, for idle workers stay beside a JVM that needs it.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from foliospark.sources.scratch import materialize, release, scratch_dir, scratch_path  # noqa: F401

WORD_SPLIT = "[\\x20\\x09-\\x0D]+"
NULL_ID = -(2**63)
#: Texts are handled in slices of about this many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 2 << 20
#: Rows and bytes of an Arrow batch; sessions with larger batches are set to these.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(df: DataFrame) -> None:
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            conf.set(key, str(most))


def keyed(df: DataFrame, id_col: str, text_col: str, *more: str | Column) -> DataFrame:
    """Only (rid, rv, id, text) and ``more``: other columns of ``df``, whatever their names, stay out."""
    small_batches(df)
    i, t = df[id_col].cast("long"), F.coalesce(df[text_col].cast("string"), F.lit(""))
    more = [df[quoted(c)] if isinstance(c, str) else c for c in more]
    return df.select(F.coalesce(i, F.lit(NULL_ID)).alias("rid"), F.xxhash64(i.isNull(), t).alias("rv"), i.alias("id"), t.alias("text"), *more)


def with_row(df: DataFrame, *apart: str) -> DataFrame:
    """``apart`` and one struct ``row`` of all other columns, so that no name of theirs meets one of an operator's."""
    rest = [df[quoted(c)].alias(c) for c in df.columns if c not in apart]
    return df.select(*(df[quoted(c)] for c in apart), (F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))).alias("row"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def trim() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mapped(df: DataFrame, run, fields: str, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """``run`` over the Arrow batches of ``df``; the result's columns are ``keep`` of ``df`` and then ``fields``."""
    small_batches(df)
    schema = StructType([StructField(f.name, f.dataType) for f in (df.schema[c] for c in keep)] + _parse_datatype_string(fields).fields)

    def all_batches(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(all_batches, schema)


def words_of(text: Column) -> Column:
    """The words of a text, natively."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), WORD_SPLIT)
    return (
        F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    ).cast("long")


# --- numpy side -----------------------------------------------------------

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    return x ^ (x >> np.uint64(33))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """Parts of a batch with about ``most`` bytes of text each, at least one row."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def gathered(batches, column: str, most: int):
    """Small batches as larger ones with ``most`` bytes of text or a little more."""
    some, size = [], 0
    for batch in batches:
        some.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, size = [], 0
    if size or some:
        yield from pa.Table.from_batches(some).combine_chunks().to_batches()


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words begin (one more entry than texts)."""
    import xxhash

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    flat = flat.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    if lower:
        distinct = [w.encode().lower() for w in distinct]  # A-Z only; the Arrow kernel for it is wrong on sliced arrays
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), dtype=np.uint64, count=len(distinct))
    return (table[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64)), offsets


class Rolling:
    """Hashes of word windows of any length, from prefix sums modulo 2**64."""

    def __init__(self, words: np.ndarray, base: int):
        n, b = len(words), np.uint64(base)
        with np.errstate(over="ignore"):
            up, down = np.full(n + 1, b, np.uint64), np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
            up[0] = down[0] = 1
            np.multiply.accumulate(up, out=up)
            self.down = np.multiply.accumulate(down)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(words + b) * up[:n], out=self.sums[1:])

    def at(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start] + np.asarray(length).astype(np.uint64))


BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def compress_text(df: DataFrame, *keep: str) -> DataFrame:
    """``text`` becomes zstd bytes ``z``: what a shuffle has to carry."""
    names = list(keep)

    def run(batches):
        import zstandard

        c = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch):
                z = [c.compress((t.as_py() or "").encode()) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(z, pa.binary())], [*names, "z"])

    return mapped(df.select(*map(quoted, names), "text"), run, "z binary", names)


def unpacked(batch: pa.RecordBatch, column: str = "z"):
    """The rows of a batch one by one, with the text of their zstd bytes."""
    import zstandard

    un = zstandard.ZstdDecompressor()
    for row, z in enumerate(batch.column(column)):
        yield row, un.decompress(z.as_buffer())
