"""Media columns: documents as interleaved sequences of texts and media references.

HTML is parsed into one ordered array of structs (position, kind, text, ref,
caption): runs of text, and references (img, audio, video, source) with the
caption of the figure around them or else their alternative text.  References
by digest are resolved by a join with a media store on the digest and go back
to their positions, so order and captions stay aligned with the payloads.

The store keeps a payload as a mono WAV of 8-bit samples.  Payload bytes are
never shuffled: a task writes what it has, equal payloads may be stored by
several tasks, features are computed where the stored bytes are read back, and
only one small row of features a digest takes part in the join.

Null and empty texts are 64 zero bytes; equal texts have one digest, one
stored form and equal features; unresolved references keep null; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import struct
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import mapped, materialize, quoted, slices

BLOCK, RATE = 64, 8000
SEQUENCE = "array<struct<pos:int,kind:string,text:string,ref:string,caption:string>>"
_MEDIA, _SKIPPED, _VOID = {"img", "audio", "video", "source"}, {"script", "style", "template", "noscript"}, {"img", "source", "br", "hr", "meta", "link", "input"}
_BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "section", "article", "figure", "br", "ul", "ol", "table", "blockquote"}


class _Figure:
    """Where the media of an open figure are, and its captions."""

    def __init__(self):
        self.media: list[int] = []
        self.captions: list[str] = []


class _Parser(HTMLParser):
    """Text goes to the open caption or else to the running text; whatever is open at the end, or around what ends, is closed with it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self.text: list[str] = []
        self.skipped = 0
        self.figures: list[_Figure] = []
        self.caption: list[str] | None = None

    def _flush(self) -> None:
        said = " ".join("".join(self.text).split())
        self.text = []
        if said:
            self.items.append(["text", said, None, None])

    def _close_caption(self) -> None:
        if self.caption is not None:
            if said := " ".join("".join(self.caption).split()):
                self.figures[-1].captions.append(said)
            self.caption = None

    def _close_figure(self) -> None:
        self._close_caption()
        self._flush()
        figure = self.figures.pop()
        if said := " ".join(figure.captions):
            for k in figure.media:
                self.items[k][3] = said
            if not figure.media:  # a caption of nothing is text
                self.items.append(["text", said, None, None])

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self.skipped += 1
        elif tag == "figure":
            self._close_caption()
            self._flush()
            self.figures.append(_Figure())
        elif tag == "figcaption" and self.figures:
            self._close_caption()
            self._flush()
            self.caption = []
        elif tag in _MEDIA:
            own = dict(attrs)
            if own.get("src"):
                self._flush()
                if self.figures:
                    self.figures[-1].media.append(len(self.items))
                self.items.append(["media", None, own["src"], own.get("alt")])
        elif tag in _BLOCKS:
            self._break()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag == "figcaption":
            self._close_caption()
        elif tag == "figure" and self.figures:
            self._close_figure()
        elif tag in _BLOCKS:
            self._break()

    def _break(self) -> None:
        if self.caption is None:
            self._flush()
        else:
            self.caption.append(" ")

    def handle_data(self, data):
        if not self.skipped:
            (self.text if self.caption is None else self.caption).append(data)

    def result(self) -> list[dict]:
        while self.figures:
            self._close_figure()
        self._flush()
        return [dict(zip(("pos", "kind", "text", "ref", "caption"), (k, *x))) for k, x in enumerate(self.items)]


def parse_html(page: str | None) -> list[dict]:
    """The sequence of one page; broken markup never raises."""
    parser = _Parser()
    parser.feed(page or "")
    parser.close()
    return parser.result()


_ITEMS = pa.list_(pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))


def with_sequence(df: DataFrame, html_col: str = "html", out: str = "sequence") -> DataFrame:
    """``df`` and the interleaved sequence of an HTML column."""
    names = [*df.columns, out]

    def run(batches):
        for batch in batches:
            for part in slices(batch, html_col):
                items = pa.array([parse_html(x) for x in part.column(html_col).to_pylist()], _ITEMS)
                yield pa.RecordBatch.from_arrays([*part.columns, items], names)

    return mapped(df, run, f"{quoted(out)} {SEQUENCE}", df.columns)


# --- the store --------------------------------------------------------------


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 with zero bytes up to a positive multiple of 64, and the length without them."""
    raw = (text or "").encode()
    return raw + b"\0" * (max(1, -(-len(raw) // BLOCK)) * BLOCK - len(raw)), len(raw)


def to_wav(samples: bytes, rate: int = RATE) -> bytes:
    n = len(samples)
    return b"RIFF" + struct.pack("<I", 36 + n + n % 2) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", n) + samples + b"\0" * (n % 2)


def from_wav(stored: bytes) -> bytes:
    """The samples of a WAV, whatever chunks stand before them."""
    at = 12
    while at + 8 <= len(stored):
        name, n = stored[at : at + 4], struct.unpack("<I", stored[at + 4 : at + 8])[0]
        if name == b"data":
            return stored[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("no samples in this WAV")


def feature_of(samples: np.ndarray) -> str:
    wide = samples.astype(np.int64)
    steps = int(np.abs(np.diff(wide)).sum())
    return f"sum={int(wide.sum())};energy={int((wide * wide).sum())};steps={steps};peak={int(wide.max())};levels={int((np.bincount(samples, minlength=256) > 0).sum())}"


def store_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written rows (row, id, html, digest, n_bytes, media): a page that refers to the text's stored form, and that form.

    ``row`` numbers the rows as they are written, so repeated rows stay apart.
    """
    names = ["id", "html", "digest", "n_bytes", "media"]

    def run(batches):
        types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for part in slices(batch):
                out: list[list] = [[] for _ in names[1:]]
                for text in part.column("text").to_pylist():
                    samples, n = payload_of(text)
                    media = to_wav(samples)
                    digest = hashlib.sha256(media).hexdigest()
                    said = html.escape(f"{n} bytes of text")
                    page = f'<article><h1>Stored text</h1><figure><audio src="sha256:{digest}"></audio><figcaption>{said}</figcaption></figure><p>End</p></article>'
                    for o, x in zip(out, (page, digest, n, media)):
                        o.append(x)
                yield pa.RecordBatch.from_arrays([part.column("id"), *(pa.array(o, t) for o, t in zip(out, types))], names)

    docs = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))
    stored = mapped(docs, run, "html string, digest string, n_bytes long, media binary", ["id"])
    return materialize(stored.withColumn("row", F.monotonically_increasing_id()), "media")


FEATURES = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def media_features(store: DataFrame) -> DataFrame:
    """One row a digest, computed from the stored bytes read back."""
    names = ["digest", *FEATURES]

    def run(batches):
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for digest, stored in zip(batch.column("digest"), batch.column("media")):
                stored = stored.as_buffer().to_pybytes()
                samples = from_wav(stored)
                values = (
                    digest.as_py(), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-BLOCK:]),
                    len(stored), hashlib.sha256(stored).hexdigest(), feature_of(np.frombuffer(samples, np.uint8)),
                )
                for o, x in zip(out, values):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names)

    fields = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    rows = mapped(store.select("digest", "media"), run, fields)
    return materialize(rows.groupBy("digest").agg(*(F.first(c).alias(c) for c in FEATURES)), "features")


def resolve_media(sequences: DataFrame, features: DataFrame, row_cols: list[str], column: str = "sequence") -> DataFrame:
    """(row columns, pos, caption, digest and features): one row a reference, joined on its digest."""
    items = sequences.select(*row_cols, F.explode(column).alias("item")).filter("item.kind = 'media'")
    digest = F.when(F.col("item.ref").startswith("sha256:"), F.substring("item.ref", 8, 64))
    items = items.select(*row_cols, "item.pos", "item.caption", digest.alias("digest"))
    return items.join(features, "digest", "left")


def interleave(sequences: DataFrame, resolved: DataFrame, row_cols: list[str], value_cols: list[str], column: str = "sequence") -> DataFrame:
    """Puts resolved values back: each row's array of (item, value) in order; texts have a null value.  Row columns must be a key."""
    items = sequences.select(*row_cols, F.explode_outer(column).alias("item"))
    values = resolved.select(*row_cols, F.col("pos").alias("_pos"), F.struct(*value_cols).alias("value"))
    on = [items[c].eqNullSafe(values[c]) for c in row_cols]
    joined = items.join(values, [*on, items["item.pos"] == values["_pos"]], "left").select(*(items[c] for c in row_cols), "item", "value")
    return joined.groupBy(*row_cols).agg(F.sort_array(F.collect_list(F.struct("item.pos", "item", "value"))).alias(column))


def op5_media(spark, sf_dir: str) -> DataFrame:
    """Each text stored and referred to from a page; the page's sequence with what its reference resolves to."""
    store = store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    key = ["row", "id", "n_bytes"]
    sequences = with_sequence(store.select(*key, "html")).drop("html")
    resolved = materialize(resolve_media(sequences, media_features(store), key), "resolved")
    whole = interleave(sequences, resolved, key, FEATURES)
    media = F.element_at(F.filter("sequence", lambda x: x["item"]["kind"] == "media"), 1)
    return whole.select(F.col("id").alias("doc_id"), "n_bytes", media.alias("m"), F.size("sequence").alias("n_items")).select(
        "doc_id", "n_bytes", *(F.col("m.value")[c].alias(c) for c in FEATURES), F.col("m.pos").alias("pos"), F.col("m.item.caption").alias("caption"), "n_items"
    )


def page_sequences(spark, sf_dir: str) -> DataFrame:
    """The interleaved sequence of every web page: its items in order, references resolved where a stored text has their digest."""
    store = store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    sequences = materialize(with_sequence(pages).drop("html"), "sequences")
    resolved = resolve_media(sequences, media_features(store), ["page_id"])
    whole = interleave(sequences, resolved, ["page_id"], FEATURES)
    texts = F.transform(F.filter("sequence", lambda x: x["item"]["kind"] == "text"), lambda x: x["item"]["text"])
    items = F.size(F.filter("sequence", lambda x: x["item"].isNotNull()))
    return whole.select("page_id", items.cast("long").alias("n_items"), F.size(texts).cast("long").alias("n_texts"), F.sha2(F.array_join(texts, "\n"), 256).alias("text_sha256"))
