"""Byte-level BPE encoding and decoding by DuckDB recursive queries, one connection a Python worker.

Encoding.  Text is split by the tokenizer's pattern.  Pieces that are a token
are looked up; the others become rows (word, position, token) of single bytes.
A recursive query joins neighbouring tokens with the merge table and contracts
the leftmost pair of least rank in each word, round by round; a word leaves when
no pair of it merges.  A query keeps the rows of all its rounds, so it ends after
``ROUNDS``.  Words that are not ready, and words of more than ``SHORT`` bytes, go
on one tape, with a barrier after each, and a second recursive query contracts in
a round every place that no pair of a lower rank can reach.  A token only ever
covers bytes that spell some token of the vocabulary, so the longest token that
the text spells from each byte bounds what a place can meet before it is
contracted: a place that has the least rank within that reach is contracted as
the leftmost-least order would.  Of overlapping equal places every other one is
taken, from the first on; a token that forms a pair of a lower rank than its own
(a *loud* one, found in the merge table) is made only where no equal place is in
reach on the left.  A reach is a few bytes in most texts and never more than the
longest token, so rounds hardly grow with a word's length.  The tape is worked in
chunks from the left: a place whose reach ends beyond the chunk waits, and what no
waiting place can reach is final, so memory hardly grows with a word either.  The
merge table holds every split of every token into two tokens, derived from the rank file when
a worker starts.  Each distinct piece is encoded once and kept in a bounded cache.

Decoding.  Rows (document, position, token) join the vocabulary; an aggregation
ordered by position puts the bytes together, a character up to U+00FF a byte.

Null or empty texts have no tokens and decode to no bytes; repeated rows are
each encoded; columns are named by the caller and no other column is read.
"""

from __future__ import annotations

import base64
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from foliospark.llm.common import gathered, mapped, quoted, slices

#: Bytes of text encoded at once, and pieces and bytes of pieces that are kept.
TEXT, CACHED, CACHED_BYTES = 4 << 20, 400_000, 64 << 20
#: Bytes of new pieces that one query encodes, and tokens that one query decodes; a longer piece or document takes a query alone.
ENCODED, DECODED = 1 << 19, 1 << 18
#: A query keeps the rows of all its rounds; words that take more, or have more bytes, go on the tape.
ROUNDS, SHORT = 24, 256
#: Tokens of a chunk of the tape, and rows that a query on it may keep.
CHUNK, ROWS = 1 << 16, 1 << 20
BARRIER = 256

# a row's key is its word and position in one number; ranks are doubled, odd ones are loud
_MERGE = f"""
WITH RECURSIVE s(g, tok, ended, r) AS (
  SELECT g, tok, false, 0 FROM fresh
  UNION ALL (
    WITH t AS MATERIALIZED (
      SELECT g, tok, r, (tok::BIGINT << 20) | lead(tok) OVER o AS pair, lead(g) OVER o AS after FROM s WHERE NOT ended AND r < {ROUNDS} WINDOW o AS (ORDER BY g)),
    best AS MATERIALIZED (
      SELECT g >> 24 AS w, min((k::BIGINT << 24) | (g & 16777215)) AS b, arg_min(after, (k::BIGINT << 24) | (g & 16777215)) AS gone
      FROM t JOIN merges USING (pair) WHERE after >> 24 = g >> 24 GROUP BY g >> 24)
    SELECT g, CASE WHEN (g & 16777215) = (b & 16777215) THEN (b >> 25)::INTEGER ELSE tok END, b IS NULL, r + 1
    FROM t LEFT JOIN best ON g >> 24 = w WHERE b IS NULL OR g <> gone))
SELECT g >> 24 AS w, list(tok ORDER BY g) AS ids, bool_and(ended) AS ended FROM s WHERE ended OR r = {ROUNDS} GROUP BY g >> 24 ORDER BY w"""

# rows are tokens by their first byte; (l, h) is what a place can meet whose second token starts there
_TAPE = """
WITH RECURSIVE s(pos, tok, l, h, r) AS (
  SELECT pos, tok, l, h, 0 FROM fresh
  UNION ALL (
    WITH p AS (
      SELECT pos, tok, l, h, r, row_number() OVER o AS n, tok::BIGINT * 1048576 + lead(tok) OVER o AS pair, lead(l) OVER o AS pl, lead(h) OVER o AS ph
      FROM s WHERE r < {rounds} WINDOW o AS (ORDER BY pos)),
    t AS MATERIALIZED (SELECT pos, tok, l, h, r, n, pl, ph, k FROM p LEFT JOIN merges USING (pair)),
    live AS (
      SELECT n, k, pl, lag(pos) OVER (PARTITION BY k ORDER BY n) AS same, n - row_number() OVER (PARTITION BY k ORDER BY n) AS run,
        k = min(k) OVER (ORDER BY pos RANGE BETWEEN greatest(pos - pl, 0) PRECEDING AND greatest(ph - 1 - pos, 0) FOLLOWING) AND ph <= {size} AS hit
      FROM t WHERE k IS NOT NULL),
    used AS MATERIALIZED (
      SELECT n, k FROM (SELECT *, row_number() OVER u AS nth, count(*) FILTER (NOT hit) OVER u AS missed FROM live WINDOW u AS (PARTITION BY k, run ORDER BY n))
      WHERE missed = 0 AND (nth & 1) = 1 AND ((k & 1) = 0 OR same IS NULL OR same < pl))
    SELECT pos, CASE WHEN u.k IS NULL THEN tok ELSE u.k >> 1 END, l, h, r + 1
    FROM t LEFT JOIN used u ON t.n = u.n LEFT JOIN used v ON t.n = v.n + 1 WHERE v.n IS NULL AND EXISTS (FROM used)))
SELECT pos, tok, r FROM s WHERE r = (SELECT max(r) FROM s) ORDER BY pos"""

_DECODE = "SELECT d, array_to_string(list(said ORDER BY i), '') AS said FROM coded JOIN vocabulary USING (id) GROUP BY d"


class Codec:
    """A vocabulary and what one worker has encoded with it."""

    _made: dict = {}

    @classmethod
    def get(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.held = 0
        pairs: dict[int, int] = {}
        loud: set[int] = set()
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[(left << 20) | right] = rank
                    loud.update(x for x in (left, right) if x > rank)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.size = np.ones(max(self.ranks.values()) + 2, np.int64)  # bytes of a token; the last entry is the barrier's
        self.size[list(self.ranks.values())] = [len(t) for t in self.ranks]
        self.longest = int(self.size.max())
        self.pairs = np.sort(np.fromiter(pairs, np.int64, len(pairs)))
        self.edges = None
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("m", pair=pa.array(pairs, pa.int64()), k=pa.array([2 * r + (r in loud) for r in pairs.values()], pa.int32()))
        self._table("v", id=pa.array(self.ranks.values(), pa.int32()), said=pa.array([t.decode("latin-1") for t in self.ranks]))
        self.db.execute("CREATE TABLE merges AS FROM m; CREATE TABLE vocabulary AS FROM v")
        self.db.unregister("m")
        self.db.unregister("v")

    def _table(self, name: str, **columns) -> None:
        self.db.register(name, pa.table(columns))

    def _contract(self, part: list[tuple[str, bytes]]) -> None:
        long = [(p, self.of_byte[np.frombuffer(b, np.uint8)]) for p, b in part if len(b) > SHORT]
        part = [x for x in part if len(x[1]) <= SHORT]
        if part:
            n = np.array([len(b) for _, b in part])
            tok = self.of_byte[np.frombuffer(b"".join(b for _, b in part), np.uint8)]
            of = np.repeat(np.arange(len(part)), n)
            self._table("fresh", g=pa.array((of << 24) | (np.arange(len(of)) - (np.cumsum(n) - n)[of])), tok=pa.array(tok))
            got = self.db.sql(_MERGE).to_arrow_table()
            ids, ended = got.column("ids").combine_chunks(), got.column("ended").to_numpy().tolist()
            flat, off = ids.values.to_numpy().astype(np.int32), ids.offsets.to_numpy().tolist()
            for (p, _), i, j, done in zip(part, off[:-1], off[1:], ended):
                if done:
                    self._keep(p, flat[i:j])
                else:
                    long.append((p, flat[i:j]))
        if long:
            for (p, _), ids in zip(long, self._tape([p for p, _ in long], [t for _, t in long])):
                self._keep(p, ids)

    def _keep(self, piece: str, ids: np.ndarray) -> None:
        self.known[piece] = ids.tobytes()
        self.held += len(piece) + 4 * len(ids)

    def _mergeable(self, tok: np.ndarray) -> np.ndarray:
        """Which tokens merge with the next one."""
        pair = tok[:-1].astype(np.int64) * (1 << 20) + tok[1:]
        at = np.searchsorted(self.pairs, pair)
        return self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair

    def _tape(self, words: list[str], tokens: list[np.ndarray]) -> list[np.ndarray]:
        """The ids of words from what has been contracted so far, from the left to the right."""
        tok = np.concatenate([x for t in tokens for x in (t, np.array([-1], np.int32))]).astype(np.int32)
        said = np.concatenate([x for w in words for x in (np.frombuffer(w.encode(), np.uint8).astype(np.uint16), np.array([BARRIER], np.uint16))])
        out, rest, first = [], tok[:0], 0
        for at in range(0, len(tok), CHUNK):
            rest = np.concatenate([rest, tok[at : at + CHUNK]])
            rest, done = self._chunk(rest, said, first, at + CHUNK >= len(tok))
            out.append(rest[:done])
            first += int(self.size[rest[:done]].sum())
            rest = rest[done:]
        tok = np.concatenate(out)
        parts = np.split(tok, np.flatnonzero(tok == -1))
        return [parts[0], *(x[1:] for x in parts[1:-1])]

    def _chunk(self, tok: np.ndarray, said: np.ndarray, first: int, last: bool) -> tuple[np.ndarray, int]:
        """Tokens from byte ``first`` of the tape on, contracted as far as their bytes tell, and how many of them nothing behind can change."""
        end = first + int(self.size[tok].sum())
        a = max(0, first - self.longest)
        reach = self._reach(said[a : end + self.longest]) + a
        if self._mergeable(tok).any():
            pos = first + np.cumsum(self.size[tok]) - self.size[tok]
            columns = {"pos": pos - first, "tok": tok, "l": np.searchsorted(reach, pos) + a - first, "h": reach[pos - a] - first}
            more = True
            while more:
                rounds = max(1, min(64, ROWS // len(columns["tok"])))
                self._table("fresh", **{n: pa.array(c) for n, c in columns.items()})
                got = self.db.sql(_TAPE.replace("{rounds}", str(rounds)).replace("{size}", str(end - first))).to_arrow_table()
                kept = got.column("pos").to_numpy()
                at = np.searchsorted(columns["pos"], kept)
                columns = {"pos": kept, "tok": got.column("tok").to_numpy().astype(np.int32), "l": columns["l"][at], "h": columns["h"][at]}
                more = got.column("r")[0].as_py() == rounds
            tok = columns["tok"]
        if last:
            return tok, len(tok)
        ends = first + np.cumsum(self.size[tok])
        live = np.flatnonzero(self._mergeable(tok))
        border = min(end, int(ends[live[0]])) if len(live) else end
        return tok, int(np.searchsorted(ends, np.searchsorted(reach, border) + a, "right"))

    def _reach(self, said: np.ndarray) -> np.ndarray:
        """For each byte the furthest end of a token that the bytes spell from it or from one before it."""
        if self.edges is None:  # the tree of all tokens as (node, byte) -> node, numbered by first sight
            number: dict[bytes, int] = {b"": 0}
            for token in self.ranks:
                for k in range(1, len(token) + 1):
                    number.setdefault(token[:k], len(number))
            steps = np.array([(number[t[:-1]] * 257 + t[-1], k) for t, k in number.items() if t], np.int64)
            whole = np.zeros(len(number), bool)
            whole[[number[t] for t in self.ranks]] = True
            order = np.argsort(steps[:, 0])
            self.edges = steps[order, 0], steps[order, 1], whole
        keys, to, whole = self.edges
        far = np.arange(1, len(said) + 1)
        at, node = np.arange(len(said)), np.zeros(len(said), np.int64)
        for depth in range(self.longest):
            inside = at + depth < len(said)
            at, node = at[inside], node[inside]
            key = node * 257 + said[at + depth]
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found = keys[k] == key
            at, node = at[found], to[k[found]]
            if not len(at):
                break
            done = at[whole[node]]
            far[done] = done + depth + 1
        return np.maximum.accumulate(far)

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces that are not known yet."""
        if len(self.known) > CACHED or self.held > CACHED_BYTES:  # the oldest half goes
            for p in list(islice(self.known, len(self.known) // 2 + 1)):
                self.held -= len(p) + len(self.known.pop(p))
        part, size = [], 0
        for p in pieces:
            if p not in self.known:
                b = p.encode()
                if (rank := self.ranks.get(b)) is not None:
                    self.known[p] = rank.to_bytes(4, "little")
                    self.held += len(p) + 4
                    continue
                if part and size + len(b) > ENCODED:
                    self._contract(part)
                    part, size = [], 0
                part.append((p, b))
                size += len(b)
        if part:
            self._contract(part)

    def encode(self, texts: pa.Array) -> pa.LargeListArray:
        pieces = [self.split(t) if t else [] for t in texts.to_pylist()]
        counts = np.array([len(p) for p in pieces], np.int64)
        coded = pa.array(chain.from_iterable(pieces), pa.large_string()).dictionary_encode()
        del pieces
        distinct = coded.dictionary.to_pylist()
        self._learn(distinct)
        missing = [p for p in distinct if p not in self.known]  # only if the cache was emptied meanwhile
        if missing:
            self._learn(missing)
        ids = [self.known[p] for p in distinct]
        size = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), np.int32)
        index = coded.indices.to_numpy().astype(np.int64)
        n = size[index]
        ends = np.cumsum(n)
        out = flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat((np.cumsum(size) - size)[index], n)]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(out, pa.int32()))

    def decode(self, ids: pa.Array) -> list[bytes]:
        out = [b""] * len(ids)
        n = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(n) // DECODED
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(ids)]):
            if b > a:
                some = ids.slice(a, b - a).flatten()
                self._table("coded", d=pa.array(np.repeat(np.arange(a, b), n[a:b])), i=pa.array(np.arange(len(some))), id=some)
                got = self.db.sql(_DECODE).to_arrow_table()
                for d, said in zip(got.column("d").to_pylist(), got.column("said")):
                    out[d] = said.as_py().encode("latin-1")
        return out


def _vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def _map(df: DataFrame, text: str, keep: list[str], extra: list[tuple[str, str]], make, path, pattern) -> DataFrame:
    """``keep`` of ``df`` with columns that ``make(codec, batch)`` gives, a few megabytes of rows at a time."""
    path, pattern = _vocabulary(path, pattern)
    names = [*keep, *(n for n, _ in extra)]

    def run(batches):
        codec = Codec.get(path, pattern)
        for batch in gathered(batches, text, TEXT) if text else batches:
            for part in slices(batch, text, TEXT) if text else [batch]:
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), *make(codec, part)], names)
        codec.known.clear()  # an idle worker keeps the vocabulary, not the pieces
        codec.held = 0

    return mapped(df, run, ", ".join(f"{quoted(n)} {t}" for n, t in extra), keep)


def _lists(ids: pa.Array) -> pa.Array:
    return ids.cast(pa.list_(pa.int32()))


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` and the token ids of a text column."""
    return _map(df, text_col, df.columns, [(ids_col, "array<int>")], lambda codec, part: [_lists(codec.encode(part.column(text_col)))], path, pattern)


def decode(df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` and the bytes that a column of token ids stands for; a null list has none."""
    return _map(df, "", df.columns, [(bytes_col, "binary")], lambda codec, part: [pa.array(codec.decode(part.column(ids_col)), pa.binary())], path, pattern)


def round_trip(df: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` without the text, with n_tokens and the SHA-256 of the ids and of the bytes decoded from them.

    Encodes and decodes in one worker; ids don't travel.
    """
    import hashlib

    sha = lambda b: hashlib.sha256(b).hexdigest()

    def digests(codec: Codec, part):
        ids = codec.encode(part.column(text_col))
        said = pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, ids.values.cast(pa.string())).cast(pa.list_(pa.string())), " ")
        return [
            pc.list_value_length(ids).cast(pa.int64()),
            pa.array([sha(x.as_buffer()) for x in said], pa.string()),
            pa.array([sha(x) for x in codec.decode(ids)], pa.string()),
        ]

    columns = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return _map(df, text_col, [c for c in df.columns if c != text_col], columns, digests, path, pattern)


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
