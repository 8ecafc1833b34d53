"""Long pieces against tiktoken: the tape, its chunks and its time."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from foliospark.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe._vocabulary(None, None))


@pytest.fixture(scope="module")
def encoding(codec):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe._vocabulary(None, None)[1], mergeable_ranks=codec.ranks, special_tokens={})


def said(kind, n, seed=1):
    r = random.Random(seed)
    alphabet = {"few": "ab", "letters": "abcdefghijklmnopqrstuvwxyz", "run": "a", "signs": "-=_*#.", "code": "ACGT", "blanks": " ", "wide": "éüßñ東京語", "mixed": "aAbBeEtTnNoO"}
    if kind == "speech":
        words = "the of and tion ing in er internal configuration represent ation al re un der stand function address able ment".split()
        out = "".join(r.choice(words) for _ in range(n // 3))
        return out[:n]
    return "".join(r.choice(alphabet[kind]) for _ in range(n))


KINDS = ["few", "letters", "run", "signs", "code", "blanks", "wide", "mixed", "speech"]


def ids(codec, text):
    return codec.encode(pa.array([text])).to_pylist()[0]


@pytest.mark.parametrize("kind", KINDS)
def test_chunks_of_any_size(codec, encoding, kind, monkeypatch):
    """Small chunks and few bytes on the first query: every place waits at some edge."""
    monkeypatch.setattr(bpe, "SHORT", 8)
    for chunk, rows, seed in ((600, 4000, 1), (1 << 16, 1 << 20, 2), (700, 900, 3)):
        monkeypatch.setattr(bpe, "CHUNK", chunk)
        monkeypatch.setattr(bpe, "ROWS", rows)
        for n in (9, 60, 300, 3000):
            codec.known.clear()
            text = said(kind, n, seed)
            assert ids(codec, text) == encoding.encode_ordinary(text), (kind, n, chunk)


def test_many_pieces_on_one_tape(codec, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "SHORT", 4)
    codec.known.clear()
    text = " ".join(said(k, n, n) for n in range(5, 40) for k in KINDS if k != "blanks")
    assert ids(codec, text) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("kind", KINDS)
def test_a_megabyte(codec, encoding, kind):
    text = said(kind, 1_000_000)
    codec.known.clear()
    start = time.time()
    got = ids(codec, text)
    assert time.time() - start < 60, kind
    if kind not in ("run", "blanks"):  # the library's own time grows with the square of such a run
        want = encoding.encode_ordinary(text)
        assert got == want
    else:
        assert codec.decode(pa.array([got], pa.list_(pa.int32()))) == [text.encode()] and len(set(got)) <= 3
    assert not codec._mergeable(np.array(got, np.int32)).any()


def test_cache_is_bounded_by_bytes(codec, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 5000)
    codec.known.clear()
    codec.held = 0
    for k in range(40):
        ids(codec, said("letters", 400, k))
    assert codec.held == sum(len(p) + len(x) for p, x in codec.known.items()) < 9000
