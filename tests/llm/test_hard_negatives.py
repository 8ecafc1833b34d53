"""Hard negatives against sorted lists of exact integer scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foliospark.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, rv long, q string, rows int, block long, anchor string, rank int"


def frame(spark, rows):
    vector = lambda v: v and [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, vector(v), label, 1, "q", 2, 3, "a", 4) for i, v, label in rows], SCHEMA)


def brute(rows, every=100, move=True, k=5):
    fit = set()
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if move and i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        fit.add((i, tuple(math.floor(256 * x) for x in v), label))
    out = []
    order = lambda s, x: (-s, x[0] is None, x[0] or 0)
    for a in fit:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[1], b[1])), b) for b in fit if b != a), key=lambda t: order(*t))
        for p, b in [t for t in scored if t[1][2] == a[2]][:k]:
            some = [(s, c) for s, c in scored if c[2] != a[2] and 80 * p <= 100 * s <= 100 * p][:k]
            out += [(a[0], b[0], n, c[0], p, s) for n, (s, c) in enumerate(some, 1)]
    return sorted(out, key=str)


def mined(df, every=100, move=True):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")) if move else "label"
    out = H.hard_negatives(df, F.col("vec_id") % every == 0, label=label)
    return sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def some_rows(n=700, d=6, seed=4, spread=0.4):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0.2, spread), 2) for _ in range(d)], r.randrange(10)) for i in range(n)]


def test_brute_force_with_awkward_rows(spark):
    rows = some_rows()
    rows += [rows[3], rows[100], (701, None, 1), (702, [1.0, None, 0, 0, 0, 0], 1), (703, [float("nan")] * 6, 1), (704, [float("inf")] + [0.0] * 5, 1)]
    rows += [(705, [0.3] * 6, None), (None, rows[200][1], rows[200][2]), (706, [], 1), (800, [], 1), (707, [0.5, 0.5], 3), (708, [0.4] * 9, 3), (-100, [0.2] * 6, -3), (900, [0.0] * 6, 5)]
    want = brute(rows)
    assert mined(frame(spark, rows).repartition(3)) == want
    assert len(want) > 100


def test_ties_go_by_id(spark):
    """One vector that a third of all rows share, in all labels."""
    rows = [(i, [0.25, 0.5, 0.25], i % 4) if i % 3 == 0 else x for i, x in enumerate(some_rows(900, 3, spread=0.05))]
    want = brute(rows)
    assert mined(frame(spark, rows)) == want and want


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = some_rows(400, 4, seed=9)
    want = brute(rows, every=20)
    for values, anchors in ((1 << 22, 1 << 20), (200, 30)):
        monkeypatch.setattr(H, "BLOCK_VALUES", values)
        monkeypatch.setattr(H, "ANCHOR_VALUES", anchors)
        assert mined(frame(spark, rows), every=20) == want


def test_large_components_stay_exact(spark):
    for scale in (2.0**18, 2.0**22):  # beyond 2**53 the products are 64-bit, then unbounded integers
        rows = [(i, [x * scale for x in v], label % 3) for i, v, label in some_rows(60, 5, seed=8)]
        assert mined(frame(spark, rows), every=10) == brute(rows, every=10)
    with pytest.raises(Exception, match="does not fit"):
        mined(frame(spark, [(0, [2.0**40] * 2, 1), (1, [2.0**40] * 2, 1)]))
    with pytest.raises(Exception, match="too large"):
        mined(frame(spark, [(0, [1e200], 1), (1, [1.0], 1)]))


def test_negative_scores_and_few_rows(spark):
    rows = [(0, [-1.0], 1), (1, [1.0], 1), (2, [1.0], 2), (3, [0.9], 3)]
    assert mined(frame(spark, rows), move=False) == brute(rows, move=False)
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(0, [1.0], 1)])) == []


def test_query(spark, tmp_path):
    rows = some_rows(500)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, H.op13_hard_negatives(spark, str(tmp_path)).collect()), key=str) == brute(rows)
