"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from foliospark.llm.merkle import leaves_of, manifest, op12_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place int, h string, grp string, up string, `all` int"
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(i, source, lang, n, text):
    parts = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)]
    return SHA("".join(parts))


def climb(digests):
    """(root, path of every node: the left and right siblings of each level)."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, p in enumerate(at):
            run = digests[p // 8 * 8 : p // 8 * 8 + 8]
            paths[k].append(("".join(run[: p % 8]), "".join(run[p % 8 + 1 :])))
            at[k] = p // 8
        digests = [SHA("".join(digests[a : a + 8])) for a in range(0, len(digests), 8)]
    return digests[0], paths


def brute(rows):
    ascii_lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    made = {}
    for lang, some in groups.items():
        each = sorted(((i is not None, i or 0, leaf(i, s, lang, n, t), i, s, n, t) for i, t, _, s, n in some))
        made[lang] = (each, *climb([x[2] for x in each]))
    langs = sorted(made, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = climb([made[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, tops):
        each, subroot, paths = made[lang]
        for (_, _, own, i, s, n, t), path in zip(each, paths):
            now = leaf(i, s, lang, n, ascii_lower(t)) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else own
            for left, right in path + top:
                now = SHA(left + now + right)
            out.append((i, own, subroot, root, SHA("".join(a + b for a, b in path + top)), now, now == root))
    return sorted(out, key=str)


def rows_of(seed=2):
    r = random.Random(seed)
    say = lambda k: r.choice([None, "", "Ab c", "ABC é", "x" * 40, f"Text {k} of", f"{k} plain"])
    sizes = {"en": 1300, "de": 513, "fr": 512, None: 9, "": 1, "é": 8, "zz": 65, "a1": 64, "a2": 1, "a3": 2}
    rows, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((r.randrange(-5000, 5000) if k % 40 else None, say(k), lang, r.choice([None, "s", "t u"]), r.choice([None, 3, 0])))
            k += 1
    return rows + [rows[3], rows[3], rows[5]]


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, "h", "g", "u", 2) for x in rows], SCHEMA)


def test_brute_force(spark, tmp_path):
    rows = rows_of()
    frame(spark, rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_merkle(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)
    assert {x[-1] for x in got} == {True, False}


def test_three_tables_of_one_group_with_one_hot_id(spark):
    """More than 8**6 leaves: roots of buckets of buckets; most rows have one id, and a third are equal."""
    n = (1 << 18) + 700
    i = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 8).otherwise(F.col("id"))
    df = spark.range(n).select(i.alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 1, F.col("id")).alias("v"))
    leaves = leaves_of(df, "doc_id", "lang", ["doc_id", "v"])
    out = manifest(leaves).select("place", "leaf", "root", "proof_sha256", "verified").collect()
    assert len(out) == n and all(r["verified"] for r in out) and sorted(r["place"] for r in out) == list(range(n))
    by = sorted(out, key=lambda r: r["place"])
    root, paths = climb([r["leaf"] for r in by])
    assert {r["root"] for r in out} == {root}
    for k in (0, 511, 512, 4095, n // 2, n - 1):
        assert by[k]["proof_sha256"] == SHA("".join(a + b for a, b in paths[k]))


def test_one_row_and_none(spark, tmp_path):
    frame(spark, [(5, "A", "en", "s", 1)]).write.parquet(f"{tmp_path}/one/documents.parquet")
    assert list(map(tuple, op12_merkle(spark, f"{tmp_path}/one").collect())) == brute([(5, "A", "en", "s", 1)])
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_merkle(spark, f"{tmp_path}/none").collect() == []
    frame(spark, [(None, None, None, None, None)]).write.parquet(f"{tmp_path}/null/documents.parquet")
    assert list(map(tuple, op12_merkle(spark, f"{tmp_path}/null").collect())) == brute([(None,) * 5])
    long = [(1, "L" * 9_000_000, "en", "s", 1), (2, "", "en", "s", 1)]
    frame(spark, long).write.parquet(f"{tmp_path}/long/documents.parquet")
    assert sorted(map(tuple, op12_merkle(spark, f"{tmp_path}/long").collect()), key=str) == brute(long)
