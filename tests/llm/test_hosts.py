"""Frequent lines by host, where they bite, beside the SQL."""

import duckdb

from foliospark.llm import quality_rules

LETTERS = str.maketrans("0123456789", "abcdefghij")


def say(i, n):
    return " ".join(f"q{i}_{k}".translate(LETTERS) for k in range(n))


def corpus():
    """On host a 30 documents share a footer, on host b one; rows 40 on have one id and text in both hosts, or in none."""
    rows = [(i, f"{say(i, 60)}\nall rights reserved {i % 10}", "a") for i in range(30)]
    rows += [(100 + i, say(100 + i, 70), "b") for i in range(30)]
    both = f"{say(500, 60)}\nAll  rights reserved 7"
    rows += [(40, both, "a"), (40, both, "b"), (41, f"{say(501, 55)}\nall rights reserved 1", None), (41, f"{say(501, 55)}\nall rights reserved 1", "a")]
    rows += [(42, "short words here\n" + "\n".join(["all rights reserved 5"] * 40), "a"), (43, "short words here\n" + "\n".join(["all rights reserved 5"] * 40), "b")]
    return rows + [rows[0], (None, both, "a"), (None, both, "b")]


def test_one_text_in_two_hosts(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string")
    got = quality_rules.apply_quality_rules(df, keep=("source",)).collect()
    assert len(got) == len(corpus())
    lines = {42: 40, 43: 40}
    for r in got:
        has = r.source == "a" and (r.id is None or r.id < 100)  # only on host a the line is above the limit
        has = has and "reserved" in next(t for i, t, s in corpus() if (i, s) == (r.id, r.source))
        assert r.removed_words == 4 * lines.get(r.id, 1) * has, r
        assert not (has and "reserved" in r.kept_text)
    assert {(r.id, r.source, r.removed_words) for r in got if r.id in (40, None)} == {(40, "a", 4), (40, "b", 0), (None, "a", 4), (None, "b", 0)}


def test_the_limit_ends(spark):
    """With a share that grows beyond ``most_docs``, a line in more documents than that is boilerplate all the same."""
    df = spark.createDataFrame([(i, f"{say(i, 60)}\nfooter text" if i < 40 else say(i, 60), "h") for i in range(60)], "doc_id long, text string, source string")
    removed = lambda most: sum(r.removed_words for r in quality_rules.apply_quality_rules(df, line_share=0.9, most_docs=most).collect())
    assert (removed(1000), removed(30)) == (0, 80)


def test_sql_where_lines_go(spark, tmp_path):
    """The query's SQL on a table on which lines are removed and documents rejected for it."""
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({(i, s): (i + (1000 if s == "b" else 2000 if s is None else 0), t, s) for i, t, s in rows}.values())
    rows += [(3000 + i, f"{say(3000 + i, 24)}\n" + "\n".join(f"common line {'abcdefgh'[k]} of this host" for k in range(6)), "c") for i in range(25)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = quality_rules.op9_quality_rules(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(quality_rules.ORACLE_SQL).to_arrow_table().select(sorted(got.columns)).to_pylist()
    by = lambda rows: sorted(tuple(r[c] for c in sorted(got.columns)) for r in rows)
    mine = by([r.asDict() for r in got.collect()])
    assert mine == by(want)
    assert sum(r["removed_words"] for r in want) > 200 and any(not r["kept"] and not r["base_failed"] for r in want)
