import random

import duckdb
import pytest
from support import documents
from test_language_id import corpus
from test_resemblance import edited, jaccard, plain_shingles
from test_simhash import plain_fingerprint

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm import queries, secret_scan, tables
from millrace.llm.tables import stash


def brute(rows):
    """What the first four stages keep, without Spark: (doc_id, text)."""
    letters = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    last = {t: max(d for d, x in letters if x == t) for _, t in letters}
    once = [(d, t) for d, t in letters if last[t] == d]
    fps, texts = [(d, plain_fingerprint(t)) for d, t in once], dict(once)
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(fps):
        for b, y in fps[i + 1 :]:
            if (x ^ y).bit_count() <= 4 or jaccard(*(plain_shingles(texts[i]) for i in (a, b))) >= 0.8:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((d, t.replace("24be64439e3e49cf46b2d7c90f3602a3d0b907ff", secret_scan.REDACTED)) for d, t in once if find(d) == d)


def test_stages_against_brute_force(spark):
    rows = corpus(120)
    text = rows[7][1]
    rows += [(200, text, "en", None, None), (201, text + " ", "en", None, None), (202, "12 34", "en", None, None), (203, None, "en", None, None), (204, rows[3][1] + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', "en", None, None)]
    rows += [(205, " ".join(t for _, t, *_ in rows[:120] if t) * 12, "en", None, None)]
    words = rows[-1][1].split()[:300]
    rows += [(300 + i, " ".join(edited(random.Random(i), words, 4)), "en", None, None) for i in range(5)]
    assert len(rows[-6][1]) > 200_000
    docs = documents(spark, rows)
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stash(stage(spark, docs, ""), "test")
        assert docs.columns == names
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == brute([r[:2] for r in rows])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r.doc_id for r in pieces.collect()} == {d for d, _ in brute([r[:2] for r in rows])}


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stash(stage(spark, docs, ""), "test")
        assert docs.count() == 0


def test_run_on_a_table(spark):
    before = set(tables.stashed())
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = set(tables.stashed()) - before
    assert out.count() > 100 and len(left) == 2 and any("stage-secret_scan" in path for path in left)


def test_contract():
    numbers = [int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    df = contract.queries()[name](spark, "/root/testdata/sf0.001")
    wanted = con.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(wanted.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})").fetchall())
