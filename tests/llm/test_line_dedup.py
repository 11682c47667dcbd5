"""Lines left against a plain version, runs that merge, few and many common keys, odd rows."""
import random
from collections import defaultdict

import pytest
from support import LONG, ROWS, documents, empty

from millrace.llm import line_dedup as ld
from millrace.llm import tables

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least_length=40, least_documents=5):
    holders = defaultdict(list)
    for doc, text, *_ in rows:
        for key in {plain_key(x) for x in (text or "").split("\n")}:
            if len(key) >= least_length:
                holders[key].append(doc)
    keeps = {k: max(x for x in d if x is not None) for k, d in holders.items() if len(d) >= least_documents and any(x is not None for x in d)}
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeps.get(plain_key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)


def corpus(n=120, seed=0):
    rng = random.Random(seed)
    common = [f"A line number {i} that is found in many documents, Ünïcödé too" for i in range(12)] + ["Ü" * 40, "ü" * 40, "x" * 39, "x" * 40, "é" * 39]
    rows = []
    for i in range(n):
        lines = [f"own line {i} {j} of this document and of no other one" for j in range(rng.randint(0, 3))]
        for line in rng.sample(common, rng.randint(0, 4)):
            lines += [rng.choice(["", " ", "\t\x0b"]) + (line.upper() if line.isascii() and rng.random() < 0.3 else line) + rng.choice(["", "\r", "  "])] * rng.randint(1, 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines + [""] * rng.randint(0, 1)), "en", None, None))
    hot = "one line that a third of all documents holds, and which is long enough"
    return [(d, t + "\n" + hot if d % 3 == 0 else t, *x) for d, t, *x in rows]


def odd():
    line = "a line of more than forty code points, held by rows without an id"
    return ROWS + [(None, line, *[None] * 3)] * 6 + [(3000, "y" * 50, *[None] * 3)] * 6 + [(3001, "z" * 50 + "\n" + LONG, *[None] * 3), (None, "y" * 50, *[None] * 3), (2999, "Y" * 50 + "\nleft", *[None] * 3), (2998, "y" * 50, *[None] * 3)]


@pytest.mark.parametrize("common", [0, 250_000])
@pytest.mark.parametrize("batches", [1, 7])
def test_against_a_plain_version(spark, monkeypatch, common, batches):
    monkeypatch.setattr(ld, "COMMON", common)
    rows = corpus() + odd()
    before = tables.stashed()
    assert got(ld.line_dedup(documents(spark, rows).repartition(12), batches=batches)) == plain(rows)
    tables.discard(spark, [x for x in tables.stashed() if x not in before])
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("millrace_")]


def test_empty_table(spark):
    assert ld.line_dedup(empty(spark)).count() == 0


def test_runs_hold_each_key_once_and_levels_merge(spark):
    runs, rng, held, sizes = ld.LineRuns(spark, buckets=3, fanout=2), random.Random(1), {}, []
    for b in range(5):
        own = {(rng.randrange(20), 7): (rng.randint(1, 3), rng.randrange(1000)) for _ in range(8)}
        batch = runs.add(spark.createDataFrame([(*k, *v) for k, v in own.items()], "h1 long, h2 long, n long, winner long"))
        assert {(r.h1, r.h2) for r in batch.where("new").collect()} == set(own) - set(held)
        for k, (n, w) in own.items():
            m, x = held.get(k, (0, -1))
            held[k] = (m + n, max(x, w))
        keys = [(r.h1, r.h2) for run in runs.runs for r in run.collect()]
        assert len(keys) == len(set(keys)) and set(keys) == set(held)
        sizes.append([len(level) for level in runs.levels])
    assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    found = {(r.h1, r.h2): r.winner for r in runs.common(4).collect()}
    assert found == {k: w for k, (n, w) in held.items() if n >= 4}


def test_batches_are_merged_without_a_shuffle(spark):
    """The batch is dealt by hash once; runs are read in their buckets."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = ld.LineRuns(spark)
        keys = spark.range(1000).selectExpr("id h1", "id h2", "1L n", "id winner")
        runs.add(keys)
        second = runs.runs[0].join(runs.add(keys.selectExpr("h1 + 500 h1", "h2 + 500 h2", "n", "winner")).where("new").select(*ld.HASH), ld.HASH, "left_anti")
        assert second.count() == 1000 and "Exchange hashpartitioning" not in second._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
