import duckdb
import pytest

import __spark_entry__ as contract
from millrace import plans
from millrace.sources import sequence

LINES = ["Starting the application...", *(f"Processing step {k}..." for k in range(1, 6)), "Result: Done!"]


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_matches_sql(spark, name, sf):
    df = contract.queries()[name](spark, f"/root/testdata/sf{sf}")
    expected = duckdb.sql(contract.oracle_sql()[name])
    assert df.columns == expected.columns
    assert sorted(map(tuple, df.collect())) == sorted(expected.fetchall())


def test_transcript_is_in_order(spark):
    assert [r.line for r in plans.QUERIES["transcript"](spark, "").collect()] == LINES


def test_entry_and_empty_sequence(spark):
    assert [r.i for r in contract.entry(spark).collect()] == [0, 1, 2, 3, 4]
    assert sequence(spark, 0).count() == 0 == sequence(spark, -3).count()


def test_steps_need_no_shuffle(spark):
    plan = plans.QUERIES["steps"](spark, "")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
