"""Every registered query against its DuckDB oracle (small scale), plus the driver entry point."""

import pytest

import __spark_entry__ as entry
from snapledger.plans import registry
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["order_key", "cust_key"]


def test_every_query_has_an_oracle():
    """Those of the library itself; queries of the llm subpackage have tests of their own."""
    missing = sorted(set(registry.all_queries()) - set(registry.all_oracles()))
    assert missing == []
    assert set(registry.all_queries()) <= set(entry.queries()) and set(registry.all_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.all_queries()))
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF, [key], verbose=True)[key]
    assert res[0] == "match", res


def test_no_python_evaluation_in_any_plan(spark):
    """Every registered query stays in the JVM: no (Arrow/batch) Python UDF nodes in its physical plan."""
    offenders = []
    for key, build in registry.all_queries().items():
        if key == "stream_scd2":          # runs a stream while building; its result is a Parquet read
            continue
        plan = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if "EvalPython" in plan or "PythonUDF" in plan:
            offenders.append(key)
    assert offenders == []
