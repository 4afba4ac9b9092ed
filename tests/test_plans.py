"""Plan-shape assertions: no Python UDFs, no single-partition exchange in
the ranking plans, pushdown and pruning reach the scans, entry() runs."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerlens.queries import queries

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - {"pipeline_fact"}))
def test_no_python_udf(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["dim_customers", "vw_customer_dim", "customer_segments",
                                  "rfm_quantile", "monthly_revenue", "fct_sales", "base_measures"])
def test_no_single_partition_exchange(spark, name):
    df = queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    assert "SinglePartition" not in _plan(df), name


def test_pushdown_and_pruning(spark):
    ev = queries()["events_after_hwm"](spark, SF_SMALL)
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    stg = _plan(queries()["stg_sales"](spark, SF_SMALL))
    assert "l_tax" not in stg.split("ReadSchema")[1] if "ReadSchema" in stg else True
    for line in stg.splitlines():
        if "lineitem" in line and "ReadSchema" in line:
            assert "l_tax" not in line


def test_fact_join_is_not_broadcast(spark):
    plan = _plan(queries()["stg_sales"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.schema == E.entry(spark).schema
