"""Scale checks on physical plans: no Python in the hot path, filters and
projections reach the scan, and the only single-partition steps are over
bounded summaries."""

import pytest

import __spark_entry__ as E
from tabprep.plans import catalog

HEAVY = sorted(set(catalog.REGISTRY) - {"train_score_gate"})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Arrow batches in the jobs that these run while they are built: the copula's
#: numpy marginals, the matrix sums of pairwise correlations, CSV records, histograms of boosted trees.
ARROW = {"synth_copula", "synth_copula_class_counts", "synth_quality_summary", "quality_summary_wide", "csv_roundtrip", "associations",
         "association_differences",         "boosted_regression", "boosted_classification"}


def _all_plans(spark, build):
    """Physical plans of every job that a query runs, while it is built and for its result."""
    before = {e.executionId() for e in _executions(spark)}
    df = build()
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    return [e.physicalPlanDescription() for e in _executions(spark) if e.executionId() not in before]


def _executions(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_udf(spark, sf, name):
    for plan in _all_plans(spark, lambda: E.queries()[name](spark, sf)):
        assert "BatchEvalPython" not in plan
        assert "ArrowEvalPython" not in plan or name.startswith("boosted_")  # a model's score
        assert name in ARROW or ("MapInPandas" not in plan and "MapInArrow" not in plan)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_split_plan_is_a_projection(spark, sf):
    """The split itself is a narrow projection over the scan: no exchange."""
    plan = _plan(E.queries()["split_stratified"](spark, sf))
    assert "Exchange" not in plan and "Window" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_column_pruning_reaches_scan(spark, sf):
    plan = _plan(E.queries()["impute_median"](spark, sf))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
