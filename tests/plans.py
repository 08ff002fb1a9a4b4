"""What a query really read, from its executed plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _leaves(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _leaves(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _leaves(plan.plan())
    elif name.startswith("ReusedExchange") or name.startswith("ReusedSubquery"):
        return
    else:
        children = plan.children()
        if children.isEmpty():
            yield plan
        for i in range(children.size()):
            yield from _leaves(children.apply(i))


def files_read(df: DataFrame) -> int:
    """Run ``df`` and count the files its scans opened."""
    df.collect()
    total = 0
    for leaf in _leaves(df._jdf.queryExecution().executedPlan()):
        metrics = leaf.metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numFiles").value()
    return total


def rows_scanned(df: DataFrame) -> int:
    """Run ``df`` and count the rows that its scans gave out, before any filter."""
    df.collect()
    leaves = _leaves(df._jdf.queryExecution().executedPlan())
    found = [leaf.metrics().apply("numOutputRows").value() for leaf in leaves if leaf.metrics().contains("numFiles")]
    return sum(found)


def explained(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
