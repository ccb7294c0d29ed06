"""Physical-plan census: what a reader checks first in a plan."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def physical_plan(df: DataFrame) -> str:
    """The plan of ``df``, final (as adaptive execution left it) once
    ``execute`` has run it, initial before."""
    return df._jdf.queryExecution().executedPlan().toString()


def execute(df: DataFrame) -> DataFrame:
    """Run the plan of this very frame, so that ``physical_plan`` shows what
    ran; an action on the frame would plan a copy of its own."""
    df._jdf.queryExecution().toRdd().count()
    return df


def executed_plans(spark: SparkSession, run: Callable[[], object]) -> list[str]:
    """The final plans of all SQL executions that ``run`` starts, in order:
    also those of the tables a query writes on its way."""
    bus = spark.sparkContext._jsc.sc().listenerBus()
    store = spark._jsparkSession.sharedState().statusStore()

    def last() -> int:
        bus.waitUntilEmpty(60_000)
        n = store.executionsCount()
        return store.executionsList(n - 1, 1).apply(0).executionId() if n else -1

    before = last()
    run()
    found = [store.execution(i) for i in range(before + 1, last() + 1)]
    return [x.get().physicalPlanDescription() for x in found if x.isDefined()]


def final_part(description: str) -> str:
    """Of a plan that adaptive execution changed, the final half."""
    plan = re.split(r"== Initial Plan ==", description)[0]
    return re.split(r"\n\n\n?\(1\)", plan)[0]


def census(plan: str) -> dict[str, int]:
    n = lambda pat: len(re.findall(pat, plan))
    return {"exchanges": n(r"\bExchange\b"), "reused": n(r"ReusedExchange"),
            "sorts": n(r"\bSort\b"), "windows": n(r"\bWindow\b"),
            "hash_agg": n(r"HashAggregate"), "sort_agg": n(r"SortAggregate"),
            "smj": n(r"SortMergeJoin"), "bhj": n(r"BroadcastHashJoin"),
            "single_partition": n(r"SinglePartition"), "python": n(r"EvalPython|InPandas|InArrow"),
            "scans": n(r"\bScan parquet\b|FileScan")}


def census_of(plans: list[str]) -> dict[str, int]:
    """Summed census of several executed plans."""
    parts = [census(final_part(p)) for p in plans]
    return {k: sum(p[k] for p in parts) for k in census("")}
