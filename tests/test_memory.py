"""Memory of the largest task of queries on the smallest driver tables. There it is pages, one for each sort, window and hash map of a stage: what the plan asks for ahead of any rows."""

import pytest

from tactus import plans

DIR = "/root/testdata/sf0.001"


def most_pages(spark, name):
    """Pages that the largest task of a query held."""
    context = spark.sparkContext
    context.setJobGroup(f"memory of {name}", name)
    try:
        plans.QUERIES[name](spark, DIR).write.format("noop").mode("overwrite").save()
    finally:
        context._jsc.clearJobGroup()
    store, tracker = context._jsc.sc().statusStore(), context.statusTracker()
    peaks = [0]
    for job in tracker.getJobIdsForGroup(f"memory of {name}"):
        for stage in tracker.getJobInfo(job).stageIds:
            tasks = store.taskList(stage, 0, 10_000)
            found = [tasks.apply(k).taskMetrics() for k in range(tasks.size())]
            peaks += [m.get().peakExecutionMemory() for m in found if m.isDefined()]
    return max(peaks) / context._jvm.org.apache.spark.SparkEnv.get().memoryManager().pageSizeBytes()


@pytest.mark.parametrize("name", ["align_7_8", "bar_grid_7_8", "bars_agg", "markdown_report", "abc_text", "align_before_first", "num_bars", "align_b", "markdown_rows"])
def test_largest_task_holds_few_pages(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        assert 0 < most_pages(spark, name) <= 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
