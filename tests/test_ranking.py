from pyspark.sql import functions as F

from plumage.operators.ranking import ranked
from plumage.session import cut_lineage


def test_ranks_follow_the_order_over_all_partitions(spark):
    rows = cut_lineage(spark.range(20000).select(
        F.pmod(F.xxhash64("id"), F.lit(500)).alias("score"), "id"), "rank-test")
    got = ranked(rows, F.col("score").desc(), F.col("id").asc()).collect()
    want = sorted(got, key=lambda r: (-r["score"], r["id"]))
    assert [r["rank"] for r in want] == list(range(1, 20001))


def test_ranks_of_nothing(spark):
    rows = cut_lineage(spark.range(0), "rank-test")
    assert ranked(rows, F.col("id")).collect() == []


def test_plan_has_no_one_task_window_over_the_rows(spark):
    rows = cut_lineage(spark.range(1000), "rank-test")
    plan = ranked(rows, F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window  # only the counts per partition go through it
