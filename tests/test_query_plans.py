"""Properties of physical plans that matter at scale."""

from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.operators import rules, stats
from cohortflow.plans import medallion


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_on_matching_types_reach_the_scan(spark, small_silver, tmp_path):
    path = str(tmp_path / "profiles")
    small_silver.write.parquet(path)
    plan = plan_of(medallion.silver(spark.read.parquet(path)).select("id", "age"))
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert "IsNotNull(id)" in pushed and "In(segmentation" in pushed and "age" in pushed
    assert "Exchange" not in plan
    read = plan[plan.index("ReadSchema"):]
    assert "profession" not in read and "var_1" not in read


def test_target_reads_two_columns(spark, small_silver, tmp_path):
    path = str(tmp_path / "profiles")
    small_silver.write.parquet(path)
    plan = plan_of(medallion.gold_target(spark.read.parquet(path)))
    assert "ReadSchema: struct<id:bigint,segmentation:string>" in plan


def test_counts_are_partial_before_the_only_shuffle(spark, small_silver):
    plan = plan_of(stats.value_counts(small_silver, config.CATEGORICAL))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_reports_over_many_columns_are_one_aggregate(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for df in (stats.null_counts(lines), stats.describe(lines, ["l_tax", "l_discount"]),
               stats.correlation(lines, ["l_tax", "l_discount", "l_quantity"]),
               rules.rule_report(lines, {"a": "l_tax > 0.01", "b": "l_quantity < 40"})):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_first_row_needs_no_global_sort(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(lines.groupBy("l_suppkey").count().orderBy(F.desc("count"), "l_suppkey").limit(1))
    assert "TakeOrderedAndProject" in plan
