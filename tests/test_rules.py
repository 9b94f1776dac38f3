from collections import Counter

from cohortflow import config
from cohortflow.catalog.base import profile
from cohortflow.operators import rules
from cohortflow.plans import medallion

SCHEMA = "id int, age int, family_size float, work_experience float, segmentation string"
ROWS = [
    (1, 30, 15.9, 1.0, "A"),     # 15.9 becomes 15 before the rules
    (2, 30, -0.5, 1.0, "B"),     # -0.5 becomes 0
    (3, None, None, None, "C"),  # NULL is allowed
    (None, 30, 1.0, 1.0, "A"),
    (5, -1, 1.0, 1.0, "A"),
    (6, 121, 16.0, 51.0, None),
    (7, 120, 0.0, 50.0, "D"),
    (8, 20, 1.0, 1.0, "Z"),
]


def test_rules_run_after_the_casts(spark):
    kept = medallion.silver(spark.createDataFrame(ROWS, SCHEMA))
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3, 7]
    assert dict(kept.dtypes)["family_size"] == "int"


def test_quarantine_is_the_complement_and_names_the_rules(spark):
    bad = medallion.silver_quarantine(spark.createDataFrame(ROWS, SCHEMA))
    names = {r["id"]: r["failed_rules"] for r in bad.collect()}
    assert names == {None: ["valid_id"], 5: ["non_negative_age"], 8: ["valid_segmentation"],
                     6: ["valid_segmentation", "valid_age", "valid_family_size", "valid_work_experience"]}
    assert dict(bad.dtypes)["work_experience"] == "double"


def test_silver_and_quarantine_make_up_the_input(spark, sf_dir):
    df = profile(spark, sf_dir)
    good = Counter(tuple(r) for r in medallion.silver(df).collect())
    bad = Counter(tuple(r) for r in medallion.silver_quarantine(df).drop("failed_rules").collect())
    whole = Counter(tuple(r) for r in medallion.typed(df, config.SILVER_TYPES).collect())
    assert good + bad == whole and good and bad


def test_contradictory_single_rules_leave_nothing(spark):
    df = medallion.typed(spark.createDataFrame(ROWS, SCHEMA))
    for rule in ("age < 0", "age > 120"):
        df = rules.keep_single(df, rule)
    assert df.count() == 0


def test_report_counts_null_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "a int")
    report = {r["rule"]: tuple(r)[1:] for r in rules.rule_report(df, {"pos": "a > 0", "any": "a IS NOT NULL"}).collect()}
    assert report == {"pos": (1, 2, 1), "any": (2, 1, 1)}


def test_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 1)], "a int, b int")
    assert rules.rows_with_nulls(df).count() == 2
    assert rules.rows_with_nulls(df, more_than=1).count() == 1


def test_scoring_rules_need_no_segment(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).drop("segmentation")
    assert sorted(r["id"] for r in medallion.silver(df, config.SCORING_RULES).collect()) == [1, 2, 3, 7, 8]


def test_duplicate_ids(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert rows(rules.duplicated(df, "id")) == sorted([(1, 2), (None, 2)], key=repr)
