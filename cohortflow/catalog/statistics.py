"""Queries over the statistics, sorting and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import (
    ATTRIBUTES, PROFILE_COLUMNS, Query, feature_input, profile, silver, table, union_all, with_ctes)
from cohortflow.functions import columns as C
from cohortflow.operators import impute, sketches, stats
from cohortflow.session import scratch_path
from cohortflow.sources.tables import append_rows, read_table

PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAGS = ["l_returnflag", "l_linestatus", "l_linenumber"]
NUMBERS = ["age", "family_size", "work_experience"]


def rounded(df):
    return C.round_doubles(df, 6)


SKETCHED = {"quantity": "l_quantity", "price": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END",
            "flag": "l_returnflag", "status": "CASE WHEN l_linenumber > 5 THEN NULL ELSE l_linestatus END"}
SKETCHED_NUMBERS = ["quantity", "price"]


def _sketched(spark, sf_dir):
    """Line items, and the merged profile of three batches of them that were profiled and stored one by one."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", *[f"{text} AS {c}" for c, text in SKETCHED.items()])
    target = scratch_path(spark, "profiles")
    for i in range(3):
        append_rows(sketches.batch_profile(lines.filter(F.col("l_orderkey") % 3 == i), list(SKETCHED)), target)
    return lines, sketches.merged_profile(read_table(spark, target))


def merged_profile(spark, sf_dir):
    """What is exact in it, frequent values of columns with few values included."""
    report = sketches.profile_report(_sketched(spark, sf_dir)[1])
    exact = F.col("metric").isin("rows", "nulls", "mean", "min", "max") | (F.col("metric").isin("distinct", "top") & F.col("column_name").isin("flag", "status"))
    return rounded(report.filter(exact))


def sketch_bounds(spark, sf_dir):
    """Whether the rows up to a sketched quantile are the share asked for, to two in a hundred; ties may lie on either side."""
    lines, profile = _sketched(spark, sf_dir)
    found = {(r["column_name"], r["metric"]): r["number"] for r in sketches.profile_report(profile).collect()}
    checks = [(c, p, found[c, f"q{p}"]) for c in SKETCHED_NUMBERS for p in (25, 50, 75)]
    shares = [F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("percent"), (
        (F.count_if(F.col(c) < q) / F.count(c) <= p / 100 + 0.02) & (F.count_if(F.col(c) <= q) / F.count(c) >= p / 100 - 0.02)).alias("within")) for c, p, q in checks]
    return lines.agg(*[x.alias(f"s{i}") for i, x in enumerate(shares)]).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(shares))])))


_merged_sql = "WITH x AS (SELECT " + ", ".join(f"{text} AS {c}" for c, text in SKETCHED.items()) + " FROM lineitem) " + union_all(
    [f"SELECT '{c}' AS column_name, '{name}' AS metric, round(CAST({number} AS DOUBLE), 6) AS number, CAST(NULL AS VARCHAR) AS text FROM x"
     for c in SKETCHED for name, number in [("rows", "count(*)"), ("nulls", f"count(*) - count({c})"), *(
         [("mean", f"avg(CAST({c} AS DOUBLE))"), ("min", f"min({c})"), ("max", f"max({c})")] if c in SKETCHED_NUMBERS else [("distinct", f"count(DISTINCT {c})")])]]
    + [f"SELECT * FROM (SELECT '{c}' AS column_name, 'top' AS metric, CAST(count(*) AS DOUBLE) AS number, {c} AS text FROM x WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 3 DESC LIMIT 1)"
       for c in ("flag", "status")])


def _counts_sql(columns, source):
    return union_all([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY 2"
                      for c in columns])


def _modes_sql(columns, source):
    return union_all([f"SELECT * FROM (SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n "
                      f"FROM {source} GROUP BY 2 ORDER BY n DESC, value IS NULL, value LIMIT 1)" for c in columns])


def _quantiles_sql(columns, source, probs):
    return union_all([f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, CAST(percentile_disc({p}) WITHIN GROUP "
                      f"(ORDER BY {c}) AS DOUBLE) AS value FROM {source}" for c in columns for p in probs])


def _describe_sql(numeric, text, source, quartiles=False):
    parts = []
    for c in numeric + text:
        number = f"CAST({c} AS DOUBLE)" if c in numeric else "CAST(NULL AS DOUBLE)"
        word = c if c in text else "CAST(NULL AS VARCHAR)"
        extra = f", min({word}) AS min_text, max({word}) AS max_text"
        if quartiles:
            extra = "".join(f", CAST(percentile_disc({p}) WITHIN GROUP (ORDER BY {c}) AS DOUBLE) AS q{int(p * 100)}"
                            for p in stats.QUARTILES)
        parts.append(f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({number}), 6) AS mean, "
                     f"round(stddev({number}), 6) AS stddev, min({number}) AS min_value, "
                     f"max({number}) AS max_value{extra} FROM {source}")
    return union_all(parts)


def _profile_metrics_sql(numeric, text, source):
    parts = []
    for c in numeric + text:
        top = (f"(SELECT {{}} FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL "
               f"GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")
        cells = [("rows", "count(*)", "NULL"), ("nulls", f"count(*) - count({c})", "NULL"),
                 ("distinct", f"count(DISTINCT {c})", "NULL"),
                 ("top", top.format("n"), top.format("v") if c in text else "NULL")]
        if c in numeric:
            cells += [("mean", f"round(avg(CAST({c} AS DOUBLE)), 6)", "NULL"),
                      ("stddev", f"round(stddev(CAST({c} AS DOUBLE)), 6)", "NULL"),
                      ("min", f"min({c})", "NULL"), ("max", f"max({c})", "NULL")]
            cells += [(f"q{int(p * 100)}", f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})", "NULL")
                      for p in stats.QUARTILES]
        parts += [f"SELECT '{c}' AS column_name, '{m}' AS metric, CAST({number} AS DOUBLE) AS number, "
                  f"CAST({word} AS VARCHAR) AS text" + ("" if m == "top" else f" FROM {source}")
                  for m, number, word in cells]
    return union_all(parts)


def _corr_sql(columns, source):
    return union_all([f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) "
                      f"AS corr FROM {source}" for a in columns for b in columns])


def _bin_sql(c, source, bins):
    low, high = f"(SELECT min(CAST({c} AS DOUBLE)) FROM {source})", f"(SELECT max(CAST({c} AS DOUBLE)) FROM {source})"
    return f"CAST(least(floor((CAST({c} AS DOUBLE) - {low}) / (({high} - {low}) / {bins})), {bins - 1}) AS INT)"


def _histogram_sql(columns, source, by, bins):
    return union_all([f"SELECT '{c}' AS column_name, {by} AS \"class\", {_bin_sql(c, source, bins)} AS bin, count(*) AS n "
                      f"FROM {source} WHERE {c} IS NOT NULL GROUP BY 2, 3" for c in columns])


def _distinct_sql(columns, source):
    return union_all([f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM {source}" for c in columns])


def encoded(spark, sf_dir):
    return C.map_values(feature_input(spark, sf_dir), config.VALUE_MAPS)


def sketch_check(spark, sf_dir, accuracy=1000):
    """Sketched medians, and whether their true rank is within the promised error."""
    lines = table(spark, sf_dir, "lineitem")
    found = {r["column_name"]: r["value"] for r in stats.approx_quantiles(lines, PRICES, [0.5], accuracy).collect()}
    counts = lines.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(test(F.col(c), found[c])).alias(f"{c}_{name}") for c in PRICES
        for name, test in (("below", lambda col, v: col < v), ("upto", lambda col, v: col <= v))])
    middle, slack = F.col("n") * 0.5, F.col("n") / accuracy
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("n").alias("n"),
        ((F.col(f"{c}_below") - slack <= middle) & (F.col(f"{c}_upto") + slack >= middle)).alias("within_error"))
        for c in PRICES])))


CORR_COLUMNS = list(config.VALUE_MAPS) + NUMBERS
KINDS = {"id": "id", **{c: "categorical" for c in config.CATEGORICAL}, **{c: "numeric" for c in NUMBERS},
         "segmentation": "categorical"}


def _kinds_sql(numeric, integral_or_text, source):
    """The rule itself in SQL: all different and never NULL -> id, else by type."""
    parts = []
    for c in numeric + integral_or_text:
        may_be_id = c in integral_or_text
        fallback = "numeric" if c in numeric or c in ("id", "age", "family_size") else "categorical"
        rule = (f"CASE WHEN count(*) = count(DISTINCT {c}) THEN 'id' ELSE '{fallback}' END"
                if may_be_id else "max('numeric')")
        parts.append(f"SELECT '{c}' AS column_name, {rule} AS kind FROM {source}")
    return union_all(parts)


LINE_DESCRIBE = PRICES + FLAGS

QUERIES: dict[str, Query] = {
    "e1_value_counts": Query(
        lambda s, d: stats.value_counts(profile(s, d), config.CATEGORICAL),
        with_ctes("profile", _counts_sql(config.CATEGORICAL, "profile"))),
    "e1_value_counts_lineitem": Query(
        lambda s, d: stats.value_counts(table(s, d, "lineitem"), FLAGS), _counts_sql(FLAGS, "lineitem")),
    "e1_modes": Query(
        lambda s, d: stats.modes(profile(s, d), config.CATEGORICAL),
        with_ctes("profile", _modes_sql(config.CATEGORICAL, "profile"))),
    "e1_numeric_mode_ties": Query(
        lambda s, d: stats.modes(table(s, d, "lineitem").select(F.explode(F.array(F.lit(10), F.lit(9))).alias("folded")), ["folded"]),
        "SELECT 'folded' AS column_name, '9' AS value, count(*) AS n FROM lineitem"),
    "e2_medians_with_nan": Query(
        lambda s, d: stats.quantiles(table(s, d, "lineitem").select(F.when(
            F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_extendedprice").cast("double")).alias("price")), ["price"], [0.5]),
        _quantiles_sql(["price"], "(SELECT CAST(l_extendedprice AS DOUBLE) AS price FROM lineitem WHERE l_linenumber <> 1)", [0.5])),
    "e2_medians": Query(
        lambda s, d: stats.quantiles(silver(s, d), NUMBERS, [0.5]),
        with_ctes("silver", _quantiles_sql(NUMBERS, "silver", [0.5]))),
    "e2_medians_lineitem": Query(
        lambda s, d: stats.quantiles(table(s, d, "lineitem"), PRICES, [0.5]), _quantiles_sql(PRICES, "lineitem", [0.5])),
    "e2_sketched_medians_lineitem": Query(
        sketch_check,
        union_all([f"SELECT '{c}' AS column_name, count(*) AS n, TRUE AS within_error FROM lineitem" for c in PRICES])),
    "e3_null_counts": Query(
        lambda s, d: stats.null_counts(profile(s, d)),
        with_ctes("profile", union_all([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null "
                                        "FROM profile" for c in PROFILE_COLUMNS]))),
    "e4_null_percent": Query(
        lambda s, d: rounded(stats.null_percent(profile(s, d))),
        with_ctes("profile", union_all([f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0.0 "
                                        "END), 6) AS pct_null FROM profile" for c in PROFILE_COLUMNS]))),
    "e5_distinct_counts": Query(
        lambda s, d: stats.distinct_counts(profile(s, d), PROFILE_COLUMNS),
        with_ctes("profile", _distinct_sql(PROFILE_COLUMNS, "profile"))),
    "e5_distinct_counts_lineitem": Query(
        lambda s, d: stats.distinct_counts(table(s, d, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"]),
        _distinct_sql(["l_orderkey", "l_partkey", "l_suppkey"], "lineitem")),
    "e5_distinct_values": Query(
        lambda s, d: stats.distinct_values(profile(s, d), config.CATEGORICAL),
        with_ctes("profile", union_all([f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM profile"
                                        for c in config.CATEGORICAL]))),
    "e6_describe": Query(
        lambda s, d: rounded(stats.describe(profile(s, d), ["id", *ATTRIBUTES])),
        with_ctes("profile", _describe_sql(["id", *NUMBERS], config.CATEGORICAL, "profile"))),
    "e6_describe_lineitem": Query(
        lambda s, d: rounded(stats.describe(table(s, d, "lineitem"), PRICES + FLAGS[:2])),
        _describe_sql(PRICES, FLAGS[:2], "lineitem")),
    "e7_summary": Query(
        lambda s, d: rounded(stats.summary(profile(s, d), NUMBERS)),
        with_ctes("profile", _describe_sql(NUMBERS, [], "profile", quartiles=True))),
    "e7_summary_lineitem": Query(
        lambda s, d: rounded(stats.summary(table(s, d, "lineitem"), PRICES)),
        _describe_sql(PRICES, [], "lineitem", quartiles=True)),
    "e8_table_profile": Query(
        lambda s, d: rounded(stats.table_profile(profile(s, d), ATTRIBUTES)),
        with_ctes("profile", _profile_metrics_sql(NUMBERS, config.CATEGORICAL, "profile"))),
    "e9_correlation": Query(
        lambda s, d: rounded(stats.correlation(encoded(s, d), CORR_COLUMNS)),
        with_ctes("encoded", _corr_sql(CORR_COLUMNS, "encoded"))),
    "e9_correlation_lineitem": Query(
        lambda s, d: rounded(stats.correlation(table(s, d, "lineitem"), PRICES)), _corr_sql(PRICES, "lineitem")),
    "e10_class_histogram": Query(
        lambda s, d: stats.histogram(silver(s, d), NUMBERS, "segmentation", 10),
        with_ctes("silver", _histogram_sql(NUMBERS, "silver", "segmentation", 10))),
    "e10_pair_histogram": Query(
        lambda s, d: stats.pair_histogram(silver(s, d), "age", "work_experience", "segmentation", 8),
        with_ctes("silver", f"SELECT segmentation AS \"class\", {_bin_sql('age', 'silver', 8)} AS x_bin, "
                            f"{_bin_sql('work_experience', 'silver', 8)} AS y_bin, count(*) AS n FROM silver "
                            "WHERE age IS NOT NULL AND work_experience IS NOT NULL GROUP BY 1, 2, 3")),
    "e8_merged_profile": Query(merged_profile, _merged_sql),
    "e8_sketch_bounds": Query(
        sketch_bounds, union_all([f"SELECT '{c}' AS column_name, {p} AS percent, TRUE AS within" for c in SKETCHED_NUMBERS for p in (25, 50, 75)])),
    "f1_top_first": Query(
        lambda s, d: (table(s, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
                      .orderBy(F.desc("n"), "l_suppkey").limit(1)),
        "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 1"),
    "f4_first_rows": Query(
        lambda s, d: table(s, d, "orders").orderBy("o_orderdate", "o_orderkey").limit(10)
        .select("o_orderkey", "o_custkey", "o_totalprice"),
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10"),
    "h1_mode_imputation": Query(
        lambda s, d: impute.impute_mode(silver(s, d).drop("segmentation"), config.CATEGORICAL),
        with_ctes("silver", "SELECT * EXCLUDE (segmentation) REPLACE (" + ", ".join(
            f"coalesce({c}, (SELECT {c} FROM silver GROUP BY 1 ORDER BY count(*) DESC, {c} IS NULL, {c} LIMIT 1)) AS {c}"
            for c in config.CATEGORICAL) + ") FROM silver")),
    "h2_median_imputation": Query(
        lambda s, d: impute.impute_median(silver(s, d), NUMBERS, error=0.0),
        with_ctes("silver", "SELECT * REPLACE (" + ", ".join(
            f"coalesce({c}, (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) FROM silver)) AS {c}"
            for c in NUMBERS) + ") FROM silver")),
    "l1_column_kinds": Query(
        lambda s, d: stats.column_kinds(silver(s, d)),
        with_ctes("silver", _kinds_sql(["work_experience"], [c for c in PROFILE_COLUMNS if c != "work_experience"],
                                       "silver"))),
}
