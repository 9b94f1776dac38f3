"""Queries over the ETL operators: names, casts, fills, maps, rules, joins, gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import (
    ALL_RULES_SQL, ATTRIBUTES, PROFILE, RULE_SQL, Query, case_map, profile, silver, table, union_all, with_ctes)
from cohortflow.functions import columns as C
from cohortflow.operators import joins, rules, stats
from cohortflow.plans import medallion
from cohortflow.session import scratch_path

RAW_NAMES = {name.lower(): name for name, _ in config.RAW_FIELDS}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile under its raw column names, one of them with a space."""
    df = profile(spark, sf_dir)
    return df.toDF(*["Work Experience" if c == "work_experience" else RAW_NAMES[c] for c in df.columns])


def a14_literal_lookup(spark, sf_dir):
    pairs = spark.createDataFrame([(k, float(v)) for k, v in config.VALUE_MAPS["spending_score"].items()],
                                  "spending_score string, score double")
    counted = profile(spark, sf_dir).groupBy("spending_score").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(F.broadcast(pairs), "spending_score")


def b2_casts(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"))
    return C.cast_columns(df, {"price": "int", "flag": "double"})


def c4_counted_while_writing(spark, sf_dir):
    """Silver written, its rules counted by the write."""
    return medallion.write_silver(profile(spark, sf_dir), scratch_path(spark, "silver")).drop("left_after")


def d1_feature_target(spark, sf_dir):
    s = silver(spark, sf_dir)
    features = medallion.feature_input(s).select("id", "age", "profession")
    return joins.equi_join(features, medallion.gold_target(s), "id")


def d1_orders_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", "o_totalprice")
    segment = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    return joins.equi_join(orders, segment, "id")


def d1_hot_key(spark, sf_dir):
    """Half of all line items have one of two flags: keys hot enough for a salt, against a side of three rows a flag."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("id"), "l_orderkey", "l_linenumber")
    status = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return joins.hot_key_join(lines, status, "id")


def c3_quarantine_at_the_edge(spark, sf_dir):
    """Work experience just above its bound as a double, at the bound as a float: in silver, so not in quarantine."""
    edge = profile(spark, sf_dir).withColumn("work_experience", F.expr("CAST(50 AS DOUBLE) + id % 3 * 0.000001D"))
    bad = medallion.silver_quarantine(edge).select("id", F.array_join("failed_rules", ",").alias("failed_rules"), F.lit(True).alias("bad"))
    return bad.unionByName(medallion.silver(edge).select("id", F.lit("").alias("failed_rules"), F.lit(False).alias("bad")))


def d2_positional(spark, sf_dir):
    s = table(spark, sf_dir, "orders")
    left = s.select("o_orderkey", "o_orderdate")
    right = s.select("o_totalprice", F.col("o_orderkey").alias("other_key"))
    return (joins.positional_join(left, right, ["o_orderkey"], [F.desc("o_totalprice"), "other_key"])
            .select("o_orderkey", "other_key", "o_totalprice"))


def c2_single_rules(spark, sf_dir):
    """Survivors of each rule on its own and of the rules stacked."""
    return rules.rule_report(medallion.typed(profile(spark, sf_dir)), config.ROW_RULES)


def c2_stacked_filter(spark, sf_dir):
    df = medallion.typed(profile(spark, sf_dir))
    for rule in config.SCORING_RULES.values():
        df = rules.keep_single(df, rule)
    return df


def c3_quarantine(spark, sf_dir):
    bad = medallion.silver_quarantine(profile(spark, sf_dir))
    return bad.withColumn("failed_rules", F.array_join("failed_rules", ","))


def c5_predicates(spark, sf_dir):
    return profile(spark, sf_dir).select(
        "id",
        F.expr("id IS NULL").alias("no_id"),
        F.expr("segmentation IS NOT NULL AND segmentation NOT IN ('A', 'B', 'C', 'D')").alias("bad_segment"),
        F.expr("coalesce(age < 0 OR age > 120, FALSE)").alias("bad_age"),
        F.expr("coalesce(family_size BETWEEN 0 AND 15, FALSE)").alias("good_family"))


def b7_spec(spark, sf_dir):
    return C.map_values(profile(spark, sf_dir).select("id", *config.VALUE_MAPS), config.VALUE_MAPS)


def b14_roles_by_nulls(spark, sf_dir):
    """column_roles of the silver columns, one row per column and role."""
    roles = C.column_roles(medallion.feature_input(silver(spark, sf_dir)).drop("id"))
    return spark.createDataFrame([(c, role) for role, columns in roles.items() for c in columns], "column_name string, role string")


def b14_roles(spark, sf_dir):
    """Roles of the silver columns with their NULL counts, one row per column."""
    df = medallion.feature_input(silver(spark, sf_dir)).drop("id")
    numeric, text = C.numeric_columns(df), C.columns_of(df, C.T.StringType)
    counts = df.agg(*[C.null_count(c).alias(c) for c in numeric + text])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit("numeric" if c in numeric else "string").alias("role"),
                 F.col(c).alias("n_missing")) for c in numeric + text])))


_profile_all = with_ctes("profile", "SELECT * FROM profile")
_silver_all = with_ctes("silver", "SELECT * FROM silver")
_quarantine_sql = with_ctes(
    "typed",
    "SELECT id, gender, ever_married, age, graduated, profession, CAST(work_experience AS DOUBLE) AS work_experience, "
    "spending_score, family_size, var_1, segmentation, "
    "concat_ws(',', " + ", ".join(f"CASE WHEN NOT {r} THEN '{n}' END" for n, r in RULE_SQL.items()) +
    f") AS failed_rules FROM typed WHERE NOT ({ALL_RULES_SQL})")


def report_sql(source: str, checks: dict[str, str] = RULE_SQL) -> str:
    parts, stacked = [], []
    for name, rule in checks.items():
        stacked.append(rule)
        parts.append(f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS passed, "
                     f"count(*) FILTER (WHERE NOT {rule}) AS failed, "
                     f"count(*) FILTER (WHERE {' AND '.join(stacked)}) AS left_after FROM {source}")
    return union_all(parts)


def _mode_cte(column: str) -> str:
    return (f"(SELECT {column} FROM (SELECT {column}, count(*) AS n FROM encoded GROUP BY 1) "
            f"ORDER BY n DESC, {column} IS NULL, {column} LIMIT 1)")


def gold_complete_sql() -> str:
    cells = []
    for c in ATTRIBUTES:
        if c in config.CATEGORICAL:
            cells.append(f"coalesce({c}, {_mode_cte(c)}) AS {c}")
        else:
            cells.append(f"coalesce({c}, (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) FROM encoded)) AS {c}")
    return with_ctes("encoded", f"SELECT {', '.join(cells)}, id FROM encoded")


def _lookup_sql() -> str:
    return union_all([f"SELECT '{k}' AS string_value, CAST({v} AS DOUBLE) AS numeric_value, '{c}' AS \"column\""
                      for c, m in config.VALUE_MAPS.items() for k, v in m.items()])


def f5_lookup_coverage(spark, sf_dir):
    """How often each lookup row is used in the table."""
    lookup = medallion.gold_lookup(spark)
    used = stats.value_counts(profile(spark, sf_dir), list(config.VALUE_MAPS))
    return (lookup.join(used, (lookup["column"] == used["column_name"]) & (lookup["string_value"] == used["value"]), "left")
            .select("string_value", "numeric_value", "column", F.coalesce("n", F.lit(0)).alias("n_rows")))


def f6_one_lookup(spark, sf_dir):
    """One column's lookup rows against the table: mapped rows and their sum."""
    lookup = C.lookup_frame(spark, config.VALUE_MAPS["spending_score"], "spending_score")
    df = profile(spark, sf_dir).select("spending_score")
    return (df.join(F.broadcast(lookup), df["spending_score"] == lookup["string_value"])
            .groupBy("column", "string_value")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("numeric_value").alias("total")))


def _counts_per_map(pairs: str) -> str:
    return f"SELECT * FROM (VALUES {pairs}) AS m(string_value, numeric_value)"


_map_values = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in config.VALUE_MAPS["spending_score"].items())

QUERIES: dict[str, Query] = {
    "a9_label_free": Query(
        lambda s, d: profile(s, d).drop("segmentation"),
        with_ctes("profile", "SELECT * EXCLUDE (segmentation) FROM profile")),
    "a11_upstream_dataset": Query(
        lambda s, d: silver(s, d).groupBy("segmentation").agg(F.count(F.lit(1)).alias("n")),
        with_ctes("silver", "SELECT segmentation, count(*) AS n FROM silver GROUP BY 1")),
    "a14_literal_lookup": Query(
        a14_literal_lookup,
        with_ctes("profile", "SELECT p.spending_score, count(*) AS n, max(m.numeric_value) AS score FROM profile p "
                             f"JOIN ({_counts_per_map(_map_values)}) m ON m.string_value = p.spending_score GROUP BY 1")),
    "b1_normalize_names": Query(lambda s, d: C.normalize_names(raw(s, d)), _profile_all),
    "b2_casts": Query(
        b2_casts,
        "SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INT) AS price, "
        "TRY_CAST(l_returnflag AS DOUBLE) AS flag FROM lineitem"),
    "b2_typed_profile": Query(
        lambda s, d: medallion.typed(raw(s, d)), with_ctes("typed", "SELECT * FROM typed")),
    "b3_drop_columns": Query(
        lambda s, d: C.drop_columns(silver(s, d), "id", "segmentation", "inserted_at"),
        with_ctes("silver", "SELECT * EXCLUDE (id, segmentation) FROM silver")),
    "b4_column_subset": Query(
        lambda s, d: silver(s, d).select("id", "segmentation"),
        with_ctes("silver", "SELECT id, segmentation FROM silver")),
    "b5_label_rename": Query(
        lambda s, d: C.rename_cast(medallion.gold_target(silver(s, d)), "segmentation", "label", "double"),
        with_ctes("target", "SELECT id, CAST(segmentation AS DOUBLE) AS label FROM target")),
    "b6_constant_fill": Query(
        lambda s, d: C.fill_constants(profile(s, d), config.CONSTANT_FILLS),
        with_ctes("profile", "SELECT * REPLACE (coalesce(profession, 'Other') AS profession, "
                             "coalesce(ever_married, 'No') AS ever_married) FROM profile")),
    "b7_value_maps": Query(
        b7_spec,
        with_ctes("profile", "SELECT id, " + ", ".join(
            f"{case_map(c, m)} AS {c}" for c, m in config.VALUE_MAPS.items()) + " FROM profile")),
    "b8_target_default": Query(
        lambda s, d: medallion.gold_target(profile(s, d)),
        with_ctes("profile", "SELECT id, CASE segmentation WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 4 END "
                             "AS segmentation FROM profile")),
    "b9_label_shift": Query(
        lambda s, d: C.shift_labels(
            profile(s, d).select("id", F.col("family_size").cast("int").alias("label"))),
        with_ctes("profile", "SELECT id, CASE WHEN trunc(family_size) IN (1, 2, 3, 4) "
                             "THEN CAST(trunc(family_size) AS INT) - 1 END AS label FROM profile")),
    "b10_zero_based_target": Query(
        lambda s, d: C.map_values(profile(s, d).select("id", "segmentation"),
                                  {"segmentation": {"A": 0, "B": 1, "C": 2, "D": 3}}),
        with_ctes("profile", f"SELECT id, {case_map('segmentation', {'A': 0, 'B': 1, 'C': 2, 'D': 3})} "
                             "AS segmentation FROM profile")),
    "b13_cast_to_double": Query(
        lambda s, d: C.cast_to_double(["age", "family_size"], silver(s, d))[0],
        with_ctes("silver", "SELECT * REPLACE (CAST(age AS DOUBLE) AS age, "
                            "CAST(family_size AS DOUBLE) AS family_size) FROM silver")),
    "b14_roles_by_nulls": Query(
        b14_roles_by_nulls,
        with_ctes("inputs", union_all([
            f"SELECT '{c}' AS column_name, '{role}{kind}_cols' AS role FROM inputs HAVING {test}"
            for c in ATTRIBUTES if c != "work_experience"
            for role in ["num" if c in ("age", "family_size") else "string"]
            for kind, test in (("", "count(*) >= 0"), ("_missing", f"count(*) > count({c})"))]))),
    "b14_column_roles": Query(
        b14_roles,
        with_ctes("inputs", union_all([
            f"SELECT '{c}' AS column_name, '{'numeric' if c in ('age', 'family_size') else 'string'}' AS role, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM inputs"
            for c in ATTRIBUTES if c != "work_experience"]))),
    "b17_json_text": Query(
        lambda s, d: table(s, d, "orders").select(
            "o_orderkey", C.json_text("o_orderstatus", "o_orderpriority", "o_custkey").alias("params")),
        "SELECT o_orderkey, CAST(json_object('o_orderstatus', o_orderstatus, 'o_orderpriority', o_orderpriority, "
        "'o_custkey', o_custkey) AS VARCHAR) AS params FROM orders"),
    "b18_round_metrics": Query(
        lambda s, d: C.round_doubles(table(s, d, "lineitem").select(
            "l_orderkey", "l_linenumber", F.log(F.col("l_extendedprice")).alias("log_price"))),
        "SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 5) AS log_price FROM lineitem"),
    "b20_row_ids": Query(
        lambda s, d: C.with_row_id(table(s, d, "lineitem"), "row_id").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids")),
        "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem"),
    "c1_keep_valid": Query(silver, _silver_all),
    "c2_single_rules": Query(c2_single_rules, with_ctes("typed", report_sql("typed"))),
    "c2_reject_rules": Query(
        lambda s, d: rules.rule_report(medallion.typed(profile(s, d), config.QUARANTINE_TYPES), config.REJECT_RULES),
        with_ctes("typed", report_sql("typed", {n: f"coalesce(({r}), FALSE)" for n, r in config.REJECT_RULES.items()}))),
    "c2_stacked_filter": Query(
        c2_stacked_filter,
        with_ctes("typed", "SELECT * FROM typed WHERE " + " AND ".join(
            r for n, r in RULE_SQL.items() if n != "valid_segmentation"))),
    "c3_quarantine": Query(c3_quarantine, _quarantine_sql),
    "c3_quarantine_at_the_edge": Query(
        c3_quarantine_at_the_edge,
        with_ctes("profile", f"SELECT id, failed_rules, failed_rules <> '' AS bad FROM (SELECT id, concat_ws(',', "
                  + ", ".join(f"CASE WHEN NOT {r} THEN '{n}' END" for n, r in RULE_SQL.items())
                  + ") AS failed_rules FROM edge)",
                  edge="SELECT id, gender, ever_married, CAST(age AS INT) AS age, graduated, profession, "
                       "CAST(CAST(50 AS DOUBLE) + id % 3 * CAST(0.000001 AS DOUBLE) AS FLOAT) AS work_experience, "
                       "spending_score, CAST(trunc(family_size) AS INT) AS family_size, var_1, segmentation FROM profile")),
    "c4_rule_counts": Query(
        lambda s, d: c2_single_rules(s, d).drop("left_after"),
        with_ctes("typed", f"SELECT rule, passed, failed FROM ({report_sql('typed')})")),
    "c4_counted_while_writing": Query(
        c4_counted_while_writing, with_ctes("typed", f"SELECT rule, passed, failed FROM ({report_sql('typed')})")),
    "c5_predicates": Query(
        c5_predicates,
        with_ctes("profile", "SELECT id, id IS NULL AS no_id, segmentation IS NOT NULL AND segmentation NOT IN "
                             "('A', 'B', 'C', 'D') AS bad_segment, coalesce(age < 0 OR age > 120, FALSE) AS bad_age, "
                             "coalesce(family_size BETWEEN 0 AND 15, FALSE) AS good_family FROM profile")),
    "c6_rows_with_nulls": Query(
        lambda s, d: rules.rows_with_nulls(profile(s, d), config.CATEGORICAL),
        with_ctes("profile", "SELECT * FROM profile WHERE " + " OR ".join(f"{c} IS NULL" for c in config.CATEGORICAL))),
    "c6_rows_with_many_nulls": Query(
        lambda s, d: rules.rows_with_nulls(profile(s, d), more_than=1),
        with_ctes("profile", "SELECT * FROM profile WHERE " +
                  " + ".join(f"CAST({c} IS NULL AS INT)" for c in PROFILE) + " > 1")),
    "d1_feature_target": Query(
        d1_feature_target,
        with_ctes("target", "SELECT i.id, i.age, i.profession, t.segmentation FROM inputs i JOIN target t ON i.id = t.id")),
    "d1_orders_customer": Query(
        d1_orders_customer,
        "SELECT o_custkey AS id, o_orderkey, o_totalprice, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"),
    "d1_hot_key": Query(
        d1_hot_key,
        "SELECT l_returnflag AS id, l_orderkey, l_linenumber, n FROM lineitem JOIN "
        "(SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1) ON l_returnflag = flag"),
    "d2_positional_join": Query(
        d2_positional,
        "WITH l AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders), "
        "o AS (SELECT o_totalprice, o_orderkey AS other_key, "
        "row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) "
        "SELECT o_orderkey, other_key, o_totalprice FROM l JOIN o USING (r)"),
    "f5_lookup_union": Query(
        f5_lookup_coverage,
        with_ctes("profile", "SELECT string_value, numeric_value, \"column\", coalesce(n, 0) AS n_rows FROM lookup "
                             "LEFT JOIN used ON \"column\" = column_name AND string_value = value",
                  lookup=_lookup_sql(),
                  used=union_all([f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM profile GROUP BY 2"
                                  for c in config.VALUE_MAPS]))),
    "f6_lookup_frame": Query(
        f6_one_lookup,
        with_ctes("profile", "SELECT 'spending_score' AS \"column\", string_value, count(*) AS n, "
                             "sum(numeric_value) AS total FROM profile JOIN "
                             f"({_counts_per_map(_map_values)}) m ON string_value = spending_score GROUP BY 2")),
    "h14_gold_complete": Query(lambda s, d: medallion.gold_complete(silver(s, d), median_error=0.0), gold_complete_sql()),
    "h16_gold_target": Query(lambda s, d: medallion.gold_target(silver(s, d)), with_ctes("target", "SELECT * FROM target")),
}
QUERIES["h15_gold_lookup"] = Query(f5_lookup_coverage, QUERIES["f5_lookup_union"].sql)
