"""Queries over the feature, fold and metric operators. Vectors are compared in long form."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import Query, feature_input, silver, table, union_all, with_ctes
from cohortflow.functions import columns as C
from cohortflow.operators import features, fitted, folds, knn, metrics
from cohortflow.plans import medallion
from cohortflow.session import scratch_path
from cohortflow.sources.models import load_stages, save_model

NUMERIC = ["age", "family_size"]
TEXT = ["gender", "ever_married", "graduated", "profession", "spending_score", "var_1"]
WIDTH = 34


def gold_features(spark: SparkSession, sf_dir: str, scale: bool, numeric_types: str = "int_bool_double") -> DataFrame:
    df = feature_input(spark, sf_dir)
    return features.features_of(df, features.fit_features(df, scale, numeric_types), ["id"])


def saved_and_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load in place of the fitted object, transform."""
    df = feature_input(spark, sf_dir)
    path = scratch_path(spark, "feature-stages")
    save_model(features.fit_features(df), path)
    return C.vector_to_rows(features.features_of(df, load_stages(path), ["id"]))


def assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_input(spark, sf_dir).select("id", *NUMERIC)
    df = features.median_imputer(NUMERIC, 0.0).fit(df).transform(df)
    return VectorAssembler(inputCols=NUMERIC, outputCol="features").transform(df).select("id", "features")


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = assembled(spark, sf_dir)
    model = features.robust_scaler("features", "scaled", 0.0).fit(df)
    return model.transform(df).select("id", F.col("scaled").alias("features"))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = feature_input(spark, sf_dir).select("id", *TEXT)
    return features.text_indexer(TEXT).fit(df).transform(df).select("id", *[f"{c}_index" for c in TEXT])


def one_hot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = indexed(spark, sf_dir)
    wide = features.one_hot(TEXT).fit(df).transform(df)
    parts = [C.vector_to_rows(wide.select("id", F.lit(c).alias("column_name"), F.col(f"{c}_ohe").alias("features")))
             for c in TEXT]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def both_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = C.vector_to_rows(gold_features(spark, sf_dir, False)).withColumn("variant", F.lit("plain"))
    return plain.union(C.vector_to_rows(gold_features(spark, sf_dir, True)).withColumn("variant", F.lit("scaled")))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant fills, binary codes, then flags and ordered codes."""
    binary = {c: m for c, m in config.VALUE_MAPS.items() if c != "spending_score"}
    df = C.map_values(feature_input(spark, sf_dir), binary)
    return features.flag_columns(df, config.ONEHOT, {"spending_score": ["Low", "Average", "High"]})


def fitted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills, maps and flags learnt on even ids, saved, loaded and applied to odd ids."""
    rows = silver(spark, sf_dir).drop("segmentation")
    binary = {c: m for c, m in config.VALUE_MAPS.items() if c != "spending_score"}
    stages = Pipeline(stages=[fitted.ValueFill(constants=config.CONSTANT_FILLS, modes=["gender", "graduated"], medians=["age", "family_size"], error=0.0),
                              fitted.ValueMap(maps=binary), fitted.LevelFlags(columns=config.ONEHOT, ordered={"spending_score": ["Low", "Average", "High"]})])
    path = scratch_path(spark, "fitted")
    save_model(stages.fit(rows.filter("id % 2 = 0")), path)
    return load_stages(path).transform(rows.filter("id % 2 = 1"))


def _fitted_sql() -> str:
    def mode(c: str) -> str:
        return f"coalesce({c}, (SELECT {c} FROM even GROUP BY 1 ORDER BY count(*) DESC, {c} IS NULL, {c} LIMIT 1))"

    def median(c: str) -> str:
        return f"coalesce({c}, (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) FROM even))"

    values = {"gender": mode("gender"), "graduated": mode("graduated"), "ever_married": "coalesce(ever_married, 'No')"}
    cells = [f"CASE {text} WHEN '{a}' THEN {config.VALUE_MAPS[c][a]} WHEN '{b}' THEN {config.VALUE_MAPS[c][b]} END AS {c}"
             for c, text in values.items() for a, b in [list(config.VALUE_MAPS[c])]]
    cells += [f"{median(c)} AS {c}" for c in ("age", "family_size")]
    cells += ["id", "work_experience", "CASE spending_score WHEN 'Low' THEN 0.0::DOUBLE WHEN 'Average' THEN 1.0::DOUBLE WHEN 'High' THEN 2.0::DOUBLE END AS spending_score"]
    cells += [f"CAST(coalesce(profession, 'Other') = '{p}' AS INT)::DOUBLE AS profession_{p}" for p in PROFESSIONS]
    cells += [f"coalesce(CAST(var_1 = '{v}' AS INT), 0)::DOUBLE AS var_1_{v}" for v in CATEGORIES]
    cells += ["CAST(var_1 IS NULL AS INT)::DOUBLE AS var_1_missing"]
    return with_ctes("silver", "SELECT " + ", ".join(cells) + " FROM silver WHERE id % 2 = 1", even="SELECT * FROM silver WHERE id % 2 = 0")


def labelled_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense features joined with shifted labels, one column per slot."""
    target = C.shift_labels(medallion.gold_target(silver(spark, sf_dir)), "segmentation")
    joined = gold_features(spark, sf_dir, False).join(target, "id")
    labelled = C.rename_cast(joined, "segmentation", "label", "double")
    return C.vector_to_columns(C.densify(labelled), size=C.vector_size(labelled))


# ---- SQL for the vectors -------------------------------------------------
def _median(c, source="inputs"):
    return f"(SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY {c}) FROM {source})"


def _levels_ctes():
    ctes = {f"lv_{c}": f"SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS ix FROM "
                       f"(SELECT {c} AS v, count(*) AS n FROM inputs WHERE {c} IS NOT NULL GROUP BY 1)" for c in TEXT}
    ctes["filled"] = f"SELECT id, coalesce(age, {_median('age')}) AS age, " \
                     f"coalesce(family_size, {_median('family_size')}) AS family_size FROM inputs"
    return ctes


def _width(c):
    return f"(SELECT count(*) + 1 FROM lv_{c})"


def _index(c):
    return f"coalesce((SELECT ix FROM lv_{c} WHERE v = i.{c}), (SELECT count(*) FROM lv_{c}))"


def _ohe_sql(c, offset="0", extra=""):
    return (f"SELECT i.id, {extra}CAST(s.slot + {offset} AS INT) AS pos, "
            f"CASE WHEN coalesce(l.ix, {_width(c)} - 1) = s.slot THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value "
            f"FROM inputs i LEFT JOIN lv_{c} l ON l.v = i.{c}, "
            f"(SELECT unnest(range({_width(c)})) AS slot) s")


def _numeric_sql(scale):
    parts = []
    for pos, c in enumerate(NUMERIC):
        spread = (f"(SELECT percentile_disc(0.75) WITHIN GROUP (ORDER BY {c}) - percentile_disc(0.25) "
                  f"WITHIN GROUP (ORDER BY {c}) FROM filled)")
        value = f"round({c} / CAST({spread} AS DOUBLE), 6)" if scale else c
        parts.append(f"SELECT id, {pos} AS pos, CAST({value} AS DOUBLE) AS value FROM filled")
    return parts


def _vector_sql(scale):
    parts, offset = _numeric_sql(scale), str(len(NUMERIC))
    for c in TEXT:
        parts.append(_ohe_sql(c, offset))
        offset += f" + {_width(c)}"
    return union_all(parts)


def _features_query(scale):
    return with_ctes("inputs", _vector_sql(scale), **_levels_ctes())


def _slots_sql():
    cells = ", ".join(f"max(CASE WHEN pos = {i} THEN value END) AS f{i}" for i in range(WIDTH))
    return with_ctes("target", f"SELECT v.id, CAST(max(t.segmentation) - 1 AS DOUBLE) AS label, {cells} FROM vectors v "
                               "JOIN target t ON t.id = v.id GROUP BY v.id", **_levels_ctes(), vectors=_vector_sql(False))


PROFESSIONS = ["Artist", "Doctor", "Engineer", "Entertainment", "Executive", "Healthcare", "Homemaker", "Lawyer",
               "Marketing", "Other"]
CATEGORIES = [f"Cat_{i}" for i in range(1, 8)]


def _flags_select():
    cells = [f"CAST(profession = '{p}' AS INT)::DOUBLE AS profession_{p}" for p in PROFESSIONS]
    cells += [f"coalesce(CAST(var_1 = '{v}' AS INT), 0)::DOUBLE AS var_1_{v}" for v in CATEGORIES]
    cells += ["CAST(var_1 IS NULL AS INT)::DOUBLE AS var_1_missing", "CAST(spending_score AS DOUBLE) AS spending_score"]
    cells += ["id", "gender", "ever_married", "age", "graduated", "work_experience", "family_size"]
    return "SELECT " + ", ".join(cells) + " FROM encoded"


# ---- folds and metrics -----------------------------------------------------
def graded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as labels and a quantity-based guess as prediction, by flag (model) and status (fold)."""
    guess = (F.col("l_quantity").cast("int") % 7 + 1).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("params"), F.col("l_linestatus").alias("fold"),
        F.col("l_linenumber").cast("double").alias("label"), guess.alias("prediction"))


GRADED = ("SELECT l_returnflag AS params, l_linestatus AS fold, CAST(l_linenumber AS DOUBLE) AS label, "
          "CAST(CAST(trunc(l_quantity) AS INT) % 7 + 1 AS DOUBLE) AS prediction FROM lineitem")


def metric_ctes(by: list[str], source: str = "graded") -> dict[str, str]:
    keys = "".join(f"{b}, " for b in by)
    on = " AND ".join(["a.class = p.class", *[f"a.{b} = p.{b}" for b in by]])
    a_keys = "".join(f"a.{b}, " for b in by)
    group = f" GROUP BY {', '.join(by)}" if by else ""
    return {
        "actual": f"SELECT {keys}label AS class, count(*) AS actual, count(*) FILTER (WHERE label = prediction) AS hits "
                  f"FROM {source} GROUP BY {keys}label",
        "guessed": f"SELECT {keys}prediction AS class, count(*) AS predicted FROM {source} GROUP BY {keys}prediction",
        "per_class": f"SELECT {a_keys}a.class, actual, hits, coalesce(hits / CAST(predicted AS DOUBLE), 0) AS pr, "
                     f"hits / CAST(actual AS DOUBLE) AS re FROM actual a LEFT JOIN guessed p ON {on}",
        "scores": f"SELECT {keys}sum(actual * CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END) / sum(actual) "
                  "AS f1_score, sum(hits) / CAST(sum(actual) AS DOUBLE) AS accuracy, "
                  "sum(actual * pr) / sum(actual) AS weighted_precision, "
                  f"sum(actual * re) / sum(actual) AS weighted_recall FROM per_class{group}",
    }


def _rounded_metrics(extra=""):
    return ", ".join([*([extra] if extra else []), *[f"round({m}, 6) AS {m}" for m in metrics.METRICS]])


def score_sql(body: str, by: list[str], source_sql: str = GRADED) -> str:
    ctes = {"graded": source_sql, **metric_ctes(by)}
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in ctes.items()) + " " + body


def rounded(df):
    return C.round_doubles(df, 6)


def run_table(spark, sf_dir):
    """Scores with a parent and a status, as a run log would hold them."""
    scores = metrics.weighted_metrics(graded_lines(spark, sf_dir), by=["params", "fold"])
    return scores.withColumn("parent", F.col("params")).withColumn(
        "status", F.when(F.col("fold") == "F", "FINISHED").otherwise("FAILED"))


def label_predictions(spark, sf_dir):
    """The toxicity flag judged as a guess of the quality flag."""
    return table(spark, sf_dir, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction"))


def model_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), F.col("event_id").alias("version"))


def shifted_shares(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", F.col("l_returnflag").alias("prediction"))
    return rounded(metrics.share_shift(lines.filter(F.col("l_linestatus") == "F"),
                                       lines.filter(F.col("l_linestatus") != "F"), limit=0.05))


def shifted_shares_with_null(spark, sf_dir):
    kind = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", kind.alias("prediction"))
    return rounded(metrics.share_shift(lines.filter(F.col("l_linestatus") == "F"),
                                       lines.filter(F.col("l_linestatus") != "F"), limit=0.05))


DRIFT_COLUMNS = {"quantity": "CASE WHEN l_linenumber = 7 THEN CAST('NaN' AS DOUBLE) ELSE l_quantity END",
                 "price": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END",
                 "line": "CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE l_linenumber + 1 END"}


def drifted_numbers(spark, sf_dir):
    """Open against finished line items, with NaN, NULL and one column that moved."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_linestatus", *[f"{text} AS {c}" for c, text in DRIFT_COLUMNS.items()])
    return rounded(metrics.numeric_drift(lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus <> 'F'"), list(DRIFT_COLUMNS), bins=8))


_drift_sql = (
    "WITH x AS (SELECT l_linestatus = 'F' AS ref, " + ", ".join(f"CAST({text} AS DOUBLE) AS {c}" for c, text in DRIFT_COLUMNS.items()) + " FROM lineitem), "
    f"cells AS (SELECT ref, unnest({list(DRIFT_COLUMNS)}) AS column_name, unnest([{', '.join(DRIFT_COLUMNS)}]) AS v FROM x), "
    "cuts AS (SELECT column_name, list_distinct(quantile_disc(v, [i / 8.0 FOR i IN range(1, 8)])) AS c FROM cells "
    "WHERE ref AND v IS NOT NULL AND NOT isnan(v) GROUP BY 1), "
    "placed AS (SELECT column_name, ref, CASE WHEN v IS NULL THEN -2 WHEN isnan(v) THEN -1 ELSE len(list_filter(c, lambda y: y < v)) END AS bin FROM cells JOIN cuts USING (column_name)), "
    "bins AS (SELECT column_name, unnest(range(-2, len(c) + 1)) AS bin FROM cuts), "
    "counts AS (SELECT column_name, b.bin, count(*) FILTER (WHERE ref) AS p, count(*) FILTER (WHERE NOT ref) AS q "
    "FROM bins b LEFT JOIN placed USING (column_name, bin) GROUP BY ALL), "
    "sums AS (SELECT *, sum(p) OVER w AS np, sum(q) OVER w AS nq, count(*) OVER w AS k, sum(CASE WHEN bin >= 0 THEN p ELSE 0 END) OVER u AS up, "
    "sum(CASE WHEN bin >= 0 THEN q ELSE 0 END) OVER u AS uq, sum(CASE WHEN bin >= 0 THEN p ELSE 0 END) OVER w AS tp, "
    "sum(CASE WHEN bin >= 0 THEN q ELSE 0 END) OVER w AS tq FROM counts WINDOW w AS (PARTITION BY column_name), u AS (PARTITION BY column_name ORDER BY bin)), "
    "parts AS (SELECT column_name, (p + 0.5) / (np + 0.5 * k) AS a, (q + 0.5) / (nq + 0.5 * k) AS b, abs(up / CAST(tp AS DOUBLE) - uq / CAST(tq AS DOUBLE)) AS gap FROM sums) "
    "SELECT column_name, round(sum((b - a) * ln(b / a)), 6) AS stability_index, round(max(gap), 6) AS ks_distance, sum((b - a) * ln(b / a)) > 0.2 AS drifted FROM parts GROUP BY 1")


def _shift_sql(kind: str) -> str:
    return (f"WITH c AS (SELECT {kind} AS \"class\", count(*) FILTER (WHERE l_linestatus = 'F') AS a, "
            "count(*) FILTER (WHERE l_linestatus <> 'F') AS b FROM lineitem GROUP BY 1), "
            "s AS (SELECT \"class\", a / CAST(sum(a) OVER () AS DOUBLE) AS x, b / CAST(sum(b) OVER () AS DOUBLE) AS y FROM c) "
            "SELECT \"class\", round(x, 6) AS share_reference, round(y, 6) AS share_current, round(y - x, 6) AS shift, "
            "abs(y - x) > 0.05 AS drifted FROM s")


FOLD_SQL = ("CAST((row_number() OVER (PARTITION BY segmentation ORDER BY md5(concat('13:', CAST(id AS VARCHAR))), id) - 1) "
            "% 3 AS INT) AS fold")


def folded(spark, sf_dir):
    return folds.stratified_folds(silver(spark, sf_dir).select("id", "segmentation"), "segmentation", "id")


def orders_folded(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return folds.stratified_folds(df, "o_orderstatus", "o_orderkey", folds=5, seed=7)


def fold_rows(spark, sf_dir):
    """Training and validation rows of every fold."""
    df = folded(spark, sf_dir)
    parts = []
    for i in range(3):
        train, held = folds.fold_split(df, i)
        parts += [train.select("id", F.lit(i).alias("held_out"), F.lit("train").alias("part")),
                  held.select("id", F.lit(i).alias("held_out"), F.lit("validate").alias("part"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


QUERIES: dict[str, Query] = {
    "b16_slots_as_columns": Query(labelled_slots, _slots_sql()),
    "h3_median_imputer": Query(
        lambda s, d: features.median_imputer(NUMERIC, 0.0).fit(feature_input(s, d)).transform(feature_input(s, d)),
        with_ctes("inputs", f"SELECT * REPLACE (coalesce(age, {_median('age')}) AS age, "
                            f"coalesce(family_size, {_median('family_size')}) AS family_size) FROM inputs")),
    "h4_numeric_vector": Query(
        lambda s, d: C.vector_to_rows(assembled(s, d)),
        with_ctes("inputs", union_all(_numeric_sql(False)), **_levels_ctes())),
    "h5_robust_scaler": Query(
        lambda s, d: C.vector_to_rows(scaled(s, d)),
        with_ctes("inputs", union_all(_numeric_sql(True)), **_levels_ctes())),
    "h6_string_index": Query(
        indexed,
        with_ctes("inputs", "SELECT i.id, " + ", ".join(f"CAST({_index(c)} AS DOUBLE) AS {c}_index" for c in TEXT) +
                  " FROM inputs i", **_levels_ctes())),
    "h7_one_hot": Query(
        one_hot_rows,
        with_ctes("inputs", union_all([_ohe_sql(c, "0", f"'{c}' AS column_name, ") for c in TEXT]), **_levels_ctes())),
    "h8_feature_vector": Query(lambda s, d: C.vector_to_rows(gold_features(s, d, False)), _features_query(False)),
    "h9_stage_variants": Query(
        both_variants,
        with_ctes("inputs", f"SELECT *, 'plain' AS variant FROM ({_vector_sql(False)}) UNION ALL "
                            f"SELECT *, 'scaled' AS variant FROM ({_vector_sql(True)})", **_levels_ctes())),
    "h10_fit_transform": Query(lambda s, d: C.vector_to_rows(gold_features(s, d, True)), _features_query(True)),
    "h11_gold_scaled_features": Query(
        lambda s, d: C.vector_to_rows(gold_features(s, d, True)), _features_query(True)),
    "h11_gold_plain_features": Query(
        lambda s, d: C.vector_to_rows(gold_features(s, d, False)), _features_query(False)),
    "a16_saved_stages": Query(saved_and_loaded, _features_query(False)),
    "h13_fitted_stages": Query(fitted_table, _fitted_sql()),
    "h13_flag_columns": Query(flags, with_ctes("encoded", _flags_select())),
    "i8_stratified_folds": Query(folded, with_ctes("silver", f"SELECT id, segmentation, {FOLD_SQL} FROM silver")),
    "i8_stratified_folds_orders": Query(
        orders_folded,
        "SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY "
        "md5(concat('7:', CAST(o_orderkey AS VARCHAR))), o_orderkey) - 1) % 5 AS INT) AS fold FROM orders"),
    "c7_fold_membership": Query(
        fold_rows,
        with_ctes("silver", "SELECT id, CAST(h AS INT) AS held_out, CASE WHEN fold = h THEN 'validate' ELSE 'train' END AS part "
                            "FROM folds, (SELECT unnest(range(3)) AS h)", folds=f"SELECT id, {FOLD_SQL} FROM silver")),
    "e11_weighted_metrics": Query(
        lambda s, d: rounded(metrics.weighted_metrics(graded_lines(s, d))),
        score_sql(f"SELECT {_rounded_metrics()} FROM scores", [])),
    "e11_weighted_metrics_labels": Query(
        lambda s, d: rounded(metrics.weighted_metrics(label_predictions(s, d))),
        score_sql(f"SELECT {_rounded_metrics()} FROM scores", [],
                  "SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels")),
    "e12_fold_means": Query(
        lambda s, d: rounded(metrics.fold_means(metrics.weighted_metrics(graded_lines(s, d), by=["params", "fold"]),
                                                ["params"])),
        score_sql("SELECT params, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in metrics.METRICS) +
                  " FROM scores GROUP BY 1", ["params", "fold"])),
    "e13_best_configuration": Query(
        lambda s, d: rounded(metrics.best_configuration(
            metrics.weighted_metrics(graded_lines(s, d), by=["params", "fold"]), "params", by=["fold"])),
        score_sql("SELECT fold, params, round(f1_score, 6) AS f1_score FROM (SELECT *, row_number() OVER (PARTITION BY fold "
                  "ORDER BY f1_score DESC, params) AS r FROM scores) WHERE r = 1", ["params", "fold"])),
    "e14_latest_version": Query(
        lambda s, d: metrics.latest_version(model_log(s, d)),
        "SELECT event_type AS name, max(event_id) AS version FROM events GROUP BY 1"),
    "f2_leaderboard": Query(
        lambda s, d: rounded(metrics.leaderboard(
            metrics.weighted_metrics(graded_lines(s, d), by=["params", "fold"]), ties=["params", "fold"])),
        score_sql(f"SELECT {_rounded_metrics('params, fold')} FROM scores ORDER BY f1_score DESC", ["params", "fold"])),
    "f3_finished_runs": Query(
        lambda s, d: rounded(metrics.finished_runs(run_table(s, d), "R", "f1_score")),
        score_sql(f"SELECT {_rounded_metrics('params, fold')}, params AS parent, 'FINISHED' AS status FROM scores "
                  "WHERE fold = 'F' AND params = 'R'", ["params", "fold"])),
    "i16_quality_watch": Query(
        lambda s, d: rounded(metrics.quality_watch(
            metrics.weighted_metrics(graded_lines(s, d), by=["params", "fold"]), floor=0.145)),
        score_sql(f"SELECT {_rounded_metrics('params, fold')}, f1_score < 0.145 AS retrain FROM scores", ["params", "fold"])),
    "i16_numeric_drift": Query(drifted_numbers, _drift_sql),
    "i16_share_shift": Query(shifted_shares, _shift_sql("l_returnflag")),
    "i16_share_shift_null_class": Query(
        shifted_shares_with_null, _shift_sql("CASE WHEN l_returnflag <> 'A' THEN l_returnflag END")),
}


# ---- nearest neighbours -----------------------------------------------------
FLAG_NAMES = [f"profession_{p}" for p in PROFESSIONS] + [f"var_1_{v}" for v in [*CATEGORIES, "missing"]]
KNN_COLUMNS = FLAG_NAMES + ["spending_score", "gender", "ever_married", "age", "graduated", "work_experience", "family_size"]
KNN_TARGETS = ["gender", "age", "graduated", "work_experience", "family_size"]


def knn_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flags(spark, sf_dir)
    columns = [c for c in df.columns if c != "id"]
    return rounded(knn.knn_impute(df, "id", columns, k=5))


def _knn_sql():
    ctes = {"flags": _flags_select()}
    for t in KNN_TARGETS:
        others = [c for c in KNN_COLUMNS if c != t]
        total = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0.0)" for c in others)
        shared = " + ".join(f"CAST(r.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INT)" for c in others)
        ctes[f"near_{t}"] = (
            f"SELECT id, avg(v) AS value FROM (SELECT r.id, CAST(d.{t} AS DOUBLE) AS v, row_number() OVER "
            f"(PARTITION BY r.id ORDER BY ({total}) * {len(KNN_COLUMNS)} / CAST({shared} AS DOUBLE), d.id) AS k "
            f"FROM flags r JOIN flags d ON r.{t} IS NULL AND d.{t} IS NOT NULL) WHERE k <= 5 GROUP BY 1")
    cells = ", ".join(f"round(coalesce(CAST(f.{c} AS DOUBLE), near_{c}.value), 6) AS {c}" if c in KNN_TARGETS
                      else f"CAST(f.{c} AS DOUBLE) AS {c}" for c in KNN_COLUMNS)
    joins = " ".join(f"LEFT JOIN near_{t} ON near_{t}.id = f.id" for t in KNN_TARGETS)
    return with_ctes("encoded", f"SELECT f.id, {cells} FROM flags f {joins}", **ctes)


QUERIES["h12_knn_imputation"] = Query(knn_filled, _knn_sql())
