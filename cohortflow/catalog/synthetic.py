"""Queries over synthetic data: as many rows as the silver table has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.catalog.base import PROFILE_COLUMNS, Query, silver, table, union_all, with_ctes
from cohortflow.operators import dependence, synth
from cohortflow.session import scratch_path
from cohortflow.sources import files

RANKED = [c for c in PROFILE_COLUMNS if c not in ("id", "segmentation")]


def made(spark: SparkSession, sf_dir: str, seed: int = 13) -> DataFrame:
    df = silver(spark, sf_dir)
    return synth.synthetic_rows(df, "segmentation", df.count(), seed=seed)


def features_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver(spark, sf_dir)
    return synth.synthetic_split(df, "segmentation", df.count(), seed=29)[0]


def target_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver(spark, sf_dir)
    target = synth.synthetic_split(df, "segmentation", df.count(), seed=29)[1]
    return target.groupBy("segmentation").agg(F.count(F.lit(1)).alias("n"))


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dated batches, one landed twice, read back."""
    path = scratch_path(spark, "landed")
    batch = made(spark, sf_dir)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        files.land_batch(batch, path, day)
    back = files.read_csv(spark, path, batch.schema.add("batch_date", "string"))
    return back.select(*PROFILE_COLUMNS, "batch_date")


def many_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by status: a number column in which nearly every value is its own."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", F.col("o_totalprice").cast("double").alias("total"))
    return synth.synthetic_rows(orders, "o_orderstatus", orders.count(), max_levels=100)


def wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as synthetic order owners: a column with more values than fit an array."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("owner"))
    return synth.synthetic_rows(orders, "o_orderstatus", orders.count(), max_levels=100)


def _u(seed, tag, row="r"):
    return f"(CAST('0x' || substr(md5(concat('{seed}:{tag}:', CAST({row} AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def synth_sql(seed: int, select: str) -> str:
    ctes = {
        "shares": "SELECT segmentation AS c, count(*) AS n, sum(count(*)) OVER (ORDER BY segmentation) AS hi FROM silver GROUP BY 1",
        "rows_": "SELECT unnest(range((SELECT count(*) FROM silver))) AS r",
        "picked": f"SELECT r, floor({_u(seed, 'segmentation')} * (SELECT count(*) FROM silver)) AS spot FROM rows_",
        "base": "SELECT r, c, n FROM picked JOIN shares ON spot < hi AND spot >= hi - n",
    }
    for c in RANKED:
        ctes[f"t_{c}"] = (f"SELECT segmentation AS c, {c} AS v, count(*) AS n, sum(count(*)) OVER (PARTITION BY segmentation "
                          f"ORDER BY {c} NULLS FIRST) AS hi FROM silver GROUP BY 1, 2")
        ctes[f"d_{c}"] = (f"SELECT b.r, t.v FROM (SELECT *, floor({_u(seed, c)} * n) AS spot FROM base) b "
                          f"JOIN t_{c} t ON t.c = b.c AND b.spot < t.hi AND b.spot >= t.hi - t.n")
    cells = ", ".join(f"d_{c}.v AS {c}" for c in PROFILE_COLUMNS if c not in ("id", "segmentation"))
    joins = " ".join(f"JOIN d_{c} ON d_{c}.r = base.r" for c in RANKED)
    ctes["made"] = f"SELECT base.r + 1 AS id, {cells}, base.c AS segmentation FROM base {joins}"
    return with_ctes("silver", select, **ctes)


def _wide_sql(column: str, value: str) -> str:
    return (
        f"WITH o AS (SELECT o_orderstatus AS c, {value} AS v FROM orders), "
        "s AS (SELECT c, count(*) AS n, sum(count(*)) OVER (ORDER BY c) AS hi FROM o GROUP BY 1), "
        "t AS (SELECT c, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY c ORDER BY v) AS hi FROM o GROUP BY 1, 2), "
        "b AS (SELECT r, c, n FROM (SELECT r, floor(" + _u(13, "o_orderstatus") + " * (SELECT count(*) FROM o)) AS spot "
        "FROM (SELECT unnest(range((SELECT count(*) FROM o))) AS r)) JOIN s ON spot < hi AND spot >= hi - n) "
        f"SELECT b.c AS o_orderstatus, t.v AS {column} FROM (SELECT *, floor(" + _u(13, column) + " * n) AS spot FROM b) b "
        "JOIN t ON t.c = b.c AND b.spot < t.hi AND b.spot >= t.hi - t.n")


# Some of the profile's columns tell much about each other; every column but the label and the id has a parent here.
PARENTS = {"age": "segmentation", "gender": "age", "ever_married": "age", "graduated": "segmentation", "profession": "segmentation",
           "var_1": "profession", "work_experience": "graduated", "spending_score": "segmentation", "family_size": "work_experience"}


def dependent(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = silver(spark, sf_dir)
    return dependence.dependent_rows(df, "segmentation", df.count(), seed=17, parents=PARENTS)


def spanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the tree that the data give."""
    df = silver(spark, sf_dir)
    return dependence.dependent_rows(df, "segmentation", df.count(), seed=17)


def information(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dependence.pair_information(silver(spark, sf_dir), [*RANKED, "segmentation"])
    return found.withColumn("information", F.round("information", 6))


def dependent_sql(seed: int, select: str) -> str:
    ctes = {
        "shares": "SELECT segmentation AS v, count(*) AS n, sum(count(*)) OVER (ORDER BY segmentation NULLS FIRST) AS hi FROM silver GROUP BY 1",
        "d_segmentation": f"SELECT r, v FROM (SELECT r, floor({_u(seed, 'segmentation')} * (SELECT count(*) FROM silver)) AS spot "
                          "FROM (SELECT unnest(range((SELECT count(*) FROM silver))) AS r)) JOIN shares ON spot < hi AND spot >= hi - n",
    }
    for c, p in PARENTS.items():
        ctes[f"t_{c}"] = (f"SELECT {p} AS p, {c} AS v, count(*) AS n, sum(count(*)) OVER (PARTITION BY {p} ORDER BY {c} NULLS FIRST) AS hi, "
                          f"sum(count(*)) OVER (PARTITION BY {p}) AS total FROM silver GROUP BY 1, 2")
        ctes[f"s_{c}"] = f"SELECT d.r, d.v AS p, floor({_u(seed, c, 'd.r')} * s.total) AS spot FROM d_{p} d JOIN (SELECT DISTINCT p, total FROM t_{c}) s ON s.p IS NOT DISTINCT FROM d.v"
        ctes[f"d_{c}"] = f"SELECT s.r, t.v FROM s_{c} s JOIN t_{c} t ON t.p IS NOT DISTINCT FROM s.p AND s.spot < t.hi AND s.spot >= t.hi - t.n"
    cells = ", ".join(f"d_{c}.v AS {c}" for c in PROFILE_COLUMNS if c != "id")
    joins = " ".join(f"JOIN d_{c} ON d_{c}.r = d_segmentation.r" for c in RANKED)
    ctes["made"] = f"SELECT d_segmentation.r + 1 AS id, {cells} FROM d_segmentation {joins}"
    return with_ctes("silver", select, **ctes)


def _information_sql() -> str:
    columns = [*RANKED, "segmentation"]
    stats = [f"SELECT {i} AS a, {j} AS b, sum(n) AS n, sum(n * ln(n)) AS s, count(*) AS k FROM (SELECT count(*) AS n FROM silver GROUP BY {x}, {y})"
             for i, x in enumerate(columns) for j, y in enumerate(columns) if i <= j]
    return with_ctes(
        "silver", "SELECT names[p.a + 1] AS column_a, names[p.b + 1] AS column_b, round(ln(p.n) + (p.s - x.s - y.s) / p.n - (x.k - 1) * (y.k - 1) / (2.0::DOUBLE * p.n), 6) "
        f"AS information FROM pairs p JOIN pairs x ON x.a = p.a AND x.b = p.a JOIN pairs y ON y.a = p.b AND y.b = p.b, (SELECT {columns} AS names) WHERE p.a < p.b",
        pairs=union_all(stats))


QUERIES: dict[str, Query] = {
    "l2_dependent_rows": Query(dependent, dependent_sql(17, "SELECT * FROM made")),
    "l2_dependent_rows_by_tree": Query(spanned),
    "l2_mutual_information": Query(information, _information_sql()),
    "l2_synthetic_rows": Query(made, synth_sql(13, "SELECT * FROM made")),
    "l2_synthetic_wide_column": Query(wide_values, _wide_sql("owner", "'c' || CAST(o_custkey AS VARCHAR)")),
    "l2_synthetic_many_numbers": Query(many_numbers, _wide_sql("total", "CAST(o_totalprice AS DOUBLE)")),
    "l3_synthetic_features": Query(features_only, synth_sql(29, "SELECT * EXCLUDE (segmentation) FROM made")),
    "l3_synthetic_target": Query(target_only, synth_sql(29, "SELECT segmentation, count(*) AS n FROM made GROUP BY 1")),
    "a17_landed_batches": Query(landed, synth_sql(13, union_all(
        [f"SELECT *, '{day}' AS batch_date FROM made" for day in ("2024-01-01", "2024-01-02")]))),
}
