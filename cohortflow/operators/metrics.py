"""Classification metrics and comparisons of runs, from confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.stats import quantiles

METRICS = ["f1_score", "accuracy", "weighted_precision", "weighted_recall"]


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] = ()) -> DataFrame:
    """Rows per (label, prediction) and group: the only step that reads the predictions."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: list[str] = ()) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1, one row per group."""
    zero = F.lit(0)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), zero.cast("bigint").alias("predicted"),
                 hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.cast("bigint").alias("actual"), F.col("n").alias("predicted"),
                 zero.cast("bigint").alias("hits"))))
    per_class = (confusion(df, label, prediction, by).select(*by, sides).groupBy(*by, "class")
                 .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")]))

    def ratio(top, bottom):
        return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)

    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("actual"))
    f1 = ratio(2 * precision * recall, precision + recall)
    total = F.sum("actual")
    return per_class.groupBy(*by).agg(
        (F.sum(F.col("actual") * f1) / total).alias("f1_score"),
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.col("actual") * precision) / total).alias("weighted_precision"),
        (F.sum(F.col("actual") * recall) / total).alias("weighted_recall"))


def fold_means(scores: DataFrame, by: list[str]) -> DataFrame:
    """Mean of each metric over the folds of a configuration."""
    return scores.groupBy(*by).agg(*[F.avg(m).alias(m) for m in METRICS if m in scores.columns])


def best_configuration(scores: DataFrame, config: str, metric: str = "f1_score", by: list[str] = ()) -> DataFrame:
    """The configuration with the highest metric; on a tie the smallest configuration."""
    best = F.min(F.struct((-F.col(metric)).alias("score"), F.col(config).alias("config")))
    return (scores.groupBy(*by).agg(best.alias("best"))
            .select(*by, F.col("best.config").alias(config), (-F.col("best.score")).alias(metric)))


def leaderboard(results: DataFrame, metric: str = "f1_score", ties: list[str] = ()) -> DataFrame:
    return results.orderBy(F.desc(metric), *ties)


def finished_runs(runs: DataFrame, parent: str, metric: str, status: str = "FINISHED", ties: list[str] = ()) -> DataFrame:
    """Runs below one parent with the given status, best first."""
    return leaderboard(runs.filter((F.col("parent") == parent) & (F.col("status") == status)), metric, ties)


def latest_version(log: DataFrame, name: str | None = None) -> DataFrame:
    """Highest version per model name, or of one model."""
    log = log if name is None else log.filter(F.col("name") == name)
    return log.groupBy("name").agg(F.max("version").alias("version"))


def quality_watch(scores: DataFrame, metric: str = "f1_score", floor: float = 0.5) -> DataFrame:
    """Marks batches whose metric fell below the floor."""
    return scores.withColumn("retrain", F.col(metric) < floor)


def share_shift(reference: DataFrame, current: DataFrame, column: str = "prediction", limit: float = 0.1) -> DataFrame:
    """Class shares then and now, their difference, and whether it exceeds the limit. NULL is a class like any other."""
    sides = [df.select(F.col(column).alias("class"), F.lit(now).alias("_now")) for df, now in ((reference, False), (current, True))]
    both = sides[0].union(sides[1]).groupBy("class").agg(
        F.count_if(~F.col("_now")).alias("n_reference"), F.count_if("_now").alias("n_current"))
    everything = Window.partitionBy(F.lit(0))  # one row per class at this point
    shares = both.select("*", F.sum("n_reference").over(everything).alias("all_reference"),
                         F.sum("n_current").over(everything).alias("all_current"))
    return (shares.select("class", (F.col("n_reference") / F.col("all_reference")).alias("share_reference"),
                          (F.col("n_current") / F.col("all_current")).alias("share_current"))
            .withColumn("shift", F.col("share_current") - F.col("share_reference"))
            .withColumn("drifted", F.abs("shift") > limit))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, limit: float = 0.2) -> DataFrame:
    """Per number column the population stability index and the Kolmogorov-Smirnov distance, over shared cuts.

    The cuts are the reference's exact quantiles; NULL and NaN are bins of their own. Shares are smoothed by half a row a
    bin, so an empty bin has a finite part. The distance is the greatest difference of the shares up to a cut, among the
    rows that are numbers; NULL if either side has none. drifted: the index is above the limit.
    """
    found = quantiles(reference, columns, [i / bins for i in range(1, bins)]).collect()  # bins - 1 rows a column
    cuts = {c: sorted({r["value"] for r in found if r["column_name"] == c}) for c in columns}

    def bin_of(c: str) -> Column:
        x = F.col(c).cast("double")
        above = F.lit(0)
        for cut in cuts[c]:
            above = above + (x > cut).cast("int")
        return F.when(x.isNull(), -2).when(F.isnan(x), -1).otherwise(above)

    sides = [df.select(*[bin_of(c).alias(c) for c in columns]).unpivot([], columns, "column_name", "bin").groupBy("column_name", "bin")
             .agg(F.count(F.lit(1)).alias("n")).withColumn("now", F.lit(now)) for df, now in ((reference, 0), (current, 1))]
    places = reference.sparkSession.createDataFrame([(c, b) for c in columns for b in range(-2, len(cuts[c]) + 1)], "column_name string, bin int")
    # as many rows as there are bins, of all columns together
    counts = places.join(sides[0].union(sides[1]), ["column_name", "bin"], "left").groupBy("column_name", "bin").agg(
        *[F.coalesce(F.sum(F.when(F.col("now") == now, F.col("n"))), F.lit(0)).alias(name) for name, now in (("a", 0), ("b", 1))])
    whole = Window.partitionBy("column_name")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    share = lambda n: (F.col(n) + 0.5) / (F.sum(n).over(whole) + 0.5 * F.count(F.lit(1)).over(whole))
    number = lambda n: F.when(F.col("bin") >= 0, F.col(n)).otherwise(0)
    part = lambda n: F.sum(number(n)).over(upto) / F.nullif(F.sum(number(n)).over(whole), F.lit(0))
    p, q = share("a"), share("b")
    each = counts.select("column_name", ((q - p) * F.log(q / p)).alias("index"), F.abs(part("a") - part("b")).alias("gap"))
    return each.groupBy("column_name").agg(F.sum("index").alias("stability_index"), F.max("gap").alias("ks_distance")).withColumn(
        "drifted", F.col("stability_index") > limit)
