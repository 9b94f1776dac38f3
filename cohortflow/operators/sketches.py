"""Profiles that are stored per batch and merged: a profile of all batches needs no second scan of any of them.

A batch's profile is one aggregate: exact counts, sums and bounds, and for each column a sketch of its distinct values, of
its ranks (numbers) and of its frequent values. Only these are shuffled, never a cell. Merged profiles have the same exact
parts as one of all rows at once, and sketches within the same bounds: distinct counts to about 1.6 in a hundred
(standard error 0.8), ranks to about 1.5 in a hundred, and all values that are more frequent than one in three quarters of
`tracked`, with counts that are exact as long as a column has no more different values than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.stats import is_numeric

#: Logarithm of the distinct sketch's size, items of the rank sketch, values that the frequency sketch follows.
DISTINCT, RANKS, TRACKED = 14, 200, 1024


def batch_profile(df: DataFrame, columns: list[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """One row per column, to be appended to a table of profiles. NaN counts apart and has no rank; NULL is no value."""
    columns = columns or df.columns

    def parts(c: str) -> Column:
        if is_numeric(df, c):
            x = f"nullif(CAST(`{c}` AS DOUBLE), double('NaN'))"
            numbers = [f"sum({x}) AS total", f"sum({x} * {x}) AS squares", f"min({x}) AS low", f"max({x}) AS high"]
            ranks, nans = f"kll_sketch_agg_double({x}, {RANKS})", f"count_if(isnan(CAST(`{c}` AS DOUBLE)))"
        else:
            numbers = [f"CAST(NULL AS DOUBLE) AS {n}" for n in ("total", "squares", "low", "high")]
            ranks, nans = "CAST(NULL AS BINARY)", "0L"
        text = f"CAST(`{c}` AS STRING)"
        return F.expr(f"struct('{c}' AS column_name, {str(is_numeric(df, c)).lower()} AS numeric, count(1) AS rows, count(`{c}`) AS present, {nans} AS nans, "
                      + ", ".join(numbers) + f", hll_sketch_agg({text}, {DISTINCT}) AS distinct, {ranks} AS ranks, "
                      f"approx_top_k_accumulate({text}, {tracked}) AS frequent)").alias(c)

    return df.agg(*[parts(c) for c in columns]).select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def merged_profile(profiles: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row per column from the rows of any number of batches; it may be stored and merged again."""
    return profiles.groupBy("column_name").agg(
        F.bool_and("numeric").alias("numeric"), *[F.sum(c).alias(c) for c in ("rows", "present", "nans")], F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks").alias("ranks"), F.expr(f"approx_top_k_combine(frequent, {tracked})").alias("frequent"))


def profile_report(profile: DataFrame, probs: list[float] = (0.25, 0.5, 0.75), top: int = 1) -> DataFrame:
    """Long form (column_name, metric, number, text) of a batch's or a merged profile, named as in stats.table_profile."""
    numbers = F.col("present") - F.col("nans")
    mean = F.col("total") / F.nullif(numbers, F.lit(0))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("squares") - F.col("total") * mean) / F.nullif(numbers - 1, F.lit(0)))

    def metric(name: str, number: Column, text: Column | None = None) -> Column:
        return F.struct(F.lit(name).alias("metric"), number.cast("double").alias("number"), (F.lit(None) if text is None else text).cast("string").alias("text"))

    general = [metric("rows", F.col("rows")), metric("nulls", F.col("rows") - F.col("present")), metric("distinct", F.hll_sketch_estimate("distinct"))]
    # NULL is counted like a value there
    values = f"slice(filter(approx_top_k_estimate(frequent, {top + 1}), x -> x.item IS NOT NULL), 1, {top})"
    best = profile.select("column_name", F.posexplode(F.expr(values)).alias("place", "found"))
    best = best.select("column_name", F.when(F.col("place") == 0, "top").otherwise(F.concat(F.lit("top"), (F.col("place") + 1).cast("string"))).alias("metric"),
                       F.col("found.count").cast("double").alias("number"), F.col("found.item").alias("text"))
    some = F.col("numeric") & (numbers > 0)
    quantiles = [metric(f"q{int(p * 100)}", F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(float(p))))) for p in probs]
    numeric = [metric("mean", mean), metric("stddev", spread), metric("min", F.col("low")), *quantiles, metric("max", F.col("high"))]
    return (profile.select("column_name", F.inline(F.array(*general)))
            .unionByName(best)
            .unionByName(profile.filter("numeric").select("column_name", F.inline(F.array(*numeric)))))
