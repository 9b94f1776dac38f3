"""Synthetic rows that follow the training data's class shares and, within each class, each column's distribution.

Every draw is a hash of (seed, column, row number), so rows are reproducible wherever they are computed.
Columns are drawn independently given the class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.dependence import dependent_rows
from cohortflow.operators.ranking import running_total
from cohortflow.operators.stats import detect_kinds, is_numeric

BROADCAST_VALUES = 1_000_000  # table entries, some tens of MB


def uniform(seed: int, tag: str, row: str = "row") -> Column:
    """A number in [0, 1) from 32 hash bits."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), F.col(row).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _value_tables(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Per class and column: values in order (numbers as such) with the running count up to each; values are few."""
    cells = df.select(F.col(label).alias("_class"), *[F.col(c).cast("string").alias(c) for c in columns])
    counts = (cells.unpivot(["_class"], columns, "column_name", "value")
              .groupBy("_class", "column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    # NULL comes first, as in the running total below; a class's values of one column are few here
    number = F.when(F.col("column_name").isin([c for c in columns if is_numeric(df, c)]), F.col("value").try_cast("double"))
    before = Window.partitionBy("_class", "column_name").orderBy(number, "value").rowsBetween(Window.unboundedPreceding, 0)
    pairs = F.sort_array(F.collect_list(F.struct("upto", "value")))
    arrays = counts.withColumn("upto", F.sum("n").over(before)).groupBy("_class", "column_name").agg(pairs.alias("pairs"))
    return arrays.select("_class", "column_name", F.col("pairs.value").alias("values"), F.col("pairs.upto").alias("upto"))


def _class_tables(df: DataFrame, label: str, narrow: list[str]) -> DataFrame:
    """One row per class: its size and value tables of the narrow columns."""
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    if not narrow:
        return sizes
    wide = _value_tables(df, label, narrow).groupBy("_class").agg(*[
        F.first(F.when(F.col("column_name") == c, F.struct("values", "upto")), ignorenulls=True).alias(f"_v_{c}")
        for c in narrow])
    return sizes.join(wide, sizes["_class"].eqNullSafe(wide["_class"])).drop(wide["_class"])


def _wide_column(drawn: DataFrame, df: DataFrame, label: str, column: str, seed: int, levels: int) -> DataFrame:
    """(row, value) for a column with too many values for an array: the running counts are cut into equal
    stretches and a draw meets only the values of its stretch."""
    counts = df.groupBy(F.col(label).alias("_class"), F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    spans = running_total(counts, ["_class"], ["_value"], "n")
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    stretch = F.greatest(F.floor(F.col("_n") / levels), F.lit(1))
    sizes = sizes.withColumn("_stretch", stretch)
    spans = (spans.join(sizes, spans["_class"].eqNullSafe(sizes["_class"])).drop(sizes["_class"])
             .withColumn("_from", F.col("upto") - F.col("n"))
             .withColumn("_bucket", F.explode(F.sequence(
                 F.floor(F.col("_from") / F.col("_stretch")), F.floor((F.col("upto") - 1) / F.col("_stretch")))))
             .select(F.col("_class").alias("_span_class"), "_bucket", "_from", "upto", "_value"))
    rank = F.floor(uniform(seed, column) * F.col("_n"))
    seek = drawn.select("row", "_class", "_n", rank.alias("_rank")).withColumn(
        "_bucket", F.floor(F.col("_rank") / F.greatest(F.floor(F.col("_n") / levels), F.lit(1))))
    met = (seek["_class"].eqNullSafe(spans["_span_class"]) & (seek["_bucket"] == spans["_bucket"])
           & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("upto")))
    return seek.join(spans, met).select("row", F.col("_value").alias(column))


def synthetic_rows(df: DataFrame, label: str, rows: int, seed: int = 13, max_levels: int = 1000,
                   id_start: int = 1) -> DataFrame:
    """As many rows as asked for, with the columns of df. Id columns count up from id_start.

    Every other column, number or text, is drawn by rank over the running counts of its class, so each value of df can
    come, as often as it is frequent. Columns with few values keep their counts in arrays, the others in a table, as do
    all columns where there are many classes; all ways draw the same value for a rank.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != label]
    kinds = detect_kinds(df, columns)
    ranked = [c for c in columns if kinds[c] != "id"]
    levels = df.agg(*[F.approx_count_distinct(c).alias(c) for c in [label, *ranked]]).first()
    if levels[label] > max_levels:  # the same draws from one table of running counts, classes among them
        return dependent_rows(df, label, rows, seed, dict.fromkeys(ranked, label), id_start)
    narrow = [c for c in ranked if levels[c] <= max_levels and levels[c] * levels[label] <= 100 * max_levels]

    # Class shares: one literal array, as long as there are classes.
    shares = sorted(((r["_class"], r["n"]) for r in df.groupBy(F.col(label).alias("_class"))
                     .agg(F.count(F.lit(1)).alias("n")).collect()), key=lambda x: (x[0] is not None, x[0]))
    total = sum(n for _, n in shares)
    rank, upto, pick = F.floor(uniform(seed, label) * F.lit(float(total))), 0, None
    for value, n in shares:
        upto += n
        value = F.lit(value).cast(df.schema[label].dataType)
        pick = F.when(rank < upto, value) if pick is None else pick.when(rank < upto, value)
    base = spark.range(rows).select(F.col("id").alias("row")).withColumn("_class", pick)

    # One row per class with short arrays. Their total length is known here, so broadcast only what is small.
    tables = _class_tables(df, label, narrow).withColumnRenamed("_class", "_known")
    if levels[label] * sum(levels[c] for c in narrow) <= BROADCAST_VALUES:
        tables = F.broadcast(tables)
    drawn = base.join(tables, F.col("_class").eqNullSafe(F.col("_known")))

    def value_of(c: str) -> Column:
        kind = df.schema[c].dataType
        if kinds[c] == "id":
            number = F.col("row") + F.lit(id_start)
            return number.cast(kind) if is_numeric(df, c) else F.concat(F.lit(f"{c}_"), number.cast("string"))
        spot = F.floor(uniform(seed, c) * F.col("_n"))
        above = F.size(F.filter(F.col(f"_v_{c}.upto"), lambda bound: bound <= spot))
        return F.element_at(F.col(f"_v_{c}.values"), above + 1).cast(kind)

    simple = [c for c in columns if c not in ranked or c in narrow]
    out = drawn.select("row", *[value_of(c).alias(c) for c in simple], F.col("_class").alias(label))
    for c in ranked:
        if c not in narrow:
            found = _wide_column(drawn, df, label, c, seed, max(int(levels[c]), 1))
            out = out.join(found, "row")
    return out.select(*df.columns)


def synthetic_split(df: DataFrame, label: str, rows: int, **options) -> tuple[DataFrame, DataFrame]:
    """A synthetic scoring set as (features, target)."""
    made = synthetic_rows(df, label, rows, **options)
    return made.drop(label), made.select(label)
