"""Table statistics. All counts over many columns come from one unpivot and one grouping."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.columns import null_count
from cohortflow.operators.ranking import values_at_ranks

QUARTILES = [0.25, 0.5, 0.75]
BRACKET = 8  # width of a bracket in units of the sketch's rank error


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def _lines(df: DataFrame, aggregates: list[Column], lines: list[Column]) -> DataFrame:
    """A one-row aggregate turned into one row per struct."""
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def unpivot(df: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    """(column_name, value), one row per cell."""
    cells = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    return cells.unpivot([], list(columns), "column_name", "value")


def value_counts(df: DataFrame, columns: list[str], kind: str = "string") -> DataFrame:
    """(column_name, value, n) for several columns, NULL counted as a value. Partial counts are made
    before the shuffle, so a frequent value costs one row per task."""
    return unpivot(df, columns, kind).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(counts: DataFrame, numeric: list[str] | tuple = ()) -> DataFrame:
    """The most frequent value per column; on a tie a value before NULL, then the smallest value: the smallest
    number in numeric columns, the first text in others."""
    number = F.when(F.col("column_name").isin(list(numeric)), F.col("value").try_cast("double"))
    key = F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("missing"), number.alias("number"), "value")
    best = counts.groupBy("column_name").agg(F.min(key).alias("best"))
    return best.select("column_name", F.col("best.value").alias("value"), (-F.col("best.n")).alias("n"))


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    return top_values(value_counts(df, columns), [c for c in columns if is_numeric(df, c)])


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return value_counts(df, columns).select("column_name", "value")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct non-NULL values per column."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)
    return (value_counts(df, columns, "bigint" if whole else "string").groupBy("column_name")
            .agg(F.count("value").alias("n_distinct")))


def approx_distinct_counts(df: DataFrame, columns: list[str], rsd: float = 0.05) -> DataFrame:
    """Sketch-based distinct counts: no shuffle of values."""
    return _lines(df, [F.approx_count_distinct(c, rsd).alias(c) for c in columns],
                  [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns])


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return _lines(df, [null_count(c).alias(c) for c in columns],
                  [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])


def columns_with_nulls(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    columns = columns or df.columns
    found = df.agg(*[null_count(c).alias(c) for c in columns]).first()
    return [c for c in columns if found[c]]


def null_percent(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    return _lines(df, [F.avg(F.col(c).isNull().cast("int") * 100.0).alias(c) for c in columns],
                  [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("pct_null")) for c in columns])


def medians(df: DataFrame, columns: list[str], error: float = 0.01) -> dict[str, float | None]:
    """Median per column in one job, an existing value within the given rank error; error 0 is exact."""
    if error == 0:
        found = _exact_quantiles(df, columns, [0.5])[0]
        return {c: found.get((c, 0.5)) for c in columns}
    found = df.approxQuantile(list(columns), [0.5], error)
    return {c: (q[0] if q else None) for c, q in zip(columns, found)}


def quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """Exact discrete quantiles of several columns, (column_name, prob, value), from two scans. Values are doubles;
    whole numbers beyond 2 ** 53 are rounded to one. NaN and NULL have no rank.

    The first scan sketches a narrow bracket around every quantile and counts the rows. The second
    counts values inside the brackets one by one and all others in bulk, so little is shuffled or
    sorted. Should a bracket miss its rank, the values of all rows are counted.
    """
    found, _ = _exact_quantiles(df, columns, probs, accuracy)
    return df.sparkSession.createDataFrame([(c, p, value) for (c, p), value in found.items()],
                                           "column_name string, prob double, value double")


def _exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10000,
                     extra: list[Column] = ()) -> tuple[dict[tuple[str, float], float], Row]:
    """{(column, prob): value} and the first scan's row, to which further aggregates may be added."""
    brackets, row = _brackets(df, columns, probs, accuracy, extra)
    rank = {(c, float(p)): max(math.ceil(p * row[f"{c}_n"]), 1) for c in columns for p in probs if row[f"{c}_n"]}
    names = list(dict.fromkeys(c for c, _ in rank))
    if not names:
        return {}, row
    ranks = {c: [r for (name, _), r in rank.items() if name == c] for c in names}
    table = _marked(df, names, brackets).groupBy("column_name", "value", "bulk").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("value").asc_nulls_first(), "bulk"]
    hits = values_at_ranks(table, "column_name", order, "n", ranks).collect()  # one row per column and probability
    if any(h["bulk"] for h in hits):
        numbers = df.select(*[_number(df, c).alias(c) for c in names])
        counts = value_counts(numbers, names, "double").filter(F.col("value").isNotNull()).withColumn("bulk", F.lit(False))
        hits = values_at_ranks(counts, "column_name", order, "n", ranks).collect()
    value = {(h["column_name"], h["rank"]): h["value"] for h in hits}
    return {key: value[(key[0], r)] for key, r in rank.items()}, row


def _number(df: DataFrame, column: str) -> Column:
    """The column as double; NaN has no rank and counts as NULL, whatever the error allowed."""
    number = F.col(column).cast("double")
    fractional = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType, T.StringType))
    return F.nanvl(number, F.lit(None).cast("double")) if fractional else number


def _brackets(df: DataFrame, columns: list[str], probs: list[float], accuracy: int,
              extra: list[Column]) -> tuple[dict[str, list], Row]:
    """Per column the merged (low, high) brackets that should hold the quantiles, and the aggregate's row."""
    edges = [min(max(p + side * BRACKET / 2 / accuracy, 0.0), 1.0) for p in probs for side in (-1, 1)]
    wanted = F.array(*[F.lit(e) for e in edges])
    row = df.agg(*[F.count(_number(df, c)).alias(f"{c}_n") for c in columns], *[
        F.percentile_approx(_number(df, c), wanted, accuracy).alias(f"{c}_q") for c in columns], *extra).first()
    out = {}
    for c in columns:
        found, merged = row[f"{c}_q"] or [], []
        for low, high in sorted(zip(found[::2], found[1::2])):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        out[c] = merged
    return out, row


def _marked(df: DataFrame, columns: list[str], brackets: dict[str, list]) -> DataFrame:
    """(column_name, value, bulk): values in a bracket as they are; values in a gap as the end of the bracket
    below it (NULL below the first), marked as bulk."""
    cells = []
    for c in columns:
        number = _number(df, c)
        value, bulk, before = None, None, F.lit(None).cast("double")
        for low, high in brackets[c]:
            steps = ((number < low, before, True), (number <= high, number, False))
            for test, v, flag in steps:
                value = F.when(test, v) if value is None else value.when(test, v)
                bulk = F.when(test, F.lit(flag)) if bulk is None else bulk.when(test, F.lit(flag))
            before = F.lit(high)
        cells.append(F.when(number.isNotNull(), F.struct(
            value.otherwise(before).alias("value"), bulk.otherwise(F.lit(True)).alias("bulk"))).alias(c))
    long = df.select(*cells).unpivot([], columns, "column_name", "cell").filter(F.col("cell").isNotNull())
    return long.select("column_name", "cell.value", "cell.bulk")


def approx_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """Sketched quantiles in one aggregate of bounded memory; rank error 1 / accuracy."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), wanted, accuracy).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
             for c in columns for i, p in enumerate(probs)]
    return found.select(F.inline(F.array(*pairs)))


def _spread(df: DataFrame, column: str) -> dict[str, Column]:
    """Aggregates of one column. Text columns have a text range only."""
    numeric = is_numeric(df, column)
    number = F.col(column).cast("double") if numeric else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if numeric else F.col(column).cast("string")
    return {"n": F.count(column), "mean": F.avg(number), "stddev": F.stddev(number),
            "min_value": F.min(number), "max_value": F.max(number), "min_text": F.min(text), "max_text": F.max(text)}


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation and range per column."""
    parts = {c: _spread(df, c) for c in columns or df.columns}
    return _lines(df, [part.alias(f"{c}_{name}") for c in parts for name, part in parts[c].items()],
                  [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}_{name}").alias(name) for name in parts[c]])
                   for c in parts])


def summary(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """describe() of numeric columns plus quartiles: exact in two scans, or sketched in one if an accuracy is given."""
    names = ["n", "mean", "stddev", "min_value", "max_value"]
    parts = [(c, name, part) for c in columns for name, part in _spread(df, c).items() if name in names]
    if accuracy is not None:
        wanted = F.array(*[F.lit(p) for p in QUARTILES])
        sketches = [F.percentile_approx(F.col(c).cast("double"), wanted, accuracy).alias(f"{c}_q") for c in columns]
        return _lines(df, [part.alias(f"{c}_{name}") for c, name, part in parts] + sketches, [F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"{c}_{name}").alias(name) for name in names],
            *[F.col(f"{c}_q")[i].alias(f"q{int(p * 100)}") for i, p in enumerate(QUARTILES)]) for c in columns])
    extra = [part.alias(f"{c}_{name}") for c, name, part in parts if name != "n"]  # the sketch counts already
    found, row = _exact_quantiles(df, columns, QUARTILES, extra=extra)
    rows = [(c, *[row[f"{c}_{name}"] for name in names], *[found.get((c, p)) for p in QUARTILES]) for c in columns]
    schema = "column_name string, n bigint, " + ", ".join(
        f"{name} double" for name in [*names[1:], *[f"q{int(p * 100)}" for p in QUARTILES]])
    return df.sparkSession.createDataFrame(rows, schema)


def table_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form (column_name, metric, number, text): rows, NULLs, distinct values, top value and its
    count for every column, quartiles and spread for numeric ones."""
    columns = columns or df.columns
    numeric = [c for c in columns if is_numeric(df, c)]
    counts = value_counts(df, columns)
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), "value")))
    per_column = counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct"), best.alias("best"))

    def metric(name: str, number: Column, text: Column | None = None) -> Column:
        text = F.lit(None) if text is None else text
        return F.struct(F.lit(name).alias("metric"), number.cast("double").alias("number"),
                        text.cast("string").alias("text"))

    is_text = ~F.col("column_name").isin(numeric) if numeric else F.lit(True)
    general = per_column.select("column_name", F.inline(F.array(
        metric("rows", F.col("rows")), metric("nulls", F.col("nulls")), metric("distinct", F.col("distinct")),
        metric("top", -F.col("best.n"), F.when(is_text, F.col("best.value"))))))
    if not numeric:
        return general
    spread = summary(df, numeric).select("column_name", F.inline(F.array(*[
        metric(name, F.col(source)) for name, source in
        [("mean", "mean"), ("stddev", "stddev"), ("min", "min_value"), ("q25", "q25"), ("q50", "q50"),
         ("q75", "q75"), ("max", "max_value")]])))
    return general.unionByName(spread)


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, rows with a NULL in the pair left out: (column_a, column_b, corr).
    One aggregate; the pairs below the diagonal repeat those above."""
    pairs = list(combinations_with_replacement(columns, 2))
    aggregates = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
                  for i, (a, b) in enumerate(pairs)]
    lines = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            lines.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"_{i}").alias("corr")))
    return _lines(df, aggregates, lines)


def value_range(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{n}")
                   for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"{c}_lo"], row[f"{c}_hi"]) for c in columns}


def bin_of(column: str, low: float, high: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1, NULL for NULL; the upper end belongs to the last bin."""
    width = (high - low) / bins or 1.0
    bin_number = F.floor((F.col(column).cast("double") - F.lit(low)) / F.lit(width))
    return F.when(F.col(column).isNotNull(), F.least(bin_number, F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, columns: list[str], by: str, bins: int = 10) -> DataFrame:
    """Counts per class and bin for each column: (column_name, class, bin, n)."""
    ranges = value_range(df, columns)
    binned = df.select(F.col(by).alias("class"),
                       *[bin_of(c, *ranges[c], bins).alias(c) for c in columns])
    long = binned.unpivot(["class"], list(columns), "column_name", "bin")
    return (long.filter(F.col("bin").isNotNull()).groupBy("column_name", "class", "bin")
            .agg(F.count(F.lit(1)).alias("n")))


def pair_histogram(df: DataFrame, x: str, y: str, by: str, bins: int = 10) -> DataFrame:
    """Counts per class and cell of a two-column grid: (class, x_bin, y_bin, n)."""
    ranges = value_range(df, [x, y])
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(F.col(by).alias("class"), bin_of(x, *ranges[x], bins).alias("x_bin"),
                     bin_of(y, *ranges[y], bins).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def detect_kinds(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """numeric, categorical or id per column.

    An integer or text column without NULLs whose values are all different is an id; other
    numbers are numeric and the rest categorical. A sketch rules out most id candidates; only
    those it leaves are counted exactly.
    """
    columns = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"{c}_n") for c in columns], *[
        F.approx_count_distinct(c, 0.02).alias(f"{c}_d") for c in columns]).first()
    fractional = (T.FractionalType, T.DecimalType)
    maybe = [c for c in columns if row["n"] and row[f"{c}_n"] == row["n"] and row[f"{c}_d"] >= 0.8 * row["n"]
             and not isinstance(df.schema[c].dataType, fractional)]
    ids = {r["column_name"] for r in distinct_counts(df, maybe).collect() if r["n_distinct"] == row["n"]} if maybe else set()
    return {c: "id" if c in ids else "numeric" if is_numeric(df, c) else "categorical" for c in columns}


def column_kinds(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """detect_kinds as rows: (column_name, kind)."""
    return df.sparkSession.createDataFrame(list(detect_kinds(df, columns).items()), "column_name string, kind string")
