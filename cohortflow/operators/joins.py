"""Equality joins and the join of two frames by position."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.ranking import number_rows


def equi_join(left: DataFrame, right: DataFrame, on: str, salts: int = 1) -> DataFrame:
    """Inner join on one key.

    With salts > 1 the rows of a key are spread over that many shuffle keys on the
    left and repeated on the right; the result is the same. The salt is a hash of
    the row, so a repeated task places each row as before.
    """
    if salts <= 1:
        return left.join(right, on, "inner")
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [on, "_salt"], "inner").drop("_salt")


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys with at least that share of the rows, from a sketch of frequent values: at most 1 / share keys, and none missed by
    more than the sketch's error of a quarter of the share. NULL is no key."""
    most = math.ceil(1 / share)
    sketch = f"approx_top_k(`{key}`, {most}, {min(32 * most, 1_000_000)})"
    row = df.filter(F.col(key).isNotNull()).agg(F.expr(sketch).alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= share * row["n"]]


def hot_key_join(left: DataFrame, right: DataFrame, on: str, share: float = 0.01, salts: int = 16) -> DataFrame:
    """Inner join on one key, left rows of frequent keys apart from the others.

    Keys with at least that share of the left rows are found by a sketch. Their left rows are dealt by a hash of the row
    over as many parts as salts, and only the right rows of these keys are repeated for each part; all other rows are joined
    plainly. Rows are the same whatever the keys found.
    """
    hot = hot_keys(left, on, share)
    if not hot:
        return equi_join(left, right, on)
    among = F.col(on).isin(hot)
    return equi_join(left.filter(among), right.filter(among), on, salts).unionByName(
        equi_join(left.filter(~among), right.filter(~among), on))


def positional_join(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """Row i of one frame next to row i of the other, both in an explicit total order.

    Surplus rows of the longer frame are dropped, as in an inner join on the row number.
    """
    if not left_order or not right_order:
        raise ValueError("a positional join needs an explicit order on both sides")
    return (number_rows(left, left_order, name="_row")
            .join(number_rows(right, right_order, name="_row"), "_row", "inner")
            .drop("_row"))
