"""Consecutive row numbers and exact quantiles without a single-task window.

A global sort spreads the rows over range partitions, hot keys included, since the
whole sort key decides. Inside a partition the position is known; across partitions
one running sum over (partition, group) totals, a table no longer than partitions
plus groups, gives the offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.session import settle

# monotonically_increasing_id puts the partition number above bit 33 and the position below.
POSITION_BITS = 33


def _sorted_parts(df: DataFrame, keys: list) -> DataFrame:
    """Rows in global order with the partition (_part) and the position in it (_pos)."""
    placed = settle(df.orderBy(*keys).withColumn("_mid", F.monotonically_increasing_id()))
    return (placed.withColumn("_part", F.shiftright("_mid", POSITION_BITS))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))
            .drop("_mid"))


def _before(group: list[str]):
    """All earlier partitions of the same group."""
    window = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    return window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, order_by: list, group_by: list[str] | None = None,
                name: str = "row_number") -> DataFrame:
    """Row numbers 1..n in the given order, per group if groups are given.

    The order must be total (end it with an id) for the result to be well defined.
    """
    if not order_by:
        raise ValueError("row numbers need an explicit order")
    group = list(group_by or [])
    placed = _sorted_parts(df, group + list(order_by))
    heads = placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    heads = heads.select(
        F.col("_part").alias("_head_part"), *[F.col(g).alias(f"_head_{i}") for i, g in enumerate(group)], "_first",
        F.coalesce(F.sum("_n").over(_before(group)), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_head_part")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_head_{i}"))
    number = (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).alias(name)
    return placed.join(heads, same).select(*df.columns, number)


def running_total(table: DataFrame, group_by: list[str], order_by: list[str], weight: str,
                  name: str = "upto") -> DataFrame:
    """Sum of the weights of a group up to and including each row, in a total order within the group."""
    placed = _sorted_parts(table, [*group_by, *order_by])
    parts = placed.groupBy("_part", *group_by).agg(F.sum(weight).alias("_n"))
    parts = parts.select(
        F.col("_part").alias("_head_part"), *[F.col(g).alias(f"_head_{i}") for i, g in enumerate(group_by)],
        F.coalesce(F.sum("_n").over(_before(group_by)), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_head_part")
    for i, g in enumerate(group_by):
        same = same & F.col(g).eqNullSafe(F.col(f"_head_{i}"))
    inside = Window.partitionBy("_part", *group_by).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (placed.withColumn("_inside", F.sum(weight).over(inside)).join(parts, same)
            .select(*table.columns, (F.col("_offset") + F.col("_inside")).alias(name)))


def values_at_ranks(table: DataFrame, group: str, order_by: list[str], weight: str,
                    ranks: dict[str, list[int]]) -> DataFrame:
    """The rows in which the running weight of a group reaches the given ranks: the row's columns and rank.

    Partition totals show where a rank lies, so only those partitions are summed up row by row.
    """
    placed = _sorted_parts(table, [group, *order_by])
    parts = placed.groupBy("_part", group).agg(F.sum(weight).alias("_n"))
    parts = parts.withColumn("_offset", F.coalesce(F.sum("_n").over(_before([group])), F.lit(0)))
    return _pick(placed.join(_holding(parts, group, ranks), ["_part", group]), ["_part", group], ["_pos"], weight,
                 table.columns)


def _holding(parts: DataFrame, group: str, ranks: dict[str, list[int]]) -> DataFrame:
    """Parts that hold a sought rank, with the ranks they hold."""
    wanted = F.create_map(*[F.lit(x) for g, found in ranks.items() for x in (g, sorted(set(found)))])
    held = F.filter(F.try_element_at(wanted, F.col(group)),
                    lambda rank: (rank > F.col("_offset")) & (rank <= F.col("_offset") + F.col("_n")))
    return parts.withColumn("_ranks", held).filter(F.size("_ranks") > 0).drop("_n")


def _pick(rows: DataFrame, within: list[str], order_by: list[str], weight: str, columns: list[str]) -> DataFrame:
    inside = Window.partitionBy(*within).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_offset") + F.sum(weight).over(inside)
    return (rows.withColumn("_upto", upto)
            .withColumn("rank", F.explode(F.filter("_ranks", lambda rank: (rank <= F.col("_upto")) & (
                rank > F.col("_upto") - F.col(weight)))))
            .select(*columns, "rank"))
