"""Synthetic rows in which columns depend on each other: a tree of columns, every value drawn given its parent's.

The dependence of every two columns is their mutual information, from one grouping of all pairs. The tree is the maximum
spanning tree over it, with the label as its root. A column is then drawn by rank over the running counts that its values
have beside the drawn value of its parent, level by level of the tree; all columns of a level share one join. Draws are
hashes of (seed, column, row number), as in synth, and a tree in which every column hangs on the label gives synth's rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.ranking import running_total
from cohortflow.operators.stats import detect_kinds, is_numeric
from cohortflow.session import settle

#: Stretches into which the ranks beside one parent value are dealt, at least, so that a frequent one is no single join key.
STRETCHES = 64
#: Parent values that are broadcast with their sizes, at most; beyond, sizes are repeated for as many parts of the rows.
BROADCAST_PARENTS, PARTS = 200_000, 16


def _texts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def pair_information(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, information) for every two columns: mutual information in nats, less what chance alone gives to
    columns with so many values, (values - 1) (values - 1) / (2 rows). NULL is a value. The result has a row per pair."""
    spark = df.sparkSession
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = _texts(df, columns).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")) for a, b in pairs])))
    counts = cells.groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    sums = {(r["a"], r["b"]): r for r in counts.groupBy("a", "b").agg(  # a row per pair of columns
        F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("s"), F.count(F.lit(1)).alias("k")).collect()}
    out = []
    for a, b in pairs:
        if a != b and (a, b) in sums:
            both, x, y = sums[a, b], sums[a, a], sums[b, b]
            # n ln n sums are entropies in disguise: H(a) + H(b) - H(a, b)
            found = math.log(both["n"]) + (both["s"] - x["s"] - y["s"]) / both["n"]
            out.append((a, b, found - (x["k"] - 1) * (y["k"] - 1) / (2 * both["n"])))
    return spark.createDataFrame(out, "column_a string, column_b string, information double")


def dependence_tree(information: list[tuple[str, str, float]], root: str, columns: list[str]) -> dict[str, str]:
    """Parent of every column but the root: the maximum spanning tree from the root on; ties go to the earlier column.

    A column that tells nothing about any other hangs on the root.
    """
    weight = {frozenset((a, b)): w for a, b, w in information}
    place = {c: i for i, c in enumerate([root, *[c for c in columns if c != root]])}
    joined, parents = [root], {}
    while len(joined) < len(place):
        w, _, _, child, parent = max(
            (weight.get(frozenset((a, b)), 0.0), -place[b], -place[a], b, a) for a in joined for b in place if b not in joined)
        parents[child] = parent if w > 0 else root
        joined.append(child)
    return parents


def _spans(df: DataFrame, parents: dict[str, str], root: str) -> tuple[DataFrame, DataFrame]:
    """Per column and parent value: (sizes) rows and stretch; (spans) each value's ranks, by stretch. The root has no parent."""
    columns = [root, *parents]
    text = _texts(df, columns)
    cells = text.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.struct((F.col(parents[c]) if c in parents else F.lit(None).cast("string")).alias("v")).alias("given"), F.col(c).alias("value"))
        for c in columns])))
    counts = cells.groupBy("column", "given", "value").agg(F.count(F.lit(1)).alias("n"))
    numbers = F.when(F.col("column").isin([c for c in columns if is_numeric(df, c)]), F.col("value").try_cast("double"))
    upto = settle(running_total(counts.withColumn("number", numbers), ["column", "given"], ["number", "value"], "n"), "running")
    sizes = upto.groupBy("column", "given").agg(F.sum("n").alias("rows"), F.greatest(F.count(F.lit(1)), F.lit(STRETCHES)).alias("_most"))
    sizes = settle(sizes.select("column", "given", "rows", F.greatest(F.floor(F.col("rows") / F.col("_most")), F.lit(1)).alias("stretch")), "sizes")
    first = F.floor((F.col("upto") - F.col("n")) / F.col("stretch"))
    spans = upto.join(sizes, ["column", "given"]).select(
        "column", "given", F.explode(F.sequence(first, F.floor((F.col("upto") - 1) / F.col("stretch")))).alias("part"),
        (F.col("upto") - F.col("n")).alias("low"), "upto", "value")
    return sizes, settle(spans, "spans")


def _uniform(seed: int) -> Column:
    """synth.uniform with the column's name from the row."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("column"), F.col("row").cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _drawn(seek: DataFrame, sizes: DataFrame, spans: DataFrame, few: bool, seed: int) -> DataFrame:
    """seek: row, column, given. Returns row, column, value."""
    if few:
        sized = seek.join(F.broadcast(sizes), ["column", "given"])
    else:
        dealt = seek.withColumn("_deal", F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int"))
        sized = dealt.join(sizes.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), ["column", "given", "_deal"])
    rank = F.floor(_uniform(seed) * F.col("rows"))
    placed = sized.select("row", "column", "given", rank.alias("rank"), F.floor(rank / F.col("stretch")).alias("part"))
    return placed.join(spans, ["column", "given", "part"]).filter("rank >= low AND rank < upto").select("row", "column", "value")


def dependent_rows(df: DataFrame, label: str, rows: int, seed: int = 13, parents: dict[str, str] | None = None, id_start: int = 1) -> DataFrame:
    """As many rows as asked for, with the columns of df; values depend on each other as the tree `parents` says, by default
    the maximum spanning tree of the pairs' mutual information. Id columns count up from id_start.

    NULL is a value like others. Without rows in df there are none in the result. Any number of classes and values will do.
    """
    spark = df.sparkSession
    kinds = detect_kinds(df, [c for c in df.columns if c != label])
    ranked = [c for c in df.columns if c != label and kinds[c] != "id"]
    if parents is None:
        found = pair_information(df, [label, *ranked]).collect()  # a row per pair of columns
        parents = dependence_tree([tuple(r) for r in found], label, ranked)
    if set(parents) != set(ranked) or any(p != label and p not in parents for p in parents.values()):
        raise ValueError("every column but the label and ids needs a parent")
    sizes, spans = _spans(df, parents, label)
    few = sizes.count() <= BROADCAST_PARENTS
    level = spark.range(rows).select(F.col("id").alias("row"), F.lit(label).alias("column"), F.struct(F.lit(None).cast("string").alias("v")).alias("given"))
    here, reached, parts = {label}, {label}, []
    while True:
        level = settle(_drawn(level, sizes, spans, few, seed), "level")
        parts.append(level)
        below = {p: sorted(c for c, q in parents.items() if q == p) for p in sorted(here) if p in parents.values()}
        if not below:
            break
        children = F.create_map(*[x for p, some in below.items() for x in (F.lit(p), F.array(*map(F.lit, some)))])
        level = level.select("row", F.explode(F.try_element_at(children, F.col("column"))).alias("column"), F.struct(F.col("value").alias("v")).alias("given"))
        here = {c for some in below.values() for c in some}
        reached |= here
    if len(reached) < len(parents) + 1:
        raise ValueError("the parents form a circle")
    cells = parts[0]
    for part in parts[1:]:
        cells = cells.unionByName(part)
    wide = cells.groupBy("row").agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"_{c}") for c in [label, *ranked]])

    def value_of(c: str) -> Column:
        kind = df.schema[c].dataType
        if c != label and kinds[c] == "id":
            number = F.col("row") + F.lit(id_start)
            return number.cast(kind) if is_numeric(df, c) else F.concat(F.lit(f"{c}_"), number.cast("string"))
        return F.col(f"_{c}").cast(kind)

    return wide.select(*[value_of(c).alias(c) for c in df.columns])
