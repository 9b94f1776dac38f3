"""Near-duplicates by an inverted join over MinHash signature coordinates.

1. Every text becomes its set of word shingles and a signature of `coordinates` MinHash values. Texts with equal sets
   are one node from here on.
2. Nodes are posted under each (coordinate, value). Two nodes whose signatures agree in at least `matches` coordinates
   share a posting among the coordinates - matches + 1 rarest of either, whatever the rest is (prefix), so the frequent
   ones behind are skipped, and postings of one node alone are skipped as well.
3. Collisions with the first node of each posting are counted; a node's best partner is confirmed on the full sets.
   After this a large group of near copies is one component, without its pairs having been written out.
4. What is left are nodes that share postings with other components. They are compared in blocks, signature first, then
   full sets, and only confirmed links between different components leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from cohortflow.llm.components import components
from cohortflow.llm.shingles import shingle_sets, signatures
from cohortflow.llm.shipping import bound_batches, ship_package
from cohortflow.llm.words import parts
from cohortflow.operators.ranking import number_rows
from cohortflow.session import settle

SHINGLE = 5
#: Similarity in percent from which texts are linked.
PERCENT = 75
#: At 75 % similarity 48 of 64 coordinates agree on average; fewer than 34 do in 3 of 100,000 such pairs.
COORDINATES, MATCHES = 64, 34
#: Bytes of text whose shingles are made at once; the arrays over them are many times as large.
SET_BYTES = 1 << 20
#: Nodes of a block that are compared in one task with those of another.
BLOCK = 256

SIGNED = "node bigint, n_shingles bigint, set_key binary, signature binary"


def _signed(shingle: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, most=SET_BYTES):
            codes, starts = shingle_sets(part.column("text"), shingle)
            signed = signatures(codes, starts, coordinates)
            keys = [xxhash.xxh3_128_digest(codes[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(np.diff(starts), pa.int64()), pa.array(keys, pa.binary()),
                pa.array([s.tobytes() for s in signed], pa.binary())], ["node", "n_shingles", "set_key", "signature"])

    return run


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each node and coordinate; the posting is the coordinate above the value."""
    for batch in batches:
        signed = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1).astype(np.int64)
        coordinates = signed.shape[1] if batch.num_rows else 0
        posting = signed | (np.arange(coordinates, dtype=np.int64) << 32)
        node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), coordinates)
        yield pa.RecordBatch.from_arrays([pa.array(posting.ravel()), pa.array(node, pa.int64())], ["posting", "node"])


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, most=SET_BYTES):
            codes, starts = shingle_sets(part.column("text"), shingle)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([codes[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary())], ["node", "shingles"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets are as similar as asked for: 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in rows]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def _across(percent: int, matches: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Confirmed links between nodes of different components, one for two components that a link joins already."""
        rows = rows.sort_values(["node", "n_shingles"], kind="stable", ignore_index=True)
        node, part, block = (rows[c].to_numpy() for c in ("node", "component", "block"))
        size, signed = rows["n_shingles"].to_numpy(), np.stack([np.frombuffer(s, np.uint32) for s in rows["signature"]])
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        out, other = [], int(block.max())
        for i in np.flatnonzero(block == block.min()):
            rivals = (part != part[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            rivals &= (block == other) if other != block[i] else (np.arange(len(node)) > i)
            j = np.flatnonzero(rivals)
            j = j[(signed[j] == signed[i]).sum(1) >= matches]
            for k in j:
                if find(int(part[i])) != find(int(part[k])) and linked(sets[i], sets[k], percent):
                    root[find(int(part[i]))] = find(int(part[k]))
                    out.append((node[i], node[k]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _hung(starred: DataFrame) -> DataFrame:
    """Links a, b with the components of (node, first): a node hangs on its least first, and its other firsts on that one. Nodes of
    a large group share their firsts, so there are hardly more links than nodes, and not one for every posting."""
    least = starred.select("node", "first", F.min("first").over(Window.partitionBy("node")).alias("b"))
    return least.select(F.explode(F.array("node", "first")).alias("a"), "b").filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, coordinates: int = COORDINATES, matches: int = MATCHES, block: int = BLOCK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The component of every row: doc_id, n_shingles, component_id, kept.

    Words are runs without white space, A-Z lower-cased; whole texts are read. component_id is the smallest id that
    links reach, kept marks rows with that id. A text without words, or null, has no shingles and no links. Rows that
    share an id are one node; a null id has no links and is its own component (null, kept). Ids are whole numbers;
    other columns are left out. Signatures can miss a pair right at the threshold (see MATCHES); every link is confirmed.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    texts = docs.select(F.col(id_column).cast("bigint").alias("node"), F.col(text_column).cast("string").alias("text"))
    signed = settle(texts.mapInArrow(_signed(shingle, coordinates), SIGNED), "signatures")
    linkable = signed.filter("n_shingles > 0 AND node IS NOT NULL")
    heads = linkable.groupBy("set_key").agg(F.min("node").alias("head"))
    equal = linkable.select("node", "set_key").distinct().join(heads, "set_key").select("node", "head", "set_key")
    nodes = settle(linkable.select("node", "set_key", "n_shingles", "signature").join(
        heads.select("set_key", F.col("head").alias("node")), ["set_key", "node"]).dropDuplicates(["set_key", "node"]), "nodes")

    posts = nodes.select("node", "signature").mapInArrow(_posted, "posting bigint, node bigint")
    shared = posts.groupBy("posting").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    met = posts.join(shared, "posting")
    rarest = Window.partitionBy("node").orderBy("held", "posting")
    alone = coordinates - F.count(F.lit(1)).over(Window.partitionBy("node"))
    prefix = settle(met.select("posting", "node", (F.row_number().over(rarest) + alone).alias("at"))
                    .filter(F.col("at") <= coordinates - matches + 1).select("posting", "node"), "postings")

    # full sets of all nodes that share a posting
    meeting = prefix.select("node").distinct()
    sets = settle(texts.join(meeting, "node", "left_semi").mapInArrow(_sets(shingle), "node bigint, shingles binary")
                  .filter(F.octet_length("shingles") > 0).dropDuplicates(["node", "shingles"]), "sets")
    first = prefix.groupBy("posting").agg(F.min("node").alias("first"))
    starred = settle(prefix.join(first, "posting").filter("node <> first").groupBy("node", "first").agg(F.count(F.lit(1)).alias("collisions")), "collisions")
    best = starred.groupBy("node").agg(F.max_by("first", F.struct("collisions", -F.col("first"))).alias("first"))
    pairs = (best.join(sets, "node").select("node", "first", F.col("shingles").alias("_own"))
             .join(sets.select(F.col("node").alias("first"), F.col("shingles").alias("_first")), "first").select("node", "first", "_own", "_first"))
    found = settle(pairs.mapInArrow(_confirmed(percent), "a bigint, b bigint"), "confirmed")
    same_set = equal.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    parts = components(found)

    # nodes that meet, by the groups in which postings hang together
    group = components(_hung(starred))
    placed = (group.select("node", F.col("label").alias("cluster")).join(parts.withColumnRenamed("label", "_part"), "node", "left")
              .select("node", "cluster", F.coalesce("_part", "node").alias("component")))
    open_clusters = placed.groupBy("cluster").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo <> _hi").select("cluster")
    left = number_rows(placed.join(open_clusters, "cluster"), [F.col("component"), F.col("node")], ["cluster"], "_n")
    left = settle(left.withColumn("block", F.expr(f"(_n - 1) div {int(block)}")).drop("_n"), "left")
    blocks = left.groupBy("cluster", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    mains = left.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("_c")).groupBy("cluster").agg(F.max_by("component", F.struct("_c", "component")).alias("main"))
    stray = blocks.join(mains, "cluster").filter("lo <> main OR hi <> main").select("cluster", F.col("block").alias("x"))
    units = (stray.join(blocks.select("cluster", F.col("block").alias("y")), "cluster")
             .select("cluster", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j")).distinct())
    asked = units.select("cluster", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    full = (left.join(nodes.select("node", "set_key", "n_shingles", "signature"), "node")
            .join(sets.withColumn("_size", F.expr("octet_length(shingles) div 8")), "node").filter("_size = n_shingles").drop("_size"))
    compared = settle(asked.join(full, ["cluster", "block"]).groupBy("cluster", "i", "j")
                .applyInPandas(_across(percent, matches), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])), "compared")
    links = found.union(compared).union(same_set).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("first"))
    labels = components(_hung(links.filter("node <> first")))
    return (signed.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
            .select(F.col("node").alias("doc_id"), "n_shingles", F.coalesce("label", "node").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
