"""Shards of near equal bytes by balanced label propagation: linked documents move towards their neighbours under quotas.

Links come as groups: the documents of a group are linked with each other. A group's documents are told apart by a hash
of their id into PIECES pieces at most; a piece of a group is the node that moves, so that an ordinary group's nodes are
its documents and a group of a third of all rows still has no node, and no join key, of more than a small part of it.

All nodes start at a shard dealt by their ids, sizes even. In every round a group's bytes by shard are summed up, and each
node whose group has more bytes in another shard that isn't full wants to move there. How much may move from shard to
shard is solved on the table of wanted bytes by shard and shard, so that no shard grows beyond its capacity while room that
others leave is used; groups move by hash order until a quota is used up. Every move lowers the number of groups that a
shard boundary cuts, or leaves their larger part together; the rounds end when too little moves. Documents without links are
dealt last, the largest first, each lot to the emptiest shard, which evens out the shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.operators.ranking import number_rows
from cohortflow.session import settle

#: Nodes of a group, at most.
PIECES = 1024
#: Lots of a size class that are dealt as one; there are 64 classes at most, one per power of two.
LOTS = 1024
#: Steps in which a quota is used up.
STEPS = 4096
#: Share of an even shard that linked documents may fill.
CAPACITY = 0.99
#: A shard that couldn't take all that wanted to go there is full as long as it holds this share.
FULL = 0.9
ROUNDS = 12
#: A round that moves less than this share of the linked bytes is the last.
LEAST_MOVED = 1e-4


def deal(lots: list[tuple[int, int, int]], load: np.ndarray) -> dict[tuple[int, int], int]:
    """Shard of each lot (size class, lot, bytes): the largest first, each to the shard with least; load is brought up to date."""
    out = {}
    for size, lot, total in sorted(lots, key=lambda x: (-x[2], x[0], x[1])):
        shard = int(np.argmin(load))
        load[shard] += total
        out[size, lot] = shard
    return out


def quotas(wanted: np.ndarray, load: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """How much of wanted[from, to] may move so that no shard ends above its capacity.

    Begins with all; what overfills a shard is taken from those who want to go there, all by the same share. As they stay
    where they are, other shards may be overfull in turn, so this is repeated until none is.
    """
    given = wanted.astype(float)
    for _ in range(200):
        after = load + given.sum(0) - given.sum(1)
        over = after - capacity
        coming = given.sum(0)
        full = (over > 0.5) & (coming > 0)
        if not full.any():
            break
        share = np.where(full, np.maximum(0.0, 1 - over / np.maximum(coming, 1.0)), 1.0)
        given *= share
    return np.floor(given)


def _lots(nodes: DataFrame) -> DataFrame:
    """nodes with _class, the power of two of their bytes, and _lot, a hash of the node."""
    return nodes.withColumn("_class", F.floor(F.log2("bytes")).cast("int")).withColumn("_lot", F.pmod(F.xxhash64("group", "piece", F.lit(1)), F.lit(LOTS)).cast("int"))


def _dealt(nodes: DataFrame, load: np.ndarray) -> DataFrame:
    """nodes with shard. The table of lots has LOTS rows for each of 64 classes at most, whatever the input."""
    spark, lots = nodes.sparkSession, _lots(nodes)
    sums = lots.groupBy("_class", "_lot").agg(F.sum("bytes").alias("bytes")).toArrow()
    where = deal(list(zip(*(sums[c].to_pylist() for c in ("_class", "_lot", "bytes")), strict=True)), load)
    table = spark.createDataFrame(pa.table({"_class": pa.array([k[0] for k in where], pa.int32()), "_lot": pa.array([k[1] for k in where], pa.int32()), "shard": pa.array(list(where.values()), pa.int32())}))
    return lots.join(F.broadcast(table), ["_class", "_lot"]).drop("_class", "_lot")


def _rank(group: Column, shard: Column | int) -> Column:
    """Decides between shards in which a group has as much."""
    return F.xxhash64(group, shard if isinstance(shard, Column) else F.lit(shard))


def _wishes(nodes: DataFrame, room: list[int]) -> DataFrame:
    """nodes with _to, the shard each wants to move to; null where it wants to stay.

    A group's bytes by shard are one map of at most as many entries as shards; a shard without room is wanted by none.
    """
    held = nodes.groupBy("group", "shard").agg(F.sum("bytes").alias("_held"))
    of = F.struct("_held", _rank(F.col("group"), F.col("shard")).alias("_rank"), "shard")
    choice = held.groupBy("group").agg(
        F.max(F.when(F.col("shard").isin(room), of) if room else F.lit(None).cast("struct<_held:bigint,_rank:bigint,shard:int>")).alias("_best"),
        F.map_from_entries(F.collect_list(F.struct("shard", "_held"))).alias("_by"))
    mine = F.struct(F.col("_by")[F.col("shard")].alias("_held"), _rank(F.col("group"), F.col("shard")).alias("_rank"), "shard")
    return nodes.join(choice, "group").withColumn("_to", F.when(F.col("_best") > mine, F.col("_best.shard"))).drop("_best", "_by")


def propagate(nodes: DataFrame, shards: int, target: float, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Move nodes (group, piece, bytes, shard) towards their groups' shards; returns them and the bytes by shard.

    A shard's nodes take at most CAPACITY of the target, or what it held before. The driver sees sums by shard and shard,
    and by shard, shard and step of the quota: a number of rows that doesn't grow with the input.
    """
    full: set[int] = set()
    for _ in range(rounds):
        load = np.zeros(shards)
        for r in nodes.groupBy("shard").agg(F.sum("bytes").alias("n")).collect():
            load[r["shard"]] = r["n"]
        capacity = np.maximum(load, CAPACITY * target)
        # full shards are left out, so that what they can't take looks elsewhere; if all are full, swaps may help
        room = [s for s in range(shards) if s not in full or load[s] < FULL * target] or list(range(shards))
        step = F.pmod(F.xxhash64("group", F.lit(2)), F.lit(STEPS // 64)) * 64 + F.pmod(F.xxhash64("group", "piece", F.lit(3)), F.lit(64))
        wishes = settle(_wishes(nodes, room).withColumn("_step", step.cast("int")), "wishes")
        sums = wishes.filter("_to IS NOT NULL").groupBy("shard", "_to", "_step").agg(F.sum("bytes").alias("n")).toArrow()
        frm, to, at, n = (sums[c].to_numpy() for c in ("shard", "_to", "_step", "n"))
        wanted = np.zeros((shards, shards))
        np.add.at(wanted, (frm, to), n)
        allowed = quotas(wanted, load, capacity)
        full = {s for s in full if s not in room} | set(np.flatnonzero(allowed.sum(0) < wanted.sum(0) - shards).tolist())
        until = np.zeros((shards, shards), np.int64)
        for i, j in zip(*np.nonzero(allowed), strict=True):
            own = (frm == i) & (to == j)
            order = np.argsort(at[own], kind="stable")
            fits = np.cumsum(n[own][order]) <= allowed[i, j]
            until[i, j] = STEPS if fits.all() else at[own][order][np.argmin(fits)]
        limits = F.array(*[F.lit(int(x)) for x in until.ravel()])
        goes = F.col("_to").isNotNull() & (F.col("_step") < F.get(limits, F.col("shard") * shards + F.coalesce("_to", F.lit(0))))
        moved = sum(int(n[(frm == i) & (to == j) & (at < until[i, j])].sum()) for i, j in zip(*np.nonzero(until), strict=True))
        nodes = wishes.withColumn("shard", F.when(goes, F.col("_to")).otherwise(F.col("shard"))).drop("_to", "_step")
        if moved <= LEAST_MOVED * load.sum():
            break
    load = np.zeros(shards)
    for r in nodes.groupBy("shard").agg(F.sum("bytes").alias("n")).collect():
        load[r["shard"]] = r["n"]
    return nodes, load


def shard(docs: DataFrame, shards: int = 16, groups: Column | None = None, rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's shard under the law `bytes`: the shards' bytes are near equal, linked documents lie together.

    groups: an expression over docs that linked documents share, the text itself by default; null links with nothing.
    One row per row of docs: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot (place in the
    shard by id, gapless from 0). A null text counts as empty. Rows without an id and rows that repeat one are documents
    like others; those that repeat id and group move together. A group larger than a shard fills several. Sizes are even
    as far as single documents and groups' nodes allow: the largest shard is above the mean by less than the largest of
    them, and mostly by a few bytes. Other columns are left out; an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    link = text if groups is None else groups.cast("string")
    rows = settle(docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(link.cast("binary"))), F.encode(F.expr("uuid()"), "utf-8")).alias("group"),
        F.pmod(F.xxhash64(F.col(id_column)), F.lit(PIECES)).cast("int").alias("piece")), "sizes")
    nodes = rows.groupBy("group", "piece").agg(F.sum("size").alias("bytes"))
    several = nodes.groupBy("group").agg((F.count(F.lit(1)) > 1).alias("linked"))
    nodes = settle(nodes.join(several, "group"), "nodes")
    sums = nodes.groupBy("linked").agg(F.sum("bytes").alias("n")).collect()
    target = sum(r["n"] for r in sums) / shards
    linked = _dealt(nodes.filter("linked").drop("linked"), np.zeros(shards))
    linked, load = propagate(linked, shards, target, rounds)
    free = _dealt(nodes.filter("NOT linked").drop("linked"), load)
    where = linked.unionByName(free).select("group", "piece", "shard")
    placed = rows.join(where, ["group", "piece"]).drop("group", "piece")
    numbered = number_rows(placed, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], ["shard"], "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot") - 1).alias("slot"))
