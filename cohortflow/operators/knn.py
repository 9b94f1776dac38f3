"""Nearest-neighbour imputation, exact, without comparing every row with every row.

The distance between two rows is the squared difference summed over the columns both
have, scaled up by (all columns / shared columns). For all columns to fill together:

1. Equal rows are folded. Recipients become distinct tuples; of equal donors only the
   k smallest ids can ever be chosen, so only those are kept. Both steps work on
   partial groups before the shuffle.
2. Donors are counted in cells (one per tuple if there are few, else a grid), each with
   its bounding box. The grid is chosen so that the number of boxes stays below a limit
   whatever the table size; that list goes to the driver, which puts near cells of one
   NULL pattern together to pieces and pieces to lots of bounded length. A cell that is
   too large for a lot is dealt over several.
3. Every recipient meets one lot that surrounds it. The k-th distance found there bounds
   what may lie elsewhere: it then meets each other lot with a piece within that bound.
   Only recipients, lots and k rows per meeting are shuffled, never pairs.
4. Where a lot is met, rows of one NULL pattern are projected on the columns both sides
   have, folded again, split into leaves, and compared block by block with the leaves
   within the bound. Nothing is sampled and nothing is capped.

Equal distances are resolved by the smaller id.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortflow.session import settle

# The Python stages travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEVELS = range(13)  # 2^level bins per column
EXACT = -1
LOT_ROWS = 4096, 32768  # rows of a lot: what gives every core several lots, within these limits
LOT_PIECES = 8  # pieces a lot has at least, each with a box of its own
MEETING = 32768  # recipients that meet a lot in one task; a lot that more of them meet is sent to several tasks
LEAF, BLOCK = 128, 128  # donors and recipients that are judged by one box
AT_ONCE = 16384  # donors compared with a block at once
NOBODY = np.iinfo(np.int64).max


# Expressions over many columns are written as SQL text: one parsed string instead of hundreds of calls.
def _mask(columns: list[str]) -> str:
    """Bit i is set where column i is NULL."""
    return " + ".join(f"CASE WHEN `{c}` IS NULL THEN {1 << i}L ELSE 0L END" for i, c in enumerate(columns))


def _bin(column: str, low: float | None, high: float | None, level: int, widest: float) -> str:
    """All columns have bins of about the same width, as the distance adds them up as they are: 2^level bins of the
    widest column, fewer of the others, so that a narrow one does not take cells away from it. Empty with one bin."""
    if level == EXACT or low is None or high == low:
        return f"`{column}`" if level == EXACT else ""
    bins = max(1, math.ceil((high - low) / widest * (1 << level)))
    if bins == 1:
        return ""
    return (f"CASE WHEN `{column}` IS NOT NULL THEN "
            f"least(floor((`{column}` - {low!r}D) / {high - low!r}D * {bins}), {bins - 1}L) END")


def _cell(columns: list[str], ranges: dict, level: int) -> str:
    """Cell number among rows of one NULL pattern. Should two cells ever share a number, their box covers both."""
    widest = max((high - low for low, high in ranges.values() if low is not None), default=0.0)
    bins = [text for c in columns if (text := _bin(c, *ranges[c], level, widest))]
    return f"xxhash64({', '.join(bins)})" if bins else "0L"


def _choose_level(df: DataFrame, columns: list[str], ranges: dict, max_cells: int) -> int:
    """Cells to use: the finest of which there are at most max_cells. Grids are counted only if there are too many tuples."""
    def count(levels) -> dict[int, int]:
        found = df.selectExpr("*", f"{_mask(columns)} AS _mask").selectExpr(*[
            f"approx_count_distinct(struct(_mask, {_cell(columns, ranges, level)}), 0.02) AS `{level}`" for level in levels]).first()
        return {level: found[str(level)] for level in levels}

    if count([EXACT])[EXACT] <= max_cells:
        return EXACT
    cells = count(LEVELS)
    fitting = [level for level in LEVELS if cells[level] <= max_cells]
    if not fitting:
        raise ValueError("more NULL patterns than cells allowed; raise max_cells")
    return fitting[-1]


def _boxes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bounding box and row count per NULL pattern and cell."""
    return df.groupBy("_mask", "_cell").agg(F.expr("count(1) AS _n"), *[
        F.expr(f"array({', '.join(f'coalesce({f}(`{c}`), 0D)' for c in columns)}) AS {name}")
        for f, name in (("min", "_low"), ("max", "_high"))])


class _Cells:
    """Cells as spheres around their boxes: centre with 0 for NULL, presence flags, radius, row count."""

    def __init__(self, masks, low, high, counts, width: int):
        self.masks, self.counts = np.asarray(masks, dtype=np.int64), np.asarray(counts)
        low, high = (np.asarray(list(side), dtype=float).reshape(len(self.masks), width) for side in (low, high))
        self.present = ((self.masks[:, None] >> np.arange(width)) & 1 == 0).astype(float)
        self.centre = (low + high) / 2 * self.present
        self.radius = np.sqrt((((high - low) / 2 * self.present) ** 2).sum(axis=1))

    def part(self, rows: slice) -> _Cells:
        cut = object.__new__(_Cells)
        for name, values in vars(self).items():
            setattr(cut, name, values[rows])
        return cut

    def bounds(self, other: _Cells) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible distance (squared, scaled) between rows of every two cells;
        infinite where no column is shared. Rounding errors widen the bounds."""
        width = self.present.shape[1]
        n_shared = self.present @ other.present.T
        squares = (self.centre ** 2) @ other.present.T + self.present @ (other.centre ** 2).T
        apart = squares - 2 * self.centre @ other.centre.T
        slack = squares * (width * 1e-14)
        reach = self.radius[:, None] + other.radius[None, :]
        scale = np.divide(width, n_shared, out=np.full(n_shared.shape, np.inf), where=n_shared > 0)
        least = np.maximum(0.0, np.sqrt(np.maximum(0.0, apart - slack)) - reach) ** 2
        greatest = (np.sqrt(np.maximum(0.0, apart + slack)) + reach) ** 2
        with np.errstate(invalid="ignore"):
            return (np.where(n_shared > 0, least * scale * (1 - 1e-12), np.inf),
                    np.where(n_shared > 0, greatest * scale * (1 + 1e-12), np.inf))


def _candidates(recipients: _Cells, donors: _Cells, k: int) -> np.ndarray:
    """Which donor cells may hold one of the k nearest: every cell has a row, so k cells settle the bound."""
    least, greatest = recipients.bounds(donors)
    n = min(k, greatest.shape[1])
    close = np.argpartition(greatest, n - 1, axis=1)[:, :n]
    close = np.take_along_axis(close, np.argsort(np.take_along_axis(greatest, close, axis=1), axis=1), axis=1)
    reached = np.cumsum(donors.counts[close], axis=1) >= k
    first = np.argmax(reached, axis=1)
    limit = np.take_along_axis(greatest, np.take_along_axis(close, first[:, None], axis=1), axis=1)
    limit = np.where(reached.any(axis=1)[:, None], limit, np.inf)
    return np.isfinite(least) & (least <= limit)


def _halved(points: np.ndarray, weights: np.ndarray, most: int) -> list[np.ndarray]:
    """The points in groups of at most this weight (or one point), halved across the widest column."""
    groups, todo = [], [np.arange(len(points))] if len(points) else []
    while todo:
        rows = todo.pop()
        if len(rows) == 1 or weights[rows].sum() <= most:
            groups.append(rows)
            continue
        here = points[rows]
        with np.errstate(invalid="ignore"):
            widest = np.argmax(np.nan_to_num(here.max(axis=0) - here.min(axis=0), nan=np.inf))
        rows = rows[np.argsort(here[:, widest], kind="stable")]
        reached = np.cumsum(weights[rows])
        cut = min(max(1, int(np.searchsorted(reached, reached[-1] / 2, side="right"))), len(rows) - 1)
        todo += [rows[cut:], rows[:cut]]
    return groups


def _gaps(low: np.ndarray, high: np.ndarray, box_low: np.ndarray, box_high: np.ndarray) -> np.ndarray:
    """Least squared distance of boxes from boxes. Summed as distances are, so that rounding never lifts it above one."""
    total = np.zeros((len(low), len(box_low)))
    for j in range(low.shape[1]):
        if box_low[:, j].max() > high[:, j].min() or box_high[:, j].min() < low[:, j].max():
            with np.errstate(invalid="ignore"):
                apart = np.maximum(box_low[:, j][None, :] - high[:, j][:, None], low[:, j][:, None] - box_high[:, j][None, :])
            total += np.fmax(0.0, apart) ** 2
    return total


class _Lots:
    """Lots of donors: their pieces (box, NULL pattern, row count, lot) and each lot's first number and count of numbers."""

    def __init__(self, cells: pa.Table, width: int, rows: int):
        self.width = width
        masks, counts = (cells[c].to_numpy() for c in ("_mask", "_n"))
        low, high = (cells[c].combine_chunks().flatten().to_numpy().reshape(-1, width) for c in ("_low", "_high"))
        pieces, lot_of_piece, self.lot_of_cell = [], [], np.zeros(len(masks), dtype=np.int64)
        parts, filled = [], 0
        for mask in np.unique(masks):
            own = np.flatnonzero(masks == mask)
            for group in _halved((low[own] + high[own]) / 2, counts[own], max(1, rows // LOT_PIECES)):
                cell, n = own[group], int(counts[own[group]].sum())
                if not parts or n > rows or filled + n > rows:
                    parts.append(-(-n // rows))
                    filled = 0
                filled += n
                pieces.append(cell)
                lot_of_piece.append(len(parts) - 1)
                self.lot_of_cell[cell] = len(parts) - 1
        self.parts = np.array(parts, dtype=np.int64)
        self.first = np.cumsum(self.parts) - self.parts
        self.lot = np.array(lot_of_piece, dtype=np.int64)
        self.masks = np.array([masks[cell[0]] for cell in pieces], dtype=np.int64)
        self.counts = np.array([counts[cell].sum() for cell in pieces])
        self.low, self.high = (np.array([f(side[cell], axis=0) for cell in pieces]) for f, side in ((np.min, low), (np.max, high)))

    def usable(self, mask: int, target: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces with the column to fill and any shared one, and how many they share."""
        shared = (((self.masks | mask)[:, None] >> np.arange(self.width)) & 1 == 0).sum(axis=1)
        found = np.flatnonzero((shared > 0) & ((self.masks >> target) & 1 == 0))
        return found, shared[found]

    def sides(self, pieces: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boxes in a recipient's own columns, without end in those they lack."""
        absent = (self.masks[pieces][:, None] >> own) & 1 == 1
        return tuple(np.where(absent, end, side[pieces][:, own]) for end, side in ((-np.inf, self.low), (np.inf, self.high)))

    def homes(self, points: np.ndarray, mask: int, target: int, k: int) -> np.ndarray:
        """For each recipient the lot of the nearest piece with k rows, of equally near ones that with most; -1 without any."""
        pieces, shared = self.usable(mask, target)
        if (self.counts[pieces] >= k).any():
            pieces, shared = (x[self.counts[pieces] >= k] for x in (pieces, shared))
        home = np.full(len(points), -1, dtype=np.int64)
        if not len(pieces):
            return home
        order = np.argsort(-self.counts[pieces], kind="stable")
        pieces, shared = pieces[order], shared[order]
        own = np.flatnonzero((mask >> np.arange(self.width)) & 1 == 0)
        low, high = self.sides(pieces, own)
        points = points[:, own]
        for block in _halved(points, np.ones(len(points)), BLOCK):
            q = points[block]
            least = _gaps(q.min(axis=0)[None], q.max(axis=0)[None], low, high)[0] * self.width / shared
            near = np.sort(np.argsort(least, kind="stable")[:64])
            home[block] = self.lot[pieces[near[np.argmin(_gaps(q, q, low[near], high[near]) * self.width / shared[near], axis=1)]]]
        return home

    def reached(self, points: np.ndarray, mask: int, target: int, limits: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Recipients and lots with a piece that is no farther than the recipient's limit."""
        pieces, shared = self.usable(mask, target)
        if not len(pieces):
            return
        own = np.flatnonzero((mask >> np.arange(self.width)) & 1 == 0)
        low, high = self.sides(pieces, own)
        free = np.isinf(limits)
        for rows in (np.flatnonzero(free), np.flatnonzero(~free)):
            for group in _halved(points[rows][:, own], np.ones(len(rows)), BLOCK):
                block = rows[group]
                q = points[block][:, own]
                least = _gaps(q.min(axis=0)[None], q.max(axis=0)[None], low, high)[0] * self.width / shared
                near = np.flatnonzero(least * (1 - 1e-12) <= limits[block].max())
                if not len(near):
                    continue
                least = _gaps(q, q, low[near], high[near]) * self.width / shared[near]
                within = least * (1 - 1e-12) <= limits[block][:, None]
                if free[block[0]]:  # too few rows at home: the boxes give the limit
                    there = _Cells(self.masks[pieces], self.low[pieces], self.high[pieces], self.counts[pieces], self.width)
                    here = _Cells(np.full(len(block), mask), points[block], points[block], np.ones(len(block)), self.width)
                    within &= _candidates(here, there, k)[:, near]
                i, j = np.nonzero(within)
                found = np.unique(block[i] * len(self.parts) + self.lot[pieces[near[j]]])
                yield found // len(self.parts), found % len(self.parts)


def _matrix(table: pa.Table | pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.column_stack([pc.fill_null(table.column(c), 0.0).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch)
                            else pc.fill_null(table.column(c), 0.0).to_numpy() for c in columns]) + 0.0


def _routed(lots, columns: list[str], k: int, home: bool):
    """Recipients with the number of the lot they are to meet: the home of each, or afterwards all others within their limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = object.__new__(_Lots)
        vars(known).update(lots.value)
        for batch in batches:
            points = _matrix(batch, columns)
            masks, targets, limits, seen, keys = (batch.column(c).to_numpy() for c in ("_mask", "_target", "_limit", "_lot", "_q"))
            for mask, target in {*zip(masks.tolist(), targets.tolist())}:
                rows = np.flatnonzero((masks == mask) & (targets == target))
                if home:
                    lot = known.homes(points[rows], mask, target, k)
                    found = [(np.flatnonzero(lot >= 0), lot[lot >= 0])]
                else:
                    found = known.reached(points[rows], mask, target, limits[rows], k)
                for i, lot in found:
                    i = rows[i]
                    if home:
                        number = known.first[lot] + keys[i] % known.parts[lot]
                    else:
                        times = known.parts[lot]
                        i = np.repeat(i, times)
                        number = np.repeat(known.first[lot], times) + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                        i, number = i[number != seen[i]], number[number != seen[i]]
                    at = batch.schema.get_field_index("_lot")
                    yield batch.take(pa.array(i)).set_column(at, batch.schema.field(at), pa.array(number, pa.int64()))

    return run


def _folded(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For points in any order: a group per point, and its rank in the group. Equal points share a group, but for
    clashing hashes; unequal ones never do."""
    odd = np.random.default_rng(7).integers(1, 1 << 62, points.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    bits = np.ascontiguousarray(points).view(np.uint64)
    hashes = np.zeros(len(points), dtype=np.uint64)
    for j in range(points.shape[1]):
        hashes = (hashes ^ (hashes >> np.uint64(29)) ^ bits[:, j]) * odd[j]
    order = np.argsort(hashes ^ (hashes >> np.uint64(32)), kind="stable")
    new = np.ones(len(points), dtype=bool)
    new[1:] = (points[order[1:]] != points[order[:-1]]).any(axis=1)
    start = np.flatnonzero(new)
    group, rank = np.empty(len(points), dtype=np.int64), np.empty(len(points), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    rank[order] = np.arange(len(points)) - start[group[order]]
    return group, rank


def _first(q: np.ndarray, far: np.ndarray, position: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of each of n recipients out of a list of (recipient, distance, position), the first position first."""
    order = np.lexsort((position, far, q))
    q, far, position = q[order], far[order], position[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    kept = rank < k
    best, who = np.full((n, k), np.inf), np.full((n, k), NOBODY)
    best[q[kept], rank[kept]], who[q[kept], rank[kept]] = far[kept], position[kept]
    return best, who


class _Leaves:
    """Donors of one NULL pattern, projected on shared columns, in leaves with boxes. Of equal ones the first k are kept."""

    def __init__(self, points: np.ndarray, positions: np.ndarray, width: int, k: int):
        kept = _folded(points)[1] < k
        points, positions = points[kept], positions[kept]
        groups = _halved(points, np.ones(len(points)), LEAF)
        order = np.concatenate(groups)
        self.points, self.positions = points[order], positions[order]
        self.sizes = np.array([len(g) for g in groups])
        self.start = np.cumsum(self.sizes) - self.sizes
        self.low, self.high = (f.reduceat(self.points, self.start, axis=0) for f in (np.minimum, np.maximum))
        self.squares = (self.points ** 2).sum(axis=1)
        self.width, self.shared, self.k = width, points.shape[1], k

    def nearest(self, recipients: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance and position of the k nearest that are no farther than the limits."""
        best, who = np.full((len(recipients), self.k), np.inf), np.full((len(recipients), self.k), NOBODY)
        for block in _halved(recipients, np.ones(len(recipients)), BLOCK):
            q, limit = recipients[block], limits[block]
            least = _gaps(q.min(axis=0)[None], q.max(axis=0)[None], self.low, self.high)[0] * self.width / self.shared * (1 - 1e-12)
            order = np.argsort(least, kind="stable")
            order = order[least[order] <= limit.max()]
            cut = np.searchsorted(np.cumsum(self.sizes[order]), max(4 * self.k, 2 * LEAF)) + 1
            here, names = best[block], who[block]
            while len(order):  # the nearest leaves give limits for the others
                some, order = order[:cut], order[cut:]
                here, names = self._compared(q, limit, some, here, names)
                limit = np.minimum(limit, here[:, -1])
                order = order[least[order] <= limit.max()]
                cut = max(1, AT_ONCE // LEAF)
            best[block], who[block] = here, names
        return best, who

    def _compared(self, q, limit, leaves, here, names) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[leaves]
        rows = np.repeat(self.start[leaves] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        points, squares = self.points[rows], (q ** 2).sum(axis=1)
        with np.errstate(invalid="ignore", over="ignore"):
            about = squares[:, None] + self.squares[rows][None, :] - 2 * (q @ points.T)
            slack = (squares.max() + self.squares[rows].max()) * (self.width * 1e-14)
            most = limit * self.shared / self.width * (1 + 1e-12) + slack
            near = ~(about > most[:, None])
            if len(rows) > self.k and np.count_nonzero(near) > 8 * self.k * len(q):
                near &= ~(about > np.partition(about, self.k - 1, axis=1)[:, self.k - 1:self.k] + 2 * slack)
            i, j = np.nonzero(near)
            total = np.zeros(len(i))
            for c in range(self.shared):
                apart = q[i, c] - points[j, c]
                total += apart * apart
        far = total * self.width / self.shared
        held = np.nonzero(names != NOBODY)
        return _first(np.concatenate([held[0], i]), np.concatenate([here[held], far]),
                      np.concatenate([names[held], self.positions[rows][j]]), len(q), self.k)


def _met(id_column: str, columns: list[str], k: int, schema: pa.Schema):
    """Recipients that meet a lot: their limits, lowered by what the lot has, and id, value and distance of up to k donors."""
    width = len(columns)

    def run(recipients: pa.Table, donors: pa.Table) -> pa.Table:
        if not recipients.num_rows or not donors.num_rows:
            return schema.empty_table()
        donors = donors.take(pc.sort_indices(donors, sort_keys=[(id_column, "ascending")], null_placement="at_start"))
        points, rows = _matrix(recipients, columns), _matrix(donors, columns)
        masks, targets, limits = (recipients[c].to_numpy() for c in ("_mask", "_target", "_limit"))
        limits = limits.copy()
        donor_masks = donors["_mask"].to_numpy()
        kinds, sizes = np.unique(donor_masks, return_counts=True)
        best, who = np.full((len(points), k), np.inf), np.full((len(points), k), NOBODY)
        for kind in kinds[np.argsort(-sizes, kind="stable")].tolist():
            positions, leaves = np.flatnonzero(donor_masks == kind), {}
            for mask in np.unique(masks).tolist():
                shared = np.flatnonzero(((kind | mask) >> np.arange(width)) & 1 == 0)
                own = np.flatnonzero((masks == mask) & ((kind >> targets) & 1 == 0))
                if not len(shared) or not len(own):
                    continue
                if kind | mask not in leaves:
                    leaves[kind | mask] = _Leaves(rows[positions][:, shared], positions, width, k)
                here = points[own][:, shared]
                group, rank = _folded(here)
                each = np.empty((group.max() + 1, len(shared)))
                each[group[rank == 0]] = here[rank == 0]
                limit = np.full(len(each), -np.inf)
                np.maximum.at(limit, group, limits[own])
                found = leaves[kind | mask].nearest(each, limit)
                far, name = (np.concatenate([a[own], b[group]], axis=1) for a, b in zip((best, who), found))
                order = np.lexsort((name, far), axis=1)[:, :k]
                best[own], who[own] = np.take_along_axis(far, order, axis=1), np.take_along_axis(name, order, axis=1)
                limits[own] = np.minimum(limits[own], best[own][:, -1])
        i, j = np.nonzero(who != NOBODY)
        offsets = pa.array(np.concatenate([[0], np.cumsum((who != NOBODY).sum(axis=1))]), pa.int32())
        made = {"_limit": pa.array(limits)}
        for name, values in (("_ids", donors[id_column].take(pa.array(who[i, j])).combine_chunks()),
                             ("_values", pa.array(rows[who[i, j], targets[i]])), ("_far", pa.array(best[i, j]))):
            made[name] = pa.ListArray.from_arrays(offsets, values)
        return pa.table([made[f.name] if f.name in made else recipients[f.name] for f in schema], names=schema.names).cast(schema)

    return run


def _meetings(routed: DataFrame, donors: DataFrame, id_column: str, columns: list[str], k: int, kept: list[str]) -> DataFrame:
    """What the recipients find in the lots they are sent to."""
    spark = routed.sparkSession
    tasks = [(row["_lot"], -(-row["count"] // MEETING)) for row in routed.groupBy("_lot").count().collect()]
    shares = F.broadcast(spark.createDataFrame(pa.table({
        "_lot": pa.array([lot for lot, _ in tasks], pa.int64()), "_shares": pa.array([share for _, share in tasks], pa.int32())})))
    # Few, small groups with much work each: spread them over all cores instead of letting them be merged.
    n = max(spark.sparkContext.defaultParallelism, sum(share for _, share in tasks))
    left = routed.join(shares, "_lot").withColumn("_share", F.expr("CAST(pmod(xxhash64(_q), _shares) AS INT)")).drop("_shares")
    right = donors.join(shares, "_lot").withColumn("_share", F.expr("explode(sequence(0, _shares - 1))")).drop("_shares")
    key = ["_lot", "_share"]
    found = {"_ids": donors.schema[id_column].dataType, "_values": T.DoubleType(), "_far": T.DoubleType()}
    out = T.StructType([routed.schema[c] for c in kept] + [T.StructField(c, T.ArrayType(kind)) for c, kind in found.items()])
    return (left.repartition(n, *key).groupBy(*key).cogroup(right.repartition(n, *key).groupBy(*key))
            .applyInArrow(_met(id_column, columns, k, to_arrow_schema(out)), out))


def _fill(x: DataFrame, id_column: str, columns: list[str], targets: list[str], k: int, ranges: dict, level: int) -> DataFrame:
    """(id, column_name, value) for every NULL in a target column, value NULL if no row is comparable."""
    spark = x.sparkSession
    cores = spark.sparkContext.defaultParallelism
    placed = x.selectExpr("*", f"{_mask(columns)} AS _mask", f"{_cell(columns, ranges, level)} AS _cell")
    missing = {c: f"(_mask & {1 << columns.index(c)}L) <> 0L" for c in targets}

    donors = settle(placed.filter(" OR ".join(f"NOT {m}" for m in missing.values()))
                    .withColumn("_rank", F.row_number().over(Window.partitionBy(*columns).orderBy(id_column)))
                    .filter(F.col("_rank") <= k).drop("_rank"))
    cells = _boxes(donors, columns).toArrow()  # at most about max_cells boxes, by the choice of the grid
    least, most = LOT_ROWS
    lots = _Lots(cells, len(columns), min(max(pc.sum(cells["_n"]).as_py() // (8 * cores), least), most))
    at = spark.createDataFrame(pa.table({
        "_mask": cells["_mask"], "_cell": cells["_cell"],
        "_lot0": lots.first[lots.lot_of_cell], "_parts": lots.parts[lots.lot_of_cell]}))
    donors = (donors.join(F.broadcast(at), ["_mask", "_cell"])
              .withColumn("_lot", F.expr(f"_lot0 + pmod(xxhash64(`{id_column}`, {', '.join(f'`{c}`' for c in columns)}), _parts)"))
              .drop("_cell", "_lot0", "_parts"))

    recipients = placed.filter(" OR ".join(missing.values()))
    tuples = settle(recipients.select("_mask", *columns).distinct().withColumn("_q", F.monotonically_increasing_id()))
    known = spark.sparkContext.broadcast(vars(lots))
    queries = (tuples.selectExpr("*", "explode(filter(array({}), t -> (_mask & shiftleft(1L, t)) <> 0L)) AS _target".format(
                   ", ".join(str(columns.index(c)) for c in targets)))
               .selectExpr("_q", "_target", "double('Infinity') AS _limit", "-1L AS _lot", "_mask", *[f"`{c}`" for c in columns])
               .repartition(2 * cores, "_q"))
    at_home = settle(queries.mapInArrow(_routed(known, columns, k, True), queries.schema))
    found = settle(_meetings(at_home, donors, id_column, columns, k, queries.columns))
    others = settle(found.select(*queries.columns).mapInArrow(_routed(known, columns, k, False), queries.schema))
    key = ["_q", "_target"]
    met = [part.selectExpr(*key, "inline(arrays_zip(_ids, _values, _far))")
           for part in (found, _meetings(others, donors, id_column, columns, k, [*key, "_limit"]))]
    nearest_first = Window.partitionBy(*key).orderBy("_far", "_ids")
    chosen = (met[0].union(met[1]).withColumn("_rank", F.row_number().over(nearest_first)).filter(F.col("_rank") <= k)
              .groupBy(*key).agg(F.avg("_values").alias("value")))

    keyed = (recipients.select(F.col(id_column), F.struct(*columns).alias("_r"))
             .join(_shuffled(tuples.select("_q", F.struct(*columns).alias("_t"))), F.col("_r") == F.col("_t"))
             .selectExpr(f"`{id_column}`", "_q", "inline(filter(array({}), t -> t.missing))".format(", ".join(
                 f"struct({columns.index(c)} AS _target, '{c}' AS column_name, _r.`{c}` IS NULL AS missing)" for c in targets))))
    return keyed.join(_shuffled(chosen), key, "left").select(id_column, "column_name", "value")


def _shuffled(found: DataFrame) -> DataFrame:
    """For a join that never sends these whole to the driver and every task: they are as many as the recipients, whatever
    Spark takes them for."""
    return found.hint("merge")


def knn_values(df: DataFrame, id_column: str, columns: list[str], k: int = 5, max_cells: int = 20000) -> DataFrame:
    """The filled cells: (id, column_name, value). Ids must be unique. Where no row is comparable,
    the column's mean is taken."""
    # Read several times below, hence written once, in parts for all cores. NaN counts as missing.
    parts = df.sparkSession.sparkContext.defaultParallelism
    x = settle(df.repartition(parts, id_column).selectExpr(f"`{id_column}`", *[f"nullif(CAST(`{c}` AS DOUBLE), double('NaN')) AS `{c}`" for c in columns]))
    facts = x.selectExpr(*[f"{f} AS `{c}_{name}`" for c in columns for f, name in (
        (f"count_if(`{c}` IS NULL)", "nulls"), (f"min(`{c}`)", "low"), (f"max(`{c}`)", "high"),
        (f"avg(`{c}`)", "mean"))]).first()
    ranges = {c: (facts[f"{c}_low"], facts[f"{c}_high"]) for c in columns}
    targets = [c for c in columns if facts[f"{c}_nulls"] and facts[f"{c}_mean"] is not None]
    if not targets:
        return x.selectExpr(f"`{id_column}`", "'' AS column_name", "0D AS value").filter("FALSE")
    filled = _fill(x, id_column, columns, targets, k, ranges, _choose_level(x, columns, ranges, max_cells))
    means = "CASE column_name " + " ".join(f"WHEN '{t}' THEN {facts[f'{t}_mean']!r}D" for t in targets) + " END"
    return filled.selectExpr(f"`{id_column}`", "column_name", f"coalesce(value, {means}) AS value")


def knn_impute(df: DataFrame, id_column: str, columns: list[str], k: int = 5, max_cells: int = 20000) -> DataFrame:
    """NULL -> mean of the k nearest rows that have the column; the columns become double."""
    filled = knn_values(df, id_column, columns, k, max_cells)
    wide = filled.groupBy(id_column).agg(*[
        F.expr(f"max(CASE WHEN column_name = '{c}' THEN value END) AS `_knn_{c}`") for c in columns])
    return df.join(wide, id_column, "left").selectExpr(*[
        f"coalesce(nullif(CAST(`{c}` AS DOUBLE), double('NaN')), `_knn_{c}`) AS `{c}`" if c in columns else f"`{c}`"
        for c in df.columns])
