"""Ratings as a grid of cells between blocks of users and blocks of items, for models that take full-batch steps.

A block's vectors are one array, float64 (vectors, ids).  An exchange sends every block to the cells of its row or
column, and the cells' sums back to the blocks: 2 * sides arrays a block, whatever the number of ratings, which stay in their cells.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.operators.cells import _bytes, _own_buckets
from quarry.operators.factors import dot, seeded_arrays
from quarry.operators.recsys import I, R, U
from quarry.session import drop_table, write_bucketed, write_table

SIDES = 3                   # blocks at least, if there are FEW ratings for each cell
FEW = 250_000
MOST = 2_000_000            # ratings of a cell, on average
LONGEST = 500_000           # ids of a block, about
USERS, ITEMS = 0, 1
CELL = "c int, row binary, col binary, w binary, score binary, held_row binary, held_col binary, held_score binary"
VECTORS = "side int, b int, v binary, sums array<double>"
Settle = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, list[float]]]


def _cell(key: tuple, rows: pa.Table) -> pa.Table:
    """The ratings of a cell as arrays: those that weigh and teach, and the held ones."""
    get = lambda n: rows.column(n).to_numpy()
    order = np.lexsort((get(R), get("col"), get("row")))
    held = get("held")[order]
    out = {"c": pa.array([key[0].as_py()], pa.int32())}
    for name, kind, own in (("row", np.int32, ~held), ("col", np.int32, ~held), ("w", np.float64, ~held), (R, np.float64, ~held)):
        out[name] = pa.array([_bytes(get(name)[order][own].astype(kind))], pa.binary())
    for name, kind in (("row", np.int32), ("col", np.int32), (R, np.float64)):
        out[f"held_{name}"] = pa.array([_bytes(get(name)[order][held].astype(kind))], pa.binary())
    return pa.table(out)


def spread(cell: dict[str, np.ndarray], users: np.ndarray, items: np.ndarray):
    """The weighted sums of the other side's vectors, for both sides of a cell."""
    row, col, w = cell["row"], cell["col"], cell["w"]
    out = (np.zeros(users.shape), np.zeros(items.shape))
    for f in range(len(users)):
        out[USERS][f] = np.bincount(row, w * items[f][col], users.shape[1])
        out[ITEMS][f] = np.bincount(col, w * users[f][row], items.shape[1])
    return out, []


def errors(cell: dict[str, np.ndarray], users: np.ndarray, items: np.ndarray):
    """Gradients of the sum of squared errors of a cell's products of vectors; squared errors of the held ones."""
    row, col = cell["row"], cell["col"]
    e = -cell["score"]
    for p, q in zip(users, items):
        e += p[row] * q[col]
    e *= 2
    out = (np.zeros(users.shape), np.zeros(items.shape))
    for f in range(len(users)):
        out[USERS][f] = np.bincount(row, e * items[f][col], users.shape[1])
        out[ITEMS][f] = np.bincount(col, e * users[f][row], items.shape[1])
    off = -cell["held_score"]
    for p, q in zip(users, items):
        off += p[cell["held_row"]] * q[cell["held_col"]]
    return out, [float((off * off).sum())]


class Bipartite:
    """Ratings (user_id, item_id, score, w, held) between blocks; ids are those with a rating that isn't held.

    Held ratings with another user or item are in no cell: ``unknown`` is their number and the sum of their squared distances to ``mean``.
    """

    def __init__(self, rows: DataFrame, n: int, mean: float, sides: int | None = None):
        self.spark = rows.sparkSession
        rows = write_table(rows, "bipartite-rows")
        ids = [write_table(rows.where("NOT held").select(F.col(k).alias("id")).distinct(), "bipartite-ids") for k in (U, I)]
        p = self.sides = sides or max(1, min(SIDES, math.ceil(math.sqrt(n / FEW))), math.ceil(math.sqrt(n / MOST)),
                                      math.ceil(max(x.count() for x in ids) / LONGEST))
        self.ids, self.lengths = [], []
        for side in ids:
            numbered = write_table(side.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(p)).cast("int")).withColumn(
                "at", (F.row_number().over(W.partitionBy("b").orderBy("id")) - 1).cast("int")), "bipartite-numbers")
            self.ids.append(numbered)
            self.lengths.append({r["b"]: r["n"] for r in numbered.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()})   # a row a block
            drop_table(side)
        self.keys = _own_buckets(self.spark, p * p)
        user, item = (t.select(F.col("id").alias(k), F.col("b").alias(f"_b{k}"), F.col("at").alias(a)) for t, k, a in zip(self.ids, (U, I), ("row", "col")))
        placed = rows.join(user, U, "left").join(item, I, "left")
        lost = placed.where("held AND (row IS NULL OR col IS NULL)").agg(F.count(F.lit(1)), F.coalesce(F.sum(F.pow(F.col(R) - F.lit(mean), 2)), F.lit(0.0))).first()
        self.unknown = (lost[0], lost[1])
        placed = placed.where("row IS NOT NULL AND col IS NOT NULL").select(
            self._at(F.col(f"_b{U}"), F.col(f"_b{I}")).alias("c"), "row", "col", "w", R, "held")
        self.cells = write_bucketed(placed.groupBy("c").applyInArrow(_cell, CELL), "bipartite", "c", p * p)
        drop_table(rows)

    def _at(self, a, b):
        return F.get(F.array(*[F.lit(c) for c in self.keys]), a * self.sides + b)

    def start(self, values: list[DataFrame], dim: int, zeros: int = 0) -> DataFrame:
        """The state of (id, val ARRAY) of users and of items, with ``zeros`` vectors of 0 behind; written."""
        def pack(key: tuple, rows: pa.Table) -> pa.Table:
            found = rows.column("val").combine_chunks().flatten().to_numpy().reshape(len(rows), dim)[np.argsort(rows.column("at").to_numpy())]
            made = np.vstack([found.T, np.zeros((zeros, len(found)))])
            return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([_bytes(made)], pa.binary()),
                             pa.array([[]], pa.list_(pa.float64()))], names=["side", "b", "v", "sums"])

        both = [ids.join(own, "id").select(F.lit(side).alias("side"), "b", "at", "val") for side, (ids, own) in enumerate(zip(self.ids, values))]
        return write_table(both[0].unionByName(both[1]).groupBy("side", "b").applyInArrow(pack, VECTORS), "bipartite-state")

    def first(self, state: DataFrame, dim: int, vectors: int) -> DataFrame:
        """The first ``dim`` of a state's vectors."""
        return state.select("side", "b", F.expr(f"substring(v, 1, octet_length(v) div {vectors} * {dim})").alias("v"))

    def met(self, vectors: DataFrame, dim: int, work, settle: Settle, beside: DataFrame) -> DataFrame:
        """(side, b, v, sums): ``settle(sums of what the cells' work gives a block, the block's vectors of beside)``.

        ``work(cell, users' vectors, items' vectors)`` gives vectors for the users, for the items and some numbers, which are added up
        in the sums of a block of users, before settle's own.
        """
        lengths, sides = self.lengths, self.sides
        other = F.explode(F.sequence(F.lit(0), F.lit(sides - 1))).alias("o")
        user = F.col("side") == USERS
        sent = vectors.select("side", "b", "v", other).select(
            self._at(F.when(user, F.col("b")).otherwise(F.col("o")), F.when(user, F.col("o")).otherwise(F.col("b"))).alias("c"), "side", "b", "v")

        def run(given: pa.Table, cell: pa.Table) -> pa.Table:
            found = {s: (b, v) for s, b, v in zip(given.column("side").to_pylist(), given.column("b").to_pylist(), given.column("v"))}
            names, out = ["side", "b", "v", "sums", "c"], ([], [], [], [], [])
            if len(cell) and len(found) == 2:
                x = [np.frombuffer(found[s][1].as_buffer(), np.float64).reshape(dim, -1) for s in (USERS, ITEMS)]
                arrays = {n: np.frombuffer(cell.column(n)[0].as_buffer(), np.int32 if n.endswith(("row", "col")) else np.float64) for n in cell.column_names if n != "c"}
                made, sums = work(arrays, *x)
                for s, y in enumerate(made):
                    for column, value in zip(out, (s, found[s][0], _bytes(y), sums if s == USERS else [], cell.column("c")[0].as_py())):
                        column.append(value)
            return pa.table([pa.array(a, t) for a, t in zip(out, (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()), pa.int32()))], names=names)

        def added(key: tuple, given: pa.Table) -> pa.Table:
            side, b = key[0].as_py(), key[1].as_py()
            n = lengths[side][b]
            total, near, counted = np.zeros((dim, n)), None, []
            cells, numbered = given.column("c").to_pylist(), given.column("sums").to_pylist()
            for k in sorted(range(len(given)), key=lambda k: -1 if cells[k] is None else cells[k]):      # the same sums in every run
                v, cell, numbers = given.column("v")[k], cells[k], numbered[k]
                values = np.frombuffer(v.as_buffer(), np.float64).reshape(-1, n)
                if cell is None:
                    near = values
                else:
                    total += values
                    counted += [numbers] if numbers else []
            counted = np.array(counted).sum(axis=0).tolist() if counted else []
            new, sums = settle(total, near)
            return pa.table([pa.array([side], pa.int32()), pa.array([b], pa.int32()), pa.array([_bytes(new)], pa.binary()),
                             pa.array([(counted if side == USERS else []) + sums], pa.list_(pa.float64()))], names=["side", "b", "v", "sums"])

        cells = self.cells.select("c", "row", "col", "w") if work is spread else self.cells
        parts = sent.groupBy("c").cogroup(cells.groupBy("c")).applyInArrow(run, VECTORS + ", c int")
        own = beside.select("side", "b", "v", F.lit(None).cast("array<double>").alias("sums"), F.lit(None).cast("int").alias("c"))
        return parts.unionByName(own).groupBy("side", "b").applyInArrow(added, VECTORS)

    def rows(self, state: DataFrame, side: int, vectors: int) -> DataFrame:
        """(id, val ARRAY): the vectors of one side by id."""
        def run(numbers: pa.Table, block: pa.Table) -> pa.Table:
            x = np.frombuffer(block.column("v")[0].as_buffer(), np.float64).reshape(vectors, -1).T[numbers.column("at").to_numpy()]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * vectors), pa.array(np.ascontiguousarray(x).reshape(-1)))
            return pa.table([numbers.column("id").combine_chunks(), lists], names=["id", "val"])
        blocks = state.where(F.col("side") == side).select("b", "v")
        return self.ids[side].groupBy("b").cogroup(blocks.groupBy("b")).applyInArrow(run, "id long, val array<double>")

    def drop(self) -> None:
        for table in (*self.ids, self.cells):
            drop_table(table)


def weighed(ratings: DataFrame, weighted: bool, eps: float) -> DataFrame:
    """(user_id, item_id, w): the entries of the normalised adjacency D^-1/2 A D^-1/2; A is 1 or the rating (none: 0), degrees are sums of it plus ``eps``."""
    a = F.coalesce(F.col(R).cast("double"), F.lit(0.0)) if weighted else F.lit(1.0)
    rows = ratings.where(F.col(U).isNotNull() & F.col(I).isNotNull()).select(F.col(U).cast("long").alias(U), F.col(I).cast("long").alias(I), a.alias("a"))
    both = rows
    for key in (U, I):
        both = both.join(rows.groupBy(key).agg((F.sum("a") + eps).alias(f"_d{key}")), key)
    return both.select(U, I, F.coalesce(F.try_divide("a", F.sqrt(F.col(f"_d{U}") * F.col(f"_d{I}"))), F.lit(0.0)).alias("w"))


def propagated(ratings: DataFrame, dim: int, layers: int, weighted: bool = False, eps: float = 0.0, scale: float = 0.2,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(id, val) of users and of items: as ``gcn.propagate`` from ``gcn.seeded_embeddings`` over all of them, with the ratings in cells."""
    rows = write_table(weighed(ratings, weighted, eps), "gcn-weights")
    tags = {U: "u:", I: "i:"}
    first = [seeded_arrays(rows.select(F.concat(F.lit(t), F.col(k).cast("string")).alias("node")).distinct(), dim, scale, seed).select(
        F.expr("substring(node, 3)").cast("long").alias("id"), "val") for k, t in tags.items()]
    grid = Bipartite(rows.select(U, I, "w", F.lit(0.0).alias(R), F.lit(False).alias("held")), rows.count(), 0.0)
    own = at = grid.start(first, dim)
    for k in range(layers):
        share = 1.0 if k < layers - 1 else 1.0 / (layers + 1)
        at = grid.met(at, dim, spread, lambda total, e, share=share: ((e + total) * share, []), own)
    final = write_table(at, "gcn-final")
    out = tuple(write_table(grid.rows(final, side, dim), "gcn-final") for side in (USERS, ITEMS))
    for table in (rows, own, final):
        drop_table(table)
    grid.drop()
    return out


def tagged(users: DataFrame, items: DataFrame) -> DataFrame:
    """(node, f, val): a row a factor, nodes named u:<id> and i:<id>."""
    sides = [side.select(F.concat(F.lit(t), F.col("id").cast("string")).alias("node"), F.posexplode("val").alias("f", "val"))
             for side, t in ((users, "u:"), (items, "i:"))]
    return sides[0].unionByName(sides[1])


def products(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, item_id, score): dot products for the pairs whose user and item are known."""
    return (pairs.select(U, I).join(users.select(F.col("id").alias(U), F.col("val").alias("_p")), U)
            .join(items.select(F.col("id").alias(I), F.col("val").alias("_q")), I).select(U, I, dot(F.col("_p"), F.col("_q")).alias("score")))
