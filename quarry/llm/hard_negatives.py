"""Operator 12: hard-negative mining with anchor spanning-tree bounds.

Anchors come in waves of at most WAVE rows; the anchors of a wave and of one
vector length are joined by a minimum spanning tree on their distances.  Rows are
read where they lie.  Against a chunk of rows the root's scores are computed in
full; a child's score lies within its parent's, plus or minus the length of the
edge times the norm of the row (Cauchy-Schwarz), and a parent that was only
bounded hands down its bounds.  A pair is scored again only if its bounds overlap
a window in which the anchor still looks for rows.  First pass: at least the
score of the anchor's present last positive.  Second pass: between ``least``
percent of a positive's score (or the present last negative) and that score.

Each partition keeps the best few rows of every window, which a ranked window
merges; vectors are never shuffled, and a broadcast holds one wave only: WAVE
anchors, their tree and their positives' scores, a proven bound.

Components become floor(scale * x); scores are inner products in double, exact below
2 ** 53.  Beyond that they are rounded, and components are cut at 1e150.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part; rows of different vector lengths have no score with each
other; rows equal in id, label and vector are one row; rows equal in id alone are
rows of their own, but never positives or negatives of an anchor with that id;
vectors without components score 0; other columns are ignored, whatever their
names; anchors without positives, or without rows in a window, give no rows;
an empty table gives an empty table.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import textnum as tn
from quarry.llm.common import written

WAVE = 1024           # anchors of a broadcast at most
CELLS = 1 << 21       # bounds held at once: anchors of the wave x rows of a chunk
HUGE = 1e150


def spanning_tree(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Visiting order, parent and edge length of a minimum spanning tree of the rows of ``a`` (the root is its own parent)."""
    n = len(a)
    norm = (a * a).sum(axis=1)
    order, parent, length = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, via, left = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for k in range(n):
        order[k], left[at] = at, False
        square = np.maximum(norm + norm[at] - 2 * (a @ a[at]), 0)
        closer = left & (square < near)
        near[closer], via[closer] = square[closer], at
        if k + 1 < n:
            at = int(np.where(left, near, np.inf).argmin())
            parent[at] = via[at]
            gap = a[at] - a[via[at]]
            length[at] = np.sqrt((gap * gap).sum())
    return order, parent, length


@dataclasses.dataclass
class Anchors:
    """Anchors of one wave and vector length, as a tree."""

    number: np.ndarray               # position in the wave
    id: np.ndarray
    label: np.ndarray
    vec: np.ndarray
    order: np.ndarray
    parent: np.ndarray
    length: np.ndarray
    positives: np.ndarray | None = None    # (anchors, n) scores of the positives, best first; nan where there are fewer

    @classmethod
    def of(cls, number: np.ndarray, ids: np.ndarray, label: np.ndarray, vec: np.ndarray) -> Anchors:
        return cls(number, ids, label, vec, *spanning_tree(vec))


class _Best:
    """The first rows of some lists: higher scores first, then smaller ids, distinct rows."""

    def __init__(self, lists: int, n: int):
        self.n = n
        self.score = np.full((lists, n), -np.inf)
        self.id = np.full((lists, n), np.iinfo(np.int64).max)
        self.row = np.zeros((lists, n), np.int64)      # hash of the row: rows of one id may differ

    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, k: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score) > 4 * self.n:                    # only what reaches the n-th best can stay, ties included
            enough = score >= np.partition(score, len(score) - self.n)[len(score) - self.n]
            score, ids, rows = score[enough], ids[enough], rows[enough]
        s, i, r = (np.concatenate(x) for x in ((self.score[k], score), (self.id[k], ids), (self.row[k], rows)))
        order = np.lexsort((r, i, -s))
        s, i, r = s[order], i[order], r[order]
        same = (s[1:] == s[:-1]) & (i[1:] == i[:-1]) & (r[1:] == r[:-1]) & np.isfinite(s[1:])
        keep = np.concatenate(([True], ~same))
        s, i, r = s[keep][:self.n], i[keep][:self.n], r[keep][:self.n]
        self.score[k, :len(s)], self.id[k, :len(s)], self.row[k, :len(s)] = s, i, r


class Search:
    """One pass over the rows of a partition for the anchors of one tree; ``scored`` and ``pairs`` tell how the bounds do."""

    def __init__(self, anchors: Anchors, n: int, least: float):
        self.anchors, self.n, self.least = anchors, n, least
        self.windows = 1 if anchors.positives is None else anchors.positives.shape[1]
        self.best = _Best(len(anchors.id) * self.windows, n)
        self.scored = self.pairs = 0

    def _window(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the windows of anchor ``k``; an empty window is (inf, -inf)."""
        last = self.best.last()[k * self.windows:(k + 1) * self.windows]
        if self.anchors.positives is None:
            return last, np.full(1, np.inf)
        p = self.anchors.positives[k]
        none = np.isnan(p)
        low = np.where(none, np.inf, np.maximum(self.least * p / 100, last))
        return low, np.where(none, -np.inf, p)

    def chunk(self, ids: np.ndarray, label: np.ndarray, rows: np.ndarray, vec: np.ndarray) -> None:
        a = self.anchors
        once = np.unique(np.stack((ids, rows)), axis=1, return_index=True)[1]
        if len(once) < len(ids):
            ids, label, rows, vec = ids[once], label[once], rows[once], vec[once]
        norm = np.sqrt((vec * vec).sum(axis=1))
        slack = 1e-9 * norm                            # distances and norms are rounded
        low, high = np.empty((len(a.id), len(ids))), np.empty((len(a.id), len(ids)))
        for k in a.order:
            right_label = (label == a.label[k]) == (a.positives is None)
            other = right_label & (ids != a.id[k])
            bottom, top = self._window(k)
            self.pairs += int(other.sum())
            if k == a.order[0]:
                low[k] = high[k] = vec @ a.vec[k]
                chosen = np.flatnonzero(other)
            else:
                reach = a.length[k] * norm + slack * (1 + a.length[k])
                np.subtract(low[a.parent[k]], reach, out=low[k])
                np.add(high[a.parent[k]], reach, out=high[k])
                overlap = np.zeros(len(ids), bool)
                for b, t in zip(bottom, top):
                    if b <= t:
                        overlap |= (high[k] >= b) & (low[k] <= t)
                chosen = np.flatnonzero(overlap & other)
                low[k, chosen] = high[k, chosen] = vec[chosen] @ a.vec[k]
            self.scored += len(chosen)
            if len(chosen):
                self._keep(k, low[k, chosen], ids[chosen], rows[chosen])

    def _keep(self, k: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        bottom = self.best.last()[k * self.windows:(k + 1) * self.windows]
        if self.anchors.positives is None:
            take = score >= bottom[0]
            if take.any():
                self.best.add(k, score[take], ids[take], rows[take])
            return
        for w, p in enumerate(self.anchors.positives[k]):
            if not np.isnan(p):
                take = (score <= p) & (100 * score >= self.least * p) & (score >= bottom[w])
                if take.any():
                    self.best.add(k * self.windows + w, score[take], ids[take], rows[take])

    def found(self) -> list[np.ndarray]:
        """Anchor's number, window, row's id, row's hash and score of all that is held."""
        at, place = np.nonzero(np.isfinite(self.best.score))
        return [self.anchors.number[at // self.windows], at % self.windows, self.best.id[at, place], self.best.row[at, place],
                self.best.score[at, place]]


def scaled(vec: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(vec * scale), -HUGE, HUGE)


def _chunks(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(vector length, [ids, labels, row hashes, vectors]) of a batch with the columns id, label, row, vec."""
    column = batch.column(3)
    length = np.diff(column.offsets.to_numpy())
    for n in np.unique(length):
        part = batch.take(pa.array(np.flatnonzero(length == n)))
        vec = np.asarray(part.column(3).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(part.num_rows, int(n))
        yield int(n), [*[part.column(c).to_numpy(zero_copy_only=False) for c in range(3)], scaled(vec, scale)]


def _search(rows: DataFrame, wave: list[Anchors], n: int, least: float, scale: float) -> DataFrame:
    """(anchor, win, id, row, score): the best rows of each window, partition by partition."""
    shared = rows.sparkSession.sparkContext.broadcast(wave)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = {a.vec.shape[1]: Search(a, n, least) for a in shared.value}
        for batch in batches:
            for size, (ids, label, row, vec) in _chunks(batch, scale):
                if size in passes:
                    step = max(64, CELLS // len(passes[size].anchors.id))
                    for lo in range(0, len(ids), step):
                        hi = lo + step
                        passes[size].chunk(ids[lo:hi], label[lo:hi], row[lo:hi], vec[lo:hi])
        for p in passes.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in p.found()], names=["anchor", "win", "id", "row", "score"])

    found = written(rows.select("id", "label", "row", "vec").mapInArrow(run, "anchor long, win long, id long, row long, score double"),
                    "mining-found")
    shared.destroy()
    return found


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct rows of each window with their ``place`` from 1."""
    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), "id", "row")
    return found.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def _usable(vec: Column) -> Column:
    return F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def _wave_anchors(rows: list) -> list[Anchors]:
    sizes = np.array([len(r["vec"]) for r in rows])
    out = []
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        vec = np.array([rows[i]["vec"] for i in at], np.float64).reshape(len(at), int(n))
        out.append(Anchors.of(at, np.array([rows[i]["id"] for i in at], np.int64),
                              np.array([rows[i]["label"] for i in at], np.int64), vec))
    return out


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, least: int = 80, scale: float = 256, label: Column | None = None,
         wave: int = WAVE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` picks the anchors; ``label`` may replace the label column. For each
    anchor and each of its first ``positives`` rows of the same label: the first
    ``negatives`` rows of another label with a score from ``least`` percent of the positive's up to it.
    """
    spark = rows.sparkSession
    vec = F.col(f"`{vector_col}`")
    given = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        (F.col(f"`{label_col}`") if label is None else label).cast("long").alias("label"),
                        vec.cast("array<double>").alias("vec"), is_anchor.alias("chosen"))
    good = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(_usable(F.col("vec")))
    good = good.withColumn("row", F.xxhash64("id", "label", "vec"))
    anchors = written(good.where("chosen").select("id", "label", "row", "vec").dropDuplicates(["id", "label", "row"]), "mining-anchors")
    # Cells hold anchors of one label, whose edges are shorter; a wave takes as many cells as it has room for.
    of_label = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    cells = written(anchors.join(of_label, "label").withColumn("cell", F.pmod(
        F.xxhash64("row", F.lit(3)), F.ceil(F.col("n") * 8 / wave))).drop("n"), "mining-cells")
    plan = _grouped(cells.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "cell").toLocalIterator(), wave)
    result = None
    for group in plan:
        picked = spark.createDataFrame(group, "label long, cell long")
        held = cells.join(F.broadcast(picked), ["label", "cell"]).orderBy("label", "id", "row").select("id", "label", "row", "vec").collect()
        trees = _wave_anchors([{"id": r["id"], "label": r["label"], "vec": scaled(np.array(r["vec"], np.float64), scale)} for r in held])
        close = _first(_search(good, trees, positives, least, scale), positives)
        close = written(close.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("p")), "mining-positives")
        scores = np.full((len(held), positives), np.nan)
        for r in close.select("anchor", "place", "p").collect():      # WAVE x positives numbers
            scores[r["anchor"], r["place"] - 1] = r["p"]
        for t in trees:
            t.positives = scores[t.number]
        far = _first(_search(good, trees, negatives, least, scale), negatives)
        names = spark.createDataFrame([(k, r["id"]) for k, r in enumerate(held)], "anchor long, anchor_id long")
        out = (far.join(F.broadcast(close.withColumn("win", F.col("place").cast("long") - 1).drop("place")), ["anchor", "win"])
               .join(F.broadcast(names), "anchor")
               .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                       F.col("p").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score")))
        out = written(out, "mining-part")
        result = out if result is None else result.unionByName(out)
    if result is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return result


def _grouped(parts: Iterator, most: int) -> Iterator[list[tuple[int, int]]]:
    """(label, cell) pairs, as many together as hold at most ``most`` anchors."""
    held, n = [], 0
    for r in parts:
        if held and n + r["n"] > most:
            yield held
            held, n = [], 0
        held.append((r["label"], r["cell"]))
        n += r["n"]
    if held:
        yield held
