"""Operator 11: filter interaction audit with count-weighted decision diagrams.

Every document gets a mask of the filters that it fails, and the documents of a
part (a language, a source) are counted by mask.  The counts of a part become a
decision diagram: one level per filter, a pass and a fail branch in each node, a
weight at the leaves, equal subgraphs shared.  Swapping two adjacent levels
turns the diagram of one filter order into that of a neighbouring order; a walk
over all orders by such swaps visits each once.  In every order the nodes on the
all-pass path hold the documents that reach a step: their weight, that of the
pass branch and that of the fail branch are the step's figures.

A diagram is built from at most 2 ** (number of filters) counts, whatever the
data.  Documents are only counted: texts are read once and never shuffled,
repeated texts are found by their SHA-256, combined before each shuffle.

Defined cases: null texts are empty texts; a null part is the empty string; rows
without an id are counted, never count as an earlier copy and never fail as one;
rows equal in id and text aren't earlier copies of each other; a document is
good (toxic) if any of its labels rows says 1; null labels say nothing; other
columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
MOST_FILTERS = 8      # 8! orders of a part are still a small table


class Diagram:
    """A reduced diagram over ordered filters with weight vectors at its leaves.

    A node is (pass child, fail child), found by its children, so equal subgraphs
    of a level are one node; ``weight`` is the sum over the leaves below it.
    """

    def __init__(self, counts: np.ndarray):
        """``counts`` (2 ** n, k): k weights for each mask; bit i is set where filter i fails."""
        self.n = int(counts.shape[0]).bit_length() - 1
        self.order = list(range(self.n))
        self._found: dict[tuple[int, int, int], int] = {}
        self._leaves: dict[tuple[int, ...], int] = {}
        self.child: list[tuple[int, int]] = []
        self.weight: list[np.ndarray] = []
        self.root = self._grow(counts, 0, 0)

    def _leaf(self, weights: np.ndarray) -> int:
        key = tuple(int(w) for w in weights)
        if key not in self._leaves:
            self._leaves[key] = self._add((-1, -1), np.array(key, np.int64))
        return self._leaves[key]

    def _add(self, children: tuple[int, int], weight: np.ndarray) -> int:
        self.child.append(children)
        self.weight.append(weight)
        return len(self.child) - 1

    def _node(self, level: int, passed: int, failed: int) -> int:
        key = (level, passed, failed)
        if key not in self._found:
            self._found[key] = self._add((passed, failed), self.weight[passed] + self.weight[failed])
        return self._found[key]

    def _grow(self, counts: np.ndarray, level: int, mask: int) -> int:
        if level == self.n:
            return self._leaf(counts[mask])
        return self._node(level, self._grow(counts, level + 1, mask), self._grow(counts, level + 1, mask | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the level below; the levels further down stay as they are."""
        done: dict[int, int] = {}

        def turned(node: int, at: int) -> int:
            if node not in done:
                p, f = self.child[node]
                if at < level:
                    done[node] = self._node(at, turned(p, at + 1), turned(f, at + 1))
                else:
                    (pp, pf), (fp, ff) = self.child[p], self.child[f]
                    done[node] = self._node(level, self._node(level + 1, pp, fp), self._node(level + 1, pf, ff))
            return done[node]

        self.root = turned(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(filter, weight that passes, weight that fails) for every step of the all-pass path."""
        node, out = self.root, []
        for f in self.order:
            passed, failed = self.child[node]
            out.append((f, self.weight[passed], self.weight[failed]))
            node = passed
        return out


def all_orders(n: int) -> Iterator[int | None]:
    """Levels to swap, one after the other, so that every order of ``n`` filters is seen once (None: the first order)."""
    place, way = list(range(n)), [-1] * n          # place of element e, and where it moves to
    at = list(range(n))
    yield None
    while True:
        for e in range(n - 1, -1, -1):             # the largest element that can move does
            p = place[e]
            q = p + way[e]
            if 0 <= q < n and at[q] < e:
                at[p], at[q] = at[q], e
                place[at[p]], place[e] = p, q
                for larger in range(e + 1, n):
                    way[larger] = -way[larger]
                yield min(p, q)
                break
        else:
            return


def audit_of(counts: np.ndarray, names: str) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``counts`` (2 ** n, 3): documents, good and toxic ones by mask.
    """
    n = len(names)
    masks = np.arange(1 << n)
    fails = [int(counts[masks >> f & 1 == 1, 0].sum()) for f in range(n)]
    alone = [int(counts[1 << f, 0]) for f in range(n)]
    diagram, steps, shapley = Diagram(counts), [], [0] * n
    for level in all_orders(n):
        if level is not None:
            diagram.swap(level)
        named = "".join(names[f] for f in diagram.order)
        for k, (f, passed, failed) in enumerate(diagram.path()):
            shapley[f] += int(failed[0])
            steps.append((named, k + 1, f, int(passed[0]), int(failed[0]), int(failed[1]), int(failed[2])))
    return [(named, k, kept, removed, fails[f] - removed, alone[f], good, toxic, shapley[f])
            for named, k, f, kept, removed, good, toxic in steps]


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame, names: str) -> DataFrame:
    """The audit of every part, from (part, mask, n, good, toxic).

    A part has at most 2 ** len(names) masks, which are gathered in one row.
    """
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = np.zeros((1 << len(names), 3), np.int64)
                for c in found:
                    table[c["mask"]] = c["n"], c["good"], c["toxic"]
                rows = audit_of(table, names)
                order, step, *figures = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows)), pa.array(order), pa.array(step, pa.int32()),
                     *[pa.array(f, pa.int64()) for f in figures]], names=["part", "filter_order", "step", *COLUMNS])

    gathered = (counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
                .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")))
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
                           T.StructField("step", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in COLUMNS]])
    return gathered.mapInArrow(run, schema)


def _bits(*failed: Column) -> Column:
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)), F.lit(0))


def text_failures(text: Column, words: Column) -> list[Column]:
    """Filters on one text: too short, repetitive, shouting, with symbols."""
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    n = F.size(words)
    return [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
            text.rlike("[#$%&*|]")]


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failed filters A to E (E: a copy of an earlier document)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                        text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    facts = given.select("id", "part", F.unhex(F.sha2("text", 256)).alias("same"),
                         _bits(*text_failures(F.col("text"), F.col("words"))).alias("mask"))
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), *[F.coalesce((F.col(f"`{c}`") == 1).cast("int"), F.lit(0)).alias(t)
                                                              for c, t in (("quality", "good"), ("toxic", "toxic"))])
    marks = marks.where("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    none = F.lit(0)
    marked = (facts.where("id IS NOT NULL").join(marks, "id", "left")
              .withColumns({"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)}))
    like = ["part", "mask", "good", "toxic"]
    single = marked.groupBy("id", "same", *like).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct("id", "n"))             # the smallest id of these rows and how often it occurs
    groups = single.groupBy("same", *like).agg(F.sum("n").alias("n"), first.alias("first"))
    least = F.min("first.id").over(Window.partitionBy("same"))
    earliest = F.when(F.col("first.id") == least, F.col("first.n")).otherwise(none)
    split = groups.select(*like, "n", earliest.alias("kept")).select(*like, F.explode(F.array(
        F.struct(F.col("mask").alias("m"), F.col("kept").alias("c")),
        F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - F.col("kept")).alias("c")))).alias("x"))
    with_id = split.where("x.c > 0").select("part", F.col("x.m").alias("mask"), F.col("x.c").alias("n"),
                                            (F.col("x.c") * F.col("good")).alias("good"), (F.col("x.c") * F.col("toxic")).alias("toxic"))
    zero = F.lit(0).cast("long")
    without = facts.where("id IS NULL").select("part", "mask", F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic"))
    both = with_id.unionByName(without.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return audit(mask_counts(docs, labels, id_col, text_col, part_col), "ABCDE")
