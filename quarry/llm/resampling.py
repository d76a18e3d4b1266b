"""Operator 5: quality by importance resampling.

Two bag-of-n-grams models (words and punctuation runs, singly and in pairs,
hashed into SLOTS slots) are counted: one over all documents, one over the
documents labelled good.  A document's log weight is the sum of the log ratios
of its n-grams; Gumbel noise from a hash of its id is added, and the k largest
are taken, which is a sample without replacement by weight.

The counts are sums per task, added up by slot; the k-th largest key is found
by counting keys in ever finer bins, so no task sees all keys.

Defined cases: null or empty texts have no n-grams and weight 0; without target
documents all weights are 0; null labels aren't used; rows tied with the k-th key are all
taken; repeated rows are scored each; rows without an id share one draw of noise, so
among them the weight alone decides; other columns are ignored, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import textnum as tn
from quarry.llm.common import written

SLOTS = 10_000
BINS = 4096
FEW = 10_000
BROADCAST_IDS = 2_000_000
_WORD = tn.byte_table(lambda b: b >= 128 or chr(b).isalnum())
_MARK = tn.byte_table(lambda b: 32 < b < 127 and not chr(b).isalnum())


def ngrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and row of every n-gram of the texts."""
    ones, rows = [], []
    for lo, hi in tn.runs(buf, _WORD | _MARK):
        spans = [tn.word_spans(buf[lo:hi], np.clip(off, lo, hi) - lo, keep) for keep in (_WORD, _MARK)]
        start, end, row = (np.concatenate([s[k] for s in spans]) for k in range(3))
        order = np.argsort(start, kind="stable")
        ones.append(tn.Hasher(buf[lo:hi])(start[order], end[order]) if len(order) else np.zeros(0, np.uint64))
        rows.append(row[order])
    one, row = np.concatenate(ones), np.concatenate(rows)
    two = tn.finish(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[row[1:] == row[:-1]]
    slot = np.concatenate((one, two)) % np.uint64(SLOTS)
    return slot.astype(np.int64), np.concatenate((row, row[1:][row[1:] == row[:-1]]))


def count_ngrams(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Counts (2, SLOTS): over all documents, and over those whose id is in ``target``."""
    wanted = target.select(F.col(f"`{id_col}`").alias("_tid")).where("_tid IS NOT NULL").distinct()
    if wanted.count() <= BROADCAST_IDS:            # beyond that a shuffle join
        wanted = F.broadcast(wanted)
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(
        wanted, F.col("_id") == F.col("_tid"), "left").select("_text", F.col("_tid").isNotNull().alias("_good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SLOTS), np.int64)
        for batch in tn.slices(batches, 0):
            buf, off = tn.text_buffers(batch.column(0))
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in tn.pieces(off):
                slot, row = ngrams(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                total[0] += np.bincount(slot, minlength=SLOTS)
                total[1] += np.bincount(slot[good[lo:hi][row]], minlength=SLOTS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])],
                                         names=["slot", "raw", "target"])

    sums = given.mapInArrow(run, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw"), F.sum("target"))
    out = np.zeros((2, SLOTS), np.int64)
    for slot, raw, good in sums.collect():         # SLOTS rows at most
        out[:, slot] = raw, good
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    if not counts[1].any():
        return np.zeros(SLOTS)
    p = (counts + 1.0) / (counts + 1.0).sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def weigh(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_ngrams, log_weight) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tn.slices(batches, 1):
            buf, off = tn.text_buffers(batch.column(1))
            n, w = [np.zeros(0, np.int64)], [np.zeros(0)]
            for lo, hi in tn.pieces(off):
                slot, row = ngrams(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                n.append(np.bincount(row, minlength=hi - lo))
                w.append(np.bincount(row, weights=shared.value[slot], minlength=hi - lo))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n)), pa.array(np.concatenate(w))],
                                             names=["_id", "n_ngrams", "log_weight"])

    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([given.schema["_id"], T.StructField("n_ngrams", T.LongType()),
                           T.StructField("log_weight", T.DoubleType())])
    return given.mapInArrow(run, schema)


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value: bins around it are counted and refined until few values are left."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return low
    above = 0                                      # values beyond the present range
    while n > FEW and low < high:
        width = (high - low) / BINS
        if low + width == low:
            break
        edge = F.least(F.lit(BINS - 1), F.floor((F.col(column) - low) / width))
        part = df.where((F.col(column) >= low) & (F.col(column) <= high)).groupBy(edge.alias("bin")).agg(
            F.count(column).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(part, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high, n = r["low"], r["high"], r["n"]
                break
            above += r["n"]
    if low == high:
        return low
    near = df.where((F.col(column) >= low) & (F.col(column) <= high)).select(column)
    return near.orderBy(F.desc(column)).limit(k - above).agg(F.min(column)).first()[0]


def resample(docs: DataFrame, target: DataFrame, share: float, id_col: str = "doc_id", text_col: str = "text",
             seed: int = 1) -> DataFrame:
    """(id, n_ngrams, log_weight, gumbel_key, selected): round(share * rows) rows sampled by weight."""
    ratios = log_ratios(count_ngrams(docs, target, id_col, text_col))
    uniform = (F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = weigh(docs, ratios, id_col, text_col).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    keyed = written(keyed, "resampling")
    limit = kth_largest(keyed, "gumbel_key", round(share * keyed.count()))
    picked = F.lit(False) if limit is None else F.col("gumbel_key") >= F.lit(limit)
    return keyed.withColumn("selected", picked).withColumnRenamed("_id", id_col)
