"""Operator 2: embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; each of TABLES tables quantises HASHES random
projections in steps of STEP and joins them to a bucket key.  Vectors of one
label and bucket are compared by exact cosine in double precision.  At a cosine
of 0.93 (a distance of 0.374) a pair shares no bucket with a chance of about
5 in 10,000, at 0.95 less than 1 in 10,000.

Equal vectors of a label are one class.  Buckets are cut into blocks of
BLOCK_ROWS rows and compared block by block as matrices; a task emits, for every
row with a link, its number of links and one edge to the smallest id it hangs
together with in that block pair, never the pairs.  A pair is counted in the first table in which it
shares a bucket, so in no other; of buckets with the same members in several tables only the first is
compared, so a clump that meets in every table ships its vectors once.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label or id, are linked with nothing; vectors of different
lengths are never compared; vectors are divided by their largest component first, so finite ones of any
size have a cosine; rows equal in id, label and vector are one vector
(each row gets its result), rows equal in id alone are vectors of their own that share a component;
other columns are ignored, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import textnum as tn
from quarry.llm.common import written
from quarry.llm.components import connected_components

HASHES = 16
TABLES = 96
STEP = 2.0
BLOCK_ROWS = 512


@functools.cache
def _projections(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([3, size])
    return rng.normal(size=(size, TABLES * HASHES)), rng.uniform(0, STEP, TABLES * HASHES)


def bucket_keys(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Keys (rows, tables) of normalised vectors in the first ``tables`` tables."""
    a, b = (x[..., :tables * HASHES] for x in _projections(unit.shape[1]))
    cell = np.floor((unit @ a + b) / STEP).astype(np.int64).reshape(len(unit), tables, HASHES)
    key = np.broadcast_to(np.arange(tables, dtype=np.uint64), (len(unit), tables))
    for k in range(HASHES):
        key = tn.finish(key ^ (cell[:, :, k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)))
    return tn.signed(np.ascontiguousarray(key))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as normalised rows."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)   # squares of very large or small components would not be finite, or 0
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _by_length(column: pa.Array) -> Iterator[np.ndarray]:
    length = np.diff(column.offsets.to_numpy())
    for n in np.unique(length):
        yield np.flatnonzero(length == n)


def _keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            for rows in _by_length(batch.column(1)):
                part = batch.take(pa.array(rows))
                keys = bucket_keys(_matrix(part.column(1)))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * TABLES),
                                                  pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), listed], names=["class", "keys"])


def _compare(group: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, links and root of the rows of one block pair that have a link counted here."""
    left = np.flatnonzero(group["blk"] == group["i"][0])
    right = left if group["i"][0] == group["j"][0] else np.flatnonzero(group["blk"] == group["j"][0])
    unit, rep, copies, table = group["unit"], group["rep"], group["copies"], int(group["tab"][0])
    near = unit[left] @ unit[right].T >= least
    if right is left:
        near = np.triu(near, 1)
    x, y = np.nonzero(near)
    if not len(x):
        return (np.zeros(0, np.int64),) * 3
    x, y = left[x], right[y]
    if table:
        used, back = np.unique(np.concatenate((x, y)), return_inverse=True)
        keys = bucket_keys(unit[used], table)
        bx, by = back[:len(x)], back[len(x):]
        new = np.concatenate([~(keys[bx[k:k + 4096]] == keys[by[k:k + 4096]]).any(axis=1) for k in range(0, len(x), 4096)])
        x, y = x[new], y[new]
        if not len(x):
            return (np.zeros(0, np.int64),) * 3
    links = np.bincount(x, weights=copies[y], minlength=len(rep)) + np.bincount(y, weights=copies[x], minlength=len(rep))
    root = rep.copy()
    while True:                                    # smallest id by neighbours, to the fixed point
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(links)
    return group["class"][at], links[at].astype(np.int64), root[at]


def _links_of(least: float):
    names = ["class", "rep", "copies", "tab", "blk", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: pa.Table) -> pa.RecordBatch | None:
            col = {n: rows.column(n).to_numpy() for n in names}
            gid = rows.column("gid").to_numpy()
            vec = rows.column("vec").combine_chunks()
            vec = vec if isinstance(vec, pa.Array) else pa.concat_arrays(vec.chunks)
            out = [[], [], []]
            bounds = np.append(tn.segment_starts(gid), len(gid))
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo > 1:
                    group = {n: c[lo:hi] for n, c in col.items()}
                    group["unit"] = _matrix(vec.slice(lo, hi - lo))
                    for o, v in zip(out, _compare(group, least)):
                        if len(v):
                            o.append(v)
            if out[0]:
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["class", "links", "root"])
            return None

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            gid = held.column("gid").to_numpy()
            cut = int(np.flatnonzero(gid == gid[-1])[0]) if len(gid) else 0
            if cut:
                done = flush(held.slice(0, cut))
                if done is not None:
                    yield done
                held = held.slice(cut)
        if held is not None and held.num_rows:
            done = flush(held)
            if done is not None:
                yield done
    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.93, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``."""
    vec = F.col(f"`{vector_col}`")
    usable = (F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & vec.isNotNull()
              & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
              & F.exists(vec, lambda v: v != 0))
    v64 = vec.cast("array<double>")
    usable = F.coalesce(usable, F.lit(False))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("lab"),
                     F.when(usable, F.xxhash64(F.col(f"`{label_col}`"), v64)).alias("h1"),
                     F.when(usable, F.xxhash64(F.lit(9), F.hash(v64), v64, F.col(f"`{label_col}`"))).alias("h2"), v64.alias("vec"))
    good = rows.where(F.col("h1").isNotNull())
    classes = (good.select("h1", "h2", "id", "lab", "vec").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.max("id").alias("last"), F.first("lab").alias("lab"), F.first("vec").alias("vec")))
    copies = good.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("copies"))
    classes = written(classes.join(copies, ["h1", "h2"]).withColumn("class", F.monotonically_increasing_id()), "vec-classes")

    schema = T.StructType([T.StructField("class", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType()))])
    member = (classes.select("class", "vec").mapInArrow(_keys_of, schema)
              .select("class", F.posexplode("keys").alias("tab", "key"))
              .join(classes.select("class", "lab", F.size("vec").alias("dim")), "class"))
    member = written(member, "vec-keys")
    bucket = ["lab", "dim", "tab", "key"]
    # Buckets of several tables with the same members: only the first is compared, where all their pairs count.
    sets = member.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("class")).alias("s1"),
                                       F.bit_xor(F.xxhash64(F.lit(7), "class")).alias("s2")).where("n > 1")
    shared = (sets.groupBy("lab", "dim", "n", "s1", "s2").agg(F.min(F.struct("tab", "key")).alias("b"))
              .select("lab", "dim", "b.tab", "b.key", "n"))
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    placed = (member.join(shared, bucket).withColumn("nb", blocks)
              .withColumn("blk", F.pmod(F.xxhash64("class"), F.col("nb")).cast("int")))
    pair = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(
        F.least(o, F.col("blk")).alias("i"), F.greatest(o, F.col("blk")).alias("j")))
    work = (placed.select("class", *bucket, "blk", F.explode(pair).alias("p")).select("class", *bucket, "blk", "p.i", "p.j")
            .join(classes.select("class", "rep", "copies", "vec"), "class")
            .withColumn("gid", F.xxhash64(*bucket, "i", "j")))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = work.select("class", "rep", "copies", "tab", "blk", "i", "j", "gid", "vec").repartition(n_parts, "gid") \
        .sortWithinPartitions("gid", "tab", "i", "j", "class")
    out_schema = T.StructType([T.StructField(c, T.LongType()) for c in ("class", "links", "root")])
    found = written(work.mapInArrow(_links_of(least), out_schema), "vec-links")

    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.join(classes.select("class", "rep"), "class").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    renamed = (good.select("id", "h1", "h2").distinct().join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
               .groupBy("id").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
               .select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")))
    parts = connected_components(edges.union(renamed))
    result = (classes.join(links, "class", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
              .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                      F.coalesce("component", "rep").alias("part")))
    out = rows.select("id", "h1", "h2").join(result, ["h1", "h2"], "left")
    part = F.when(F.col("id").isNotNull(), F.coalesce("part", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      part.alias("component_id"), F.coalesce(F.col("id") == part, F.lit(True)).alias("kept"))
