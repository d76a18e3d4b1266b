"""Operator 10: MinHash near-duplicates by min-max hashing.

Each document's set of word shingles is hashed; under each permutation both the
smallest and the largest value are kept, so PERMUTATIONS evaluations give
2 * PERMUTATIONS signature values.  BANDS bands of ROWS values are the buckets.
At a similarity of 0.8 a pair shares no bucket with a chance of about 3 in a million.

Documents with equal sets are one class, found by a 128-bit digest of the set.
In a bucket the class with the smallest id is compared with all others on the
full sets; components of these links come next, and then only pairs of
buckets that still hold several components are compared, block by block as
matrices that give at most an edge per row.  So a large group of near copies
costs a few comparisons per member, no link between two components is lost, and
the pairs of a bucket are never listed.

Defined cases: null or empty texts (or texts without words) have an empty set
and are linked with nothing; fewer words than a shingle has are one shingle; rows
sharing an id are one document, which is linked by any of its texts; rows without
an id are linked with nothing and kept; other columns are ignored, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import textnum as tn
from quarry.llm.common import drop_written, small_enough, written
from quarry.llm.components import connected_components

PERMUTATIONS = 48
ROWS = 4
BLOCK_ROWS = 256
BROADCAST_IDS = 1_000_000
BANDS = 2 * PERMUTATIONS // ROWS
_random = np.random.default_rng(11)
_XOR = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_MUL = _random.integers(0, 1 << 62, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_BYTES = tn.byte_table(lambda b: not (b == 32 or 9 <= b <= 13))


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct word shingles of every text, sorted by both."""
    low = tn.LOWER[buf]
    h, row = tn.word_hashes(low, off, _WORD_BYTES)
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = np.bincount(row, minlength=len(off) - 1)
    rows, sets = [], []
    if n >= words:
        whole = row[words - 1:] == row[:n - words + 1]
        g = np.zeros(n - words + 1, np.uint64)
        for k in range(words):
            g += h[k:n - words + 1 + k] * _PLACE[k]
        rows.append(row[:n - words + 1][whole])
        sets.append(tn.finish(g[whole]))
    first = np.cumsum(count) - count
    for size in range(1, words):
        short = np.flatnonzero(count == size)
        g = np.full(len(short), np.uint64(size), np.uint64)
        for k in range(size):
            g += h[first[short] + k] * _PLACE[words + k]
        rows.append(short)
        sets.append(tn.finish(g))
    r, s = np.concatenate(rows), np.concatenate(sets)
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    return r[new], s[new]


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n_shingles, d1, d2, bands): set size, digest of the set and band keys (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tn.slices(batches, 1):
            buf, off = tn.text_buffers(batch.column(1))
            for lo, hi in tn.pieces(off):
                n = hi - lo
                row, s = shingle_sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], words)
                size = np.bincount(row, minlength=n).astype(np.int64)
                digest = np.zeros((2, n), np.uint64)
                bands = np.zeros((n, BANDS), np.uint64)
                if len(s):
                    at = tn.segment_starts(row)
                    has = row[at]
                    digest[0, has] = np.add.reduceat(tn.finish(s ^ np.uint64(1)), at)
                    digest[1, has] = np.add.reduceat(tn.finish(s ^ np.uint64(2)), at)
                    values = np.empty((2 * PERMUTATIONS, len(at)), np.uint64)
                    for k in range(PERMUTATIONS):
                        v = (s ^ _XOR[k]) * _MUL[k]
                        v ^= v >> np.uint64(32)
                        np.minimum.reduceat(v, at, out=values[2 * k])
                        np.maximum.reduceat(v, at, out=values[2 * k + 1])
                    for b in range(BANDS):         # a band mixes values of different permutations
                        key = np.full(len(at), np.uint64(b))
                        for k in range(ROWS):
                            key = tn.finish(key ^ (values[(b + k * BANDS) % (2 * PERMUTATIONS)] * _PLACE[k]))
                        bands[has, b] = key
                listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS),
                                                  pa.array(tn.signed(bands.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(size), pa.array(tn.signed(digest[0])),
                     pa.array(tn.signed(digest[1])), listed], names=["id", "n_shingles", "d1", "d2", "bands"])

    long = T.LongType()
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_shingles", long),
                           T.StructField("d1", long), T.StructField("d2", long), T.StructField("bands", T.ArrayType(long))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _full_sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, shingles): the whole set of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tn.slices(batches, 1):
            buf, off = tn.text_buffers(batch.column(1))
            for lo, hi in tn.pieces(off):
                n = hi - lo
                row, s = shingle_sets(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], words)
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(tn.signed(s)))],
                    names=["id", "shingles"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("shingles", T.ArrayType(T.LongType()))])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _intersections(at: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Sizes (n, n) of the common parts of n sets, given as (row, code of the member) with codes from 0."""
    often = np.bincount(code) > 1
    place = np.cumsum(often) - 1
    at, code = at[often[code]], place[code[often[code]]]
    order = np.argsort(code, kind="stable")
    at, code = at[order], code[order]
    out = np.zeros((n, n), np.int64)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        x = np.zeros((n, 4096), np.float32)
        x[at[a:b], code[a:b] - lo] = 1
        out += (x @ x.T).astype(np.int64)     # at most 4,096 each, exact in float32
    return out


def _links_in_blocks(percent: int):
    """Tasks over rows sorted by block pair: an edge from each row with a new link to the smallest id it hangs together with."""
    def links(rep, part, blk, i, j, at, code, size) -> tuple[np.ndarray, np.ndarray]:
        n = len(rep)
        common = _intersections(at, code, n)
        near = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        near &= (part[:, None] != part[None, :]) & ((blk[:, None] != blk[None, :]) | (i == j))
        x, y = np.nonzero(np.triu(near, 1))
        root = rep.copy()
        while len(x):
            low = root.copy()
            np.minimum.at(low, x, root[y])
            np.minimum.at(low, y, root[x])
            if (low == root).all():
                break
            root = low
        moved = np.flatnonzero(root != rep)
        return rep[moved], root[moved]

    def flush(rows: pa.Table) -> pa.RecordBatch | None:
        col = {n: rows.column(n).to_numpy() for n in ("rep", "part", "blk", "i", "j", "gid")}
        sets = rows.column("shingles").combine_chunks()
        sets = sets if isinstance(sets, pa.Array) else pa.concat_arrays(sets.chunks)
        found = ([], [])
        bounds = np.append(tn.segment_starts(col["gid"]), len(col["gid"]))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo > 1 and (col["part"][lo:hi] != col["part"][lo]).any():
                own = sets.slice(lo, hi - lo)
                size = np.diff(own.offsets.to_numpy())
                at = np.repeat(np.arange(hi - lo), size)
                code = np.unique(own.flatten().to_numpy(), return_inverse=True)[1]
                a, b = links(col["rep"][lo:hi], col["part"][lo:hi], col["blk"][lo:hi], col["i"][lo], col["j"][lo], at, code,
                             size.astype(np.int64))
                found[0].append(a)
                found[1].append(b)
        if not found[0]:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(f)) for f in found], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            gid = held.column("gid").to_numpy()
            cut = int(np.searchsorted(gid, gid[-1])) if len(gid) else 0
            if cut:
                done = flush(held.slice(0, cut))
                held = held.slice(cut)
                if done is not None:
                    yield done
        if held is not None and held.num_rows:
            done = flush(held)
            if done is not None:
                yield done
    return run


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges between components that share a bucket, from exact comparison block by block.

    A bucket of m rows is cut into ceil(m / BLOCK_ROWS) blocks; a pair of blocks
    meets in one task as a matrix product, which gives at most an edge per row.
    """
    placed = members.withColumn("nb", F.ceil(F.col("m") / BLOCK_ROWS).cast("int")).withColumn(
        "blk", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(
        F.least(o, F.col("blk")).alias("i"), F.greatest(o, F.col("blk")).alias("j")))
    work = (placed.select("band", "key", "rep", "part", "blk", F.explode(other).alias("p"))
            .select("rep", "part", "blk", "p.i", "p.j", F.xxhash64("band", "key", "p.i", "p.j").alias("gid"))
            .join(sets, F.col("rep") == F.col("id")).drop("id"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = work.repartition(n, "gid").sortWithinPartitions("gid")
    return written(work.mapInArrow(_links_in_blocks(percent), "a long, b long"), "minhash-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row; linked when 100 * |A and B| >= percent * |A or B|."""
    sig = written(signatures(docs, id_col, text_col, words), "minhash")
    named = sig.where("id IS NOT NULL AND n_shingles > 0")
    classes = written(named.groupBy("d1", "d2").agg(
        F.min("id").alias("rep"), F.max("id").alias("_last"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands")), "minhash-classes")

    member = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    lead = member.groupBy("band", "key").agg(F.min("rep").alias("lead"), F.max("rep").alias("_last")).where("lead < _last")
    shared = written(member.join(lead.drop("_last"), ["band", "key"]), "minhash-buckets")
    sizes = classes.groupBy("rep").agg(F.max("n").alias("most"), F.min("n").alias("least"))

    def full_sets(ids: DataFrame) -> DataFrame:
        ids = written(ids, "minhash-ids")
        chosen = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")).join(
            small_enough(ids, BROADCAST_IDS), F.col("_id") == F.col("_e"), "left_semi")
        out = written(_full_sets(chosen, "_id", "_t", words).where(F.size("shingles") > 0), "minhash-sets")
        drop_written(ids)
        return out

    def verified(pairs: DataFrame) -> DataFrame:
        sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("_e")).distinct())
        one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        out = written(pairs.join(one, "a").join(two, "b").where(
            100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct(), "minhash-links")
        drop_written(sets)
        return out

    def comparable(pairs: DataFrame) -> DataFrame:
        """Pairs whose set sizes allow the similarity."""
        x = sizes.select(F.col("rep").alias("a"), F.col("most").alias("ma"), F.col("least").alias("la"))
        y = sizes.select(F.col("rep").alias("b"), F.col("most").alias("mb"), F.col("least").alias("lb"))
        return pairs.join(x, "a").join(y, "b").where(
            (100 * F.col("ma") >= percent * F.col("lb")) & (100 * F.col("mb") >= percent * F.col("la"))).select("a", "b")

    stars = written(comparable(shared.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()),
                    "minhash-pairs")
    links = verified(stars)
    renamed = (named.select("id", "d1", "d2").distinct().join(classes.select("d1", "d2", "rep"), ["d1", "d2"])
               .groupBy("id").agg(F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
               .select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a <> b"))
    parts = connected_components(links.union(renamed))

    labelled = (shared.select("band", "key", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
                .select("band", "key", "rep", F.coalesce("component", "rep").alias("part")))
    mixed = labelled.groupBy("band", "key").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.count(F.lit(1)).alias("m")).where("p < q")
    open_ = written(labelled.join(mixed.select("band", "key", "m"), ["band", "key"]), "minhash-open")
    if not open_.isEmpty():
        sets = full_sets(open_.select(F.col("rep").alias("_e")).distinct())
        more = _block_links(open_, sets, percent)
        drop_written(sets)
        if not more.isEmpty():
            parts = connected_components(links.union(renamed).union(more))
        drop_written(more)
    for gone in (shared, stars, links, open_):     # written and read for the last time
        drop_written(gone)

    moved = (classes.join(parts.withColumnRenamed("id", "rep"), "rep", "left")
             .select("d1", "d2", F.coalesce("component", "rep").alias("component_id"), F.col("_last").alias("_l")).where("component_id <> _l").drop("_l"))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    out = sig.drop("bands").join(moved, ["d1", "d2"], "left").select("id", "n_shingles", own.alias("component_id"))
    out = out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
