"""Streaming operators (K1-K3) on Structured Streaming.

K1 reservoir sample: a uniform sample of size k equals the k rows with the
   smallest hash keys, so the sample is a bottom-k.  The bottom-k of a union is
   the bottom-k of the per-batch bottom-k's (associative), so the streaming
   version keeps only k rows of state and gives exactly the batch answer,
   whatever the micro-batch boundaries.
K2 BFR over a chunk stream: every micro-batch is a chunk; state = the k DS
   summaries.
K3 rating upserts: last write wins per (user, item) -- the table lies in hash
   buckets of the key; a micro-batch merges and overwrites the buckets it touches, no others.

The small state of K1 and K2 is versioned by batch id (``state_version=<id>``): a replayed
batch rewrites its own version from version id-1, so re-execution after a failure
is idempotent.  Older versions are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import cluster as C
from quarry.functions.text import md5_bucket
from quarry.session import delete_path, path_exists, scratch_path


def sample_key(cols: list[str], seed: int = 42):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def reservoir_sample(df: DataFrame, k: int, key_cols: list[str], seed: int = 42) -> DataFrame:
    """K1 batch: k rows uniformly without replacement (all rows when fewer than k)."""
    return df.withColumn("_key", sample_key(key_cols, seed)).orderBy("_key", *key_cols).limit(k).drop("_key")


VERSION_COL = "state_version"
BUCKET = "key_bucket"
DS_SCHEMA = "cluster int, n long, sum array<double>, sumsq array<double>"


def _versioned(path: str, batch_id: int) -> str:
    return f"{path}/{VERSION_COL}={batch_id}"


def _read_version(spark: SparkSession, path: str, batch_id: int, schema: str | None):
    """Version ``batch_id``; only the first batch has no predecessor.

    Every batch writes a version, so a read that fails is an error: it fails
    the micro-batch, which is then replayed.
    """
    if batch_id < 0:
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(_versioned(path, batch_id))


def _drop_version(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete version ``batch_id``, once a later batch has finished the one after it."""
    if batch_id >= 0:
        delete_path(spark, _versioned(path, batch_id))


def reservoir_stream(stream: DataFrame, k: int, key_cols: list[str], state_path: str, checkpoint: str,
                     seed: int = 42):
    """K1 streaming: merge each micro-batch's bottom-k into the k-row state.

    Returns the started query; ``latest_state(spark, state_path)`` reads the sample.
    """
    schema = stream.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def merge(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        prev = _read_version(spark, state_path, batch_id - 1, schema)
        cur = reservoir_sample(batch, k, key_cols, seed)
        if prev is not None:
            cur = reservoir_sample(prev.unionByName(cur), k, key_cols, seed)
        cur.write.mode("overwrite").parquet(_versioned(state_path, batch_id))
        _drop_version(spark, state_path, batch_id - 2)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """Read the highest ``state_version=<id>`` version of a foreachBatch state folder.

    The versions are partition folders, so the newest number comes from the
    folders and only that version's files are read.
    """
    allv = spark.read.parquet(path)
    top = allv.agg(F.max(VERSION_COL)).first()[0]
    newest = allv.where(F.lit(False)) if top is None else allv.where(F.col(VERSION_COL) == top)  # a partition filter
    return newest.drop(VERSION_COL)


def upsert_stream(stream: DataFrame, key_cols: list[str], value_col: str, seq_col: str, state_path: str,
                  checkpoint: str, buckets: int = 64):
    """K3: keyed last-write-wins into a table in ``buckets`` folders by hash of the key.

    A micro-batch reads and overwrites only the buckets of its own keys, so it costs what these
    hold; choose ``buckets`` so that one is a task's worth.  The merged buckets are written beside the table
    first and put in place then: a batch that failed halfway is replayed from that copy if it was whole, from
    the untouched table if not, and a batch that comes again changes nothing.  The largest sequence wins, of
    equal ones the largest value; a null sequence is the smallest.  Rows with null keys are keyed by the null.

    Returns the started query; :func:`upserted` reads the table (with the sequence).
    """
    newest = F.max(F.struct(F.col(seq_col).alias("s"), F.col(value_col).alias("v"))).alias("_new")
    given = stream.select(*key_cols, value_col, seq_col)
    schema = f"{given.schema.simpleString()[len('struct<'):-1].replace(':', ' ')}, {BUCKET} int"
    table = f"{state_path}/table"

    def staged(batch_id: int) -> str:
        return f"{state_path}/merged/batch={batch_id}"

    def merge(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if not path_exists(spark, f"{staged(batch_id)}/_SUCCESS"):
            bucket = F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int")
            rows = batch.select(*key_cols, value_col, seq_col, bucket.alias(BUCKET))
            touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
            if path_exists(spark, table):
                rows = spark.read.schema(schema).parquet(table).where(F.col(BUCKET).isin(touched)).unionByName(rows)
            merged = rows.repartition(BUCKET).groupBy(BUCKET, *key_cols).agg(newest).select(
                *key_cols, F.col("_new.v").alias(value_col), F.col("_new.s").alias(seq_col), BUCKET)
            merged.write.mode("overwrite").parquet(staged(batch_id))
        (spark.read.schema(schema).parquet(staged(batch_id)).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "dynamic").parquet(table))
        delete_path(spark, staged(batch_id - 1))

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upserted(spark: SparkSession, state_path: str) -> DataFrame:
    """The table of :func:`upsert_stream`."""
    return spark.read.parquet(f"{state_path}/table").drop(BUCKET)


def bfr_stream(stream: DataFrame, k: int, state_path: str, out_path: str, checkpoint: str,
               threshold: float = 2.0, seed: int = 42, init_rounds: int = 10, x_col: str = "x"):
    """K2: BFR with one chunk per micro-batch.

    The first batch with points seeds the k DS summaries by k-means; every later batch assigns its
    points against the summaries of the previous version (Mahalanobis distance
    < threshold -> that DS, else RS = -1), writes the assignments under
    ``out_path/batch=<id>`` and the merged summaries as version id.
    :func:`split_into_chunks` makes a stream whose batches are those of ``cluster.bfr``.
    """
    def step(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        pts = batch.where(F.col(x_col).isNotNull()).select("id", x_col)
        prev = _read_version(spark, state_path, batch_id - 1, DS_SCHEMA)
        summ = {} if prev is None else {r["cluster"]: (r["n"], list(r["sum"]), list(r["sumsq"])) for r in prev.collect()}
        if not pts.isEmpty():       # an empty batch hands on the summaries, so the next one finds them
            assigned, summ = C.bfr_chunk(pts, summ, threshold, x_col) if summ else C.bfr_seed(pts, k, seed, init_rounds, x_col)
            assigned.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        rows = [(int(c), int(n), [float(v) for v in s], [float(v) for v in q]) for c, (n, s, q) in summ.items()]
        spark.createDataFrame(rows, DS_SCHEMA).write.mode("overwrite").parquet(_versioned(state_path, batch_id))
        _drop_version(spark, state_path, batch_id - 2)

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


ROWS_PER_FILE = 1_000_000


def split_into_files(df: DataFrame, n_files: int, spark: SparkSession, name: str, by: tuple[str, ...] = ()) -> str:
    """Write a table as ``n_files`` parquet parts in the shared scratch folder (a replayable file stream).

    With ``by`` the parts are hash partitions of these columns, whatever the files of the input.
    """
    path = scratch_path(spark, name)
    df.repartition(n_files, *by).write.parquet(path)
    return path


def split_into_chunks(df: DataFrame, chunks: int, spark: SparkSession, name: str, key: str = "id",
                      seed: int = 42) -> tuple[str, int]:
    """A file stream whose micro-batches are the chunks by md5 of ``key``, in order: (folder, files per batch).

    The table is dealt into chunks once; these are then appended one after the other,
    each in as many files as its rows call for.  A file stream takes files by age.
    """
    dealt, path = scratch_path(spark, f"{name}-dealt"), scratch_path(spark, name)
    marked = df.withColumn("chunk", md5_bucket(key, modulus=chunks, seed=str(seed)).cast("int"))
    marked.write.partitionBy("chunk").parquet(dealt)
    marked = spark.read.schema(marked.schema).parquet(dealt)
    files = 1 + marked.count() // (chunks * ROWS_PER_FILE)
    for c in range(chunks):
        marked.where(F.col("chunk") == c).drop("chunk").repartition(files, key).write.mode("append").parquet(path)
    delete_path(spark, dealt)
    return path, files


__all__ = ["reservoir_sample", "reservoir_stream", "latest_version", "upsert_stream", "upserted", "bfr_stream",
           "split_into_files", "split_into_chunks", "sample_key"]
