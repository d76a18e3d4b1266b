"""Helpers shared by the corpus operators: written intermediate tables and row packing."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1024
BATCH_BYTES = 1 << 20
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of jobs run inside have at most BATCH_ROWS rows and about BATCH_BYTES, unless the session sets numbers of its own.

    By default a batch is 10,000 rows, some 25 MB of texts a task on either side of the worker's pipe.
    """
    rows, size = spark.conf.get(_ROWS_KEY), spark.conf.get(_BYTES_KEY, None)
    try:
        if rows == "10000":
            spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))
        if size is None:
            spark.conf.set(_BYTES_KEY, str(BATCH_BYTES))
        yield
    finally:
        spark.conf.set(_ROWS_KEY, rows)
        if size is None:
            spark.conf.unset(_BYTES_KEY)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder, in small Arrow batches, and read it back.

    A written table is computed once, survives lost executors and cuts lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that no plan reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tables/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of ``df`` as one struct, so added columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "_row", **replaced: Column) -> DataFrame:
    """The columns of a packed row again, some of them replaced."""
    return df.select(*[(replaced[c] if c in replaced else F.col(f"{name}.`{c}`")).alias(c) for c in columns])


def small_enough(df: DataFrame, rows: int, per_row: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (or units of ``per_row``), else as it is.

    ``df`` should be a written table of a few numbers a row, so that counting is cheap and the bound holds in bytes.
    """
    n = df.count() if per_row is None else df.agg(F.coalesce(F.sum(per_row), F.lit(0))).first()[0]
    return F.broadcast(df) if n <= rows else df
