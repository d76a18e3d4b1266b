"""Session helpers: building a local session for tests/bench, and lineage cuts.

Library code never creates its own session; it takes the caller's.  The only
session-level knob the library reads is ``spark.checkpoint.dir`` (the shared
folder the cluster names).  A machine-local fallback is set only when the
session is a ``local[...]`` master and the setting is missing (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


BUCKETED = "quarry_"     # names of catalog tables begin with it


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "quarry", event_log_dir: str | None = None) -> SparkSession:
    """A local session tuned like the cluster one (AQE on, UI off)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name a shared (HDFS/S3/...) folder;
    a machine-local folder would lose checkpoints with the executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives in too few partitions for CPU-heavy rows.

    It adds a shuffle of the rows when the scan has fewer splits than the
    session has cores, e.g. one small parquet file holding long texts; the
    result is the same either way.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back (computed once, lineage cut)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, by: str, n: int | None = None) -> DataFrame:
    """As ``write_table``, in ``n`` hash buckets of ``by``: joins and aggregations on ``by`` don't shuffle it again."""
    import uuid
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{BUCKETED}{name}_{uuid.uuid4().hex[:12]}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{table}"     # the folder tells the table's name
    (df.repartition(n, by).write.bucketBy(n, by).sortBy(by).option("path", path)
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared scratch space; one that isn't there is no error."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def drop_table(df: DataFrame) -> None:
    """Delete a table written by ``write_table`` or ``write_bucketed`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tables/" in folder:
            name = folder.rsplit("/", 1)[1]
            if name.startswith(BUCKETED):
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(spark, folder)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers (mapInPandas code refers to it).

    Zips the package once per application and hands it to ``addPyFile``; Spark
    then distributes it to every executor, whatever the workers' cwd.
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="quarry-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)
