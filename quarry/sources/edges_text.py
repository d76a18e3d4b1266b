"""Edge-list text files (A5) and the top-K TSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import split_ws


def read_edge_list(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """(src, dst) from lines of two whitespace-separated integers; blank lines skipped."""
    t = F.trim(F.col("value"))
    df = spark.read.text(paths).where(t != "")
    parts = split_ws(F.col("value"))
    if strict:
        return df.select(parts.getItem(0).cast("long").alias("src"), parts.getItem(1).cast("long").alias("dst"))
    return (df.select(F.expr("try_cast(split(trim(value), '\\\\s+')[0] AS BIGINT)").alias("src"),
                      F.expr("try_cast(split(trim(value), '\\\\s+')[1] AS BIGINT)").alias("dst"))
            .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def id_range_vertices(edges: DataFrame) -> DataFrame:
    """Vertices 0..max id: ids never seen still count as (dangling) nodes."""
    mx = edges.agg(F.greatest(F.max("src"), F.max("dst")).alias("_m"))
    return mx.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m"))).alias("id"))


def write_edge_list(edges: DataFrame, path: str) -> None:
    edges.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string"))).write.mode(
        "overwrite").text(path)


def write_top_k_tsv(scores: DataFrame, path: str, score_col: str = "pr", k: int = 100, id_col: str = "id") -> None:
    """``node<TAB>score`` for the top k by (score desc, id asc), one file."""
    top = scores.orderBy(F.col(score_col).desc(), F.col(id_col).asc()).limit(k)
    top.select(id_col, score_col).coalesce(1).write.mode("overwrite").csv(path, sep="\t")
