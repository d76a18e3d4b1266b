"""Corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, tokenising.

STAGES lists the stages in order.  Each takes (spark, docs, sf_dir) and returns
a DataFrame, which is written and read again as the next stage's documents.
All but the last return the columns of documents.  Stages whose texts go to Python at the end write
their result themselves (``WRITTEN``), in small Arrow batches whatever the caller's session says.

Defined cases: rows without an id, without a text or without words pass all
stages that they don't break a rule of; texts that line dedup empties go, as
all their lines stay in earlier documents; repeated rows are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, line_dedup, minhash, toxicity, winnow
from quarry.llm.common import table, written
from quarry.llm.queries import vocabulary
from quarry.session import ensure_checkpoint_dir, ship_package


def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject at the threshold of their language."""
    _prepare(spark)
    model, limits = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, also=tuple(docs.columns), to="_toxicity")
    clean = scored.where(F.col("_toxicity") < toxicity.threshold_of(F.col("lang"), limits)).select(*docs.columns)
    return written(clean, "pipeline-toxicity")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of repeated three-line windows; those that lose all their lines go."""
    _prepare(spark)
    out = line_dedup.dedup_lines(docs, added=("_lines", "_removed"))
    changed = F.col("_removed") > 0
    out = out.where(~(changed & (F.col("_lines") == F.col("_removed"))))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(
        *docs.columns)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    _prepare(spark)
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    _prepare(spark)
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenise_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the documents' tokens."""
    _prepare(spark)
    return written(bpe.token_digests(docs, vocabulary(spark)), "pipeline-byte_bpe")


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("minhash", minhash_stage),
          ("decontamination", decontamination_stage), ("byte_bpe", tokenise_stage)]

#: Stages that return a table they have written.
WRITTEN = {"toxicity", "byte_bpe"}

#: SQL can't express the classifier; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    _prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name in WRITTEN else written(docs, f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
