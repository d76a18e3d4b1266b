"""Rating-block text format: readers (A1-A4) and writer (A10).

Format: a header line ``<user>|<n>`` applies to the following ``<item> <score>``
lines (pair files: ``<item>`` only).  A header can sit in an earlier file split
than its rows, so the reader cannot just forward-fill inside a task.

Reader plan (no driver collect, no single-task window):
  1. ``read.text`` with the file path, the split start and a row id that
     increases in line order inside each split;
  2. forward-fill the header inside each (file, split) with ``last(ignorenulls)``;
  3. rows before the first header of a split take the last header of the
     nearest earlier split of the same file: a table with one row per split
     (small by construction), forward-filled and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.scalar import round_clamp_int


def _lines(spark: SparkSession, paths) -> DataFrame:
    return spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_rid"))


def read_blocks(spark: SparkSession, paths, with_scores: bool = True, strict: bool = True) -> DataFrame:
    """(user_id, item_id[, score]) rows of rating-block files.

    strict=True (A1): a blank line, a row before any header, a row with too few
    or too many fields and a bad number raise, whichever columns are read.  strict=False
    (A2): blank lines and rows with too few fields or bad numbers are skipped.
    """
    df = _lines(spark, paths)
    t = F.trim(F.col("line"))
    is_hdr = t.contains("|")
    hdr_user = F.split(t, r"\|").getItem(0)
    hdr_user = hdr_user.cast("long") if strict else F.expr("try_cast(split(trim(line), '[|]')[0] AS BIGINT)")
    df = df.withColumn("_hdr", F.when(is_hdr, hdr_user))
    w_in = (W.partitionBy("_file", "_start").orderBy("_rid")
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    df = df.withColumn("_ffill", F.last("_hdr", ignorenulls=True).over(w_in))
    # last header of every split, carried into later splits of the same file
    last_hdr = (df.where(F.col("_hdr").isNotNull()).groupBy("_file", "_start")
                .agg(F.max_by("_hdr", "_rid").alias("_last")))
    splits = df.select("_file", "_start").distinct().join(last_hdr, ["_file", "_start"], "left")
    w_split = W.partitionBy("_file").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)
    carry = splits.select("_file", "_start", F.last("_last", ignorenulls=True).over(w_split).alias("_carry"))
    df = df.join(F.broadcast(carry), ["_file", "_start"], "left")  # one row per file split
    df = df.withColumn("user_id", F.coalesce("_ffill", "_carry"))
    body = df.where(~is_hdr)
    parts = F.split(t, r"\s+")
    n_fields = F.when(t == "", F.lit(0)).otherwise(F.size(parts))
    need = 2 if with_scores else 1
    if strict:
        # The check is part of every returned column, so the optimizer can't prune it.
        wrong = (n_fields != need) | F.col("user_id").isNull()
        error = F.raise_error(F.concat(F.lit("malformed rating line: '"), F.col("line"), F.lit("'")))
        body = body.withColumn("user_id", F.when(wrong, error.cast("long")).otherwise(F.col("user_id")))
        item = F.when(wrong, error.cast("long")).otherwise(parts.getItem(0).cast("long"))
        score = F.when(wrong, error.cast("double")).otherwise(parts.getItem(1).cast("double"))
    else:
        body = body.where((n_fields >= need) & F.col("user_id").isNotNull())
        item = F.expr("try_cast(split(trim(line), '\\\\s+')[0] AS BIGINT)")
        score = F.expr("try_cast(split(trim(line), '\\\\s+')[1] AS DOUBLE)")
    cols = [F.col("user_id"), item.alias("item_id")] + ([score.alias("score")] if with_scores else [])
    out = body.select(*cols)
    if not strict:
        out = out.where(F.col("item_id").isNotNull() & (F.col("score").isNotNull() if with_scores else F.lit(True)))
    return out


def read_pairs(spark: SparkSession, paths, strict: bool = False) -> DataFrame:
    """A3: (user_id, item_id) rows of a pair file (header then item lines)."""
    return read_blocks(spark, paths, with_scores=False, strict=strict)


def declared_counts(spark: SparkSession, paths) -> DataFrame:
    """(user_id, declared) from the header lines."""
    t = F.trim(F.col("line"))
    return (_lines(spark, paths).where(t.contains("|"))
            .select(F.split(t, r"\|").getItem(0).cast("long").alias("user_id"),
                    F.split(t, r"\|").getItem(1).cast("long").alias("declared")))


def block_count_check(spark: SparkSession, paths, with_scores: bool = True) -> DataFrame:
    """A4: users whose declared count differs from the rows read: (user_id, declared, read)."""
    got = read_blocks(spark, paths, with_scores, strict=False).groupBy("user_id").agg(F.count(F.lit(1)).alias("read"))
    dec = declared_counts(spark, paths).groupBy("user_id").agg(F.sum("declared").alias("declared"))
    j = dec.join(got, "user_id", "full_outer").select("user_id", F.coalesce("declared", F.lit(0)).alias("declared"),
                                                      F.coalesce("read", F.lit(0)).alias("read"))
    return j.where(F.col("declared") != F.col("read"))


def format_score(score, mode: str = "round"):
    """Score text per sink mode: 'round' half-even int, 'clamp' int in [20,100], 'fixed4', 'raw'."""
    if mode == "round":
        return F.bround(score, 0).cast("long").cast("string")
    if mode == "clamp":
        return round_clamp_int(score).cast("string")
    if mode == "fixed4":
        return F.format_string("%.4f", score)
    return score.cast("string")


def block_lines(ratings: DataFrame, mode: str = "round", with_scores: bool = True,
                declared: DataFrame | None = None) -> DataFrame:
    """A10: (user_id, line_no, line): header ``user|n`` (line 0) then items ascending.

    n is the user's number of rows, or that of ``declared`` (user_id, declared) where given.

    Long form, no per-user collect: the header comes from a count per user and
    the item lines keep their rows; ``write_blocks`` orders them when writing.
    """
    if declared is None:
        declared = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("declared"))
    hdr = declared.withColumnRenamed("declared", "_n").select(
        "user_id", F.lit(0).alias("line_no"),
        F.concat(F.col("user_id").cast("string"), F.lit("|"), F.col("_n").cast("string")).alias("line"))
    w = W.partitionBy("user_id").orderBy("item_id")
    txt = F.col("item_id").cast("string")
    if with_scores:
        txt = F.concat(txt, F.lit("  "), format_score(F.col("score"), mode))
    rows = ratings.select("user_id", F.row_number().over(w).alias("line_no"), txt.alias("line"))
    return hdr.unionByName(rows)


def write_blocks(ratings: DataFrame, path: str, mode: str = "round", with_scores: bool = True,
                 declared: DataFrame | None = None) -> None:
    """Write the block file(s): range-partitioned by user, sorted, one text part per range.

    Part files are in user order, so their concatenation is the full file.
    """
    lines = block_lines(ratings, mode, with_scores, declared)
    (lines.repartitionByRange("user_id").sortWithinPartitions("user_id", "line_no")
     .select("line").write.mode("overwrite").text(path))
