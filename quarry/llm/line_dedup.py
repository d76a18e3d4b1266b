"""Operator 1: line deduplication by overlapping three-line windows (DataFrame functions only).

Every run of three consecutive lines is hashed (128 bits).  A window seen before,
in the order of (document id, document hash, position), is a repeat; the lines
that repeats cover are merged per document and removed.  The first occurrence
stays.  Windows of three empty lines don't count, and a document with fewer than
three lines has no window and stays as it is.

Defined cases: a null text has no lines and stays null; null ids sort before all
others; rows equal in id and text are one document whose rows all get the same
result, rows equal in id alone are told apart by their text's hash; other
columns stay as they are, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import packed, small_enough, written

WINDOW = 3
BROADCAST_LINES = 2_000_000


def _windows(lines: Column) -> Column:
    """Start and 128-bit hash of every window with a line that isn't empty."""
    def one(i: Column) -> Column:
        part = [F.get(lines, i + k) for k in range(WINDOW)]
        return F.struct(i.alias("start"), F.xxhash64(*part).alias("h1"), F.xxhash64(F.lit(7), *reversed(part)).alias("h2"),
                        (F.concat(*part) != "").alias("full"))
    starts = F.when(F.size(lines) >= WINDOW, F.sequence(F.lit(0), F.size(lines) - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    return F.filter(F.transform(starts, one), lambda w: w["full"])


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _hash, covered): sorted line numbers that repeated windows cover, for documents that have any."""
    lines = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_hash"),
                        F.split(F.col(f"`{text_col}`"), "\n", -1).alias("lines"))
    at = lines.select("_id", "_hash", F.explode(_windows(F.col("lines"))).alias("w")).select(
        "_id", "_hash", F.col("w.start").alias("start"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"))
    place = F.struct("_id", "_hash", "start")
    repeated = at.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").drop("last")
    later = at.join(repeated, ["h1", "h2"]).where(~F.col("first").eqNullSafe(place))
    return (later.groupBy("_id", "_hash").agg(F.collect_set("start").alias("starts"))
            .select("_id", "_hash", F.array_distinct(F.flatten(F.transform(
                "starts", lambda s: F.array(*[s + k for k in range(WINDOW)])))).alias("covered")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                added: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with the text rid of repeated windows, and two further long columns: lines before, lines removed."""
    columns = [c for c in docs.columns if c not in added]
    rows = docs.select(packed(docs), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_hash"))
    cover = written(covered_lines(docs, id_col, text_col).withColumnsRenamed({"_id": "_cid", "_hash": "_chash"}), "lines")
    cover = small_enough(cover, BROADCAST_LINES, F.size("covered") + 4)   # line numbers; else the texts are shuffled
    both = rows.join(cover, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_hash") == F.col("_chash")), "left")
    text = F.col(f"_row.`{text_col}`")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered")), lambda i: F.get(F.col("_lines"), i)), "\n")
    both = both.withColumn("_lines", F.when(F.col("covered").isNotNull(), lines))
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(F.regexp_replace(text, "[^\n]+", "")) + 1).cast("long")
    out = both.select("_row", F.when(F.col("covered").isNull(), text).otherwise(kept).alias("_text"),
                      n_lines.alias("_n"), F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("_gone"))
    return out.select(*[(F.col("_text") if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in columns],
                      F.col("_n").alias(added[0]), F.col("_gone").alias(added[1]))
