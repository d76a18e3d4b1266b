"""Operator 8: sharding by sampled splitters (DataFrame functions only).

Records are ordered by a unique key: hash of the text, hash of the id, row
number.  Equal texts are neighbours in this order.  A size-weighted sample of
the keys gives quantile boundaries, records are range-partitioned by them, and
ranges that hold too many rows are subdivided by a denser sample from inside
them (a group of copies has many keys, so it can be divided).  Prefix sums of
sizes within a range, plus the sums of the ranges before it, give each record
its place in the whole order; the order is cut where each shard has its share
of the bytes.

Law ``bytes``: shard sizes differ by about one record at most.  The sample and
the boundaries only spread the work, so they don't change the result.

Defined cases: a null text has size 1 and crc 0; null ids are a key of their
own; repeated rows get slots of their own; other columns are ignored, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.llm.common import written

ROWS_PER_RANGE = 2_000_000
LEAST_RANGES = 64
KEYS_PER_RANGE = 16


def _range_of(key: Column, bounds: list[str]) -> Column:
    """How many boundaries are at or below the key, looked up in two levels."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1::step]])
    blocks = F.array(*[F.array(*[F.lit(b) for b in bounds[i:i + step]]) for i in range(0, len(bounds), step)])
    block = F.size(F.filter(coarse, lambda b: b <= key))
    rest = F.coalesce(F.size(F.filter(F.get(blocks, block), lambda b: b <= key)), F.lit(0))
    return block * step + F.greatest(rest, F.lit(0))


def _sample(df: DataFrame, rate: Column) -> list[str]:
    """Sorted keys of a sample; ``rate`` is each row's chance."""
    coin = F.pmod(F.xxhash64("key", F.lit("coin")), F.lit(1 << 30)) / float(1 << 30)
    return sorted(r[0] for r in df.where(coin < rate).select("key").collect())


def shard(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    The driver holds KEYS_PER_RANGE sampled keys and one row of sums per range,
    with one range per ``rows_per_range`` rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    meta = docs.select(
        F.col(f"`{id_col}`").alias("_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("crc"), F.concat(
            F.md5(text), F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-"))),
            F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")).alias("key"))
    meta = written(meta, "shard-keys")
    n, total = meta.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(LEAST_RANGES, math.ceil(n / rows_per_range))
    keys = _sample(meta, F.col("size") * float(KEYS_PER_RANGE * ranges) / float(max(1, total)))
    bounds = keys[KEYS_PER_RANGE::KEYS_PER_RANGE]
    most = 2 * math.ceil(max(1, n) / ranges)
    while True:
        placed = meta.withColumn("range", _range_of(F.col("key"), bounds))
        sums = {r["range"]: (r["rows"], r["bytes"]) for r in placed.groupBy("range").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).collect()}
        over = {r: math.ceil(rows / most) for r, (rows, _) in sums.items() if rows > max(most, KEYS_PER_RANGE)}
        if not over:
            break
        rate = F.coalesce(*[F.when(F.col("range") == r, F.lit(2.0 * KEYS_PER_RANGE * parts / sums[r][0]))
                            for r, parts in over.items()], F.lit(0.0))
        more = _sample(placed, rate)[KEYS_PER_RANGE::KEYS_PER_RANGE]
        if not more:
            break
        bounds = sorted({*bounds, *more})
    rows_before, bytes_before, offsets = 0, 0, []
    for r in sorted(sums):
        offsets.append((r, rows_before, bytes_before))
        rows_before, bytes_before = rows_before + sums[r][0], bytes_before + sums[r][1]
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("rows_before", T.LongType()),
                           T.StructField("bytes_before", T.LongType())])
    spark = docs.sparkSession
    order = Window.partitionBy("range").orderBy("key")
    ranked = (placed.withColumn("_rank", F.row_number().over(order))
              .withColumn("_cum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .join(F.broadcast(spark.createDataFrame(offsets, schema)), "range"))
    middle = 2 * (F.col("_cum") + F.col("bytes_before")) - F.col("size")
    part = F.expr("0") if total == 0 else F.floor(middle * n_shards / F.lit(2 * total))
    ranked = written(ranked.select(
        "_id", "size", "crc", F.least(F.lit(n_shards - 1), part).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("_rank") - 1).alias("place")), "shard-places")
    first = ranked.groupBy("shard").agg(F.min("place").alias("first"))
    out = ranked.join(F.broadcast(first), "shard")   # n_shards rows
    return out.select(F.col("_id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
