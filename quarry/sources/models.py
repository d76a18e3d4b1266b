"""CSV sink (A11) and model save/load (A14) as parquet tables in a shared folder."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str) -> None:
    """Predictions / grid results as CSV with a header (one part per partition)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Small parameter tables (centroids, weights) as one parquet table of (name, shape, values)."""
    rows = [(k, json.dumps(list(np.shape(v))), [float(x) for x in np.ravel(v)]) for k, v in params.items()]
    spark.createDataFrame(rows, "name string, shape string, vals array<double>").write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> dict:
    out = {}
    for r in spark.read.parquet(path).collect():  # one row per parameter tensor
        shape = tuple(json.loads(r["shape"]))
        out[r["name"]] = np.asarray(r["vals"], dtype=np.float64).reshape(shape)
    return out


def save_table(df: DataFrame, path: str) -> None:
    """A14 for data-sized factors (embeddings, biases): a plain parquet table."""
    df.write.mode("overwrite").parquet(path)
