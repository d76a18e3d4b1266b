"""Perceptron and one-hidden-layer MLP on ``labelled(id, x ARRAY<DOUBLE>, y)``.

Training moves data-sized work to the executors and keeps only the weights on
the driver: the MLP's full-batch gradient is a sum of per-partition numpy
gradient sums (exactly the reference's full-batch step); the perceptron runs
its online rule over each partition in order and the driver averages the
partition weights each epoch (iterative parameter mixing; with one partition
it is the reference's rule).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import sigmoid


def _stack(col) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in col])


# ---------------------------------------------------------------- perceptron (I4)

def _next_mistake(signed: np.ndarray, is_one: np.ndarray, weights: np.ndarray, start: int) -> int:
    """First row from ``start`` on whose side of the plane is wrong; len(signed) if there is none."""
    wrong = (signed[start:] @ weights >= 0) != is_one[start:]
    return start + int(wrong.argmax()) if wrong.any() else len(signed)


def perceptron_fit(df: DataFrame, epochs: int = 10, lr: float = 0.1, x_col: str = "x", y_col: str = "y",
                   order_cols: tuple[str, ...] = ("id",), block: int = 256):
    """Weights [bias, w1..wd] of a mistake-driven linear separator (a point on the plane counts as class 1).

    Within a partition rows are taken in the order of ``order_cols``.  Rows
    between two mistakes leave the weights alone, so each block is scored as one
    matrix product and only its mistakes are visited; a mistake moves the
    weights by ``lr`` times the bias-augmented row, towards class 1 or away.
    Partition weights are averaged by their numbers of rows.
    """
    order = [c for c in order_cols if c in df.columns]
    data = df.select(x_col, y_col, *order)
    data = (data.sortWithinPartitions(*order) if order else data).select(x_col, y_col).cache()
    size = 1 + len(data.first()[x_col])
    weights = np.zeros(size)
    for _ in range(epochs):
        shared = weights

        def local_pass(batches, shared=shared):
            here, seen = shared.copy(), 0
            for frame in batches:
                rows = np.column_stack([np.ones(len(frame)), _stack(frame[x_col])])
                is_one = frame[y_col].to_numpy(dtype=np.float64) >= 0.5
                for first in range(0, len(rows), block):
                    part, ones, k = rows[first:first + block], is_one[first:first + block], 0
                    while (k := _next_mistake(part, ones, here, k)) < len(part):
                        here += (lr if ones[k] else -lr) * part[k]
                        k += 1
                seen += len(rows)
            if seen:
                yield pd.DataFrame({"place": np.arange(size, dtype=np.int32), "mass": here * seen, "seen": np.full(size, seen)})

        merged = data.mapInPandas(local_pass, "place int, mass double, seen long").groupBy("place").agg(
            (F.sum("mass") / F.sum("seen")).alias("weight")).orderBy("place").collect()  # one row per weight
        weights = np.array([r["weight"] for r in merged])
    return weights.tolist()


def linear_score(x_col: str, weights: list[float]):
    b, ws = float(weights[0]), [float(v) for v in weights[1:]]
    x = F.col(x_col)
    return sum((x[j] * F.lit(wj) for j, wj in enumerate(ws)), F.lit(b))


def perceptron_predict(df: DataFrame, weights: list[float], x_col: str = "x") -> DataFrame:
    return df.withColumn("pred", F.when(linear_score(x_col, weights) >= 0, F.lit(1.0)).otherwise(F.lit(0.0)))


# ---------------------------------------------------------------- MLP

def mlp_init(d: int, hidden: int = 5, seed: int = 42, scale: float = 0.01):
    """W1 ~ scale*N(0,1) (d x h), b1 = 0, W2 ~ scale*N(0,1) (h x 1), b2 = 0 (numpy legacy generator)."""
    rs = np.random.RandomState(seed)
    return {"W1": rs.randn(d, hidden) * scale, "b1": np.zeros(hidden),
            "W2": rs.randn(hidden, 1) * scale, "b2": np.zeros(1)}


def mlp_forward_expr(x_col: str, params) -> "F.Column":
    """P(y=1) as a Catalyst expression: sigmoid(sigmoid(x W1 + b1) W2 + b2)."""
    W1, b1, W2, b2 = (np.asarray(params[k]) for k in ("W1", "b1", "W2", "b2"))
    x = F.col(x_col)
    hidden = []
    for h in range(W1.shape[1]):
        z = sum((x[j] * F.lit(float(W1[j, h])) for j in range(W1.shape[0])), F.lit(0.0)) + F.lit(float(b1[h]))
        hidden.append(sigmoid(z))
    z2 = sum((a * F.lit(float(W2[h, 0])) for h, a in enumerate(hidden)), F.lit(0.0)) + F.lit(float(b2[0]))
    return sigmoid(z2)


def mlp_fit(df: DataFrame, hidden: int = 5, lr: float = 0.1, epochs: int = 100, seed: int = 42,
            x_col: str = "x", y_col: str = "y", valid: DataFrame | None = None, patience: int | None = None,
            log: list | None = None):
    """Full-batch gradient descent on binary cross-entropy; returns the parameter dict.

    Per epoch one job: every partition returns its summed gradients (a few
    hundred numbers), the driver divides by m and steps.  With ``valid`` and
    ``patience`` (J4) training stops after ``patience`` epochs without a better
    validation loss and the best parameters are returned; ``log`` collects
    (epoch, validation loss) (J6).
    """
    best, best_loss, bad = None, float("inf"), 0
    d = len(df.select(x_col).first()[0])
    p = mlp_init(d, hidden, seed)
    data = df.select(x_col, y_col).cache()
    m = data.count()
    for _ in range(epochs):
        # lower layer with the bias as first row: (d + 1) x h; upper layer likewise: (h + 1)
        lower = np.vstack([p["b1"], p["W1"]])
        upper = np.concatenate([p["b2"], p["W2"][:, 0]])

        def slopes(batches, lower=lower, upper=upper):
            total = np.zeros(lower.size + upper.size)
            for frame in batches:
                target = frame[y_col].to_numpy(dtype=np.float64)
                inputs = np.column_stack([np.ones(len(target)), _stack(frame[x_col])])
                unit = np.tanh(inputs @ lower / 2) / 2 + 0.5          # the logistic function
                seen = np.column_stack([np.ones(len(target)), unit])
                error = np.tanh(seen @ upper / 2) / 2 + 0.5 - target   # slope of the loss by the upper sum
                back = np.einsum("n,h,nh,nh->nh", error, upper[1:], unit, 1 - unit)
                total += np.concatenate([np.einsum("nd,nh->dh", inputs, back).ravel(), error @ seen])
            yield pd.DataFrame({"place": np.arange(total.size, dtype=np.int32), "slope": total})

        sums = data.mapInPandas(slopes, "place int, slope double").groupBy("place").agg(
            F.sum("slope").alias("slope")).orderBy("place").collect()  # one row per weight
        move = lr / m * np.array([r["slope"] for r in sums])
        lower = lower - move[:lower.size].reshape(lower.shape)
        upper = upper - move[lower.size:]
        p = {"W1": lower[1:], "b1": lower[0], "W2": upper[1:, None], "b2": upper[:1]}
        if valid is not None and patience is not None:
            loss = bce(valid.select(F.col(y_col).alias("y"), mlp_forward_expr(x_col, p).alias("p"))).first()[0]
            if log is not None:
                log.append((len(log) + 1, float(loss)))
            if loss < best_loss:
                best, best_loss, bad = {k: v.copy() for k, v in p.items()}, loss, 0
            else:
                bad += 1
                if bad >= patience:
                    return best
    return best if best is not None else p


# ---------------------------------------------------------------- metrics

def accuracy(df: DataFrame, y_col: str = "y", pred_col: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(y_col) == F.col(pred_col)).cast("double")).alias("accuracy"))


def bce(df: DataFrame, y_col: str = "y", p_col: str = "p", eps: float = 1e-8) -> DataFrame:
    y, p = F.col(y_col), F.col(p_col)
    term = y * F.log(p + F.lit(eps)) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p + F.lit(eps))
    return df.agg((-F.avg(term)).alias("bce"))
