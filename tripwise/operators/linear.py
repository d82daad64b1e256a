"""Linear regression without intercept by full-batch gradient descent.

Semantics of the SGD trainer the source uses with mini-batch fraction 1:
w_0 = 0;  w_t = w_{t-1} - (step / sqrt(t)) * (1/n) sum_i (w_{t-1}.x_i - y_i) x_i;
stop after ``iterations`` or once |w_t - w_{t-1}| < tol * max(|w_t|, 1).

The gradient only needs the sufficient statistics G = sum x x^T, b = sum y x
and n, which ONE distributed pass computes (each task multiplies its Arrow
batches with numpy; Spark sums the per-task partials).  Every step size and iteration count of a grid then runs on
a d x d matrix (d = number of features) without touching the data again, and
the MSE of any weight vector on a split follows from that split's statistics.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONVERGENCE_TOL = 0.001
# Fixed values of the source's linear grid: iteration counts and step sizes.
LR_ITERATIONS = (25, 50, 75, 100, 250, 500)
LR_STEPS = (1e-6, 1e-7, 1e-8, 1e-9, 1e-10)


@dataclass
class Moments:
    """Sufficient statistics of a least-squares problem."""
    gram: np.ndarray   # sum x x^T
    xty: np.ndarray    # sum y x
    yty: float         # sum y^2
    n: int

    def mse(self, w: np.ndarray) -> float:
        if self.n == 0 or not np.all(np.isfinite(w)):
            return float("nan")
        with np.errstate(over="ignore", invalid="ignore"):
            return float((w @ self.gram @ w - 2.0 * w @ self.xty + self.yty) / self.n)


def _stat_names(d: int) -> list[str]:
    return ([f"g_{i}_{j}" for i in range(d) for j in range(i, d)] + [f"b_{i}" for i in range(d)]
            + ["yy", "n"])


def _partial_moments(features: list[str], label: str, key: str | None):
    """Per task: X^T X, X^T y, y^T y and n of each key, by numpy over Arrow batches."""
    d = len(features)
    iu = np.triu_indices(d)

    def fn(batches):
        import pyarrow as pa
        acc: dict = {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = np.column_stack([rb.column(f).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for f in features])
            y = rb.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
            if key:
                import pyarrow.compute as pc
                kc = rb.column(key)
                groups = {kv: pc.fill_null(pc.equal(kc, kv), False).to_numpy(zero_copy_only=False)
                          for kv in (True, False)}
            else:
                groups = {None: None}
            for k, mask in groups.items():
                xs, ys = (x, y) if mask is None else (x[mask], y[mask])
                if len(ys) == 0:
                    continue
                g, b, yy, n = acc.get(k, (np.zeros((d, d)), np.zeros(d), 0.0, 0))
                acc[k] = (g + xs.T @ xs, b + xs.T @ ys, yy + float(ys @ ys), n + len(ys))
        if not acc:
            return
        kcol, scol, vcol = [], [], []
        for k, (g, b, yy, n) in acc.items():
            vals = list(g[iu]) + list(b) + [yy, float(n)]
            kcol.extend([k] * len(vals))
            scol.extend(range(len(vals)))
            vcol.extend(float(v) for v in vals)
        yield pa.RecordBatch.from_arrays([pa.array(kcol, type=pa.bool_()), pa.array(scol, type=pa.int32()),
                                          pa.array(vcol, type=pa.float64())], names=["k", "stat", "v"])
    return fn


def _from_stats(vals: dict[int, float], d: int) -> Moments:
    names = _stat_names(d)
    v = [vals.get(i, 0.0) for i in range(len(names))]
    g = np.zeros((d, d))
    g[np.triu_indices(d)] = v[:d * (d + 1) // 2]
    g = g + np.triu(g, 1).T
    off = d * (d + 1) // 2
    return Moments(g, np.array(v[off:off + d]), float(v[off + d]), int(round(v[off + d + 1])))


def _moments_frame(df: DataFrame, features: list[str], label: str, key: str | None) -> DataFrame:
    """Statistics as (k, stat, v) rows: one value per statistic and key.

    Rows with a NULL feature or label are left out.  Each task emits
    d(d+3)/2+2 partial sums per key from numpy, merged by one tiny group-by:
    the shuffle carries (tasks x keys x stats) rows, never data rows.
    """
    kexpr = F.col(key).cast("boolean") if key else F.lit(None).cast("boolean")
    data = df.select(kexpr.alias("_key"), *[F.col(c).cast("double") for c in list(features) + [label]]) \
             .dropna(subset=list(features) + [label])
    part = data.mapInArrow(_partial_moments(list(features), label, "_key" if key else None),
                           "k boolean, stat int, v double")
    return part.groupBy("k", "stat").agg(F.sum("v").alias("v"))


def _collect(df: DataFrame, d: int) -> dict:
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["k"], {})[r["stat"]] = r["v"]
    return {k: _from_stats(v, d) for k, v in out.items()}


def moments(df: DataFrame, features: list[str], label: str) -> Moments:
    """Upper triangle of X^T X, X^T y, y^T y and n in one pass over ``df``."""
    d = len(features)
    return _collect(_moments_frame(df, features, label, None), d).get(None, _from_stats({}, d))


def moments_by(df: DataFrame, key: str, features: list[str], label: str) -> dict:
    """Moments per value of a boolean ``key`` (e.g. the train / test flag) in ONE pass."""
    return _collect(_moments_frame(df, features, label, key), len(features))


def descend(m: Moments, step: float, iterations, tol: float = CONVERGENCE_TOL) -> dict[int, tuple[np.ndarray, int]]:
    """Weights after each requested iteration count: {count: (weights, iterations run)}."""
    wanted = sorted(set(int(i) for i in iterations))
    out: dict[int, tuple[np.ndarray, int]] = {}
    w = np.zeros(len(m.xty))
    prev = None
    done = 0
    converged = False
    for t in range(1, wanted[-1] + 1):
        if not converged and m.n > 0 and np.all(np.isfinite(w)):
            with np.errstate(over="ignore", invalid="ignore"):
                # A step too large diverges to inf / NaN: that cell's MSE is NaN and never wins.
                grad = (m.gram @ w - m.xty) / m.n
                w = w - (step / math.sqrt(t)) * grad
            done = t
            if prev is not None:
                with np.errstate(over="ignore", invalid="ignore"):
                    converged = bool(np.linalg.norm(w - prev) < tol * max(np.linalg.norm(w), 1.0))
            prev = w.copy()
        if t in wanted:
            out[t] = (w.copy(), done)
    return out


@dataclass
class LinearModel:
    """w.x without intercept, applied as a plain column expression (no UDF, no vector)."""
    features: list[str]
    weights: list[float]
    intercept: float = 0.0

    def predict_col(self) -> Column:
        expr = F.lit(float(self.intercept)) if self.intercept else None
        for f, w in zip(self.features, self.weights):
            term = F.lit(float(w)) * F.col(f)
            expr = term if expr is None else expr + term
        return expr

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict_col())

    def save(self, spark: SparkSession, path: str) -> None:
        payload = json.dumps({"features": self.features, "weights": list(map(float, self.weights)),
                              "intercept": float(self.intercept)})
        spark.createDataFrame([(payload,)], "model string").write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearModel":
        d = json.loads(spark.read.json(path).first()["model"])
        return LinearModel(d["features"], d["weights"], d.get("intercept", 0.0))


def fit_linear_sgd(train: DataFrame, features: list[str], label: str, iterations: int, step: float,
                   tol: float = CONVERGENCE_TOL) -> LinearModel:
    w, _ = descend(moments(train, features, label), step, [iterations], tol)[iterations]
    return LinearModel(list(features), w.tolist())
