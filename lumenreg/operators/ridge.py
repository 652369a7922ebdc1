"""Closed-form ridge regression from grouped moments — one pass per grid.

With L2-only regularisation and few features, MLlib's ``LinearRegression``
(solver ``auto`` -> ``normal``) solves the normal equations of the
standardised problem; ``maxIter`` has no effect. That solution depends on the
data only through count, means and the centred cross-product matrix of
(features, label). Those are *mergeable*: per-group moments combine exactly
(Chan et al. parallel update), so one ``groupBy(group).agg(...)`` pass over
the rows yields the moments of every fold, of every "all folds but one"
training set, of a validation cut and of the test rows at once.

From them the driver solves tiny (p x p) systems for every (split, regParam)
pair, and the squared error of any linear model on any group follows from
the same moments:

    SSE_g(b, w) = n_g * (mean_y - b - mean_x . w)^2
                  + C_yy - 2 w . C_xy + w' C_xx w          (centred, per group)

so a full k-fold grid search plus the held-out test RMSE costs **one scan**
with map-side partial aggregation and k+1 output rows, instead of
``k * grid + 1`` model fits each reading the data. Only these bounded
statistics (groups x (p+1)^2 numbers) ever reach the driver.

Scaling conventions follow MLlib's weighted least squares: population
standard deviations ``s_j``, ``s_y``; effective penalty ``lambda / s_y`` on the
standardised coefficients (``standardization=True``) or
``lambda / (s_y * s_j^2)`` per raw coefficient (``False``); constant features get
coefficient 0; a constant label gives all-zero coefficients and intercept
``mean_y``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreg.config import FEATURE_COLS, LABEL_COL, PREDICTION_COL
from lumenreg.session import ensure_codegen_fields


@dataclass
class Moments:
    """Count, mean vector and centred co-moment matrix of (x_1..x_p, y)."""

    n: float
    mean: np.ndarray
    comom: np.ndarray

    @staticmethod
    def empty(dim: int) -> "Moments":
        return Moments(0.0, np.zeros(dim), np.zeros((dim, dim)))

    def merge(self, other: "Moments") -> "Moments":
        if other.n == 0:
            return self
        if self.n == 0:
            return other
        n = self.n + other.n
        delta = other.mean - self.mean
        mean = self.mean + delta * (other.n / n)
        comom = self.comom + other.comom + np.outer(delta, delta) * (self.n * other.n / n)
        return Moments(n, mean, comom)

    @staticmethod
    def combine(parts) -> "Moments":
        parts = list(parts)
        out = Moments.empty(len(parts[0].mean))
        for m in parts:
            out = out.merge(m)
        return out


def moment_aggregates(cols: list[str]) -> list[Column]:
    """Aggregate expressions: n, means, population co-variances and counts of NaN.

    ``covar_pop`` keeps centred co-moments with a stable streaming update
    and merges partial results exactly (no ``sum(x*y) - sum(x)sum(y)/n``
    cancellation). Its buffer has 4 fields per pair (127 for 6 features +
    label), above Spark's default whole-stage-codegen field limit, so
    :func:`grouped_moments` raises that limit.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}"))
    aggs += [F.count_if(F.isnan(F.col(c).cast("double"))).alias(f"nan{i}")
             for i, c in enumerate(cols)]
    return aggs


def codegen_fields(dim: int) -> int:
    """Aggregation-buffer fields of :func:`moment_aggregates` (with headroom)."""
    return 1 + 3 * dim + 4 * dim * (dim + 1) // 2 + 16


def check_nan(rows, cols: list[str]) -> None:
    """Fail, naming the columns, if any group holds NaN (as the assembler does for trees)."""
    bad = [c for i, c in enumerate(cols) if any(r[f"nan{i}"] for r in rows)]
    if bad:
        raise ValueError(f"NaN in column(s) {', '.join(bad)}; remove or mend these rows first")


def _row_to_moments(row, dim: int) -> Moments:
    n = float(row["n"])
    mean = np.array([row[f"m{i}"] for i in range(dim)], dtype=float)
    comom = np.zeros((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            comom[i, j] = comom[j, i] = float(row[f"c{i}_{j}"]) * n
    return Moments(n, mean, comom)


def grouped_moments(df: DataFrame, group_col: str | Column | None,
                    features: list[str] = FEATURE_COLS,
                    label: str = LABEL_COL) -> dict:
    """One aggregation pass -> {group value: Moments}.

    The result has one small row per group (the group count is chosen by the
    caller: folds, a validation flag, a test marker), so collecting it is
    bounded no matter how many rows are scanned. Partial aggregation runs
    map-side inside whole-stage codegen. NaN in any column is an error.
    """
    cols = list(features) + [label]
    ensure_codegen_fields(df.sparkSession, codegen_fields(len(cols)))
    if group_col is None:
        rows = df.agg(*moment_aggregates(cols)).collect()
        check_nan(rows, cols)
        return {None: _row_to_moments(rows[0], len(cols))} if rows[0]["n"] else {}
    g = F.col(group_col) if isinstance(group_col, str) else group_col
    rows = df.groupBy(g.alias("_g")).agg(*moment_aggregates(cols)).collect()
    check_nan(rows, cols)
    return {r["_g"]: _row_to_moments(r, len(cols)) for r in rows}


@dataclass
class RidgeFit:
    coefficients: np.ndarray
    intercept: float
    features: list[str] = field(default_factory=lambda: list(FEATURE_COLS))

    def prediction(self) -> Column:
        """Prediction as a JVM-side column expression (stays in codegen)."""
        expr = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coefficients):
            expr = expr + F.col(c) * F.lit(float(w))
        return expr

    def transform(self, df: DataFrame, output_col: str = PREDICTION_COL) -> DataFrame:
        return df.withColumn(output_col, self.prediction())


def fit_ridge(m: Moments, reg_param: float, standardization: bool = True,
              features: list[str] = FEATURE_COLS) -> RidgeFit:
    """Solve the standardised ridge normal equations from moments."""
    p = len(m.mean) - 1
    if m.n <= 0:
        raise ValueError("cannot fit on zero rows")
    cov = m.comom / m.n
    sd = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    sd_x, sd_y = sd[:p], sd[p]
    coef = np.zeros(p)
    if sd_y > 0:
        active = np.flatnonzero(sd_x > 0)
        if active.size:
            sx = sd_x[active]
            corr = cov[np.ix_(active, active)] / np.outer(sx, sx)
            rhs = cov[active, p] / (sx * sd_y)
            lam = reg_param / sd_y
            if standardization:
                pen = np.full(active.size, lam)
            else:
                pen = lam / (sx * sx)
            system = corr + np.diag(pen)
            try:
                w = np.linalg.solve(system, rhs)
            except np.linalg.LinAlgError:
                # singular (no penalty, collinear inputs): least-squares solution
                w = np.linalg.lstsq(system, rhs, rcond=None)[0]
            coef[active] = w * sd_y / sx
    intercept = float(m.mean[p] - coef @ m.mean[:p])
    return RidgeFit(coef, intercept, list(features))


def group_sse(m: Moments, fit: RidgeFit) -> float:
    """Sum of squared residuals of ``fit`` over the rows summarised by ``m``."""
    p = len(m.mean) - 1
    w = fit.coefficients
    resid_mean = m.mean[p] - fit.intercept - w @ m.mean[:p]
    cxx, cxy, cyy = m.comom[:p, :p], m.comom[:p, p], m.comom[p, p]
    centred = cyy - 2.0 * (w @ cxy) + w @ cxx @ w
    return float(m.n * resid_mean * resid_mean + max(centred, 0.0))


def group_rmse(m: Moments, fit: RidgeFit) -> float:
    return float(np.sqrt(group_sse(m, fit) / m.n))
