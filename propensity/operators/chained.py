"""Iterative (chained-equation) imputation of numeric columns from Gram matrices.

Rows are grouped by the set of columns they have.  Within such a pattern every imputed value is an affine function
of the values that are there, so the Gram matrix of the completed rows follows from the Gram matrix of the
observed ones.  One pass sums these per pattern (at most 2**columns small matrices); every regression of
every round is then solved from them on the driver, column by column as if over the rows themselves.
One pass a round measures the largest change of a row for the stopping rule, and one last projection fills the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns come to the driver: at most 2**MAX_COLUMNS matrices of (columns + 1)**2 numbers.
MAX_COLUMNS = 12


def ordinary(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Least squares of centred sums (smallest norm where columns depend on each other)."""
    return np.linalg.pinv(xx, hermitian=True) @ xy


def bayesian_ridge(xx: np.ndarray, xy: np.ndarray, yy: float, n: float, rounds: int = 300, tol: float = 1e-3, prior: float = 1e-6) -> np.ndarray:
    """Ridge whose penalty is the ratio of weight and noise precision that maximises the evidence."""
    values, vectors = np.linalg.eigh(xx)
    values = np.maximum(values, 0)
    turned = vectors.T @ xy
    noise, weight = 1 / (yy / n + np.finfo(float).eps), 1.0
    before = None

    def solve():
        c = vectors @ (turned / (values + weight / noise))
        return c, max(yy - 2 * c @ xy + c @ xx @ c, 0.0)
    for _ in range(rounds):
        coef, rss = solve()
        effective = (noise * values / (weight + noise * values)).sum()
        weight = (effective + 2 * prior) / (coef @ coef + 2 * prior)
        noise = (n - effective + 2 * prior) / (rss + 2 * prior)
        if before is not None and np.abs(before - coef).sum() < tol:
            break
        before = coef
    return solve()[0]


def lasso(alpha: float = 1.0, positive: bool = True, rounds: int = 10_000, tol: float = 1e-4) -> Callable:
    """Coordinate descent on the Gram matrix for ``|y - Xw|^2 / 2n + alpha |w|``, by default with w >= 0."""
    def fit(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
        w = np.zeros(len(xy))
        for _ in range(rounds):
            step = 0.0
            for j in range(len(w)):
                if xx[j, j] <= 0:
                    continue
                rho = xy[j] - xx[j] @ w + xx[j, j] * w[j]
                new = max(abs(rho) - alpha * n, 0.0) / xx[j, j] * (1 if rho > 0 else -1)
                new = max(new, 0.0) if positive else new
                step, w[j] = max(step, abs(new - w[j])), new
            if step <= tol * max(np.abs(w).max(initial=0.0), 1e-12):
                break
        return w
    return fit


def _regression(gram: np.ndarray, j: int, others: list[int], estimator: Callable) -> np.ndarray:
    """Intercept and coefficients of column j on the others; gram's row 0 is the constant."""
    n, out = gram[0, 0], np.zeros(len(gram))
    at = [o + 1 for o in others]
    mx, my = gram[0, at] / n, gram[0, j + 1] / n
    xx = gram[np.ix_(at, at)] - n * np.outer(mx, mx)
    xy = gram[at, j + 1] - n * mx * my
    yy = max(gram[j + 1, j + 1] - n * my * my, 0.0)
    out[at] = estimator(xx, xy, yy, n)
    out[0] = my - mx @ out[at]
    return out


def _masked(cols: Sequence[str]) -> Column:
    return sum((F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(cols)), F.lit(0)).cast("int").alias("__mask")


def _with_maps(df: DataFrame, maps: dict[int, np.ndarray], name: str) -> DataFrame:
    """Each row with the affine maps of its pattern: (columns) x (columns + 1) numbers, broadcast (at most 2**MAX_COLUMNS rows)."""
    rows = [(m, [[float(v) for v in line] for line in a]) for m, a in maps.items()]
    side = df.sparkSession.createDataFrame(rows, f"__of int, {name} array<array<double>>")
    return df.join(F.broadcast(side), F.col("__mask") == F.col("__of"), "left").drop("__of")


def _applied(maps: str, i: int, values: list[Column]) -> Column:
    line = F.get(F.col(maps), F.lit(i))
    return sum((F.get(line, F.lit(k)) * v for k, v in enumerate(values, 1)), F.get(line, F.lit(0)))


def impute_chained(df: DataFrame, cols: Sequence[str], estimator: Callable = bayesian_ridge, max_iter: int = 10, tol: float = 1e-3) -> DataFrame:
    """NULL and NaN of numeric ``cols`` filled by regressing each column on the others, fewest missing first.

    Columns are standardised by the mean and population deviation of their values (a constant column by 1).  Missing
    cells start at the mean; in each round a column is fitted on the rows that have it, with the others'
    current values, and its missing cells are overwritten at once.  Rounds end after ``max_iter`` or when the
    largest sum of changes in a row falls below ``tol`` times the largest absolute value.  A column without
    any value stays NULL and takes no part; an empty table stays empty."""
    cols = list(cols)
    if len(cols) > MAX_COLUMNS:
        raise ValueError(f"at most {MAX_COLUMNS} columns, not {len(cols)}")
    clean = df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols})
    stats = clean.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop), ("n", F.count))]).first()
    use = [i for i in range(len(cols)) if stats[f"n_{i}"]]
    kept = [cols[i] for i in use]
    mean, dev = [stats[f"m_{i}"] for i in use], [stats[f"s_{i}"] or 1.0 for i in use]
    n = len(use)
    if not n:
        return clean
    z = [(F.col(c) - m) / s for c, m, s in zip(kept, mean, dev)]
    tagged = clean.withColumn("__mask", _masked(kept))
    zero = [F.coalesce(v, F.lit(0.0)) for v in z]
    cells = [(i, k) for i in range(n) for k in range(i + 1)]
    got = tagged.groupBy("__mask").agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(zero)],
                                       *[F.sum(zero[i] * zero[k]).alias(f"p{i}_{k}") for i, k in cells],
                                       F.max(F.greatest(*[F.abs(v) for v in zero], F.lit(0.0))).alias("top")).collect()
    grams: dict[int, np.ndarray] = {}
    for r in got:
        g = np.zeros((n + 1, n + 1))
        g[0, 0] = r["n"]
        g[0, 1:] = g[1:, 0] = [r[f"s{i}"] for i in range(n)]
        for i, k in cells:
            g[i + 1, k + 1] = g[k + 1, i + 1] = r[f"p{i}_{k}"]
        grams[r["__mask"]] = g
    limit = tol * max((r["top"] for r in got), default=0.0)
    # maps[mask][i]: value of column i in rows of the pattern, from (1, observed values with 0 for missing)
    maps = {m: np.array([[0.0] + [float(i == k and m >> i & 1) for k in range(n)] for i in range(n)]) for m in grams}
    missing = {i: sum(g[0, 0] for m, g in grams.items() if not m >> i & 1) for i in range(n)}
    order = sorted((i for i in range(n) if missing[i]), key=lambda i: missing[i])
    for _ in range(max_iter if n > 1 and order else 0):
        before = {m: a.copy() for m, a in maps.items()}
        for j in order:
            whole = np.zeros((n + 1, n + 1))
            for m, g in grams.items():
                if m >> j & 1:
                    a = np.vstack([np.eye(1, n + 1), maps[m]])
                    whole += a @ g @ a.T
            coef = _regression(whole, j, [k for k in range(n) if k != j], estimator)
            for m, a in maps.items():
                if not m >> j & 1:
                    a[j] = coef[1:] @ a
                    a[j, 0] += coef[0]
        moves = _with_maps(tagged.where(F.col("__mask") != (1 << n) - 1), {m: maps[m] - before[m] for m in maps}, "__move")
        change = moves.agg(F.max(sum((F.abs(_applied("__move", i, zero)) for i in order), F.lit(0.0)))).first()[0] or 0.0
        if change < limit:
            break
    filled = _with_maps(tagged, maps, "__map")
    out = {c: F.coalesce(F.col(c), _applied("__map", i, zero) * dev[i] + mean[i]) for i, c in enumerate(kept)}
    return filled.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in df.columns])
