"""Least squares from sufficient statistics.

One aggregate over the rows gives, per fold and combination of category values, the counts, sums and cross products
of the numeric columns and the target. Everything else follows from these few rows: the fit over all folds, the fits
without each fold (differences of sums), the r2 of each on the rows left out, means and deviations of all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOLERANCE = 1e-10    # eigenvalues below this share of the largest belong to collinear columns
FEW = 100_000        # category values whose effects are broadcast
COEFFICIENTS = "feature string, level string, coefficient double, mean double, std double"


def cell_sums(rows: DataFrame, numbers: list[str], categories: list[str], target: str, fold: str) -> DataFrame:
    """One row per fold and combination of category values: n, sums and cross products.

    Partial sums are made in the map tasks, so the shuffle carries one row per task and combination.
    """
    x = [F.col(n).cast("double") for n in numbers] + [F.col(target).cast("double")]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(len(x)) for j in range(i, len(x))]
    return rows.groupBy(fold, *categories).agg(F.count("*").alias("n"), *sums, *products)


@dataclass
class Moments:
    """Per fold, the matrix of summed products of (1, numbers, one column per category value, target)."""

    numbers: list[str]
    levels: dict[str, list[str]]
    folds: dict[int, np.ndarray]

    @property
    def total(self) -> np.ndarray:
        return sum(self.folds.values())


def moments(rows: DataFrame, numbers: list[str], categories: list[str], target: str, fold: str) -> Moments:
    """The moment matrices of every fold, from one scan; the driver gets one row per fold and combination of values.

    A null category has no column, so that its row of indicators is zero.
    """
    cells = cell_sums(rows, numbers, categories, target, fold).collect()
    levels = {c: sorted({r[c] for r in cells if r[c] is not None}) for c in categories}
    first, places = 1 + len(numbers), {}
    for c in categories:
        places[c] = {v: first + i for i, v in enumerate(levels[c])}
        first += len(levels[c])
    q, folds = len(numbers) + 1, {}
    own = np.append(np.arange(1, q), first)  # the numbers and, last of all, the target
    for r in cells:
        m = folds.setdefault(r[fold], np.zeros((first + 1, first + 1), np.longdouble))
        s = np.array([r[f"s{i}"] for i in range(q)], np.longdouble)
        p = np.zeros((q, q), np.longdouble)
        for i in range(q):
            for j in range(i, q):
                p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        m[np.ix_(own, own)] += p
        ones = [0] + [places[c][r[c]] for c in categories if r[c] is not None]
        m[np.ix_(ones, ones)] += r["n"]
        m[np.ix_(ones, own)] += s
        m[np.ix_(own, ones)] += s[:, None]
    return Moments(numbers, levels, folds)


def solve(moment: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Intercept, coefficients, means and deviations of the columns.

    The columns are standardised; constant ones get 0, and among the solutions that collinear columns leave open the
    one of least norm is taken, as a least-squares solver on scaled columns takes it.
    """
    n = moment[0, 0]
    mean = moment[0, 1:] / n
    centred = moment[1:, 1:] - n * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(centred)[:-1], 0))
    size = np.sqrt(np.maximum(np.diag(moment)[1:-1], 0))
    varies = spread > 1e-9 * np.maximum(size, 1e-300)
    beta = np.zeros(len(spread))
    if varies.any():
        scale = spread[varies]
        inner = (centred[:-1, :-1][np.ix_(varies, varies)] / np.outer(scale, scale)).astype(np.float64)
        right = (centred[:-1, -1][varies] / scale).astype(np.float64)
        values, vectors = np.linalg.eigh(inner)
        kept = values > TOLERANCE * values.max()
        beta[varies] = (vectors[:, kept] @ ((vectors[:, kept].T @ right) / values[kept])) / scale
    deviation = np.where(varies, spread, 0) / np.sqrt(max(n - 1, 1))
    return float(mean[-1] - beta @ mean[:-1]), beta, mean[:-1].astype(np.float64), deviation.astype(np.float64)


def squared_error(moment: np.ndarray, intercept: float, beta: np.ndarray) -> float:
    """Summed squared error on the rows of a moment matrix."""
    w = np.concatenate([[-intercept], -beta, [1.0]]).astype(np.longdouble)
    return float(w @ moment @ w)


def left_out_r2(sums: Moments) -> list[float | None]:
    """r2 on each fold of the fit on all other folds; none where the fold's target doesn't vary."""
    out = []
    for _, own in sorted(sums.folds.items()):
        intercept, beta, _, _ = solve(sums.total - own)
        n = own[0, 0]
        spread = float(own[-1, -1] - own[0, -1] ** 2 / n)
        out.append(1 - squared_error(own, intercept, beta) / spread if spread > 1e-12 * float(own[-1, -1]) else None)
    return out


@dataclass
class LinearFit:
    """A fitted line: one effect per number and per category value."""

    intercept: float
    numbers: dict[str, float]
    levels: dict[str, dict[str, float]]
    means: list[float]
    deviations: list[float]

    @classmethod
    def of(cls, sums: Moments) -> "LinearFit":
        intercept, beta, mean, deviation = solve(sums.total)
        q, levels = len(sums.numbers), {}
        at = q
        for c, values in sums.levels.items():
            levels[c] = dict(zip(values, beta[at:at + len(values)].tolist()))
            at += len(values)
        return cls(intercept, dict(zip(sums.numbers, beta[:q].tolist())), levels, mean.tolist(), deviation.tolist())

    def names(self) -> list[tuple[str, str | None]]:
        return [(n, None) for n in self.numbers] + [(c, v) for c, values in self.levels.items() for v in values]

    def transform(self, rows: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Adds the prediction; an unknown or null category value has no effect of its own.

        The effects of category values are joined: by broadcast while they are few, else by a shuffle on the value.
        """
        given, total = rows.columns, F.lit(self.intercept)
        for name, effect in self.numbers.items():
            total = total + F.lit(effect) * F.col(name).cast("double")
        for i, (column, effects) in enumerate(self.levels.items()):
            if not effects:
                continue
            table = rows.sparkSession.createDataFrame(list(effects.items()), f"_level{i} string, _effect{i} double")
            rows = rows.join(F.broadcast(table) if len(effects) <= FEW else table, F.col(column) == F.col(f"_level{i}"), "left")
            total = total + F.coalesce(F.col(f"_effect{i}"), F.lit(0.0))
        return rows.select(*given, total.alias(prediction))

    def save(self, path: str, spark: SparkSession) -> None:
        effects = list(self.numbers.values()) + [e for values in self.levels.values() for e in values.values()]
        table = [("", None, self.intercept, None, None)] + [
            (n, v, float(e), float(m), float(d)) for (n, v), e, m, d in zip(self.names(), effects, self.means, self.deviations)]
        numbered = [(i, *row) for i, row in enumerate(table)]
        spark.createDataFrame(numbered, f"place int, {COEFFICIENTS}").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "LinearFit":
        first, *rest = spark.read.parquet(path).orderBy("place").collect()  # one row per column of the model
        levels: dict[str, dict[str, float]] = {}
        for r in rest:
            if r["level"] is not None:
                levels.setdefault(r["feature"], {})[r["level"]] = r["coefficient"]
        return cls(first["coefficient"], {r["feature"]: r["coefficient"] for r in rest if r["level"] is None}, levels,
                   [r["mean"] for r in rest], [r["std"] for r in rest])
