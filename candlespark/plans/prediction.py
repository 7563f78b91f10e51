"""Next-bar return prediction: linear regression on lagged returns, by sums that can be merged.

Least squares need no more of the rows than their Gram sums: the sums of products of all pairs of columns, the constant 1
included. These are summed per stretch of time in one aggregation with map-side combine. Sums of stretches add up to those of any
training span, and the error on a stretch follows from its own sums, so that walking forward costs no further look at the rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from candlespark.functions.time import time_chunk, unix_micros
from candlespark.operators.blocks import CANDLES, Series, over_series
from candlespark.operators.features import log_return_column
from candlespark.session import materialize

LAGS = 5


def lagged_returns(candles: DataFrame, lags: int = LAGS, series: Series = CANDLES, price: str = "close") -> DataFrame:
    """Log return and its ``lags`` predecessors; rows that lack one are of no use to the regression."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        rows = rows.withColumn("log_return", log_return_column(price, w))
        return rows.withColumns({f"lag_{i}": F.lag("log_return", i).over(w) for i in range(1, lags + 1)})

    names = ["log_return", *[f"lag_{i}" for i in range(1, lags + 1)]]
    return over_series(candles, series, lags + 1, add).dropna(subset=names)


def gram_sums(rows: DataFrame, by: Column, names: list[str], target: str) -> DataFrame:
    """Per value of ``by`` (column ``part``): ``g_i_j``, the sums of products of the columns ``1, *names, target``."""
    columns = [F.lit(1.0), *[F.col(c) for c in [*names, target]]]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    return rows.groupBy(by.alias("part")).agg(*[F.sum(columns[i] * columns[j]).alias(f"g_{i}_{j}") for i, j in pairs])


def _matrix(row: Row, size: int, prefix: str = "g") -> np.ndarray:
    gram = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            gram[i, j] = gram[j, i] = row[f"{prefix}_{i}_{j}"]
    return gram


def _fit(gram: np.ndarray) -> np.ndarray:
    """Intercept and coefficients from the sums of the training rows; the shortest solution if there are several."""
    return np.linalg.lstsq(gram[:-1, :-1], gram[:-1, -1], rcond=None)[0]


def _rmse(gram: np.ndarray, beta: np.ndarray) -> float | None:
    """Root of the mean squared error of ``beta`` on the rows that ``gram`` sums up."""
    weights = np.append(-beta, 1.0)
    return math.sqrt(max(0.0, weights @ gram @ weights) / gram[0, 0]) if gram[0, 0] else None


def next_bar_prediction(candles: DataFrame, train_share: float = 0.8, series: Series = CANDLES, lags: int = LAGS) -> DataFrame:
    """One row: intercept, coefficients and test error; the first part of the time span trains."""
    rows = materialize(lagged_returns(candles, lags, series=series), "lagged")  # read for the span and for the sums
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    micros = unix_micros(F.col(series.time))
    spec = ", ".join(f"{n} double" for n in ["intercept", *names, "rmse"])
    span = rows.agg(F.min(micros).alias("lo"), F.max(micros).alias("hi")).first()
    if span["lo"] is None:
        return candles.sparkSession.createDataFrame([], spec)
    cut = span["lo"] + int((span["hi"] - span["lo"]) * train_share)
    size = lags + 2
    parts = {row["part"]: _matrix(row, size) for row in gram_sums(rows, micros <= cut, names, "log_return").collect()}
    beta = _fit(parts[True])
    rmse = _rmse(parts[False], beta) if False in parts else None
    return candles.sparkSession.createDataFrame([(*map(float, beta), rmse)], spec)


def walk_forward(candles: DataFrame, stretch: str = "1 day", series: Series = CANDLES, lags: int = LAGS, least: int | None = None) -> DataFrame:
    """Per stretch of time the regression on all rows before it, and its error on the stretch.

    ``part`` numbers the stretches since the epoch. Stretches with fewer than ``least`` training rows (by default two more than
    coefficients) are left out. The rows are read once; from there on one row of sums per stretch is handled.
    """
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    size = lags + 2
    least = size + 1 if least is None else least
    sums = gram_sums(lagged_returns(candles, lags, series=series), time_chunk(F.col(series.time), stretch), names, "log_return")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pairs = [f"{i}_{j}" for i in range(size) for j in range(i, size)]
    sums = sums.withColumns({f"t_{p}": F.sum(f"g_{p}").over(earlier) for p in pairs}).where(F.col("t_0_0") >= least)
    spec = ", ".join(["part bigint", "n_train bigint", "n bigint", *[f"{n} double" for n in ["intercept", *names, "rmse"]]])

    def solve(batches):
        import pandas as pd

        for batch in batches:
            found = []
            for row in batch.to_dict("records"):
                beta = _fit(_matrix(row, size, "t"))
                own = _matrix(row, size)
                found.append((row["part"], int(row["t_0_0"]), int(own[0, 0]), *beta, _rmse(own, beta)))
            yield pd.DataFrame(found, columns=[c.split()[0] for c in spec.split(", ")])

    return sums.mapInPandas(solve, spec)
