"""Sequential gap filling with a first-order autoregression.

Each missing cell is the one-step forecast of an AR(1) with mean, fitted by exact Gaussian
likelihood to everything before it, filled cells included.  The fit needs six running sums, so a
series is read once, in order, with constant memory: Spark partitions by series and sorts inside
each partition, and the task streams Arrow batches through the sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .ordered import floats, in_order, pieces
from .panel import COMPANY, PERIOD, series_rows

_GRID = np.linspace(-0.999, 0.999, 201)


class RunningFit:
    """Running sums of a series, measured from its first value, and the forecast they give."""

    def __init__(self, first: float):
        self.origin = first
        self.n = 1
        self.last = 0.0
        self.total = self.squares = self.products = 0.0

    def extend(self, values: np.ndarray) -> None:
        v = values - self.origin
        before = np.concatenate(([self.last], v[:-1]))
        self.n += len(v)
        self.total += float(v.sum())
        self.squares += float(v @ v)
        self.products += float(v @ before)
        self.last = float(v[-1])

    def _profile(self, phi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood up to a constant, and the mean that maximises it, for each phi."""
        m = self.n - 1
        # The first value is 0 by choice of origin, so sums over t >= 2 are the full sums.
        early, early_sq = self.total - self.last, self.squares - self.last**2
        drift = self.total - phi * early
        drift_sq = self.squares - 2 * phi * self.products + phi**2 * early_sq
        edge, slope = 1 - phi**2, 1 - phi
        mean = slope * drift / (edge + m * slope**2)
        s = edge * mean**2 + drift_sq - 2 * mean * slope * drift + m * (slope * mean) ** 2
        with np.errstate(divide="ignore"):
            return -0.5 * self.n * np.log(np.maximum(s, 0.0)) + 0.5 * np.log(edge), mean

    def _score(self, phi: np.ndarray) -> np.ndarray:
        """Slope of the log-likelihood; its zero is known to the last digits, the top of a flat curve is not."""
        m = self.n - 1
        early, early_sq = self.total - self.last, self.squares - self.last**2
        drift, slope, edge = self.total - phi * early, 1 - phi, 1 - phi**2
        mean = slope * drift / (edge + m * slope**2)
        s = edge * mean**2 + self.squares - 2 * phi * self.products + phi**2 * early_sq - 2 * mean * slope * drift + m * (slope * mean) ** 2
        # The mean is the best one for each phi, so it counts as fixed here.
        ds = 2 * phi * early_sq - 2 * self.products - 2 * phi * mean**2 + 2 * mean * (drift + slope * early) - 2 * m * slope * mean**2
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(s > 0, -0.5 * self.n * ds / s - phi / edge, 0.0)

    def forecast(self) -> float:
        spread = self.squares - self.total**2 / self.n
        if self.n < 3 or spread <= 1e-12 * max(self.squares, 1e-300):
            return self.origin + self.last
        best, step = _GRID[int(np.argmax(self._profile(_GRID)[0]))], _GRID[1] - _GRID[0]
        low, high = max(best - step, -0.999999), min(best + step, 0.999999)
        for _ in range(4):
            grid = low + np.arange(41) * ((high - low) / 40)
            rising = int(np.cumprod(self._score(grid) > 0).sum())
            low, high = grid[max(rising - 1, 0)], grid[min(rising, 40)]
        left, right = self._score(np.array([low, high]))
        phi = low + (high - low) * left / (left - right) if left > right else low
        mean = float(self._profile(np.array([phi]))[1][0])
        return float(self.origin + mean + phi * (self.last - mean))


def _fill(values: np.ndarray, fit: RunningFit | None) -> RunningFit | None:
    """Fill one piece of one series in place; returns the sums to continue with."""
    missing = np.flatnonzero(np.isnan(values))
    at = 0
    for gap in [*missing, len(values)]:
        if gap > at:
            run = values[at:gap]
            if fit is None:
                fit, run = RunningFit(float(run[0])), run[1:]
            if len(run):
                fit.extend(run)
        if gap < len(values) and fit is not None:
            values[gap] = fit.forecast()
            fit.extend(values[gap : gap + 1])
        at = gap + 1
    return fit


def ar1_fill(
    df: DataFrame,
    columns: Sequence[str],
    partition_by: Sequence[str] = COMPANY,
    order_by: Sequence[str] = PERIOD,
) -> DataFrame:
    """Fill every gap of ``columns`` that has a value before it; leading gaps stay NULL.

    A history of one or two values, or a constant one, is continued with its last value.
    """
    key, values = list(partition_by), list(columns)
    schema = T.StructType(
        [T.StructField(f.name, T.DoubleType() if f.name in values else f.dataType) for f in df.schema.fields]
    )

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, fits = None, {}
        for batch in batches:
            data = {c: floats(batch, c) for c in values}
            for name, start, stop in pieces(batch, key):
                if name != current:
                    current, fits = name, {}
                for c in values:
                    fits[c] = _fill(data[c][start:stop], fits.get(c))
            yield batch.assign(**data)

    typed = series_rows(df, key).withColumns({c: F.col(c).cast("double") for c in values})
    return in_order(typed, key, order_by).mapInPandas(stream, schema)
