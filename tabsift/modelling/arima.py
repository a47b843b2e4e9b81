"""Monthly forecasts by decomposition, differencing and an ARMA of the rest, one series a task.

A series is cut into a yearly season, a trend and a rest. What is left without the season is differenced until it
holds its level (at most twice), an ARMA model with a constant is fitted for every small order, and the order with the
lowest AIC makes the forecast, with intervals from its error and the weights of past shocks. A series has at most a few
hundred months, whatever the number of rows behind them, and series are independent of one another.

Defined cases: months without rows are filled by level, trend and season of the others and the neighbours' distance
from those, and are counted; a series of under two years has no season, one of under MIN_MONTHS months no forecast;
equal values give a forecast without width; a missing value counts as a missing month.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import MIN_PERIODS

MIN_MONTHS = 8
# Orders tried: autoregressive and moving-average terms up to these.
MOST_AR, MOST_MA, MOST_DIFFERENCES = 3, 2, 2
# Fixed value: the KPSS statistic above which a level is not held, at 5%.
KPSS_LIMIT = 0.463
YEAR = 12


def _least_squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(x, y, rcond=None)[0]


def filled(values: np.ndarray, first_month: int) -> np.ndarray:
    """Missing months from a line and month means of the known ones, and the neighbours' distance from those."""
    known = np.flatnonzero(np.isfinite(values))
    if len(known) == len(values):
        return values
    t = np.arange(len(values))
    month = (t + first_month) % YEAR
    # A yearly pattern only where every month was seen and there are years enough to tell it from the line.
    seasonal = len(values) >= MIN_PERIODS and len(known) > YEAR + 1 and len(set(month[known])) == YEAR
    x = np.column_stack([t, np.eye(YEAR)[month]]) if seasonal else np.column_stack([t, np.ones(len(t))])
    fitted = x @ _least_squares(x[known], values[known])
    return np.where(np.isfinite(values), values, fitted + np.interp(t, known, values[known] - fitted[known]))


def decomposed(values: np.ndarray, first_month: int) -> tuple[np.ndarray, np.ndarray]:
    """Trend and season of a filled series: a year's moving average, then the mean distance from it per month."""
    n, t = len(values), np.arange(len(values))
    if n < MIN_PERIODS:
        line = np.column_stack([t, np.ones(n)])
        return line @ _least_squares(line, values), np.zeros(n)
    window = np.r_[0.5, np.ones(YEAR - 1), 0.5] / YEAR
    half, middle = YEAR // 2, np.convolve(values, window, mode="valid")
    month = (t + first_month) % YEAR
    away = values[half : n - half] - middle
    means = np.array([away[month[half : n - half] == m].mean() for m in range(YEAR)])
    season = (means - means.mean())[month]
    # The ends go on as the line of the nearest year does.
    trend = np.empty(n)
    trend[half : n - half] = middle
    for ends, near in ((t[:half], t[half : half + YEAR]), (t[n - half :], t[n - half - YEAR : n - half])):
        near = near[(near >= half) & (near < n - half)]
        line = np.column_stack([near, np.ones(len(near))])
        trend[ends] = np.column_stack([ends, np.ones(half)]) @ _least_squares(line, trend[near])
    return trend, season


def _flat(y: np.ndarray) -> bool:
    """No spread beyond rounding."""
    return len(y) < 2 or y.std() <= 1e-9 * max(1.0, np.abs(y).max())


def differences(y: np.ndarray) -> int:
    """How often to difference until the series holds its level, by the KPSS statistic."""
    for d in range(MOST_DIFFERENCES):
        if _flat(y):
            return d
        e = y - y.mean()
        lags = int(4 * (len(y) / 100) ** 0.25)
        spread = (e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))) / len(y)
        if spread > 0 and (np.cumsum(e) ** 2).sum() / len(y) ** 2 / spread < KPSS_LIMIT:
            return d
        y = np.diff(y)
    return MOST_DIFFERENCES


@dataclass
class Arma:
    """Constant, weights of past values and past shocks, the error's variance and the AIC."""

    constant: float
    ar: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ma: np.ndarray = field(default_factory=lambda: np.zeros(0))
    variance: float = 0.0
    aic: float = -np.inf
    shocks: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def ahead(self, y: np.ndarray, steps: int) -> np.ndarray:
        values, shocks = list(y), list(self.shocks)
        for _ in range(steps):
            past = sum(w * values[-1 - i] for i, w in enumerate(self.ar))
            values.append(self.constant + past + sum(w * shocks[-1 - i] for i, w in enumerate(self.ma)))
            shocks.append(0.0)
        return np.array(values[len(y) :])

    def shock_weights(self, steps: int, d: int) -> np.ndarray:
        """What a shock adds to the values 0, 1, … steps - 1 later, after summing up ``d`` times."""
        psi = np.zeros(steps)
        psi[0] = 1.0
        for k in range(1, steps):
            psi[k] = sum(w * psi[k - 1 - i] for i, w in enumerate(self.ar) if k > i) + (self.ma[k - 1] if k <= len(self.ma) else 0.0)
        for _ in range(d):
            psi = np.cumsum(psi)
        return psi


def _steady(weights: np.ndarray) -> bool:
    """Do all roots of 1 - w1 z - w2 z² … lie outside the unit circle, so that effects die out?"""
    return not len(weights) or bool(np.all(np.abs(np.roots(np.r_[1.0, -weights])) < 0.999))


def fit_arma(y: np.ndarray) -> Arma:
    """The order with the lowest AIC, by two regressions: shocks from a long autoregression, then the ARMA on them.

    All orders are fitted to the same months. Orders whose effects would not die out are passed over.
    """
    if _flat(y):
        return Arma(float(y.mean()) if len(y) else 0.0, shocks=np.zeros(max(len(y), MOST_MA)))
    long = max(1, min(8, len(y) // 4))
    lagged = np.column_stack([np.ones(len(y) - long), *[y[long - k : len(y) - k] for k in range(1, long + 1)]])
    rough = np.r_[np.zeros(long), y[long:] - lagged @ _least_squares(lagged, y[long:])]
    start = min(max(MOST_AR, MOST_MA + long), len(y) // 2)
    best = None
    for p in range(MOST_AR + 1):
        for q in range(MOST_MA + 1):
            n = len(y) - start
            if n <= p + q + 2:
                continue
            past = [y[start - k : len(y) - k] for k in range(1, p + 1)] + [rough[start - k : len(y) - k] for k in range(1, q + 1)]
            x = np.column_stack([np.ones(n), *past])
            w = _least_squares(x, y[start:])
            ar, ma = w[1 : p + 1], w[p + 1 :]
            if not (_steady(ar) and _steady(-ma)):
                continue
            shocks = np.zeros(len(y))
            for t in range(len(y)):
                told = w[0] + sum(a * y[t - 1 - i] for i, a in enumerate(ar) if t > i) + sum(m * shocks[t - 1 - i] for i, m in enumerate(ma) if t > i)
                shocks[t] = y[t] - told if t >= p else 0.0
            variance = float((shocks[start:] ** 2).mean())
            aic = n * np.log(max(variance, 1e-300)) + 2 * (p + q + 1)
            if best is None or aic < best.aic - 1e-9:
                best = Arma(float(w[0]), ar, ma, variance * n / max(1, n - p - q - 1), float(aic), shocks)
    return best or Arma(float(y.mean()), variance=float(y.var()), shocks=y - y.mean())


@dataclass
class Forecast:
    differences: int
    model: Arma
    values: np.ndarray
    errors: np.ndarray  # standard error per step


def forecast_values(values: np.ndarray, first_month: int, steps: int) -> Forecast:
    """``steps`` months after the last of a filled series."""
    _, season = decomposed(values, first_month)
    plain = values - season
    d = differences(plain)
    y, ends = plain, []
    for _ in range(d):
        ends.append(y[-1])
        y = np.diff(y)
    model = fit_arma(y)
    ahead = model.ahead(y, steps)
    for last in reversed(ends):
        ahead = last + np.cumsum(ahead)
    if len(values) >= MIN_PERIODS:  # the season of the same month a year or more before
        ahead = ahead + np.array([season[len(values) - YEAR + k % YEAR] for k in range(steps)])
    return Forecast(d, model, ahead, np.sqrt(model.variance * np.cumsum(model.shock_weights(steps, d) ** 2)))


def _regular(pdf: pd.DataFrame) -> tuple[np.ndarray, int]:
    """Values of all months from the first to the last, and the first as months since year 0."""
    months = pd.to_datetime(pdf["month"])
    at = (months.dt.year * YEAR + months.dt.month - 1).to_numpy()
    values = np.full(at.max() - at.min() + 1, np.nan)
    values[at - at.min()] = pdf["value"].to_numpy(dtype="float64")
    known = np.flatnonzero(np.isfinite(values))
    return (values[known[0] : known[-1] + 1], int(at.min() + known[0])) if len(known) else (values[:0], int(at.min()))


def _dates(first: int, n: int) -> np.ndarray:
    return np.array([date(m // YEAR, m % YEAR + 1, 1) for m in range(first, first + n)], dtype=object)


def _grouped(series: DataFrame, by: Sequence[str], work, schema: str) -> DataFrame:
    """One series a group; groups of ``by``, the missing ones among them, keep their own types."""
    keys = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.lit(0)
    numbered = series.select(keys.alias("_by"), "month", F.col("value").cast("double").alias("value"))
    marked = numbered.withColumn("_name", F.to_json(F.struct("_by"), {"ignoreNullFields": "false"}))
    names = marked.groupBy("_name").agg(F.first("_by").alias("_by"))
    found = marked.select("_name", "month", "value").groupBy("_name").applyInPandas(work, f"_name string, {schema}")
    out = found.join(names, "_name").drop("_name")
    return out.select(*[F.col("_by")[c].alias(c) for c in by], *[c for c in out.columns if c != "_by"])


def forecast(series: DataFrame, by: Sequence[str], horizon: int, confidence: float = 0.9) -> DataFrame:
    """Per series the next ``horizon`` months: step, month, forecast, ``low`` and ``high``, and what made them.

    ``series`` has a row per group of ``by`` and ``month`` with its ``value``. Of the model come along the number of
    differences, the orders ``ar`` and ``ma``, the AIC, and how many months there were and were filled.
    """
    wide = NormalDist().inv_cdf(0.5 + confidence / 2)
    schema = "step int, month date, forecast double, low double, high double, differences int, ar int, ma int, aic double, months int, filled int"

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        raw, start = _regular(pdf)
        steps = horizon if len(raw) >= MIN_MONTHS else 0
        if not steps:
            return pd.DataFrame({c.split()[0]: np.zeros(0, object) for c in f"_name string, {schema}".split(", ")})
        found = forecast_values(filled(raw, start % YEAR), start % YEAR, steps)
        aic = found.model.aic if np.isfinite(found.model.aic) else np.nan
        return pd.DataFrame({
            "_name": pdf["_name"].iloc[0], "step": np.arange(1, steps + 1), "month": _dates(start + len(raw), steps), "forecast": found.values,
            "low": found.values - wide * found.errors, "high": found.values + wide * found.errors, "differences": found.differences,
            "ar": len(found.model.ar), "ma": len(found.model.ma), "aic": aic, "months": len(raw), "filled": int(np.isnan(raw).sum()),
        })

    return _grouped(series, by, work, schema).withColumn("aic", F.when(~F.isnan("aic"), F.col("aic")))


def decompose(series: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every month of every series, the missing ones filled, as the sum of ``trend``, ``season`` and ``rest``."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        raw, start = _regular(pdf)
        values = filled(raw, start % YEAR) if len(raw) else raw
        trend, season = decomposed(values, start % YEAR) if len(raw) else (raw, raw)
        return pd.DataFrame({
            "_name": pdf["_name"].iloc[0], "month": _dates(start, len(raw)), "value": values, "filled": np.isnan(raw),
            "trend": trend, "season": season, "rest": values - trend - season,
        })

    return _grouped(series, by, work, "month date, value double, filled boolean, trend double, season double, rest double")
