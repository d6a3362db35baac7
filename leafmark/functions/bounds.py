"""Exact bounds of rare errors: the one-sided binomial upper bound, the trials a claim needs, and the gate over both; bootstrap intervals of means."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def binomial_cdf(errors: int, trials: int, p: float) -> float:
    """P(X <= errors), summed from the largest term's neighbourhood in logarithms."""
    if errors >= trials or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    k = np.arange(errors + 1)
    log_choose = math.lgamma(trials + 1) - np.array([math.lgamma(x + 1) + math.lgamma(trials - x + 1) for x in k])
    terms = log_choose + k * math.log(p) + (trials - k) * math.log1p(-p)
    return min(1.0, float(np.exp(terms.max()) * np.exp(terms - terms.max()).sum()))


def upper_bound(errors: int, trials: int, confidence: float = 0.95) -> float:
    """The p at which so few errors have the probability 1 - confidence."""
    if errors >= trials:
        return 1.0
    if not errors:
        return -math.expm1(math.log(1 - confidence) / trials)
    low, high = errors / trials, 1.0
    while high - low > 1e-15 and low < (low + high) / 2 < high:
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_cdf(errors, trials, middle) > 1 - confidence else (low, middle)
    return high


def holds(errors: int, trials: int, rate: float, confidence: float = 0.95) -> bool:
    """Whether the bound is at most `rate`, without the bisection."""
    return trials > 0 and binomial_cdf(errors, trials, rate) <= 1 - confidence


def least_trials(errors: int, rate: float, confidence: float = 0.95) -> int:
    """The fewest trials with which so many errors still hold the rate: doubled until they do, then halved in between."""
    high = max(1, errors)
    while not holds(errors, high, rate, confidence):
        high *= 2
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(errors, middle, rate, confidence) else (middle, high)
    return high


def gate(errors: int, trials: int, effect: float | None, rate: float, confidence: float, needs_effect: bool) -> tuple:
    """(effective errors, effective trials, upper bound, required trials, status, reason). Effective errors are rounded up, trials down."""
    if effect is not None and not (math.isfinite(effect) and effect >= 1):
        return None, None, None, None, "NOT_EVALUATED", "INVALID_DESIGN_EFFECT"
    if not trials:
        return None, None, None, None, "NOT_EVALUATED", "NO_REFERENCE_SLOTS"
    k, n = (errors, trials) if effect is None else (math.ceil(errors / effect), math.floor(trials / effect))
    bound = upper_bound(k, n, confidence) if 0 < n and k <= n else None
    found = (k, n, bound, least_trials(k, rate, confidence))
    if errors / trials > rate:
        return *found, "FAIL", "POINT_ESTIMATE_ABOVE_MAXIMUM"
    if bound is None:
        return *found, "NOT_EVALUATED", "NO_EFFECTIVE_SLOTS"
    if not holds(k, n, rate, confidence):
        return *found, "NOT_EVALUATED", "INSUFFICIENT_SLOTS_FOR_BOUND"
    if needs_effect and effect is None:
        return *found, "NOT_EVALUATED", "LOCKED_DESIGN_EFFECT_REQUIRED"
    return *found, "PASS", None


def gated(counts: DataFrame, rate: float = 1e-4, confidence: float = 0.95, needs_effect: bool = False) -> DataFrame:
    """counts (errors, trials, effect: null if unknown) with the gate's columns. For a few rows of sums, one each group that is judged."""
    schema = "effective_errors long, effective_trials long, upper_bound double, required_trials long, status string, reason string"

    def judged(errors: pd.Series, trials: pd.Series, effect: pd.Series) -> pd.DataFrame:
        rows = [gate(int(k), int(n), None if pd.isna(d) else float(d), rate, confidence, needs_effect) for k, n, d in zip(errors, trials, effect, strict=True)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    made = F.pandas_udf(judged, schema)("errors", "trials", "effect")
    return counts.withColumn("_gate", made).select(*counts.columns, "_gate.*")


def bootstrap_mean(df: DataFrame, by: list[str], value: Column, draws: int = 1000, confidence: float = 0.95, seed: int = 0) -> DataFrame:
    """Mean and percentile interval of it by resampling, for each group.

    Each row counts in draw b with a Poisson(1) weight from a hash of the row and b (the online bootstrap), so weights need no pass over the group, no group is held by a task,
    and reruns agree. Draws are summed before the shuffle.
    """
    # Poisson(1) by its distribution function: the number of thresholds that a uniform number reaches
    thresholds = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]).tolist()
    rows = df.select(*by, value.cast("double").alias("_v"), F.xxhash64(*df.columns).alias("_h")).where("_v is not null")
    u = F.pmod(F.xxhash64("_h", "_b", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    drawn = rows.withColumn("_b", F.explode(F.sequence(F.lit(1), F.lit(draws)))).withColumn("_u", u)
    weight = sum(((F.col("_u") >= t).cast("int") for t in thresholds), F.lit(0))
    means = drawn.withColumn("_w", weight).groupBy(*by, "_b").agg((F.sum(F.col("_w") * F.col("_v")) / F.nullif(F.sum("_w"), F.lit(0))).alias("_m"))
    tail = (1 - confidence) / 2
    ends = means.groupBy(*by).agg(F.percentile("_m", F.lit(tail)).alias("low"), F.percentile("_m", F.lit(1 - tail)).alias("high"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg("_v").alias("mean")).join(ends, by)
