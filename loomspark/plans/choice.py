"""Event rates and conditional logit over risk sets.

The rate of a candidate is exp(theta . s); given that one event happens in a risk set, it
is the candidate's with its share of the set's rates.  A set of several events counts each
of them against the whole set.  All sums run as aggregates with partial sums before the
shuffle, so that a risk set of very many candidates is no task's alone; what reaches the
driver is one number for each pair of covariates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.session import written


def _eta(covariates: list[str], theta: list[float]) -> Column:
    return sum((F.col(c).cast("double") * F.lit(float(b)) for c, b in zip(covariates, theta, strict=True)), F.lit(0.0))


def choice_probabilities(rows: DataFrame, stratum: str, covariates: list[str], theta: list[float]) -> DataFrame:
    """``rows`` with ``rate`` exp(theta . s) and ``probability``, its share of the stratum's rates.

    A row with a null covariate has neither and no part in the stratum.  Shares are taken
    relative to the stratum's largest exponent, so no rate can overflow them.
    """
    known = rows.withColumn("_eta", _eta(covariates, theta))
    top = known.groupBy(F.col(stratum).alias("_of")).agg(F.max("_eta").alias("_top"))
    shifted = known.join(top, F.col(stratum).eqNullSafe(F.col("_of"))).drop("_of").withColumn("_w", F.exp(F.col("_eta") - F.col("_top")))
    total = shifted.groupBy(F.col(stratum).alias("_of")).agg(F.sum("_w").alias("_sum"))
    both = shifted.join(total, F.col(stratum).eqNullSafe(F.col("_of")))
    return both.select(*rows.columns, F.exp("_eta").alias("rate"), (F.col("_w") / F.col("_sum")).alias("probability"))


def centred(rows: DataFrame, stratum: str, is_case: str, covariates: list[str]) -> DataFrame:
    """``(stratum, is_case, covariates)`` less the mean of the stratum's cases, which no likelihood notices.

    Strata without a case or without another row say nothing and leave, as do rows with a null.
    """
    numbers = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(covariates)]
    plain = rows.select(F.col(stratum).alias("stratum"), F.col(is_case).alias("is_case"), *numbers).dropna()
    n = range(len(covariates))
    case = F.when(F.col("is_case"), F.lit(1))
    means = plain.groupBy(F.col("stratum").alias("of")).agg(F.count(F.lit(1)).alias("all"), F.count(case).alias("cases"), *(F.avg(F.when(F.col("is_case"), F.col(f"x{i}"))).alias(f"m{i}") for i in n))
    means = means.where("cases > 0 AND all > 1")
    return plain.join(means, F.col("stratum") == F.col("of")).select("stratum", "is_case", "cases", *((F.col(f"x{i}") - F.col(f"m{i}")).alias(f"x{i}") for i in n))


def likelihood_terms(rows: DataFrame, theta: list[float]) -> DataFrame:
    """One row of the log likelihood ``ll``, gradient ``g0..`` and information ``h0_0..`` of :func:`centred` rows at ``theta``."""
    d = len(theta)
    x = [F.col(f"x{i}") for i in range(d)]
    weighted = rows.withColumn("w", F.exp(_eta([f"x{i}" for i in range(d)], theta)))
    w = F.col("w")
    sums = [F.sum(w * x[i]).alias(f"s{i}") for i in range(d)] + [F.sum(w * x[i] * x[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i + 1)]
    each = weighted.groupBy("stratum").agg(F.first("cases").alias("m"), F.sum("w").alias("w"), *sums)
    m, mean = F.col("m"), [F.col(f"s{i}") / F.col("w") for i in range(d)]
    terms = [F.sum(-m * F.log("w")).alias("ll"), F.count(F.lit(1)).alias("strata"), F.sum("m").alias("cases")]
    terms += [F.sum(-m * mean[i]).alias(f"g{i}") for i in range(d)]
    terms += [F.sum(m * (F.col(f"q{i}_{j}") / F.col("w") - mean[i] * mean[j])).alias(f"h{i}_{j}") for i in range(d) for j in range(i + 1)]
    return each.agg(*terms)


@dataclass
class Fit:
    """Coefficients with their standard errors, and how well they explain the events."""

    covariates: list[str]
    theta: np.ndarray
    errors: np.ndarray
    log_likelihood: float
    null_log_likelihood: float
    strata: int
    steps: int
    gradient: np.ndarray

    @property
    def aic(self) -> float:
        return 2 * len(self.theta) - 2 * self.log_likelihood

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(covariate, coefficient, error, z)``."""
        rows = [(c, float(b), float(e), float(b / e) if e else None) for c, b, e in zip(self.covariates, self.theta, self.errors, strict=True)]
        return spark.createDataFrame(rows, "covariate string, coefficient double, error double, z double")


def _read(terms: DataFrame, d: int):
    r = terms.first().asDict()
    if r["ll"] is None:
        raise ValueError("no stratum has a case and another row")
    gradient = np.array([r[f"g{i}"] for i in range(d)])
    information = np.array([[r[f"h{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)])
    return r["ll"], gradient, information, r["strata"]


def climbed(terms, theta: np.ndarray, rounds: int, tolerance: float):
    """Newton steps up ``terms(theta) -> (value, gradient, information, ..)``, halved while the value falls.

    Returns the point, the terms there and the number of steps.  A direction without any
    information keeps its coefficient.
    """
    now = terms(theta)
    for step in range(1, rounds + 1):
        move = np.linalg.pinv(now[2], hermitian=True) @ now[1]
        if not np.isfinite(move).all():
            raise ValueError("a covariate separates the cases: no finite estimate")
        for _ in range(30):
            new = terms(theta + move)
            if np.isfinite(new[0]) and new[0] >= now[0] - 1e-12 * abs(now[0]):
                break
            move = move / 2
        else:
            return theta, now, step
        gained, theta, now = new[0] - now[0], theta + move, new
        if abs(gained) <= tolerance * (abs(now[0]) + 1) and np.abs(move).max() <= tolerance**0.5 * (np.abs(theta).max() + 1):
            return theta, now, step
    raise ValueError(f"not settled after {rounds} steps: a covariate may separate the cases")


def fit_conditional_logit(rows: DataFrame, stratum: str, is_case: str, covariates: list[str], rounds: int = 30, tolerance: float = 1e-12) -> Fit:
    """Maximum of the conditional likelihood by Newton steps, each one aggregate over the rows.

    The centred rows are written once.  Covariates that explain the cases without remainder
    raise an error, as does a table without a usable stratum.
    """
    fixed = written(centred(rows, stratum, is_case, covariates), "riskset")
    d = len(covariates)
    none = np.zeros(d)
    start = _read(likelihood_terms(fixed, list(none)), d)
    theta, (value, gradient, information, strata), steps = climbed(lambda t: _read(likelihood_terms(fixed, list(t)), d), none, rounds, tolerance)
    errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(information, hermitian=True)), 0))
    return Fit(covariates, theta, errors, value, start[0], strata, steps, gradient)


def nested_fits(rows: DataFrame, stratum: str, is_case: str, blocks: list[list[str]]) -> list[Fit]:
    """One fit for each prefix of ``blocks``: what every further block of covariates explains."""
    names: list[str] = []
    fits = []
    for block in blocks:
        names = names + block
        fits.append(fit_conditional_logit(rows, stratum, is_case, names))
    return fits


# -- propensity ------------------------------------------------------------------------------


def logistic_terms(rows: DataFrame, treated: str, covariates: list[str], theta: list[float]) -> DataFrame:
    """One row as :func:`likelihood_terms`, of the plain logistic model with an intercept first."""
    x = [F.lit(1.0)] + [F.col(c).cast("double") for c in covariates]
    d = len(x)
    eta = sum((b * F.lit(float(t)) for b, t in zip(x, theta, strict=True)), F.lit(0.0))
    scored = rows.where(F.col(treated).isNotNull()).withColumn("_eta", eta).where("_eta IS NOT NULL")
    y = F.col(treated).cast("int")
    p = 1 / (1 + F.exp(-F.col("_eta")))
    # ln(1 + exp(eta)) without overflow
    soft = F.greatest(F.col("_eta"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_eta")))
    terms = [F.sum(y * F.col("_eta") - soft).alias("ll"), F.count(F.lit(1)).alias("strata")]
    terms += [F.sum((y - p) * x[i]).alias(f"g{i}") for i in range(d)]
    terms += [F.sum(p * (1 - p) * x[i] * x[j]).alias(f"h{i}_{j}") for i in range(d) for j in range(i + 1)]
    return scored.agg(*terms)


def fit_propensity(rows: DataFrame, treated: str, covariates: list[str], rounds: int = 30, tolerance: float = 1e-12) -> np.ndarray:
    """Intercept and coefficients of the chance to be treated; every step is one aggregate without a shuffle of rows."""
    d = len(covariates) + 1
    theta, _, _ = climbed(lambda t: _read(logistic_terms(rows, treated, covariates, list(t)), d), np.zeros(d), rounds, tolerance)
    return theta


def propensity(covariates: list[str], theta) -> Column:
    """The chance to be treated."""
    eta = sum((F.col(c).cast("double") * F.lit(float(b)) for c, b in zip(covariates, theta[1:], strict=True)), F.lit(float(theta[0])))
    return 1 / (1 + F.exp(-eta))
