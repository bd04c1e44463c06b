"""Churn probability: class-balanced, L2-regularised logistic regression by Newton steps.

With ten coefficients the whole problem travels as sums: each step is one aggregation of the training
rows that returns the objective, its gradient and its second derivatives, 67 numbers whatever the
number of rows, and the small system is solved on the driver. The objective is strictly convex, so
every run on every cluster ends at the same coefficients, where the gradient is zero.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import inf

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import hash_mod_sql, ratio_or
from ..operators.ranking import Point, beyond, rank_cuts, rank_sum_auc

# Behavioural features; recency is left out because it decides the label.
CHURN_FEATURES = [
    "n_baskets", "total_spend", "avg_basket", "tenure_days", "campaign_engaged",
    "n_departments", "income_val", "age_val", "weekly_freq",
]


@dataclass(frozen=True)
class ChurnModel:
    intercept: float
    weights: list[float]
    centre: dict[str, float]
    scale: dict[str, float]
    steps: int

    def probability(self, customers: DataFrame) -> DataFrame:
        """Customers with ``churn_probability``."""
        columns = [_scaled(c, self.centre, self.scale) for c in CHURN_FEATURES]
        return customers.withColumn(
            "churn_probability", _probability(_margin(self.intercept, self.weights, columns))
        )


def _feature(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _scaled(name: str, centre: dict, scale: dict) -> Column:
    return (_feature(name) - F.lit(centre[name])) / F.lit(scale[name])


def _margin(intercept: float, weights, columns: list[Column]) -> Column:
    total = F.lit(float(intercept))
    for w, c in zip(weights, columns):
        total = total + F.lit(float(w)) * c
    return total


def _probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def split(customers: DataFrame, seed: int = 42, share: float = 0.2) -> DataFrame:
    """Add ``in_test``: exactly the rounded share of each class, chosen by key hash."""
    order = hash_mod_sql("household_key", 4294967296, seed)

    def size(n: int) -> int:
        return max(1, round(n * share))

    sizes, cuts = rank_cuts(
        customers, {"h": order}, "household_key", [Point(share, size)], "is_churned"
    )
    in_test = " OR ".join(
        f"(is_churned = {g} AND NOT {beyond(order, 'household_key', 'bigint', cuts[g, size(n)])})"
        for g, n in sizes.items()
    )
    return customers.selectExpr("*", f"{in_test or 'false'} AS in_test")


def _sums(rows: DataFrame, point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(objective, gradient, second derivatives) at ``point``, penalty included, from one aggregation."""
    d = len(point)
    names = ["x0", *(f"x{k}" for k in range(1, d))]
    margin = _margin(0.0, point, [F.col(c) for c in names])
    placed = rows.withColumn("m", margin).select(
        "y", "w", *names, "m", _probability(F.col("m")).alias("p")
    ).withColumns({
        "g": F.col("w") * (F.col("p") - F.col("y")),
        "h": F.col("w") * F.col("p") * (1.0 - F.col("p")),
    })
    loss = F.col("w") * (
        F.greatest(F.col("m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
    )
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = placed.agg(
        F.sum(loss), *(F.sum(F.col("g") * F.col(c)) for c in names),
        *(F.sum(F.col("h") * F.col(names[i]) * F.col(names[j])) for i, j in pairs),
    ).first()
    shrunk = np.r_[0.0, point[1:]]
    second = np.zeros((d, d))
    for (i, j), value in zip(pairs, row[1 + d:]):
        second[i, j] = second[j, i] = value
    second[np.arange(1, d), np.arange(1, d)] += 1.0
    return row[0] + shrunk @ shrunk / 2, np.array(row[1:1 + d], dtype=float) + shrunk, second


def fit(split_customers: DataFrame, max_steps: int = 100, tolerance: float = 1e-11) -> ChurnModel:
    """Standardise on the training rows and fit.

    Population spread, class weights n / (2 * class size) and C = 1. A step that does not lower the
    objective is halved. With rows of one class only, that class is certain.
    """
    train = split_customers.filter(~F.col("in_test"))
    stats = train.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_churned").alias("positives"),
        *[F.avg(_feature(c)).alias(f"m_{c}") for c in CHURN_FEATURES],
        *[F.stddev_pop(_feature(c)).alias(f"s_{c}") for c in CHURN_FEATURES],
    ).first()
    n, positives = stats["n"], stats["positives"] or 0
    centre = {c: stats[f"m_{c}"] or 0.0 for c in CHURN_FEATURES}
    scale = {c: stats[f"s_{c}"] or 1.0 for c in CHURN_FEATURES}
    nothing = [0.0] * len(CHURN_FEATURES)
    if positives in (0, n):
        return ChurnModel(inf if positives else -inf, nothing, centre, scale, 0)
    rows = train.select(
        F.col("is_churned").cast("double").alias("y"),
        F.when(F.col("is_churned") == 1, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
        .alias("w"),
        F.lit(1.0).alias("x0"),
        *(_scaled(c, centre, scale).alias(f"x{k}") for k, c in enumerate(CHURN_FEATURES, 1)),
    )
    point = np.zeros(len(CHURN_FEATURES) + 1)
    value, gradient, second = _sums(rows, point)
    for steps in range(1, max_steps + 1):
        step = np.linalg.solve(second, gradient)
        while True:
            further = point - step
            found = _sums(rows, further)
            if found[0] <= value + 1e-9 * abs(value) or np.abs(step).max() <= tolerance:
                break
            step = step / 2
        point, (value, gradient, second) = further, found
        if np.abs(step).max() <= tolerance:
            break
    return ChurnModel(float(point[0]), point[1:].tolist(), centre, scale, steps)


def gradient(model: ChurnModel, split_customers: DataFrame) -> DataFrame:
    """What is left of the objective's gradient at the model's coefficients, one row each."""
    train = split_customers.filter(~F.col("in_test"))
    counts = train.agg(F.count(F.lit(1)), F.sum("is_churned")).first()
    n, positives = counts[0], counts[1] or 0
    columns = [_scaled(c, model.centre, model.scale) for c in CHURN_FEATURES]
    error = (
        _probability(_margin(model.intercept, model.weights, columns)) - F.col("is_churned")
    ) * F.when(F.col("is_churned") == 1, n / (2 * max(positives, 1))).otherwise(
        n / (2 * max(n - positives, 1))
    )
    terms = [("intercept", F.lit(1.0), 0.0), *zip(CHURN_FEATURES, columns, model.weights)]
    sums = train.agg(*(
        (F.coalesce(F.sum(error * c), F.lit(0.0)) + F.lit(w)).alias(name) for name, c, w in terms
    ))
    return sums.unpivot([], [name for name, _, _ in terms], "feature", "gradient")


def coefficients(churn: ChurnModel, session) -> DataFrame:
    """Standardised coefficients by size, with the direction of the effect."""
    frame = session.createDataFrame(
        list(zip(CHURN_FEATURES, churn.weights)), "feature string, coefficient double"
    )
    return frame.withColumn(
        "effect", F.when(F.col("coefficient") > 0, "raises churn").otherwise("lowers churn")
    ).orderBy(F.abs("coefficient").desc(), "feature")


def churn_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "household_key", "churn_probability", "is_churned", "rfm_segment",
        *[c for c in ["predicted_clv"] if c in scored.columns],
    )


def metrics(churn: ChurnModel, split_customers: DataFrame) -> DataFrame:
    """Test AUC and the per-class report at probability 0.5, one row per class."""
    test = churn.probability(split_customers.filter(F.col("in_test")))
    auc = rank_sum_auc(test, "churn_probability", "is_churned")
    label, guess = F.col("is_churned"), (F.col("churn_probability") > 0.5).cast("int")
    counts = test.agg(*[
        F.count_if((label == a) & (guess == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)
    ])
    right = {c: F.col(f"n{c}{c}") for c in (0, 1)}
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("class"),
            ratio_or(right[c], right[c] + F.col(f"n{1 - c}{c}"), 0.0).alias("precision"),
            ratio_or(right[c], right[c] + F.col(f"n{c}{1 - c}"), 0.0).alias("recall"),
            (right[c] + F.col(f"n{c}{1 - c}")).alias("support"),
            ratio_or(
                right[0] + right[1], F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11"), 0.0
            ).alias("accuracy"),
        )
        for c, name in ((0, "Active"), (1, "Churned"))
    ]))
    report = counts.select(rows.alias("r")).select("r.*")
    p, r = F.col("precision"), F.col("recall")
    return report.select(
        "class", "precision", "recall", ratio_or(2 * p * r, p + r, 0.0).alias("f1"), "support",
        "accuracy", F.lit(auc).cast("double").alias("auc"),
    )
