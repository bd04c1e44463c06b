"""Segments and predicted value by household demographics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import mean, round_half_even
from ..schema import INCOME_MIDPOINT, RFM_ORDER

DETAILS = [
    "income_desc", "age_desc", "marital_status_code", "hh_comp_desc", "homeowner_desc",
    "household_size_desc",
]


def with_demographics(customers: DataFrame, households: DataFrame) -> DataFrame:
    """Customers with whichever demographic columns the source has."""
    kept = [c for c in DETAILS if c in households.columns]
    return customers.join(households.select("household_key", *kept), "household_key", "left")


def segment_counts(customers: DataFrame, households: DataFrame, detail: str) -> DataFrame:
    """Households per segment and demographic label; households without one drop out."""
    labelled = households.select("household_key", detail).dropna(subset=[detail])
    return (
        customers.select("household_key", "rfm_segment").join(labelled, "household_key")
        .groupBy("rfm_segment", detail).agg(F.count(F.lit(1)).alias("n_households"))
        .orderBy("rfm_segment", detail)
    )


def clv_by_income(customers: DataFrame, households: DataFrame) -> DataFrame:
    """Mean predicted value and spend per income bracket."""
    labelled = households.select("household_key", "income_desc").dropna(subset=["income_desc"])
    return (
        customers.join(labelled, "household_key").groupBy("income_desc")
        .agg(
            round_half_even(mean(F.col("predicted_clv")), 2).alias("avg_clv"),
            round_half_even(mean(F.col("total_spend")), 2).alias("avg_spend"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy("income_desc")
    )


def label_order(label, labels: list[str]):
    return F.array_position(F.array(*[F.lit(x) for x in labels]), label)


def income_segment_pct(counts: DataFrame) -> DataFrame:
    """Segment shares within each income bracket, in bracket order (W7, R-4, T9)."""
    known = counts.filter(F.col("income_desc").isin(list(INCOME_MIDPOINT)))
    wide = known.groupBy("income_desc").pivot("rfm_segment", RFM_ORDER).agg(F.sum("n_households"))
    wide = wide.fillna(0, RFM_ORDER)
    total = sum((F.col(f"`{s}`") for s in RFM_ORDER[1:]), F.col(RFM_ORDER[0]))
    return wide.orderBy(label_order(F.col("income_desc"), list(INCOME_MIDPOINT))).select(
        "income_desc",
        *[
            round_half_even(F.col(f"`{s}`") / total * 100, 1)
            .alias(s.lower().replace(" ", "_"))
            for s in RFM_ORDER
        ],
    )
