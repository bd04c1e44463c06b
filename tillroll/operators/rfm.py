"""Recency / frequency / monetary scores, segments and their profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import mean, round_half_even
from ..schema import RFM_ORDER
from .ranking import add_quintiles


def segment_sql(cuts: tuple[int, int, int] = (13, 10, 7)) -> str:
    """SQL for the segment of a summed score."""
    cases = " ".join(f"WHEN rfm_score >= {cut} THEN '{s}'" for cut, s in zip(cuts, RFM_ORDER))
    return f"CASE {cases} ELSE '{RFM_ORDER[-1]}' END"


def segment_order(segment: Column) -> Column:
    """Display position of a segment; names outside the list sort last."""
    return F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(s) for s in RFM_ORDER]), segment), F.lit(0)),
        F.lit(len(RFM_ORDER) + 1),
    )


def add_rfm(customers: DataFrame, cuts: tuple[int, int, int] = (13, 10, 7)) -> DataFrame:
    """Quintile scores with a short absence scoring high, their sum and the segment."""
    scored = add_quintiles(
        customers,
        {"r_rank": "recency_days", "f_score": "n_baskets", "m_score": "total_spend"},
        "household_key",
    )
    return (
        scored.selectExpr("* EXCEPT (r_rank)", "6 - r_rank AS r_score")
        .selectExpr("*", "r_score + f_score + m_score AS rfm_score")
        .selectExpr("*", f"{segment_sql(cuts)} AS rfm_segment")
    )


def rfm_table(customers: DataFrame) -> DataFrame:
    """The per-household result table; model columns appear when they exist."""
    columns = [
        "household_key", "rfm_segment", "rfm_score", "r_score", "f_score", "m_score",
        "recency_days", "n_baskets", "total_spend", "avg_basket", "tenure_days",
        "campaign_engaged", "predicted_clv", "churn_probability", "is_churned",
    ]
    kept = customers.select(*[c for c in columns if c in customers.columns])
    money = [c for c in ("total_spend", "predicted_clv") if c in kept.columns]
    return kept.withColumns({c: F.col(c).cast("double") for c in money})


def rfm_profile(customers: DataFrame) -> DataFrame:
    """Size and means per segment, rounded to cents, in display order."""
    return (
        customers.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[
                round_half_even(mean(F.col(c)), 2).alias(name)
                for name, c in [
                    ("avg_spend", "total_spend"), ("avg_baskets", "n_baskets"),
                    ("avg_basket_size", "avg_basket"), ("avg_recency", "recency_days"),
                    ("avg_rfm", "rfm_score"),
                ]
            ],
        )
        .orderBy(segment_order(F.col("rfm_segment")))
    )


def segment_dashboard(customers: DataFrame) -> DataFrame:
    """The segment table of the report pages, one decimal, with the churn rate."""
    return (
        customers.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            *[
                round_half_even(mean(F.col(c)), 1).alias(name)
                for name, c in [
                    ("avg_spend", "total_spend"), ("avg_baskets", "n_baskets"),
                    ("avg_basket", "avg_basket"), ("recency_days", "recency_days"),
                    ("churn_rate", "is_churned"),
                ]
            ],
        )
        .orderBy(segment_order(F.col("rfm_segment")))
    )


def rfm_share(customers: DataFrame) -> DataFrame:
    """Households per segment and percent of all (A12); the window runs over four rows."""
    counts = customers.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("n"))
    total = customers.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", F.col("n") / total * 100).orderBy(
        segment_order(F.col("rfm_segment"))
    )


def rfm_score_box(customers: DataFrame) -> DataFrame:
    """Five-number summary of the score per segment; the score has 13 values, so
    ``percentile`` holds at most 13 counters a segment (A41)."""
    quartile = F.percentile("rfm_score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        customers.groupBy("rfm_segment")
        .agg(
            F.min("rfm_score").alias("low"), quartile.alias("q"), F.max("rfm_score").alias("high")
        )
        .select(
            "rfm_segment", "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"), "high",
        )
        .orderBy(segment_order(F.col("rfm_segment")))
    )


def segment_stats(customers: DataFrame) -> DataFrame:
    """Count, mean predicted value and churn rate per segment."""
    return (
        customers.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("n"),
            mean(F.col("predicted_clv")).alias("avg_clv"),
            mean(F.col("total_spend")).alias("avg_spend"),
            mean(F.col("is_churned")).alias("churn_rate"),
        )
        .orderBy(segment_order(F.col("rfm_segment")))
    )


def normalised_scores(profile: DataFrame) -> DataFrame:
    """Segment means scaled to 0-5 against the best segment."""
    top = profile.agg(
        F.struct(
            F.max("avg_spend").alias("spend"), F.max("avg_baskets").alias("baskets")
        ).alias("top")
    ).scalar()
    return profile.select(
        "rfm_segment",
        (F.col("avg_spend") / top.getField("spend") * 5).alias("monetary_norm"),
        (F.col("avg_baskets") / top.getField("baskets") * 5).alias("frequency_norm"),
    )
