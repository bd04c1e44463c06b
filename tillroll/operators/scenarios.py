"""Mailing scenarios, re-engagement economics, headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import ratio_or, round_half_even
from ..params import Params


def segment_sizes(customers: DataFrame, params: Params) -> DataFrame:
    """One row: households overall, per targeted segment group, and above the value gate."""
    segment = F.col("rfm_segment")
    gate = 2 * params.mailer_cost["TypeA"]
    return customers.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(segment.isin("Champions", "Loyal")).alias("n_keep"),
        F.count_if(segment == "At Risk").alias("n_risk"),
        F.count_if(F.col("predicted_clv") > gate).alias("n_gated"),
    )


def uplift_per_household(roi: DataFrame):
    """Struct of the rounded weekly uplift times the rounded duration, 0 for a type never sent."""
    gain = F.col("avg_uplift_weekly") * F.col("avg_duration_weeks")
    return roi.agg(
        F.struct(*[
            F.coalesce(F.max(F.when(F.col("campaign_type") == t, gain)), F.lit(0.0)).alias(t)
            for t in ("TypeA", "TypeB")
        ]).alias("gain")
    ).scalar()


def financial_scenarios(customers: DataFrame, roi: DataFrame, params: Params) -> DataFrame:
    """Blanket, segment-targeted and value-gated mailing side by side."""
    gain = uplift_per_household(roi)
    cost_a, cost_b = (F.lit(params.mailer_cost[t]) for t in ("TypeA", "TypeB"))
    sized = segment_sizes(customers, params).withColumns(
        {"gain_a": gain.getField("TypeA"), "gain_b": gain.getField("TypeB")}
    )
    total, keep, risk, gated = (F.col(c) for c in ("n_total", "n_keep", "n_risk", "n_gated"))
    gain_a, gain_b = F.col("gain_a"), F.col("gain_b")
    blanket = total * cost_a
    rows = [
        ("Blanket TypeA", total, blanket, gain_a * total),
        ("Targeted (RFM)", keep + risk, risk * cost_a + keep * cost_b,
         gain_a * risk + gain_b * keep),
        ("CLV-Gated", gated, gated * cost_a, gain_a * gated),
    ]
    scenario = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("scenario"), n.alias("n_households"), cost.alias("cost"),
            gained.alias("gained"), (blanket - cost).alias("saved"),
        )
        for name, n, cost, gained in rows
    ]))
    flat = sized.select(scenario.alias("s")).select("s.*")
    return flat.select(
        "scenario",
        "n_households",
        F.rint("cost").cast("bigint").alias("mailer_cost"),
        F.rint("gained").cast("bigint").alias("incremental_revenue"),
        round_half_even(ratio_or(F.col("gained"), F.col("cost"), 0.0), 2).alias("revenue_roi"),
        F.rint("saved").cast("bigint").alias("cost_saving"),
    )


def uplift_retained(customers: DataFrame, roi: DataFrame, params: Params) -> DataFrame:
    """Percent of the blanket uplift and of its cost that targeting keeps (G3); 0 unless positive."""
    gain = uplift_per_household(roi)
    sized = segment_sizes(customers, params).withColumns(
        {"gain_a": gain.getField("TypeA"), "gain_b": gain.getField("TypeB")}
    )
    cost_a, cost_b = params.mailer_cost["TypeA"], params.mailer_cost["TypeB"]
    blanket = F.col("gain_a") * F.col("n_total")
    targeted = F.col("gain_a") * F.col("n_risk") + F.col("gain_b") * F.col("n_keep")
    blanket_cost = F.col("n_total") * F.lit(cost_a)
    targeted_cost = F.col("n_risk") * F.lit(cost_a) + F.col("n_keep") * F.lit(cost_b)
    return sized.select(
        (ratio_or(targeted, blanket, 0.0) * 100).alias("rev_retained_pct"),
        (blanket_cost - targeted_cost).alias("cost_saving"),
        (ratio_or(blanket_cost - targeted_cost, blanket_cost, 0.0) * 100).alias("cost_saving_pct"),
    )


def risk_summary(churn: DataFrame, params: Params) -> DataFrame:
    """High-risk households and the value at stake."""
    risky = F.col("churn_probability") >= params.high_risk
    return churn.agg(
        F.count(F.lit(1)).alias("n_households"),
        F.count_if(risky).alias("n_high_risk"),
        F.coalesce(F.sum(F.when(risky, F.col("predicted_clv"))), F.lit(0)).cast("double")
        .alias("revenue_at_risk"),
    ).withColumn(
        "risk_per_household", ratio_or(F.col("revenue_at_risk"), F.col("n_high_risk"), 0.0)
    )


def reengagement_economics(
    churn: DataFrame, params: Params, mailer_cost: float = 1.50, conversion_rate: float = 0.05
) -> DataFrame:
    """What winning back a share of the high-risk households earns against mailing them all."""
    return (
        risk_summary(churn, params)
        .withColumn("saved_revenue", F.col("revenue_at_risk") * F.lit(conversion_rate))
        .withColumn("total_cost", F.col("n_high_risk") * F.lit(mailer_cost))
        .withColumn("roi", ratio_or(F.col("saved_revenue"), F.col("total_cost"), 0.0))
        .select("n_high_risk", "revenue_at_risk", "saved_revenue", "total_cost", "roi")
    )


def high_risk_customers(churn: DataFrame, params: Params, n: int = 20) -> DataFrame:
    """The high-risk households with the most value at stake."""
    return (
        churn.filter(F.col("churn_probability") >= params.high_risk)
        .orderBy(F.col("predicted_clv").desc(), "household_key").limit(n)
        .select("household_key", "churn_probability",
                F.col("predicted_clv").cast("double").alias("predicted_clv"), "rfm_segment")
    )


def kpi_summary(
    customers: DataFrame, roi: DataFrame, scenarios: DataFrame, params: Params
) -> DataFrame:
    """One row of headline figures."""
    risky = F.col("churn_probability") >= params.high_risk
    best = roi.agg(
        F.min_by(
            F.struct("campaign_type", "revenue_roi", "n_households"),
            F.struct(-F.col("revenue_roi"), "campaign_type"),
        ).alias("best")
    ).scalar()

    def pick(name: str, column: str):
        return F.max(F.when(F.col("scenario") == name, F.col(column)))

    compared = scenarios.agg(
        F.struct(
            pick("Blanket TypeA", "revenue_roi").alias("blanket_roi"),
            pick("Targeted (RFM)", "revenue_roi").alias("targeted_roi"),
            pick("Blanket TypeA", "mailer_cost").alias("blanket_cost"),
            pick("Targeted (RFM)", "mailer_cost").alias("targeted_cost"),
        ).alias("compared")
    ).scalar()
    n = F.count(F.lit(1))
    row = customers.agg(
        n.alias("n_households"),
        (F.sum("predicted_clv").cast("double") / n).alias("mean_clv"),
        F.coalesce(F.sum(F.when(risky, F.col("predicted_clv"))), F.lit(0)).cast("double")
        .alias("revenue_at_risk"),
        F.count_if(risky).alias("n_high_risk"),
        (F.sum("is_churned") / n * 100).alias("churn_rate_pct"),
        (F.count_if(F.col("rfm_segment") == "Champions") / n * 100).alias("champion_pct"),
        (F.count_if(F.col("rfm_segment") == "Lost") / n * 100).alias("lost_pct"),
    ).withColumns({"best": best, "c": compared})
    saving = F.col("c.blanket_cost") - F.col("c.targeted_cost")
    return row.select(
        "n_households", "mean_clv", "revenue_at_risk", "n_high_risk", "churn_rate_pct",
        "champion_pct", "lost_pct",
        F.col("best.campaign_type").alias("best_campaign"),
        F.col("best.revenue_roi").alias("best_revenue_roi"),
        F.col("best.n_households").alias("best_n_households"),
        ratio_or(F.col("c.targeted_roi"), F.col("c.blanket_roi"), 0.0).alias("roi_improvement"),
        saving.alias("cost_saving"),
        (ratio_or(saving, F.col("c.blanket_cost"), 0.0) * 100).alias("saving_pct"),
    )
