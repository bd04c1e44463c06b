"""Weekly and monthly trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_half_even
from ..params import Params
from .basket import day_to_month


def weekly_trend(basket: DataFrame) -> DataFrame:
    """Spend, baskets, active households and mean basket per week, to the cent.

    Aggregating per household and week first leaves a plain count for the active households.
    """
    per_household = basket.groupBy("week_no", "household_key").agg(
        F.sum("spend").alias("spend"), F.count(F.lit(1)).alias("n")
    )
    return (
        per_household.groupBy("week_no")
        .agg(
            F.sum("spend").cast("double").alias("spend"),
            F.sum("n").alias("n_baskets"),
            F.count(F.lit(1)).alias("n_households"),
        )
        .select(
            "week_no",
            round_half_even(F.col("spend"), 2).alias("total_spend"),
            "n_baskets",
            "n_households",
            round_half_even(F.col("spend") / F.col("n_baskets"), 2).alias("avg_basket"),
        )
        .orderBy("week_no")
    )


def peak_week(weekly: DataFrame) -> DataFrame:
    """Week with the highest spend, the earliest on a tie."""
    return weekly.agg(
        F.min_by("week_no", F.struct(-F.col("total_spend"), "week_no")).alias("peak_week"),
        F.max("total_spend").alias("peak_spend"),
    )


def monthly_segment_spend(
    transactions: DataFrame, customers: DataFrame, params: Params
) -> DataFrame:
    """Spend per calendar month and segment (A22, J8); lines combine to household-months, which then
    meet the segments."""
    lines = transactions.dropna(subset=["household_key", "basket_id", "day", "week_no"])
    months = lines.groupBy(
        "household_key", day_to_month(F.col("day"), params).alias("cal_month")
    ).agg(F.sum("sales_value").alias("spend"))
    return (
        months.join(customers.select("household_key", "rfm_segment"), "household_key")
        .groupBy("cal_month", "rfm_segment")
        .agg(round_half_even(F.sum("spend").cast("double"), 2).alias("total_spend"))
        .orderBy("cal_month", "rfm_segment")
    )
