"""Brand and department mix.

The input is the household-department roll-up, in which a household has one row per department and
brand; the fact table is not read again. It meets the segments by household first, so what is counted
per household needs no further exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import round_half_even
from ..schema import RFM_ORDER


def brand_by_segment(by_department: DataFrame, customers: DataFrame) -> DataFrame:
    """Spend per segment and brand with its share of the segment; NULL brands drop out."""
    spend = (
        by_department.filter(F.col("brand").isNotNull())
        .join(customers.select("household_key", "rfm_segment"), "household_key")
        .groupBy("rfm_segment", "brand").agg(F.sum("sales_value").alias("spend"))
    )
    total = F.sum("spend").over(Window.partitionBy("rfm_segment"))
    return (
        spend.withColumn("seg_total", total.cast("double"))
        .select(
            "rfm_segment",
            "brand",
            F.col("spend").cast("double").alias("sales_value"),
            "seg_total",
            round_half_even(F.col("spend").cast("double") / F.col("seg_total") * 100, 2)
            .alias("pct"),
        )
        .orderBy("rfm_segment", "brand")
    )


def category_by_segment(by_department: DataFrame, customers: DataFrame) -> DataFrame:
    """Spend, households and spend per household by segment and department.

    With one row per household and department, counting rows counts households.
    """
    return (
        by_department.filter(F.col("department").isNotNull())
        .join(customers.select("household_key", "rfm_segment"), "household_key")
        .groupBy("household_key", "rfm_segment", "department")
        .agg(F.sum("sales_value").alias("spend"))
        .groupBy("rfm_segment", "department")
        .agg(F.sum("spend").cast("double").alias("total_spend"),
             F.count(F.lit(1)).alias("n_households"))
        .withColumn(
            "avg_spend_per_hh", round_half_even(F.col("total_spend") / F.col("n_households"), 2)
        )
        .orderBy(F.col("total_spend").desc(), "rfm_segment", "department")
    )


def category_pivot(by_segment: DataFrame, top: int = 10) -> DataFrame:
    """Spend per household, top departments by segment, 0 where a pair is absent (A37, P24, R-4)."""
    wide = by_segment.groupBy("department").pivot("rfm_segment", RFM_ORDER).agg(
        F.first("avg_spend_per_hh")
    )
    totals = by_segment.groupBy("department").agg(F.sum("total_spend").alias("all_spend"))
    leaders = totals.orderBy(F.col("all_spend").desc(), "department").limit(top)
    return (
        wide.join(leaders, "department").fillna(0.0, RFM_ORDER)
        .orderBy(F.col("all_spend").desc(), "department")
        .select("department", *[
            F.col(f"`{s}`").alias(s.lower().replace(" ", "_")) for s in RFM_ORDER
        ])
    )


def department_revenue(by_department: DataFrame, top: int = 10) -> DataFrame:
    """Departments with the most revenue."""
    return (
        by_department.filter(F.col("department").isNotNull()).groupBy("department")
        .agg(F.sum("sales_value").cast("double").alias("sales_value"))
        .orderBy(F.col("sales_value").desc(), "department").limit(top)
    )


def brand_revenue(by_department: DataFrame) -> DataFrame:
    """Revenue per brand, largest first."""
    return (
        by_department.filter(F.col("brand").isNotNull()).groupBy("brand")
        .agg(F.sum("sales_value").cast("double").alias("sales_value"))
        .orderBy(F.col("sales_value").desc(), "brand")
    )
