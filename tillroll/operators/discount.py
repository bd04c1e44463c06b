"""Sensitivity to first-year discount depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import mean, round_half_even
from ..schema import DISCOUNT_BUCKETS, RFM_ORDER
from .demographics import label_order

BUCKET_LABELS = [label for _, label in DISCOUNT_BUCKETS]


def discount_ratio(customers: DataFrame) -> Column:
    """Discount over revenue: 0/0 counts as 0, x/0 as no ratio at all."""
    disc, revenue = F.col("y1_disc_abs"), F.col("y1_spend")
    return F.when(revenue != 0, disc.cast("double") / revenue.cast("double")).when(disc == 0, 0.0)


def discount_bucket(
    ratio: Column, buckets: list[tuple[float, str]] = DISCOUNT_BUCKETS
) -> Column:
    """Right-closed bins, the first one including 0; outside values get no bucket."""
    bucket = F.when(ratio < 0, F.lit(None).cast("string"))
    for upper, label in buckets:
        bucket = bucket.when(ratio <= upper, label)
    return bucket


def discount_sensitivity(
    customers: DataFrame, buckets: list[tuple[float, str]] = DISCOUNT_BUCKETS
) -> DataFrame:
    """Spend and value per segment and discount bucket, over households that bought in year 1."""
    bought = customers.filter(F.col("y1_n_baskets") > 0)
    bucketed = bought.withColumn("disc_ratio", discount_ratio(bought)).withColumn(
        "disc_bucket", discount_bucket(F.col("disc_ratio"), buckets)
    )
    return (
        bucketed.dropna(subset=["disc_bucket", "rfm_segment"])
        .groupBy("rfm_segment", "disc_bucket")
        .agg(
            F.count(F.lit(1)).alias("n_customers"),
            round_half_even(mean(F.col("total_spend")), 2).alias("avg_2yr_spend"),
            round_half_even(mean(F.col("predicted_clv")), 2).alias("avg_clv"),
            round_half_even(mean(F.col("disc_ratio")), 2).alias("avg_disc_ratio"),
        )
        .orderBy("rfm_segment", label_order(F.col("disc_bucket"), [b for _, b in buckets]))
    )


def discount_pivot(sensitivity: DataFrame) -> DataFrame:
    """Households per segment and bucket, 0 where a pair is absent (R-4)."""
    wide = sensitivity.groupBy("rfm_segment").pivot("disc_bucket", BUCKET_LABELS).agg(
        F.first("n_customers")
    )
    names = ["under_5", "from_5_to_10", "from_10_to_15", "from_15_to_20", "over_20"]
    return (
        wide.toDF("rfm_segment", *names).fillna(0, names)
        .orderBy(label_order(F.col("rfm_segment"), RFM_ORDER))
    )
