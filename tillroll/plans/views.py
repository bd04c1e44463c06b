"""The five summary views over the raw tables, usable from SQL once registered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.basket import labelled_lines
from ..params import Params
from ..schema import MONEY, RetailTables
from ..session import split_hot_partitions


def to_cents(amount: Column) -> Column:
    """Half-up rounding in decimal; a mean is divided at high scale first, so no tie is missed."""
    return F.round(amount, 2).cast("double")


def customer_summary(tables: RetailTables, params: Params) -> DataFrame:
    """Baskets, spend, first and last day per household; means are per basket and day (A1)."""
    visits = tables.transactions.groupBy("household_key", "basket_id", "day").agg(
        F.sum("sales_value").cast(MONEY).alias("spend")
    )
    last = F.col("last_day")
    return (
        visits.groupBy("household_key")
        .agg(
            F.count_distinct("basket_id").alias("n_baskets"),
            to_cents(F.sum("spend")).alias("total_spend"),
            to_cents(F.try_divide(F.sum("spend"), F.count("spend"))).alias("avg_basket"),
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
        )
        .withColumns({
            "tenure_days": last - F.col("first_day"), "recency_days": params.max_day - last,
        })
    )


def campaign_summary(tables: RetailTables, params: Params) -> DataFrame:
    """Reach and number of campaigns per mailer type (A2)."""
    return tables.campaign_assignments.groupBy("description").agg(
        F.count_distinct("household_key").alias("n_households"),
        F.count_distinct("campaign").alias("n_campaigns"),
    )


def weekly_spend(tables: RetailTables, params: Params) -> DataFrame:
    """Spend and baskets per household and week (A3)."""
    return tables.transactions.groupBy("household_key", "week_no").agg(
        to_cents(F.sum("sales_value")).alias("weekly_spend"),
        F.count_distinct("basket_id").alias("n_baskets"),
    )


def category_spend(tables: RetailTables, params: Params) -> DataFrame:
    """Baskets, households, spend and spend per line of each department.

    Lines shrink to baskets as soon as they are labelled. Baskets and households are each counted
    once from there, so no distinct count multiplies the rows.
    """
    sold = labelled_lines(tables.transactions, tables.products, "inner")
    per_basket = sold.groupBy("department", "household_key", "basket_id").agg(
        F.sum("sales_value").cast(MONEY).alias("spend"), F.count("sales_value").alias("lines")
    )
    baskets = per_basket.groupBy("department", "basket_id").agg(F.lit(1).alias("one")).groupBy(
        F.col("department").alias("of")
    ).agg(F.count("basket_id").alias("n_baskets"))
    per_household = per_basket.groupBy("department", "household_key").agg(
        F.sum("spend").cast(MONEY).alias("spend"), F.sum("lines").alias("lines")
    )
    totals = per_household.groupBy("department").agg(
        to_cents(F.sum("spend")).alias("total_spend"),
        to_cents(F.try_divide(F.sum("spend"), F.sum("lines"))).alias("avg_item_spend"),
        F.count("household_key").alias("n_households"),
    )
    return totals.join(baskets, F.col("department").eqNullSafe(F.col("of"))).select(
        "department", "n_baskets", "total_spend", "avg_item_spend", "n_households"
    )


def buyer_segments(tables: RetailTables, params: Params) -> DataFrame:
    """Households by whether any campaign was ever sent to them."""
    sent = tables.campaign_assignments.select("household_key").distinct().withColumn(
        "buyer_type", F.lit("Campaign")
    )
    return customer_summary(tables, params).join(sent, "household_key", "left").select(
        "household_key", "total_spend", "n_baskets",
        F.coalesce("buyer_type", F.lit("Organic")).alias("buyer_type"),
    )


VIEWS = {
    view.__name__: view
    for view in (customer_summary, campaign_summary, weekly_spend, category_spend, buyer_segments)
}


def register_views(spark: SparkSession, tables: RetailTables, params: Params) -> None:
    """Create or replace a temporary view per raw table and per summary."""
    split_hot_partitions(spark)
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables, params).createOrReplaceTempView(name)
