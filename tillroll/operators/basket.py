"""The basket fact and the roll-ups every later step starts from.

Raw lines are reduced before they meet another table. A roll-up keyed by household and day (or month,
or product) has a bounded number of rows per household, so a household that owns a large share of the
lines is an ordinary key from there on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..params import Params
from ..schema import MONEY
from .skew import join_dimension


def day_to_date(day: Column, params: Params) -> Column:
    return F.date_add(F.lit(params.ref_date).cast("date"), day - 1)


def day_to_month(day: Column, params: Params) -> Column:
    return F.date_format(day_to_date(day, params), "yyyy-MM")


def day_to_week(day: Column) -> Column:
    return (F.floor((day - 1) / 7) + 1).cast("int")


def _total(money: str) -> Column:
    return F.expr(f"CAST(coalesce(sum({money}), 0) AS {MONEY.simpleString()})")


def basket_fact(transactions: DataFrame, params: Params) -> DataFrame:
    """One row per household, basket and day; discounts ride along to save a second pass.

    Lines without a household, basket or day belong to no basket; a missing value counts as 0.
    """
    keys = ["household_key", "basket_id", "day", "week_no"]
    return (
        transactions.dropna(subset=keys).groupBy(*keys)
        .agg(
            _total("sales_value").alias("spend"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("n_items"),
            _total("retail_disc").alias("retail_disc"),
            _total("abs(retail_disc)").alias("retail_disc_abs"),
        )
        .withColumn("date", day_to_date(F.col("day"), params))
    )


def household_days(basket: DataFrame) -> DataFrame:
    """Spend and baskets per household and day: at most one row per calendar day and household."""
    return basket.groupBy("household_key", "day").agg(
        F.sum("spend").cast(MONEY).alias("spend"), F.count(F.lit(1)).alias("n_baskets")
    )


def labelled_lines(transactions: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Household, basket, spend, department and brand of each line; unmatched products keep NULL
    labels in a left join (J1, J2, J12)."""
    lines = transactions.select("household_key", "basket_id", "product_id", "sales_value")
    labels = products.select("product_id", "department", "brand")
    return join_dimension(lines, labels, "product_id", ["household_key", "basket_id"], how)


def household_departments(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Spend per household, department and brand: lines are labelled first and combine at once."""
    return (
        labelled_lines(transactions, products)
        .groupBy("household_key", "department", "brand")
        .agg(_total("sales_value").alias("sales_value"))
    )


def load_summary(basket: DataFrame, params: Params) -> DataFrame:
    """Totals printed after the load: baskets, households, date range, revenue, year split."""
    per_household = basket.groupBy("household_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("spend").alias("spend"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_if(F.col("day") <= params.cal_end_day).alias("y1"),
    )
    return per_household.agg(
        F.sum("n").alias("n_baskets"),
        F.count(F.lit(1)).alias("n_households"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.sum("spend").cast("double").alias("total_revenue"),
        (F.sum("spend").cast("double") / F.sum("n")).alias("avg_basket"),
        F.sum("y1").alias("n_baskets_y1"),
        (F.sum("n") - F.sum("y1")).alias("n_baskets_y2"),
    )
