"""Per-household measures and the customer master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import mean
from ..params import Params
from ..schema import AGE_MIDPOINT, INCOME_MIDPOINT, MONEY, RetailTables


def household_spend(basket: DataFrame, params: Params) -> DataFrame:
    """All spend measures in one aggregation; year and half splits are conditional sums.

    Money stays decimal so that totals do not depend on the order rows arrive in (A7, A8, A14-A16).
    Discount totals need the discount columns of the basket.
    """
    y1 = f"day <= {params.cal_end_day}"
    money = MONEY.simpleString()

    def total(column: str, condition: str = "true") -> Column:
        return F.expr(
            f"CAST(coalesce(sum(CASE WHEN {condition} THEN {column} END), 0) AS {money})"
        )

    recent = f"day >= {params.cal_end_day - params.last_window} AND {y1}"
    discounts = [
        F.abs(total("retail_disc", y1)).alias("y1_total_disc"),
        total("retail_disc_abs", y1).alias("y1_disc_abs"),
    ] if "retail_disc" in basket.columns else []
    totals = basket.groupBy("household_key").agg(
        total("spend").alias("total_spend"),
        F.expr("count(*) AS n_baskets"),
        F.expr("min(day) AS first_day"),
        F.expr("max(day) AS last_day"),
        total("spend", y1).alias("y1_spend"),
        total("spend", f"day > {params.cal_end_day}").alias("y2_spend"),
        F.expr(f"count_if({y1}) AS y1_n_baskets"),
        F.expr(f"stddev_samp(CASE WHEN {y1} THEN CAST(spend AS DOUBLE) END) AS y1_std_basket"),
        F.expr(f"min(CASE WHEN {y1} THEN day END) AS y1_first_day"),
        F.expr(f"max(CASE WHEN {y1} THEN day END) AS y1_last_day"),
        total("spend", f"day <= {params.half}").alias("y1_spend_h1"),
        total("spend", f"day > {params.half} AND {y1}").alias("y1_spend_h2"),
        total("spend", recent).alias("y1_last4wk_spend"),
        *discounts,
    )
    return totals.selectExpr(
        "*",
        "CAST(total_spend AS DOUBLE) / n_baskets AS avg_basket",
        "last_day - first_day AS tenure_days",
        f"{params.max_day} - last_day AS recency_days",
        f"n_baskets / (CAST({params.max_day} AS DOUBLE) / 7) AS weekly_freq",
        f"CAST(last_day < {params.churn_cutoff} AS INT) AS is_churned",
    )


def campaign_counts(assignments: DataFrame) -> DataFrame:
    """Campaigns per household."""
    return assignments.groupBy("household_key").agg(F.count("campaign").alias("n_campaigns"))


def department_counts(by_department: DataFrame) -> DataFrame:
    """Distinct departments per household, NULL not counted (A10); a set holds the few departments
    there are, so lines or roll-ups combine before one exchange by household."""
    return by_department.groupBy("household_key").agg(
        F.size(F.collect_set("department")).cast("long").alias("n_departments")
    )


def midpoint(label: str, table: dict[str, float]) -> str:
    """SQL for bracket label to midpoint; unknown labels give NULL."""
    cases = " ".join(f"WHEN '{name}' THEN {middle}D" for name, middle in table.items())
    return f"CASE {label} {cases} END"


def customer_base(
    spend: DataFrame, departments: DataFrame, tables: RetailTables, params: Params
) -> DataFrame:
    """Household measures with campaign, coupon, department and demographic columns.

    Every side is one row per household and hashed on it, so the joins share one partitioning.
    Missing demographics stay NULL here; ``impute_medians`` fills them.
    """
    campaigns = campaign_counts(tables.campaign_assignments)
    redemptions = tables.coupon_redemptions.groupBy("household_key").agg(
        F.count("day").alias("n_redemptions"),
        F.count_if(F.col("day") <= params.cal_end_day).alias("y1_redemptions"),
    )
    demographics = tables.households.selectExpr(
        "household_key",
        f"{midpoint('income_desc', INCOME_MIDPOINT)} AS income_val",
        f"{midpoint('age_desc', AGE_MIDPOINT)} AS age_val",
    )
    joined = (
        spend.join(campaigns, "household_key", "left")
        .join(redemptions, "household_key", "left")
        .join(departments, "household_key", "left")
        .join(demographics, "household_key", "left")
    )
    return joined.fillna(
        0, ["n_campaigns", "n_redemptions", "y1_redemptions", "n_departments"]
    ).withColumn("campaign_engaged", (F.col("n_campaigns") > 0).cast("int"))


def impute_medians(customers: DataFrame) -> DataFrame:
    """Fill income and age with the median over households that have one (P20).

    ``percentile`` keeps a count per distinct value: at most 12 incomes and 6 ages. The two medians
    become literals, so models that read the table again and again do not compute them again.
    """
    columns = ("income_val", "age_val")
    medians = customers.agg(*[F.percentile(c, 0.5).alias(c) for c in columns]).first()
    return customers.withColumns(
        {c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in columns}
    )


def master_summary(customers: DataFrame) -> DataFrame:
    """Totals printed with the master table: means, campaign reach, coupon redeemers."""
    return customers.agg(
        F.count(F.lit(1)).alias("n_households"),
        mean(F.col("total_spend")).alias("avg_spend"),
        mean(F.col("n_baskets")).alias("avg_baskets"),
        F.sum("campaign_engaged").alias("n_engaged"),
        (mean(F.col("campaign_engaged")) * 100).alias("pct_engaged"),
        F.count_if(F.col("n_redemptions") > 0).alias("n_redeemers"),
    )


# The model's 17 first-year features, in order.
CLV_FEATURES = [
    "y1_total_spend", "y1_n_baskets", "y1_avg_basket", "y1_std_basket", "y1_spend_cv",
    "y1_recency", "y1_tenure", "y1_spend_h1", "y1_spend_h2", "y1_spend_trend",
    "y1_last4wk_spend", "y1_disc_ratio", "n_departments", "campaign_engaged",
    "y1_redemptions", "income_val", "age_val",
]


def clv_features(customers: DataFrame, params: Params) -> DataFrame:
    """First-year features and second-year target; all features of a household without any
    first-year basket are 0 (M1)."""
    average = "CAST(y1_spend AS DOUBLE) / nullif(y1_n_baskets, 0)"
    spread = "coalesce(y1_std_basket, 0)"
    ratios = {
        "y1_avg_basket": average,
        "y1_std_basket": spread,
        "y1_spend_cv": f"CASE WHEN {average} > 0 THEN {spread} / ({average}) ELSE 0 END",
        "y1_spend_trend": "CASE WHEN y1_n_baskets = 0 THEN 0 WHEN y1_spend_h1 > 0 "
        "THEN CAST(y1_spend_h2 AS DOUBLE) / CAST(y1_spend_h1 AS DOUBLE) ELSE 1 END",
        "y1_disc_ratio": "CASE WHEN y1_spend > 0 "
        "THEN CAST(y1_total_disc AS DOUBLE) / CAST(y1_spend AS DOUBLE) ELSE 0 END",
    }
    features = {
        "y1_total_spend": "y1_spend",
        "y1_recency": f"{params.cal_end_day} - y1_last_day",
        "y1_tenure": "y1_last_day - y1_first_day",
        **ratios,
    }
    return customers.selectExpr(
        "household_key",
        *[f"coalesce(CAST({features.get(c, c)} AS DOUBLE), 0) AS {c}" for c in CLV_FEATURES],
        "CAST(y2_spend AS DOUBLE) AS y2_spend",
    )
