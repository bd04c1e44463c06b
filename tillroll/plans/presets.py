"""Stored queries over the saved result tables, and free-form SQL.

A stored query reads tables by name from the session, so it works on saved tables and on temporary
views alike. Ties are broken by key, which makes every limited result repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _rounded(source: str, digits: int, name: str | None = None) -> Column:
    return F.round(F.col(source), digits).alias(name or source)


def _average(source: str, digits: int, name: str) -> Column:
    return F.round(F.avg(source), digits).alias(name)


def top_customers(spark: SparkSession, n: int = 20) -> DataFrame:
    """Highest predicted values beside what was spent."""
    predicted = spark.table("clv_predictions").select(
        "household_key", "predicted_clv", "actual_y2_spend"
    )
    known = spark.table("rfm_segments").select("household_key", "rfm_segment", "total_spend")
    error = F.round(F.col("predicted_clv") - F.col("actual_y2_spend"), 2)
    return (
        known.join(predicted, "household_key").withColumn("prediction_error", error)
        .orderBy(F.desc("predicted_clv"), "household_key").limit(n)
    )


def campaign_roi(spark: SparkSession) -> DataFrame:
    return spark.table("campaign_roi").orderBy(F.desc("revenue_roi"), "campaign_type").select(
        "campaign_type", "n_households",
        _rounded("avg_pre_weekly_spend", 2, "pre_weekly_spend"),
        _rounded("avg_during_weekly_spend", 2, "during_weekly_spend"),
        _rounded("avg_uplift_weekly", 2, "uplift_per_week"),
        _rounded("total_incremental_rev", 0, "total_uplift"),
        _rounded("revenue_roi", 2), _rounded("net_roi", 2, "net_roi_margin_adj"),
        "p_value", "significant",
    )


def high_risk(spark: SparkSession, threshold: float = 0.70, n: int = 30) -> DataFrame:
    """Likely leavers with the most predicted value."""
    scores = spark.table("churn_scores").filter(F.col("churn_probability") >= threshold)
    history = spark.table("rfm_segments").select(
        "household_key", "total_spend", "n_baskets", "recency_days"
    )
    return (
        scores.select("household_key", "churn_probability", "predicted_clv", "rfm_segment")
        .join(history, "household_key")
        .orderBy(F.desc("predicted_clv"), "household_key").limit(n)
    )


def rfm_summary(spark: SparkSession) -> DataFrame:
    """Size, means and churn per segment, best spenders first."""
    leaving = F.round(F.avg("is_churned") * 100, 1).alias("churn_rate_pct")
    return spark.table("rfm_segments").groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        _average("total_spend", 2, "avg_2yr_spend"), _average("n_baskets", 1, "avg_baskets"),
        _average("recency_days", 0, "avg_recency_days"),
        _average("predicted_clv", 2, "avg_predicted_clv"), leaving,
    ).orderBy(F.desc("avg_2yr_spend"))


def cohorts(spark: SparkSession) -> DataFrame:
    leaving = F.round(F.col("churn_rate") * 100, 1).alias("churn_rate_pct")
    return spark.table("cohort_results").orderBy("first_quarter").select(
        "first_quarter", "n_customers", _rounded("avg_spend", 2, "avg_2yr_spend"),
        _rounded("avg_baskets", 1), _rounded("avg_clv", 2, "avg_predicted_clv"), leaving,
    )


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.table("financial_scenarios").orderBy(F.desc("revenue_roi"), "scenario").select(
        "scenario", "n_households", "mailer_cost", "incremental_revenue", "revenue_roi",
        "cost_saving",
    )


def top_categories(spark: SparkSession, n: int = 10) -> DataFrame:
    ranked = spark.table("category_spend").orderBy(F.desc("total_spend"), "department").limit(n)
    return ranked.select(
        "department", "n_households", "total_spend", _rounded("avg_item_spend", 2), "n_baskets"
    )


def buyer_comparison(spark: SparkSession) -> DataFrame:
    """Households reached by campaigns against the others."""
    return spark.table("buyer_segments").groupBy("buyer_type").agg(
        F.count(F.lit(1)).alias("n_households"),
        _average("total_spend", 2, "avg_spend"), _average("n_baskets", 1, "avg_baskets"),
    )


PRESETS = {
    preset.__name__: preset
    for preset in (
        top_customers, campaign_roi, high_risk, rfm_summary, cohorts, scenarios, top_categories,
        buyer_comparison,
    )
}


# Examples of free-form text over the saved tables.
SEGMENT_REACH = """
SELECT s.rfm_segment, b.buyer_type, count(*) AS households,
       CAST(sum(CAST(s.total_spend AS DECIMAL(18, 4))) AS DOUBLE) AS spend,
       max(s.n_baskets) AS most_baskets
FROM rfm_segments s JOIN buyer_segments b USING (household_key)
GROUP BY s.rfm_segment, b.buyer_type
HAVING count(*) > 0
ORDER BY s.rfm_segment, b.buyer_type;
"""
SPEND_BANDS = """
WITH banded AS (
    SELECT rfm_segment, recency_days,
           CASE WHEN rfm_score >= 12 THEN 'high' WHEN rfm_score >= 7 THEN 'middle' ELSE 'low' END AS band
    FROM rfm_segments
)
SELECT band, rfm_segment, count(*) AS households, min(recency_days) AS freshest,
       row_number() OVER (PARTITION BY band ORDER BY count(*) DESC, rfm_segment) AS place
FROM banded GROUP BY band, rfm_segment
ORDER BY band, place
"""
CAMPAIGN_MARGIN = """
SELECT campaign_type, gross_profit - total_mailer_cost AS margin, total_mailer_cost,
       (SELECT count(*) FROM category_spend) AS departments
FROM campaign_roi
WHERE revenue_roi IS NOT NULL
ORDER BY margin DESC, campaign_type
"""


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Free-form SQL over whatever tables and views the session knows."""
    return spark.sql(sql.strip().rstrip(";"))


def export_csv(result: DataFrame, path: str) -> None:
    """Write a query result as CSV part files with a header."""
    result.write.mode("overwrite").option("header", True).csv(path)
