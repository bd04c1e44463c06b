"""First-purchase cohorts, retention, acquisition."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import mean, round_half_even
from ..params import Params
from .basket import day_to_date, day_to_month


def with_first_month(customers: DataFrame, params: Params, name: str) -> DataFrame:
    return customers.withColumn(name, day_to_month(F.col("first_day"), params))


def cohort_results(customers: DataFrame, params: Params) -> DataFrame:
    """Size and unrounded means per first-purchase month, small cohorts left out."""
    return (
        with_first_month(customers, params, "first_quarter").groupBy("first_quarter")
        .agg(
            F.count(F.lit(1)).alias("n_customers"),
            mean(F.col("total_spend")).alias("avg_spend"),
            mean(F.col("n_baskets")).alias("avg_baskets"),
            mean(F.col("predicted_clv")).alias("avg_clv"),
            mean(F.col("is_churned")).alias("churn_rate"),
            mean(F.col("campaign_engaged")).alias("pct_campaign"),
        )
        .filter(F.col("n_customers") >= params.min_cohort_size)
        .orderBy("first_quarter")
    )


def cohort_extremes(cohorts: DataFrame) -> DataFrame:
    """Cohorts with the highest and lowest mean spend; the earlier month wins a tie."""
    return cohorts.agg(
        F.min_by("first_quarter", F.struct(-F.col("avg_spend"), "first_quarter"))
        .alias("best_cohort"),
        F.max("avg_spend").alias("best_avg_spend"),
        F.min_by("first_quarter", F.struct("avg_spend", "first_quarter")).alias("worst_cohort"),
        F.min("avg_spend").alias("worst_avg_spend"),
    )


def cohort_metrics(cohorts: DataFrame) -> DataFrame:
    """The metric by cohort matrix in long form, so that it holds every cohort (R-5)."""
    metrics = ["avg_spend", "avg_baskets", "avg_clv", "churn_rate"]
    return cohorts.unpivot(["first_quarter"], metrics, "metric", "value")


WORD = 62  # months per word of a month set


def household_months(transactions: DataFrame, params: Params) -> DataFrame:
    """One row per household: the months it bought in as bits, ``words[m DIV 62]`` bit ``m % 62``,
    m counting from the month of day 1 (W3).

    Lines combine to a few words per household before the one exchange. Words reach five years
    past the calendar of the parameters; a day beyond is an error, not a lost row.
    """
    date = day_to_date(F.col("day"), params)
    start = F.lit(params.ref_date).cast("date")
    month = (F.year(date) - F.year(start)) * 12 + F.month(date) - F.month(start)
    words = params.max_day // 28 // WORD + 2
    seen = transactions.dropna(subset=["household_key", "basket_id", "day", "week_no"]).select(
        "household_key", F.when(month.between(0, WORD * words - 1), month).otherwise(
            F.raise_error(F.format_string("day %d is outside the calendar", "day")).cast("int")
        ).alias("m")
    )
    return seen.groupBy("household_key").agg(F.array(*(
        F.expr(f"bit_or(CASE WHEN m DIV {WORD} = {k} THEN shiftleft(1L, m % {WORD}) ELSE 0L END)")
        for k in range(words)
    )).alias("words"))


def cohort_activity(transactions: DataFrame, params: Params) -> DataFrame:
    """Active households per cohort month and months since joining.

    The first month and the months since are read off a household's bits: no window, and the second
    exchange moves counts of at most months x months pairs.
    """
    sets = household_months(transactions, params)
    last = WORD * (params.max_day // 28 // WORD + 2) - 1
    held = F.filter(
        F.sequence(F.lit(0), F.lit(last)),
        lambda m: F.getbit(F.get("words", F.floor(m / WORD).cast("int")), m % WORD) == 1,
    )
    months = sets.select(held.alias("months")).select(
        F.get("months", F.lit(0)).alias("first"), F.explode("months").alias("m")
    )
    counted = months.groupBy("first", (F.col("m") - F.col("first")).alias("months_since")).agg(
        F.count(F.lit(1)).alias("n_active")
    )
    start = F.add_months(F.trunc(F.lit(params.ref_date).cast("date"), "month"), F.col("first"))
    return counted.select(
        F.date_format(start, "yyyy-MM").alias("cohort_month"), "months_since", "n_active"
    )


def cohort_retention(activity: DataFrame, params: Params) -> DataFrame:
    """Percent of each large enough cohort active N months on; unseen combinations are 0 (R-1, J18).

    ``activity`` is a written table of at most months x months rows. Every household is active in
    its own first month, so month 0 holds the cohort size.
    """
    sizes = activity.filter(F.col("months_since") == 0).select(
        "cohort_month", F.col("n_active").alias("size")
    ).filter(F.col("size") >= params.min_cohort_size)
    months = activity.agg(F.collect_set("months_since").alias("m")).scalar()
    grid = sizes.withColumn("months_since", F.explode(months))
    pct = F.coalesce(F.col("n_active"), F.lit(0)) / F.col("size") * 100
    return (
        grid.join(activity, ["cohort_month", "months_since"], "left")
        .select("cohort_month", "months_since", round_half_even(pct, 1).alias("retention_pct"))
        .orderBy("cohort_month", "months_since")
    )


def retention_matrix(retention: DataFrame, last_month: int = 12) -> DataFrame:
    """Cohorts by months since joining, columns m0..m12 (R-3)."""
    months = list(range(last_month + 1))
    wide = retention.groupBy("cohort_month").pivot("months_since", months).agg(
        F.first("retention_pct")
    )
    return wide.toDF("cohort_month", *[f"m{i}" for i in months]).orderBy("cohort_month")


def retention_avg(retention: DataFrame) -> DataFrame:
    """Unweighted mean over cohorts at months 3 and 12; 0 where the month never occurs."""
    def at(month: int):
        pct = F.when(F.col("months_since") == month, F.col("retention_pct").cast("decimal(6,1)"))
        return F.coalesce(mean(pct), F.lit(0.0))

    return retention.agg(
        F.count_distinct("cohort_month").alias("n_cohorts"),
        at(3).alias("avg_m3"),
        at(12).alias("avg_m12"),
    )


def acquisition_trend(customers: DataFrame, params: Params) -> DataFrame:
    """New households per month with their mean value and spend."""
    return (
        with_first_month(customers, params, "first_cal_month").groupBy("first_cal_month")
        .agg(
            F.count(F.lit(1)).alias("n_new"),
            round_half_even(mean(F.col("predicted_clv")), 2).alias("avg_clv"),
            round_half_even(mean(F.col("total_spend")), 2).alias("avg_spend"),
        )
        .orderBy("first_cal_month")
    )


def acquisition_by_segment(customers: DataFrame, params: Params) -> DataFrame:
    return (
        with_first_month(customers, params, "first_cal_month")
        .groupBy("first_cal_month", "rfm_segment").agg(F.count(F.lit(1)).alias("n_new"))
        .orderBy("first_cal_month", "rfm_segment")
    )
