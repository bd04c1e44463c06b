"""Campaign uplift, return on investment, significance, coupon effects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import cents, ratio_or, round_half_even
from ..functions.student_t import two_sided_p
from ..params import Params
from .basket import day_to_week
from .ranking import quantiles


def campaign_uplift(
    assignments: DataFrame, descriptions: DataFrame, days: DataFrame, params: Params
) -> DataFrame:
    """Weekly spend before and during each campaign, per assigned household.

    ``days`` is the household-day roll-up: the join meets at most one row per calendar day for each
    of a household's campaigns. Repeated assignments are counted first and repeated at the end.
    """
    windows = descriptions.select(
        "campaign",
        F.col("description").alias("campaign_type"),
        F.greatest(F.col("start_day") - 7 * params.pre_weeks, F.lit(1)).alias("pre_start"),
        "start_day",
        "end_day",
        F.greatest(
            (F.col("end_day") - F.col("start_day")) / F.lit(7.0), F.lit(1.0)
        ).alias("dur_weeks"),
    )
    assigned = (
        assignments.groupBy("campaign", "household_key")
        .agg(F.count(F.lit(1)).cast("int").alias("copies"))
        .join(windows, "campaign")
    )
    visits = days.select(F.col("household_key").alias("hh"), "day", "spend")
    in_window = (
        (F.col("household_key") == F.col("hh"))
        & (F.col("day") >= F.col("pre_start"))
        & (F.col("day") <= F.col("end_day"))
    )
    before = F.col("day") < F.col("start_day")
    kind = "inner" if params.exclude_zero_pre else "left"
    totals = (
        assigned.join(visits, in_window, kind)
        .groupBy("household_key", "campaign", "campaign_type", "dur_weeks", "copies")
        .agg(
            F.coalesce(F.sum(F.when(before, F.col("spend"))), F.lit(0)).alias("pre"),
            F.coalesce(F.sum(F.when(~before, F.col("spend"))), F.lit(0)).alias("during"),
        )
    )
    if params.exclude_zero_pre:
        totals = totals.filter(F.col("pre") != 0)
    pre_weekly = F.col("pre").cast("double") / F.lit(float(params.pre_weeks))
    during_weekly = F.col("during").cast("double") / F.col("dur_weeks")
    uplift = during_weekly - pre_weekly
    return totals.select(
        "campaign",
        "campaign_type",
        "household_key",
        round_half_even(pre_weekly, 2).alias("pre_weekly_spend"),
        round_half_even(during_weekly, 2).alias("during_weekly_spend"),
        round_half_even(uplift, 2).alias("uplift_weekly"),
        "dur_weeks",
        round_half_even(uplift * F.col("dur_weeks"), 2).alias("total_uplift"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def uplift_by_type(uplift: DataFrame) -> DataFrame:
    """Counts, exact totals and spread per campaign type; households are counted once a type.

    The first aggregation is per household, so the second one counts rows instead of distinct keys.
    """
    per_household = uplift.groupBy("campaign_type", "household_key").agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.sum(cents(F.col(c))).alias(c)
            for c in ("pre_weekly_spend", "during_weekly_spend", "uplift_weekly", "total_uplift")
        ],
        F.sum("dur_weeks").alias("dur_weeks"),
        F.sum(cents(F.col("uplift_weekly")) * cents(F.col("uplift_weekly"))).alias("squares"),
    )
    n = F.sum("rows")
    return per_household.groupBy("campaign_type").agg(
        n.alias("n_rows"),
        F.count(F.lit(1)).alias("n_households"),
        (F.sum("pre_weekly_spend").cast("double") / n).alias("pre"),
        (F.sum("during_weekly_spend").cast("double") / n).alias("during"),
        (F.sum("uplift_weekly").cast("double") / n).alias("uplift"),
        (F.sum("dur_weeks") / n).alias("duration"),
        F.sum("total_uplift").cast("double").alias("total_uplift"),
        F.sqrt(
            F.when(n > 1, F.greatest(
                F.sum("squares").cast("double")
                - F.sum("uplift_weekly").cast("double") * F.sum("uplift_weekly").cast("double") / n,
                F.lit(0.0),
            ) / (n - 1))
        ).alias("sd"),
    )


def campaign_ttest(by_type: DataFrame) -> DataFrame:
    """One-sample t-test of the weekly uplift against zero."""
    t = F.when(
        F.col("sd") > 0, F.col("uplift") / (F.col("sd") / F.sqrt(F.col("n_rows").cast("double")))
    ).when(F.col("uplift") != 0, F.signum("uplift") * F.lit(float("inf")))
    with_t = by_type.select(
        "campaign_type", F.col("n_rows").alias("n"), F.col("uplift").alias("mean"), "sd",
        F.when(F.col("n_rows") > 1, t).alias("t_stat"),
    )
    return with_t.withColumn("p_value", two_sided_p(F.col("t_stat"), F.col("n")))


def mailer_cost_of(params: Params):
    pairs = [F.lit(x) for pair in params.mailer_cost.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("campaign_type"))


def campaign_roi(by_type: DataFrame, params: Params) -> DataFrame:
    """Cost, gross profit and both returns per campaign type, best margin first."""
    tested = campaign_ttest(by_type).select("campaign_type", "p_value")
    costed = by_type.withColumn("unit_cost", mailer_cost_of(params)).withColumn(
        "cost", F.col("n_households") * F.col("unit_cost")
    )
    profit = F.col("total_uplift") * F.lit(params.margin)
    return (
        costed.join(tested, "campaign_type")
        .select(
            "campaign_type",
            "n_households",
            round_half_even(F.col("pre"), 2).alias("avg_pre_weekly_spend"),
            round_half_even(F.col("during"), 2).alias("avg_during_weekly_spend"),
            round_half_even(F.col("uplift"), 2).alias("avg_uplift_weekly"),
            round_half_even(F.col("duration"), 1).alias("avg_duration_weeks"),
            round_half_even(F.col("total_uplift"), 2).alias("total_incremental_rev"),
            round_half_even(F.col("cost"), 2).alias("total_mailer_cost"),
            round_half_even(profit, 2).alias("gross_profit"),
            round_half_even(ratio_or(F.col("total_uplift"), F.col("cost"), 0.0), 2)
            .alias("revenue_roi"),
            round_half_even(ratio_or(profit, F.col("cost"), 0.0), 2).alias("net_roi"),
            round_half_even(F.col("p_value"), 4).alias("p_value"),
            F.coalesce(F.col("p_value") < 0.05, F.lit(False)).cast("int").alias("significant"),
            F.col("unit_cost").alias("mailer_cost_per_hh"),
        )
        .orderBy(F.col("net_roi").desc(), "campaign_type")
    )


def campaign_totals(roi: DataFrame) -> DataFrame:
    """Incremental revenue and households over all types."""
    return roi.agg(
        F.sum(cents(F.col("total_incremental_rev"))).cast("double").alias("total_incremental_rev"),
        F.sum("n_households").alias("n_households"),
    )


def campaign_week_ranges(descriptions: DataFrame) -> DataFrame:
    """First and last week of each campaign."""
    return descriptions.select(
        "campaign",
        "description",
        day_to_week(F.col("start_day")).alias("start_week"),
        day_to_week(F.col("end_day")).alias("end_week"),
        "start_day",
        "end_day",
    )


def campaign_active_weeks(weekly: DataFrame, ranges: DataFrame) -> DataFrame:
    """The weekly trend with the number of campaigns running in each week.

    A campaign becomes one row per week it runs, which turns the interval match into an equi-join.
    """
    running = (
        ranges.select(
            "description",
            F.explode(F.sequence("start_week", "end_week")).alias("week_no"),
        )
        .groupBy("week_no")
        .agg(
            F.count(F.lit(1)).alias("n_active"),
            *[
                F.count_if(F.col("description") == t).alias(f"n_{t.lower()}")
                for t in ("TypeA", "TypeB", "TypeC")
            ],
        )
    )
    flags = ["n_active", "n_typea", "n_typeb", "n_typec"]
    return (
        weekly.join(running, "week_no", "left").fillna(0, flags)
        .select("week_no", "total_spend", *flags).orderBy("week_no")
    )


def uplift_box(uplift: DataFrame) -> DataFrame:
    """Five-number summary of weekly uplift per campaign type, exact at any size."""
    found = quantiles(
        uplift, "uplift_weekly", [0.0, 0.25, 0.5, 0.75, 1.0], "campaign_type"
    )
    return uplift.sparkSession.createDataFrame(
        [(g, *row) for g, row in sorted(found.items())],
        "campaign_type string, low double, q1 double, median double, q3 double, high double",
    )


def coupon_day_uplift(days: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Mean basket on days a household redeemed a coupon against all other days.

    Both sides are one row per household and day.
    """
    redeemed = redemptions.select("household_key", "day").distinct().withColumn(
        "redeemed", F.lit(True)
    )
    marked = days.join(redeemed, ["household_key", "day"], "left")
    hit = F.col("redeemed").isNotNull()

    def average(condition):
        return F.try_divide(
            F.sum(F.when(condition, F.col("spend"))).cast("double"),
            F.sum(F.when(condition, F.col("n_baskets"))).cast("double"),
        )

    return marked.agg(
        average(hit).alias("coupon_avg"), average(~hit).alias("regular_avg")
    ).withColumn("uplift", F.col("coupon_avg") - F.col("regular_avg"))


def coupon_redemption_rate(assignments: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Redeeming households as percent of households sent a campaign."""
    redeeming = redemptions.agg(F.count_distinct("household_key").alias("n")).scalar()
    return assignments.agg(F.count_distinct("household_key").alias("campaign_households")).select(
        "campaign_households",
        redeeming.alias("redeeming_households"),
        F.try_divide(redeeming * F.lit(100.0), F.col("campaign_households")).alias("redemption_rate"),
    )
