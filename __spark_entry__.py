"""

Queries read the star-schema tables in ``sf_dir`` through ``tillroll.sources.star``. Where a report
needs a model output, queries with an oracle use the stand-ins of ``with_stand_ins``; the queries of
the models themselves have no oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from oracle_sql import ORACLES
from tillroll.functions.numeric import round_half_even
from tillroll.ml import churn as churn_ml, clv as clv_ml
from tillroll.operators import (
    basket, campaign, cohort, demographics, discount, distribution, household, products, ranking,
    rfm, scenarios, trends,
)
from tillroll.plans import presets, views
from tillroll.plans.analysis import CORE_MEASURES, Analysis, with_stand_ins
from tillroll.plans.models import Models
from tillroll.sources.star import STAR_PARAMS as P, star_tables
from tillroll.sources.store import in_display_order

try:
    from tillroll.llm.registry import ORACLES as LLM_ORACLES, QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:  # the library works without the subpackage
    if missing.name not in ("tillroll.llm", "tillroll.llm.registry"):
        raise
    LLM_ORACLES, LLM_QUERIES = {}, {}

Query = Callable[[SparkSession, str], DataFrame]

# The operator's own search and cap on trees; tests of the model steps bring smaller ones.
MODEL_PARAMS = clv_ml.ClvParams()
HISTOGRAM_TOP = {"total_spend": 6_000_000.0, "n_baskets": 300.0, "spend": 600_000.0}


def _analysis(
    spark: SparkSession, sf_dir: str, *measures: str, share: tuple[str, ...] = ()
) -> Analysis:
    return Analysis(spark, star_tables(spark, sf_dir), P, share, CORE_MEASURES + measures)


def _full(spark: SparkSession, sf_dir: str, share: tuple[str, ...] = ()) -> Analysis:
    return Analysis(spark, star_tables(spark, sf_dir), P, share)


def _doubles(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("double") for c in columns})


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Trim values whose last bits depend on summation order."""
    return frame.withColumns({c: round_half_even(F.col(c), digits) for c in columns})


def _stand_in(a: Analysis) -> DataFrame:
    return with_stand_ins(a.segments, P)


def _view(name: str) -> Query:
    return lambda spark, sf_dir: views.VIEWS[name](star_tables(spark, sf_dir), P)


def _segmented(build: Callable[[DataFrame], DataFrame], *measures: str) -> Query:
    """A report on the segmented households with stand-ins."""
    return lambda spark, sf_dir: build(_stand_in(_analysis(spark, sf_dir, *measures)))


def _engaged(build: Callable[[DataFrame], DataFrame], *measures: str) -> Query:
    return lambda spark, sf_dir: build(
        with_stand_ins(_analysis(spark, sf_dir, *measures).engaged, P)
    )


def rfm_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_profile(_analysis(spark, sf_dir).segments)


def basket_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _full(spark, sf_dir).basket
    return _doubles(
        fact.select("household_key", "basket_id", "day", "week_no", "date", "spend", "n_items"),
        "spend",
    )


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "weekly_freq", "y1_spend", "y2_spend")
    return _doubles(a.customers, "total_spend", "y1_spend", "y2_spend")


def master_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return household.master_summary(_analysis(spark, sf_dir).customers)


def clv_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "y1_spend", "y2_spend")
    predictions = _doubles(_stand_in(a).withColumns({
        "actual_y2_spend": F.col("y2_spend"),
        "abs_error": F.abs(F.col("predicted_clv") - F.col("y2_spend")),
    }), "predicted_clv", "actual_y2_spend", "abs_error")
    return clv_ml.top_predicted(clv_ml.clv_predictions(predictions))


def clv_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _analysis(spark, sf_dir, "y1_spend").spend
    clip = distribution.upper_clip(spend, "y1_spend", 0.99)
    binned = distribution.histogram(spend, "y1_spend", 30, clip)
    return _rounded(binned, 4, "low", "high")


def churn_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(
        with_stand_ins(_analysis(spark, sf_dir).spend, P), "churn_probability", 30
    )


def churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analysis(spark, sf_dir).spend.select("household_key", "last_day", "is_churned")


def churn_by_segment(customers: DataFrame) -> DataFrame:
    return rfm.segment_stats(customers).select("rfm_segment", "churn_rate")


def campaign_uplift_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir).uplift


def campaign_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir).roi


def campaign_ttest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = campaign.campaign_ttest(_full(spark, sf_dir).uplift_by_type)
    return _rounded(tested, 6, "mean", "sd", "t_stat", "p_value")


def campaign_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.campaign_totals(_full(spark, sf_dir).roi)


def campaign_week_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week ranges of all campaigns, with the number of households each was sent to."""
    tables = star_tables(spark, sf_dir)
    sent = tables.campaign_assignments.groupBy("campaign").agg(
        F.countDistinct("household_key").alias("n_households")
    )
    ranges = campaign.campaign_week_ranges(tables.campaign_descriptions)
    return ranges.join(sent, "campaign", "left").fillna(0, ["n_households"])


def campaign_active_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = trends.weekly_trend(_full(spark, sf_dir).basket)
    descriptions = star_tables(spark, sf_dir).campaign_descriptions
    return campaign.campaign_active_weeks(weekly, campaign.campaign_week_ranges(descriptions))


def uplift_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _full(spark, sf_dir)
    return campaign.uplift_box(a.stage.table("uplift", lambda: a.uplift))


def coupon_day_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _full(spark, sf_dir)
    return campaign.coupon_day_uplift(a.days, a.tables.coupon_redemptions)


def coupon_redemption_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star_tables(spark, sf_dir)
    return campaign.coupon_redemption_rate(tables.campaign_assignments, tables.coupon_redemptions)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return household.clv_features(_full(spark, sf_dir).customers, P)


def y1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_features(spark, sf_dir), 6, "y1_std_basket", "y1_spend_cv")


def model_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _analysis(spark, sf_dir).spend.select("household_key")
    return clv_ml.model_table(keys, MODEL_PARAMS).withColumn("early", F.col("early").cast("int"))


def churn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn_ml.split(_analysis(spark, sf_dir).spend, P.seed).select(
        "household_key", "is_churned", F.col("in_test").cast("int").alias("in_test")
    )


def naive_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _analysis(spark, sf_dir, "y1_spend", "y2_spend").spend.select(
        "household_key", F.col("y1_spend").cast("double").alias("y1_total_spend"),
        F.col("y2_spend").cast("double").alias("y2_spend"),
    )
    return _rounded(
        clv_ml.naive_baseline(spend), 4, "naive_mae", "naive_median_ae", "constant_mae"
    )


def top20_precision_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _analysis(spark, sf_dir, "y1_spend", "y2_spend").spend
    top_n, both = ranking.top_overlap(spend, "y2_spend", "y1_spend", "household_key")[""]
    return spark.createDataFrame(
        [(top_n, both, both / top_n)], "top_n long, both long, precision double"
    )


def _retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_retention(_full(spark, sf_dir).cohort_activity, P)


def monthly_segment_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return trends.monthly_segment_spend(a.tables.transactions, a.segments, P)


def _by_detail(detail: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        a = _analysis(spark, sf_dir)
        return demographics.segment_counts(a.segments, a.tables.households, detail)

    return run


def income_segment_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demographics.income_segment_pct(_by_detail("income_desc")(spark, sf_dir))


def demographics_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    kept = a.segments.select("household_key", "rfm_segment")
    return demographics.with_demographics(kept, a.tables.households)


def clv_by_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "y1_spend")
    return demographics.clv_by_income(_stand_in(a), a.tables.households)


def brand_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return products.brand_by_segment(a.by_department, a.segments)


def category_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir)
    return products.category_by_segment(a.by_department, a.segments)


def category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.category_pivot(_analysis(spark, sf_dir).category_by_segment)


def top_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_display_order(_view("category_spend")(spark, sf_dir), "category_spend")


def spend_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(
        _analysis(spark, sf_dir).spend, "total_spend", 30, HISTOGRAM_TOP["total_spend"]
    )


def basket_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(
        _analysis(spark, sf_dir).spend, "n_baskets", 30, HISTOGRAM_TOP["n_baskets"]
    )


def _stored_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _full(spark, sf_dir)
    return a.stage.table("basket_spend", lambda: a.basket.select("household_key", "spend"))


def basket_size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(
        _stored_basket(spark, sf_dir), "spend", 30, HISTOGRAM_TOP["spend"]
    )


def spend_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _analysis(spark, sf_dir).spend
    found = distribution.medians({
        "total_spend": (spend, "total_spend"),
        "n_baskets": (spend, "n_baskets"),
        "basket_spend": (_stored_basket(spark, sf_dir), "spend"),
    })
    clip = distribution.upper_clip(spend, "total_spend", 0.99)
    frame = spark.createDataFrame(
        [*found, ("total_spend_p99", clip)], "measure string, value double"
    )
    return _rounded(frame, 4, "value")


def spend_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _analysis(spark, sf_dir, "weekly_freq", "y1_spend", "y2_spend").customers
    numeric = [
        f.name for f in customers.schema
        if f.name != "household_key" and isinstance(f.dataType, T.NumericType)
    ]
    described = distribution.describe(customers, numeric)
    return _rounded(described, 4, "mean", "sd", "low", "high", "q1", "median", "q3")


def household_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = _analysis(spark, sf_dir, "y1_spend", "y2_spend").spend
    picked = distribution.sample_rows(spend, "household_key", 500, P.seed)
    return _doubles(picked.select("household_key", "y1_spend", "y2_spend"), "y1_spend", "y2_spend")


def financial_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "y1_spend", share=("basket",))
    return scenarios.financial_scenarios(_stand_in(a), a.roi, P)


def uplift_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "y1_spend", share=("basket",))
    return scenarios.uplift_retained(_stand_in(a), a.roi, P)


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _analysis(spark, sf_dir, "y1_spend", share=("basket",))
    customers = _stand_in(a)
    return scenarios.kpi_summary(
        customers, a.roi, scenarios.financial_scenarios(customers, a.roi, P), P
    )


def _churn_stand_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stand_in(_analysis(spark, sf_dir, "y1_spend"))


def _preset(name: str, *needed: str) -> Query:
    """A stored query with the result tables it reads registered from stand-in results."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        a = _analysis(spark, sf_dir, "y1_spend", "y2_spend", share=("basket",))
        build = {
            "rfm_segments": lambda: rfm.rfm_table(_stand_in(a)),
            "clv_predictions": lambda: _stand_in(a).select(
                "household_key", F.col("predicted_clv").cast("double").alias("predicted_clv"),
                F.col("y2_spend").cast("double").alias("actual_y2_spend"),
            ),
            "churn_scores": lambda: _doubles(
                churn_ml.churn_scores(_stand_in(a)), "predicted_clv"
            ),
            "campaign_roi": lambda: a.roi,
            "cohort_results": lambda: cohort.cohort_results(
                with_stand_ins(a.engaged, P), P
            ),
            "financial_scenarios": lambda: scenarios.financial_scenarios(_stand_in(a), a.roi, P),
            "category_spend": lambda: _view("category_spend")(spark, sf_dir),
            "buyer_segments": lambda: _view("buyer_segments")(spark, sf_dir),
        }
        for table in needed:
            build[table]().createOrReplaceTempView(table)
        return presets.PRESETS[name](spark)

    return run


def _models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(_full(spark, sf_dir), MODEL_PARAMS)


def clv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _models(spark, sf_dir)
    return clv_ml.clv_metrics(m.oof, m.trees, m.final_predictions, m.table, MODEL_PARAMS)


def clv_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _models(spark, sf_dir)
    return clv_ml.search_table(m.table, m.search)


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _models(spark, sf_dir)
    scores = churn_ml.churn_scores(m.churn.probability(m.churn_input))
    return _rounded(scores, 6, "churn_probability")


def churn_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        churn_ml.coefficients(_models(spark, sf_dir).churn, spark), 6, "coefficient"
    )


def churn_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted optimum, checked: what is left of each derivative, to six digits."""
    m = _models(spark, sf_dir)
    left = churn_ml.gradient(m.churn, m.churn_input)
    return left.withColumn("gradient", F.abs(round_half_even(F.col("gradient"), 6)))


def churn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _models(spark, sf_dir)
    found = churn_ml.metrics(m.churn, m.churn_input)
    return _rounded(found, 6, "precision", "recall", "f1", "accuracy", "auc")


def saved_results(spark: SparkSession, sf_dir: str) -> None:
    """Result tables as a finished run saves them, registered by name for SQL text."""
    a = _analysis(spark, sf_dir, "y1_spend", share=("basket",))
    customers = _stand_in(a)
    for name, frame in {
        "rfm_segments": rfm.rfm_table(customers),
        "campaign_roi": a.roi,
        "category_spend": _view("category_spend")(spark, sf_dir),
        "buyer_segments": _view("buyer_segments")(spark, sf_dir),
    }.items():
        a.stage.table(f"saved_{name}", lambda frame=frame: frame).createOrReplaceTempView(name)


def _sql(text: str) -> Query:
    """A text query over the saved result tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        saved_results(spark, sf_dir)
        return presets.query(spark, text)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Segment profile: scan, join, two aggregations, exact ranking, projection, sort."""
    return rfm_profile(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return {
        # views
        "customer_summary": _view("customer_summary"),
        "campaign_summary": _view("campaign_summary"),
        "weekly_spend": _view("weekly_spend"),
        "category_spend": _view("category_spend"),
        "buyer_segments": _view("buyer_segments"),
        # facts and household measures
        "basket_fact": basket_fact,
        "load_summary": lambda s, d: basket.load_summary(_full(s, d).basket, P),
        "customer_master": customer_master,
        "master_summary": master_summary,
        "churn_label": churn_label,
        "y1_features": y1_features,
        "naive_baseline": naive_baseline,
        "top20_precision_naive": top20_precision_naive,
        "model_splits": model_splits,
        "churn_split": churn_split,
        # segments
        "rfm_segments": _engaged(
            lambda c: rfm.rfm_table(c.drop("predicted_clv", "churn_probability"))
        ),
        "rfm_profile": rfm_profile,
        "rfm_share": _segmented(rfm.rfm_share),
        "rfm_score_box": _segmented(rfm.rfm_score_box),
        "segment_dashboard": _segmented(rfm.segment_dashboard),
        "segment_stats": _segmented(rfm.segment_stats, "y1_spend"),
        "segment_norms": lambda s, d: rfm.normalised_scores(rfm_profile(s, d)),
        "churn_by_segment": _segmented(churn_by_segment, "y1_spend"),
        # campaigns
        "campaign_uplift_detail": campaign_uplift_detail,
        "campaign_roi": campaign_roi,
        "campaign_ttest": campaign_ttest,
        "campaign_totals": campaign_totals,
        "campaign_week_ranges": campaign_week_ranges,
        "campaign_active_weeks": campaign_active_weeks,
        "uplift_box": uplift_box,
        "coupon_day_uplift": coupon_day_uplift,
        "coupon_redemption_rate": coupon_redemption_rate,
        # cohorts and trends
        "cohort_results": _engaged(lambda c: cohort.cohort_results(c, P), "y1_spend"),
        "cohort_extremes": _engaged(
            lambda c: cohort.cohort_extremes(cohort.cohort_results(c, P)), "y1_spend"
        ),
        "cohort_metrics_wide": _engaged(
            lambda c: cohort.cohort_metrics(cohort.cohort_results(c, P)), "y1_spend"
        ),
        "cohort_retention": _retention,
        "retention_matrix": lambda s, d: cohort.retention_matrix(_retention(s, d)),
        "retention_avg": lambda s, d: cohort.retention_avg(_retention(s, d)),
        "acquisition_trend": _segmented(lambda c: cohort.acquisition_trend(c, P), "y1_spend"),
        "acquisition_by_segment": _segmented(lambda c: cohort.acquisition_by_segment(c, P)),
        "weekly_trend": lambda s, d: trends.weekly_trend(_full(s, d).basket),
        "peak_week": lambda s, d: trends.peak_week(trends.weekly_trend(_full(s, d).basket)),
        "monthly_segment_spend": monthly_segment_spend,
        # demographics
        "demographics_income": _by_detail("income_desc"),
        "demographics_age": _by_detail("age_desc"),
        "demographics_hh_comp": _by_detail("hh_comp_desc"),
        "demographics_detail": demographics_detail,
        "income_segment_pct": income_segment_pct,
        "clv_by_income": clv_by_income,
        # products and discounts
        "brand_by_segment": brand_by_segment,
        "category_by_segment": category_by_segment,
        "category_pivot": category_pivot,
        "top_departments": top_departments,
        "department_revenue": lambda s, d: products.department_revenue(_full(s, d).by_department),
        "brand_revenue": lambda s, d: products.brand_revenue(_full(s, d).by_department),
        "discount_sensitivity": _segmented(
            discount.discount_sensitivity, "y1_spend", "y1_n_baskets", "y1_disc_abs"
        ),
        "discount_pivot": _segmented(
            lambda c: discount.discount_pivot(discount.discount_sensitivity(c)),
            "y1_spend", "y1_n_baskets", "y1_disc_abs",
        ),
        # distributions
        "spend_histogram": spend_histogram,
        "basket_histogram": basket_histogram,
        "basket_size_histogram": basket_size_histogram,
        "clv_histogram": clv_histogram,
        "churn_histogram": churn_histogram,
        "spend_medians": spend_medians,
        "spend_describe": spend_describe,
        "household_sample": household_sample,
        "clv_top20": clv_top20,
        # scenarios and headline figures
        "financial_scenarios": financial_scenarios,
        "uplift_retained": uplift_retained,
        "risk_summary": lambda s, d: scenarios.risk_summary(_churn_stand_in(s, d), P),
        "reengagement_economics": lambda s, d: scenarios.reengagement_economics(
            _churn_stand_in(s, d), P
        ),
        "high_risk_stand_in": lambda s, d: scenarios.high_risk_customers(_churn_stand_in(s, d), P),
        "kpi_summary": kpi_summary,
        # stored queries
        "top_customers": _preset(
            "top_customers", "rfm_segments", "clv_predictions"
        ),
        "preset_campaign_roi": _preset("campaign_roi", "campaign_roi"),
        "preset_high_risk": _preset(
            "high_risk", "churn_scores", "rfm_segments"
        ),
        "preset_rfm_summary": _preset("rfm_summary", "rfm_segments"),
        "preset_cohorts": _preset("cohorts", "cohort_results"),
        "preset_scenarios": _preset("scenarios", "financial_scenarios"),
        "preset_top_categories": _preset("top_categories", "category_spend"),
        "buyer_comparison": _preset("buyer_comparison", "buyer_segments"),
        # free-form SQL over the saved tables
        "sql_segment_reach": _sql(presets.SEGMENT_REACH),
        "sql_spend_bands": _sql(presets.SPEND_BANDS),
        "sql_campaign_margin": _sql(presets.CAMPAIGN_MARGIN),
        # models
        "clv_oof": lambda s, d: clv_ml.clv_predictions(_models(s, d).oof),
        "clv_fold_metrics": lambda s, d: clv_ml.fold_table(_models(s, d).oof),
        "clv_metrics": clv_metrics,
        "clv_feature_importance": lambda s, d: clv_ml.feature_importance(_models(s, d).final, s),
        "clv_search": clv_search,
        "clv_holdout": lambda s, d: _models(s, d).holdout,
        "clv_holdout_metrics": lambda s, d: clv_ml.holdout_metrics(_models(s, d).holdout),
        "churn_scores": churn_scores,
        "churn_coefficients": churn_coefficients,
        "churn_gradient": churn_gradient,
        "churn_metrics": churn_metrics,
        "high_risk_customers": lambda s, d: scenarios.high_risk_customers(_models(s, d).scored, P),
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; the model queries have none."""
    return {**ORACLES, **LLM_ORACLES}
