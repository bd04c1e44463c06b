"""The full run: raw tables in, every result table out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..ml import churn as churn_ml, clv as clv_ml
from ..operators import (
    campaign, cohort, demographics, discount, products, rfm, scenarios, trends,
)
from ..params import Params
from ..schema import RetailTables
from ..sources.store import Store
from .analysis import ROLLUPS, Analysis
from .models import Models
from .views import VIEWS, register_views


def run_analysis(
    spark: SparkSession,
    tables: RetailTables,
    params: Params,
    store: Store,
    clv_params: clv_ml.ClvParams = clv_ml.ClvParams(),
) -> list[str]:
    """Compute and save all result tables; each line-level roll-up is made once and shared."""
    a = Analysis(spark, tables, params, share=ROLLUPS)
    try:
        return _write_all(spark, tables, params, store, clv_params, a)
    finally:
        a.stage.close()


def _write_all(
    spark: SparkSession, tables: RetailTables, params: Params, store: Store,
    clv_params: clv_ml.ClvParams, a: Analysis,
) -> list[str]:
    m = Models(a, clv_params)
    customers = m.scored
    roi = a.stage.table("roi", lambda: a.roi)
    activity = a.cohort_activity
    households = tables.households
    outputs = {
        "rfm_segments": rfm.rfm_table(customers),
        "clv_predictions": clv_ml.clv_predictions(m.oof),
        "clv_metrics": clv_ml.clv_metrics(
            m.oof, m.trees, m.final_predictions, m.table, clv_params
        ),
        "feature_importance": clv_ml.feature_importance(m.final, spark),
        "churn_scores": churn_ml.churn_scores(customers),
        "campaign_roi": roi,
        "campaign_uplift_detail": a.uplift,
        "cohort_results": cohort.cohort_results(customers, params),
        "financial_scenarios": scenarios.financial_scenarios(customers, roi, params),
        "cohort_retention": cohort.cohort_retention(activity, params),
        "weekly_trend": trends.weekly_trend(a.basket),
        "monthly_segment_spend": trends.monthly_segment_spend(
            tables.transactions, customers, params
        ),
        "demographics_income": demographics.segment_counts(customers, households, "income_desc"),
        "demographics_age": demographics.segment_counts(customers, households, "age_desc"),
        "demographics_hh_comp": demographics.segment_counts(customers, households, "hh_comp_desc"),
        "clv_by_income": demographics.clv_by_income(customers, households),
        "brand_by_segment": products.brand_by_segment(a.by_department, customers),
        "category_by_segment": products.category_by_segment(a.by_department, customers),
        "acquisition_trend": cohort.acquisition_trend(customers, params),
        "acquisition_by_segment": cohort.acquisition_by_segment(customers, params),
        "campaign_week_ranges": campaign.campaign_week_ranges(tables.campaign_descriptions),
        "discount_sensitivity": discount.discount_sensitivity(customers),
    }
    for name, frame in outputs.items():
        store.write(name, frame)
    register_views(spark, tables, params)
    for name in VIEWS:
        store.write(name, spark.table(name))
    return [*outputs, *VIEWS]
