"""Shared inputs of the result tables, built on demand and at most once.

The household measures are always written, because ranking reads them several times. ``share`` names
the line-level roll-ups to write as well; a run that needs one of them only once leaves it lazy.
``measures`` limits the household columns for a run that needs few of them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import basket as b, campaign, cohort, household as h, products, rfm
from ..params import Params
from ..schema import RetailTables
from ..session import split_hot_partitions
from ..staging import Stage

ROLLUPS = ("basket", "days", "departments")

# Measures the segments and their reports need; the first-year details are computed on request.
CORE_MEASURES = (
    "household_key", "total_spend", "n_baskets", "avg_basket", "first_day", "last_day",
    "tenure_days", "recency_days", "is_churned",
)
DISCOUNT_MEASURES = {"y1_total_disc", "y1_disc_abs"}


class Analysis:
    def __init__(
        self,
        spark: SparkSession,
        tables: RetailTables,
        params: Params,
        share: tuple[str, ...] = (),
        measures: tuple[str, ...] | None = None,
    ):
        self.spark = spark
        self.tables = tables
        self.params = params
        self.share = set(share)
        self.measures = measures
        self.stage = Stage(spark)
        split_hot_partitions(spark)

    def _rollup(self, name: str, build) -> DataFrame:
        return self.stage.table(name, build) if name in self.share else build()

    @cached_property
    def basket(self) -> DataFrame:
        def build() -> DataFrame:
            fact = b.basket_fact(self.tables.transactions, self.params)
            if self.measures is None or DISCOUNT_MEASURES & set(self.measures):
                return fact
            return fact.drop("n_items", "retail_disc", "retail_disc_abs")

        return self._rollup("basket", build)

    @cached_property
    def days(self) -> DataFrame:
        return self._rollup("days", lambda: b.household_days(self.basket))

    @cached_property
    def by_department(self) -> DataFrame:
        return self._rollup("departments", lambda: b.household_departments(
            self.tables.transactions, self.tables.products
        ))

    @cached_property
    def department_counts(self) -> DataFrame:
        """From the roll-up where a run shares it, else straight from the labelled lines."""
        if "departments" in self.share:
            return h.department_counts(self.by_department)
        return h.department_counts(
            b.labelled_lines(self.tables.transactions, self.tables.products)
        )

    @cached_property
    def spend(self) -> DataFrame:
        """Household measures; those not asked for are pruned from the pass over the lines."""
        def build() -> DataFrame:
            full = h.household_spend(self.basket, self.params)
            return full if self.measures is None else full.select(*self.measures)

        return self.stage.table("spend", build)

    @cached_property
    def segments(self) -> DataFrame:
        """Household measures with scores and segment: a map over the written measures."""
        return rfm.add_rfm(self.spend, self.params.rfm_cuts)

    @cached_property
    def engaged(self) -> DataFrame:
        """Segments plus whether the household was ever sent a campaign (P5)."""
        sent = h.campaign_counts(self.tables.campaign_assignments)
        return (
            self.segments.join(sent, "household_key", "left").fillna(0, ["n_campaigns"])
            .withColumn("campaign_engaged", (F.col("n_campaigns") > 0).cast("int"))
        )

    @cached_property
    def customers(self) -> DataFrame:
        """The full master table, written: the models read it many times."""
        base = self.stage.table("customers", lambda: h.customer_base(
            self.spend, self.department_counts, self.tables, self.params
        ))
        return h.impute_medians(base)

    @cached_property
    def uplift(self) -> DataFrame:
        return campaign.campaign_uplift(
            self.tables.campaign_assignments, self.tables.campaign_descriptions,
            self.days, self.params,
        )

    @cached_property
    def uplift_by_type(self) -> DataFrame:
        """Three rows, written: returns, tests and scenarios all start from them."""
        return self.stage.table("uplift_by_type", lambda: campaign.uplift_by_type(self.uplift))

    @cached_property
    def roi(self) -> DataFrame:
        return campaign.campaign_roi(self.uplift_by_type, self.params)

    @cached_property
    def cohort_activity(self) -> DataFrame:
        return self.stage.table(
            "cohort_activity",
            lambda: cohort.cohort_activity(self.tables.transactions, self.params),
        )

    @cached_property
    def category_by_segment(self) -> DataFrame:
        return self.stage.table(
            "category_by_segment",
            lambda: products.category_by_segment(self.by_department, self.segments),
        )


def with_stand_ins(customers: DataFrame, params: Params) -> DataFrame:
    """Stand-ins for the two model outputs, to exercise the reports without a model: first-year
    spend for the predicted value, recency over the window for the churn probability."""
    columns = {"churn_probability": F.col("recency_days") / F.lit(float(params.max_day))}
    if "y1_spend" in customers.columns:
        columns["predicted_clv"] = F.col("y1_spend")
    return customers.withColumns(columns)
