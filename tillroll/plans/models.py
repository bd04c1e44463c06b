"""The two models fitted on an analysis, with their intermediate tables written."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame

from ..ml import churn as churn_ml, clv as clv_ml
from ..ml.boosting import Rows, Settings
from ..operators.household import clv_features
from ..operators.rfm import add_rfm
from .analysis import Analysis


class Models:
    def __init__(self, analysis: Analysis, params: clv_ml.ClvParams):
        self.analysis = analysis
        self.params = params
        self.stage = analysis.stage

    @cached_property
    def table(self) -> DataFrame:
        return self.stage.table("clv_input", lambda: clv_ml.model_table(
            clv_features(self.analysis.customers, self.analysis.params), self.params
        ))

    @cached_property
    def data(self) -> Rows:
        """All households binned, written: every fit reads them in its task."""
        rows = clv_ml.fit_rows(self.table, self.params)
        return replace(rows, frame=self.stage.table("clv_bins", lambda: rows.frame))

    @cached_property
    def search(self) -> list[tuple[Settings, float, int]]:
        return clv_ml.search(self.table, self.data, self.params)

    @cached_property
    def tuned(self) -> Settings:
        return min(self.search, key=lambda row: row[1])[0]

    @cached_property
    def _out_of_fold(self) -> tuple[DataFrame, list[int]]:
        frame, trees = clv_ml.out_of_fold(self.table, self.data, self.tuned, self.params)
        return self.stage.table("clv_oof", lambda: frame), trees

    @property
    def oof(self) -> DataFrame:
        return self._out_of_fold[0]

    @property
    def trees(self) -> list[int]:
        return self._out_of_fold[1]

    @cached_property
    def final(self):
        mean_trees = sum(self.trees) // len(self.trees)
        return clv_ml.final_model(self.table, self.data, self.tuned, mean_trees, self.params)

    @cached_property
    def holdout(self) -> DataFrame:
        return self.stage.table(
            "clv_holdout", lambda: clv_ml.holdout(self.table, self.data, self.params)
        )

    @cached_property
    def final_predictions(self) -> DataFrame:
        return self.stage.table("clv_final", lambda: clv_ml.predict(self.final, self.table))

    @cached_property
    def churn_input(self) -> DataFrame:
        """Customers with segment and train/test flag."""
        params = self.analysis.params
        return churn_ml.split(add_rfm(self.analysis.customers, params.rfm_cuts), params.seed)

    @cached_property
    def churn(self) -> churn_ml.ChurnModel:
        return churn_ml.fit(self.churn_input)

    @cached_property
    def scored(self) -> DataFrame:
        """Every customer with segment, predicted value and churn probability, written."""
        return self.stage.table("scored", lambda: self.churn.probability(
            clv_ml.attach_predictions(self.churn_input, self.final_predictions)
        ))
