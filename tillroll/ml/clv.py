"""Second-year spend from first-year behaviour: boosted trees on absolute error.

Folds, hold-outs and early-stopping rows come from key arithmetic, so they are the same on every run
and cluster. Models learn from all households; predictions, errors and every other figure cover them all.

A search is a table of trials: one row per setting and fold, written wave by wave to the shared folder
under a digest of its input. A run that finds rows there makes the missing ones only.
"""

from __future__ import annotations

import hashlib
import random
from dataclasses import asdict, dataclass, replace
from math import exp, log, sqrt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import hash_mod
from ..operators.household import CLV_FEATURES
from ..operators.ranking import quantiles, top_overlap
from ..staging import shared_folder
from .boosting import Binned, Fit, Rows, Settings, Trees, binned, run_fits, score, trees_of

# Settings of the final model when the tuned ones are not asked for.
FINAL_SETTINGS = Settings(
    learning_rate=0.03, max_depth=4, subsample=0.8, colsample=0.8, min_child=5, l2=1.0
)


@dataclass(frozen=True)
class ClvParams:
    folds: int = 5
    trials: int = 50
    max_trees: int = 1000
    early_percent: int = 15
    holdout_percent: int = 20
    patience: int = 50
    seed: int = 42
    max_bins: int = 64
    wave: int = 25  # trials between two writes of the trial table
    use_tuned_params: bool = False


def model_table(features: DataFrame, params: ClvParams) -> DataFrame:
    """Features with fold number, early-stopping flag and hold-out flag."""
    key = "household_key"
    return features.withColumns({
        "fold": hash_mod(key, params.folds).cast("int"),
        "early": hash_mod(key, 100, params.seed + 1) < params.early_percent,
        "in_test_set": (hash_mod(key, 100, params.seed + 2) < params.holdout_percent).cast("int"),
    })


def fit_rows(table: DataFrame, params: ClvParams) -> Rows:
    """All households, binned: what every fit of a run learns from (M1)."""
    inner = hash_mod("household_key", 100, params.seed + 3) < params.holdout_percent
    return binned(
        table.withColumn("inner", inner), CLV_FEATURES, "y2_spend",
        ["early", "in_test_set", "inner"], params.max_bins,
    )


def fit_data(table: DataFrame, params: ClvParams) -> Binned:
    """The same in the driver's memory, for a table known to be small."""
    return fit_rows(table, params).collected()


def draw_settings(params: ClvParams) -> list[Settings]:
    """Random search over the tuning ranges; log-uniform where the range is multiplicative (M3)."""
    draw = random.Random(params.seed)

    def log_uniform(low: float, high: float) -> float:
        return exp(draw.uniform(log(low), log(high)))

    return [
        Settings(
            learning_rate=log_uniform(0.01, 0.2), max_depth=draw.randint(3, 8),
            subsample=draw.uniform(0.5, 1.0), colsample=draw.uniform(0.5, 1.0),
            min_child=draw.randint(1, 20), l2=log_uniform(0.1, 10.0), l1=log_uniform(1e-3, 5.0),
            min_gain=draw.uniform(0.0, 5.0),
        )
        for _ in range(params.trials)
    ]


def input_digest(table: DataFrame, params: ClvParams) -> str:
    """Names a search: its rows, whatever their order, and what its fits depend on."""
    columns = sorted(table.columns)
    sums = table.agg(F.count(F.lit(1)), *(
        F.sum(F.xxhash64(F.lit(k), *columns).cast("decimal(38,0)")) for k in range(2)
    )).first()
    settings = replace(params, trials=0, wave=0, use_tuned_params=False)
    return hashlib.sha256(repr((columns, tuple(sums), asdict(settings))).encode()).hexdigest()


class TrialTable:
    """(trial, fold, mae, grown, kept) rows in the shared folder; a finished wave stays."""

    SCHEMA = "trial int, fold int, mae double, grown int, kept int"

    def __init__(self, table: DataFrame, params: ClvParams):
        self.spark = table.sparkSession
        folder = shared_folder(self.spark).rstrip("/")
        self.path = f"{folder}/clv-trials/{input_digest(table, params)}"

    def rows(self) -> dict[tuple[int, int], tuple]:
        """What is there: at most one row per trial and fold."""
        try:
            found = self.spark.read.schema(self.SCHEMA).parquet(self.path).collect()
        except AnalysisException:
            return {}
        return {(r["trial"], r["fold"]): r for r in found}

    def add(self, results: DataFrame) -> None:
        """One file; an exchange before it, because ``coalesce`` would run all fits in one task."""
        results.selectExpr(
            "number AS trial", "fold", "mae", "grown", "size(roots) AS kept"
        ).repartition(1).write.mode("append").parquet(self.path)


def search(
    table: DataFrame, data: Rows | Binned, params: ClvParams
) -> list[tuple[Settings, float, int]]:
    """Cross-validated mean absolute error and mean number of kept trees per drawn setting (M3)."""
    settings, trials = draw_settings(params), TrialTable(table, params)
    done = trials.rows()
    missing = [
        Fit(t, fold, s, "", "early", params.max_trees, params.patience, params.seed)
        for t, s in enumerate(settings) for fold in range(params.folds) if (t, fold) not in done
    ]
    step = max(1, params.wave * params.folds)
    for at in range(0, len(missing), step):
        trials.add(run_fits(table.sparkSession, data, missing[at:at + step], keep_trees=False))
    done = trials.rows() if missing else done
    results = []
    for t, s in enumerate(settings):
        rows = [done[t, fold] for fold in range(params.folds)]
        errors = [r["mae"] for r in rows if r["mae"] is not None]
        mae = sum(errors) / len(errors) if errors else float("inf")
        results.append((s, mae, sum(r["kept"] for r in rows) // len(rows)))
    return results


def search_table(table: DataFrame, results: list[tuple[Settings, float, int]]) -> DataFrame:
    rows = [
        (i, s.learning_rate, s.max_depth, s.subsample, s.colsample, s.min_child, s.l2, s.l1,
         s.min_gain, trees, error)
        for i, (s, error, trees) in enumerate(results)
    ]
    return table.sparkSession.createDataFrame(
        rows,
        "trial int, learning_rate double, max_depth int, subsample double, colsample double, "
        "min_child_weight int, reg_lambda double, reg_alpha double, gamma double, "
        "kept_trees int, mae double",
    ).orderBy("mae", "trial")


def out_of_fold(
    table: DataFrame, data: Rows | Binned, settings: Settings, params: ClvParams
) -> tuple[DataFrame, list[int]]:
    """Every household predicted by the model that did not see its fold; trees kept per fold (M5)."""
    fits = [
        Fit(k, k, settings, "", "early", params.max_trees, params.patience, params.seed)
        for k in range(params.folds)
    ]
    # One row per fold: its size follows from the cap on trees and their depth.
    models = {r["fold"]: trees_of(r) for r in run_fits(table.sparkSession, data, fits, True).collect()}
    scored = score(table, CLV_FEATURES, models, "fold", "predicted_clv")
    return _predictions(scored), [models[k].n_trees for k in range(params.folds)]


def _predictions(scored: DataFrame) -> DataFrame:
    return scored.select(
        "household_key", "fold", "predicted_clv",
        F.col("y2_spend").alias("actual_y2_spend"),
        F.abs(F.col("predicted_clv") - F.col("y2_spend")).alias("abs_error"),
        "y1_total_spend", "in_test_set",
    )


def clv_predictions(oof: DataFrame) -> DataFrame:
    """Result table of out-of-fold predictions; every row is a test row."""
    return oof.select(
        "household_key", "predicted_clv", "actual_y2_spend", "abs_error",
        F.lit(1).alias("in_test_set"),
    )


def top_predicted(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The households with the highest predicted value (T5)."""
    return predictions.orderBy(F.col("predicted_clv").desc(), "household_key").limit(n)


def _one_fit(table: DataFrame, data: Rows | Binned, fit: Fit) -> Trees:
    return trees_of(run_fits(table.sparkSession, data, [fit], True).first())


def final_model(
    table: DataFrame, data: Rows | Binned, tuned: Settings, trees: int, params: ClvParams
) -> Trees:
    """Fit on every fold with the mean number of trees kept in cross-validation (M8)."""
    settings = tuned if params.use_tuned_params else FINAL_SETTINGS
    return _one_fit(table, data, Fit(0, -1, settings, max_trees=max(trees, 1), seed=params.seed))


def predict(model: Trees, table: DataFrame) -> DataFrame:
    scored = score(table, CLV_FEATURES, {0: model}, None, "predicted_clv")
    return scored.select("household_key", "predicted_clv")


def attach_predictions(customers: DataFrame, predictions: DataFrame) -> DataFrame:
    """Customers with their prediction, the median prediction where there is none."""
    middle = quantiles(predictions, "predicted_clv", [0.5])[""][0]
    return customers.join(predictions, "household_key", "left").withColumn(
        "predicted_clv", F.coalesce("predicted_clv", F.lit(middle).cast("double"))
    )


def feature_importance(model: Trees, session) -> DataFrame:
    """Mean gain of each feature's splits as a share, largest first."""
    gains = model.importance(len(CLV_FEATURES))
    return session.createDataFrame(
        [(name, float(g)) for name, g in zip(CLV_FEATURES, gains)],
        "feature string, importance double",
    ).orderBy(F.col("importance").desc(), "feature")


def fold_metrics(oof: DataFrame) -> dict[str, dict[str, float]]:
    """Error, fit and top-fifth precision per fold: one row per fold reaches the driver (M7)."""
    error = F.col("predicted_clv") - F.col("actual_y2_spend")
    sums = oof.groupBy(F.col("fold").cast("string").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("abs_error").alias("mae"),
        F.sum(error * error).alias("sse"),
        F.var_pop("actual_y2_spend").alias("variance"),
    ).collect()
    middles = quantiles(oof, "abs_error", [0.5], "fold")
    overlap = top_overlap(
        oof, "actual_y2_spend", "predicted_clv", "household_key", group="fold"
    )
    result = {}
    for row in sums:
        fold, n = row["fold"], row["n"]
        spread = row["variance"] * n
        top_n, both = overlap[fold]
        result[fold] = {
            "n": n, "mae": row["mae"], "sse": row["sse"], "median_ae": middles[fold][0],
            "r2": 1 - row["sse"] / spread if spread > 0 else 0.0, "top20": both / top_n,
        }
    return result


def fold_table(oof: DataFrame) -> DataFrame:
    rows = [
        (int(fold), m["n"], m["mae"], m["median_ae"], m["r2"], m["top20"])
        for fold, m in sorted(fold_metrics(oof).items())
    ]
    return oof.sparkSession.createDataFrame(
        rows, "fold int, n long, mae double, median_ae double, r2 double, top20 double"
    )


def naive_baseline(table: DataFrame) -> DataFrame:
    """Errors of predicting the first year's spend again, and of one constant, the median."""
    middle = quantiles(table, "y2_spend", [0.5])[""][0]
    errors = table.select(
        F.abs(F.col("y1_total_spend") - F.col("y2_spend")).alias("naive"),
        F.abs(F.lit(middle) - F.col("y2_spend")).alias("constant"),
    )
    naive_middle = quantiles(errors, "naive", [0.5])[""][0]
    return errors.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("naive").alias("naive_mae"),
        F.lit(naive_middle).alias("naive_median_ae"),
        F.avg("constant").alias("constant_mae"),
    )


def clv_metrics(
    oof: DataFrame, trees: list[int], final: DataFrame, table: DataFrame, params: ClvParams
) -> DataFrame:
    """The one-row metrics record."""
    folds = list(fold_metrics(oof).values())
    n = sum(m["n"] for m in folds)

    def avg(name: str) -> float:
        return sum(m[name] for m in folds) / len(folds)

    def spread(name: str) -> float:
        return sqrt(sum((m[name] - avg(name)) ** 2 for m in folds) / len(folds))

    top_n, both = top_overlap(oof, "actual_y2_spend", "predicted_clv", "household_key")[""]
    baseline = naive_baseline(table).first()
    mean_clv = final.agg(F.avg("predicted_clv").alias("m")).first()["m"]
    kept = sum(trees) // len(trees)
    better = (1 - avg("mae") / baseline["naive_mae"]) * 100 if baseline["naive_mae"] else 0.0
    row = (
        f"boosted trees, {params.trials} settings, {params.folds}-fold (n={kept})",
        round(avg("median_ae"), 2), round(avg("mae"), 2), round(spread("mae"), 2),
        round(sqrt(sum(m["sse"] for m in folds) / n), 2),
        round(avg("r2"), 4), round(spread("r2"), 4), round(both / top_n, 4), params.folds,
        round(quantiles(final, "predicted_clv", [0.5])[""][0], 2), round(mean_clv, 2),
        n, n, round(baseline["naive_mae"], 2), round(baseline["naive_median_ae"], 2),
        round(better, 1), round(baseline["constant_mae"], 2),
    )
    return oof.sparkSession.createDataFrame(
        [row],
        "model string, median_ae double, mae double, mae_std double, rmse double, r2 double, "
        "r2_std double, top20_precision double, n_folds int, median_predicted_clv double, "
        "mean_predicted_clv double, n_train long, n_test long, naive_mae double, "
        "naive_median_ae double, rf_improvement_pct double, constant_mae double",
    )


def holdout(table: DataFrame, data: Rows | Binned, params: ClvParams) -> DataFrame:
    """Predictions of one model fitted outside the hold-out rows, which are flagged."""
    model = _one_fit(table, data, Fit(
        0, -1, FINAL_SETTINGS, "in_test_set", "inner", params.max_trees, params.patience, params.seed
    ))
    return _predictions(score(table, CLV_FEATURES, {0: model}, None, "predicted_clv"))


def holdout_metrics(predictions: DataFrame) -> DataFrame:
    """Errors on the hold-out rows beside those of repeating the first year's spend."""
    test = predictions.filter("in_test_set = 1")
    error = F.col("predicted_clv") - F.col("actual_y2_spend")
    naive = test.withColumn(
        "naive_error", F.abs(F.col("y1_total_spend") - F.col("actual_y2_spend"))
    )
    figures = naive.agg(
        F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"),
        F.sum(error * error).alias("sse"), F.var_pop("actual_y2_spend").alias("variance"),
        F.avg("naive_error").alias("naive_mae"),
    ).first()
    n, spread = figures["n"], (figures["variance"] or 0.0) * figures["n"]
    top_n, both = top_overlap(test, "actual_y2_spend", "predicted_clv", "household_key").get("", (1, 0))
    row = (
        predictions.filter("in_test_set = 0").count(), n, figures["mae"],
        quantiles(naive, "abs_error", [0.5])[""][0], sqrt(figures["sse"] / n) if n else None,
        1 - figures["sse"] / spread if spread > 0 else 0.0, both / top_n, figures["naive_mae"],
        quantiles(naive, "naive_error", [0.5])[""][0],
        (1 - figures["mae"] / figures["naive_mae"]) * 100 if figures["naive_mae"] else 0.0,
    )
    return predictions.sparkSession.createDataFrame(
        [row],
        "n_train long, n_test long, mae double, median_ae double, rmse double, r2 double, "
        "top20 double, naive_mae double, naive_median_ae double, improvement_pct double",
    )
