"""Models on hand-made households where the outcome can be learned."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import line
from tillroll.__main__ import DATABASE, main
from tillroll.ml import boosting, churn as churn_ml, clv as clv_ml
from tillroll.operators.household import CLV_FEATURES
from tillroll.sources.csv_files import FILES
from tillroll.sources.store import RESULT_TABLES, Store

SMALL_SEARCH = clv_ml.ClvParams(folds=3, trials=4, max_trees=30, patience=5, wave=2)


def households(spark, n, seed=4):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        level = draw.uniform(10, 1000)
        rows.append((k, *[level if c == "y1_total_spend" else draw.random() for c in CLV_FEATURES],
                     level * 2 + draw.gauss(0, 20)))
    return spark.createDataFrame(
        rows, "household_key long, " + ", ".join(f"{c} double" for c in CLV_FEATURES)
        + ", y2_spend double",
    )


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('clv')}/table"
    clv_ml.model_table(households(spark, 400), SMALL_SEARCH).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def data(table):
    return clv_ml.fit_data(table, SMALL_SEARCH)


def test_out_of_fold_predictions_have_skill(spark, table, data):
    settings = boosting.Settings(learning_rate=0.3, min_child=2)
    oof, trees = clv_ml.out_of_fold(table, data, settings, SMALL_SEARCH)
    oof = oof.cache()
    assert len(trees) == 3
    assert oof.count() == 400 == oof.select("household_key").distinct().count()
    baseline = clv_ml.naive_baseline(table).first()
    mae = oof.agg(F.avg("abs_error")).first()[0]
    assert mae < baseline["constant_mae"] / 2
    folds = clv_ml.fold_table(oof).collect()
    assert sum(r["n"] for r in folds) == 400
    assert all(r["r2"] > 0.5 and r["top20"] > 0.6 for r in folds)
    oof.unpersist()


def early_fit(**changes):
    return boosting.Fit(0, 0, boosting.Settings(learning_rate=0.3, **changes), "", "early", 1000, 20)


def test_growth_that_stops_at_patience_keeps_the_trees_of_the_full_growth(data):
    """The cap decides nothing: more trees and more patience keep the same ones."""
    fit = early_fit()
    stopped, grown = boosting.boost(data, *fit.rows(data), fit.settings, 1000, 20, 42)
    full, all_grown = boosting.boost(data, *fit.rows(data), fit.settings, grown, 10**6, 42)
    assert grown == stopped.n_trees + 20 < 1000 and all_grown == grown
    assert stopped == full


def test_kept_trees_are_the_best_on_the_early_rows(data):
    fit = early_fit()
    train, early = fit.rows(data)
    kept, grown = boosting.boost(data, train, early, fit.settings, 60, 10**6, 42)
    everything, _ = boosting.boost(data, train, None, fit.settings, 60, 0, 42)
    rows = np.flatnonzero(early)
    x = boosting._representatives(data, early)
    losses = []
    for k in range(1, 61):
        first = replace(everything, roots=everything.roots[:k])
        losses.append(np.abs(first.score(x) - data.target[rows]).mean())
    assert kept.n_trees == int(np.argmin(losses)) + 1 and grown == 60


def test_one_split_is_the_best_of_all(data):
    """The first tree of depth one against every cut of every feature, by brute force."""
    s = boosting.Settings(learning_rate=1.0, max_depth=1, subsample=1.1, colsample=1.0, min_child=7,
                          l2=2.0, l1=1.5)
    everyone = np.ones(len(data.target), dtype=bool)
    tree, _ = boosting.boost(data, everyone, None, s, 1, 0, 1)
    sign = np.sign(data.target - np.median(data.target))

    def worth(mask):
        return max(abs(sign[mask].sum()) - s.l1, 0) ** 2 / (mask.sum() + s.l2)

    best = max(
        (worth(data.bins[:, f] <= b) + worth(data.bins[:, f] > b) - worth(everyone))
        for f in range(data.bins.shape[1]) for b in range(len(data.cuts[f]))
        if 7 <= (data.bins[:, f] <= b).sum() <= len(sign) - 7
    )
    assert tree.gain[0] == pytest.approx(best) and len(tree.feature) == 3
    x = boosting._representatives(data, everyone)
    low = x[:, tree.feature[0]] <= tree.cut[0]
    found = tree.score(x)
    assert found[low] == pytest.approx(np.median(data.target[low]))
    assert found[~low] == pytest.approx(np.median(data.target[~low]))


def test_deeper_trees_keep_their_limits(data):
    s = boosting.Settings(max_depth=6, min_child=9, subsample=0.7, colsample=0.5)
    everyone = np.ones(len(data.target), dtype=bool)
    trees, _ = boosting.boost(data, everyone, None, s, 10, 0, 3)
    ends = [*trees.roots[1:], len(trees.feature)]
    for root, end in zip(trees.roots, ends):
        depth = {root: 0}
        for k in range(root, end):
            if trees.feature[k] >= 0:
                depth[trees.left[k]] = depth[trees.left[k] + 1] = depth[k] + 1
        assert len(depth) == end - root and max(depth.values()) <= 6
        used = {trees.feature[k] for k in range(root, end) if trees.feature[k] >= 0}
        assert len(used) <= int(0.5 * len(CLV_FEATURES))


def test_boosting_goes_on_improving_a_target_in_thousands(spark, data):
    scaled = replace(data, target=data.target * 1000)
    everyone = np.ones(len(data.target), dtype=bool)
    x = boosting._representatives(data, everyone)
    errors = []
    for trees in (1, 40):
        model, _ = boosting.boost(
            scaled, everyone, None, boosting.Settings(learning_rate=0.1), trees, 0, 1
        )
        errors.append(np.abs(model.score(x) - scaled.target).mean())
    assert errors[1] < 0.3 * errors[0]


def test_scores_of_a_frame_equal_those_of_the_arrays(spark, table, data):
    fit = early_fit()
    trees, _ = boosting.boost(data, *fit.rows(data), fit.settings, 20, 20, 42)
    rows = boosting.score(table, CLV_FEATURES, {0: trees}, None, "p").collect()
    x = np.array([[r[c] for c in CLV_FEATURES] for r in rows])
    assert [r["p"] for r in rows] == pytest.approx(list(trees.score(x)))


def test_sample_is_bounded_and_whole_below_the_bound(spark):
    frame = spark.range(20_000).withColumnRenamed("id", "household_key")
    assert boosting.sampled(frame, "household_key", 20_000).count() == 20_000
    assert 4_500 < boosting.sampled(frame, "household_key", 5_000).count() < 5_500


def test_search_draws_within_the_tuning_ranges():
    for s in clv_ml.draw_settings(clv_ml.ClvParams(trials=200)):
        assert 0.01 <= s.learning_rate <= 0.2 and 3 <= s.max_depth <= 8
        assert 0 <= s.min_gain <= 5 and 0.1 <= s.l2 <= 10 and 1e-3 <= s.l1 <= 5
        assert 0.5 <= s.subsample <= 1 and 0.5 <= s.colsample <= 1 and 1 <= s.min_child <= 20
    assert clv_ml.draw_settings(SMALL_SEARCH) == clv_ml.draw_settings(SMALL_SEARCH)


def test_a_killed_search_goes_on_where_it_stopped(table, data, monkeypatch):
    made, run_fits = [], clv_ml.run_fits

    def counting(spark, known, fits, keep_trees):
        if len(made) == 6:
            raise KeyboardInterrupt
        made.extend((f.number, f.fold) for f in fits)
        return run_fits(spark, known, fits, keep_trees)

    monkeypatch.setattr(clv_ml, "run_fits", counting)
    with pytest.raises(KeyboardInterrupt):
        clv_ml.search(table, data, SMALL_SEARCH)  # two waves of six fits; the second never starts
    assert len(made) == 6
    made.append(None)
    first = clv_ml.search(table, data, SMALL_SEARCH)
    made.remove(None)
    assert sorted(made) == [(t, f) for t in range(4) for f in range(3)]
    assert clv_ml.search(table, data, SMALL_SEARCH) == first and len(made) == 12
    frame = clv_ml.search_table(table, first).collect()
    assert [r["mae"] for r in frame] == sorted(r["mae"] for r in frame) and len(frame) == 4


def test_another_input_or_seed_is_another_search(spark, table):
    same = clv_ml.input_digest(table.repartition(3), replace(SMALL_SEARCH, trials=9))
    assert clv_ml.input_digest(table, SMALL_SEARCH) == same
    assert clv_ml.input_digest(table, replace(SMALL_SEARCH, seed=1)) != same
    changed = table.withColumn("y2_spend", F.when(F.col("household_key") == 5, 0.0).otherwise(F.col("y2_spend")))
    assert clv_ml.input_digest(changed, SMALL_SEARCH) != same


def test_holdout_metrics(table, data):
    predictions = clv_ml.holdout(table, data, SMALL_SEARCH)
    found = clv_ml.holdout_metrics(predictions).first()
    rows = predictions.collect()
    test = [r for r in rows if r["in_test_set"]]
    errors = [r["abs_error"] for r in test]
    naive = [abs(r["y1_total_spend"] - r["actual_y2_spend"]) for r in test]
    assert (found["n_train"], found["n_test"]) == (len(rows) - len(test), len(test))
    assert found["mae"] == pytest.approx(np.mean(errors))
    assert found["median_ae"] == pytest.approx(np.median(errors))
    assert found["naive_mae"] == pytest.approx(np.mean(naive))
    assert found["naive_median_ae"] == pytest.approx(np.median(naive))
    assert found["mae"] < found["naive_mae"]


def test_missing_predictions_take_the_median(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "household_key long")
    predictions = spark.createDataFrame(
        [(1, 10.0), (2, 30.0)], "household_key long, predicted_clv double"
    )
    found = {r["household_key"]: r["predicted_clv"]
             for r in clv_ml.attach_predictions(customers, predictions).collect()}
    assert found == {1: 10.0, 2: 30.0, 3: 20.0}


@pytest.fixture(scope="module")
def customers(spark):
    draw = random.Random(9)
    rows = []
    for k in range(500):
        gone = draw.random() < 0.3
        rows.append((k, draw.randint(1, 5) if gone else draw.randint(4, 20), draw.uniform(10, 90),
                     5.0, draw.randint(1, 700), 1, 3, 42.0, 39.5, 0.1, int(gone), "Loyal"))
    return spark.createDataFrame(
        rows, "household_key long, n_baskets long, total_spend double, avg_basket double, "
        "tenure_days int, campaign_engaged int, n_departments long, income_val double, "
        "age_val double, weekly_freq double, is_churned int, rfm_segment string",
    )


def test_split_takes_a_fifth_of_each_class(customers):
    split = churn_ml.split(customers)
    for r in split.groupBy("is_churned").agg(
        F.count("*").alias("n"), F.count_if("in_test").alias("t")
    ).collect():
        assert r["t"] == round(r["n"] * 0.2)


def test_churn_model_ranks_and_scores(spark, customers):
    split = churn_ml.split(customers)
    model = churn_ml.fit(split)
    report = {r["class"]: r for r in churn_ml.metrics(model, split).collect()}
    assert report["Churned"]["auc"] > 0.9 and report["Active"]["recall"] > 0.8
    scored = model.probability(customers)
    low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low < high <= 1 and scored.count() == 500
    top = churn_ml.coefficients(model, spark).first()
    assert (top["feature"], top["effect"]) == ("n_baskets", "lowers churn")


def test_churn_fit_is_the_optimum(spark, customers):
    """The gradient is zero there, and a plain gradient descent ends at the same place."""
    split = churn_ml.split(customers)
    model = churn_ml.fit(split)
    left = [r["gradient"] for r in churn_ml.gradient(model, split).collect()]
    assert len(left) == 10 and max(map(abs, left)) < 1e-8 and model.steps < 15
    train = [r for r in split.collect() if not r["in_test"]]
    x = np.array([[float(r[c]) for c in churn_ml.CHURN_FEATURES] for r in train])
    spread = x.std(axis=0)
    x = np.c_[np.ones(len(x)), (x - x.mean(axis=0)) / np.where(spread > 0, spread, 1)]
    y = np.array([r["is_churned"] for r in train])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = np.zeros(10)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-x @ b))
        b -= 0.004 * (x.T @ (w * (p - y)) + np.r_[0, b[1:]])
    assert np.r_[model.intercept, model.weights] == pytest.approx(b, abs=1e-5)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_is_certain(spark, customers, label):
    only = customers.withColumn("is_churned", F.lit(label)).withColumn("in_test", F.col("household_key") < 50)
    model = churn_ml.fit(only)
    assert {r["churn_probability"] for r in model.probability(only).collect()} == {float(label)}
    assert {r["auc"] for r in churn_ml.metrics(model, only).collect()} == {None}


def panel(draw):
    """Transaction lines of 120 households, some of which stop early."""
    lines, basket = [], 0
    for h in range(1, 121):
        last = draw.choice([400, 711])
        for day in sorted(draw.sample(range(1, last), 12)):
            basket += 1
            lines.append(line(h, basket, day, round(draw.uniform(1, 60), 2), draw.randint(1, 6),
                              disc=-round(draw.uniform(0, 3), 2)))
    return lines


def test_full_run_from_csv_to_saved_results(spark, make_tables, tmp_path, capsys):
    tables = make_tables(
        transactions=panel(random.Random(2)),
        products=[(p, f"D{p % 3}", "National" if p % 2 else "Private", "x", "y")
                  for p in range(1, 7)],
        households=[(h, "35-44", "50-74K", "A", "2 Adults", "Homeowner", "2")
                    for h in range(1, 60)],
        campaign_assignments=[("TypeA" if c == 1 else "TypeB", h, c)
                              for h in range(1, 80) for c in (1, 2)],
        campaign_descriptions=[("TypeA", 1, 200, 240), ("TypeB", 2, 500, 530)],
        coupon_redemptions=[(h, 210, 1, 1) for h in range(1, 20)],
        coupons=[(1, 1, 1)],
    )
    for name, frame in tables.items():
        frame.coalesce(1).write.option("header", True).csv(f"{tmp_path}/csv/{FILES[name]}")
    spark.sql(f"DROP DATABASE IF EXISTS {DATABASE} CASCADE")
    main(["run", f"{tmp_path}/csv", f"{tmp_path}/out", "--trials", "2", "--max-trees", "4",
          "--buckets", "4"])
    store = Store(spark, DATABASE, f"{tmp_path}/out/_tables")
    assert store.ready() and all(store.has(t) for t in RESULT_TABLES)
    rfm = store.read("rfm_segments")
    assert rfm.count() == 120 and rfm.filter("predicted_clv IS NULL").count() == 0
    metrics = store.read("clv_metrics").first()
    assert metrics["n_train"] == 120 and metrics["n_folds"] == 5
    assert store.read("financial_scenarios").count() == 3
    oof = store.read("clv_predictions")
    assert oof.count() == 120 == oof.select("household_key").distinct().count()
    capsys.readouterr()
    main(["sql", f"{tmp_path}/out", "--preset", "buyer_comparison"])
    shown = capsys.readouterr().out
    assert "Campaign" in shown and "Organic" in shown
    main(["sql", f"{tmp_path}/out", "SELECT * FROM rfm_segments", "--csv", f"{tmp_path}/rfm"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/rfm").count() == 120
    spark.sql(f"DROP DATABASE {DATABASE} CASCADE")


def test_registered_models_use_the_whole_search():
    import __spark_entry__ as entry

    assert entry.MODEL_PARAMS == clv_ml.ClvParams()
    assert (entry.MODEL_PARAMS.trials, entry.MODEL_PARAMS.max_trees) == (50, 1000)


def test_registered_holdout_ends_below_the_cap(spark):
    import __spark_entry__ as entry
    from conftest import SMALL

    models = entry._models(spark, SMALL)
    fit = boosting.Fit(0, -1, clv_ml.FINAL_SETTINGS, "in_test_set", "inner")
    row = boosting.run_fits(spark, models.data, [fit], True).first()
    assert row["grown"] == len(row["roots"]) + 50 < 1000
    figures = entry.queries()["clv_holdout_metrics"](spark, SMALL).first()
    assert figures["n_train"] + figures["n_test"] == 150


def test_fits_of_a_wave_run_in_tasks_of_their_own(spark, table, data, tmp_path):
    fits = [replace(early_fit(), number=k, max_trees=2) for k in range(9)]
    placed = boosting.run_fits(spark, data, fits, keep_trees=False).groupBy(F.spark_partition_id()).count()
    assert [r["count"] for r in placed.collect()] == [1] * 9
    trials = clv_ml.TrialTable(table, SMALL_SEARCH)
    trials.path = str(tmp_path / "trials")

    def where(frames):
        from pyspark import TaskContext

        for frame in frames:
            yield frame.assign(mae=float(TaskContext.get().partitionId()))

    results = spark.range(0, 6, 1, 6).selectExpr(
        "int(id) AS number", "int(0) AS fold", "double(0) AS mae", "int(2) AS grown", "array(0) AS roots"
    )
    trials.add(results.mapInPandas(where, results.schema))
    assert sorted(r["mae"] for r in trials.rows().values()) == [0, 1, 2, 3, 4, 5]


def test_histograms_of_larger_children_are_what_their_rows_give():
    """Trees against a plain search over every node, column and cut."""
    draw = np.random.default_rng(5)
    bins = draw.integers(0, 6, (400, 3)).astype(np.uint8)
    residual = bins[:, 0] * 2.0 - bins[:, 1] + draw.normal(size=400)
    s = boosting.Settings(max_depth=4, min_child=4, l1=0.5, l2=1.5, min_gain=0.1)
    rows, columns = np.flatnonzero(draw.random(400) < 0.8), np.array([0, 1, 2])
    feature, at, left, gain, place = boosting._grow(
        bins, [bins[rows, c] for c in columns], np.sign(residual[rows]), rows, columns, s, 6
    )
    sign = np.sign(residual)

    def worth(members):
        return max(abs(sign[members].sum()) - s.l1, 0) ** 2 / (len(members) + s.l2)

    expected, stack, leaf = {}, [(0, np.arange(400), 0)], np.zeros(400, dtype=int)
    while stack:
        node, members, depth = stack.pop()
        leaf[members] = node
        inside = np.intersect1d(members, rows)
        best = (s.min_gain, None, None)
        for c in range(3 if depth < s.max_depth else 0):
            for cut in range(6):
                low = inside[bins[inside, c] <= cut]
                high = inside[bins[inside, c] > cut]
                if min(len(low), len(high)) >= s.min_child:
                    won = worth(low) + worth(high) - worth(inside)
                    best = max(best, (won, c, cut), key=lambda b: b[0])
        expected[node] = best
        if best[1] is not None:
            assert (feature[node], at[node]) == best[1:]
            assert gain[node] == pytest.approx(best[0])
            goes = bins[members, best[1]] <= best[2]
            stack += [(left[node], members[goes], depth + 1), (left[node] + 1, members[~goes], depth + 1)]
        else:
            assert feature[node] == -1
    assert len(expected) == len(feature) > 9 and (leaf == place).all()


def test_fits_learn_from_all_households_of_a_large_table(spark):
    """More households than the 200,000 that once were a sample: none is missing in memory or in a task."""
    n = 201_000
    values = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(97)).cast("double").alias(c)
              for k, c in enumerate(CLV_FEATURES)]
    frame = spark.range(n).select(
        F.col("id").alias("household_key"), *values, F.col("id").cast("double").alias("y2_spend")
    )
    table = clv_ml.model_table(frame, SMALL_SEARCH)
    assert np.array_equal(clv_ml.fit_data(table, SMALL_SEARCH).target, np.arange(n))
    fits = [boosting.Fit(k, k, boosting.Settings(), max_trees=0) for k in range(3)]
    rows = boosting.run_fits(spark, clv_ml.fit_rows(table, SMALL_SEARCH), fits, True).collect()
    fold = np.array([r[0] for r in table.orderBy("household_key").select("fold").collect()])
    for r in rows:
        keys = np.arange(n)
        base = np.median(keys[fold != r["fold"]])
        assert r["base"] == base
        assert r["mae"] == pytest.approx(np.abs(keys[fold == r["fold"]] - base).mean(), rel=1e-12)
    assert len(rows) == 3


def test_rows_reach_a_task_as_they_are_in_memory(spark, table, data):
    """Whatever the order of the blocks; rows without key or fold come last and into every fit."""
    odd = table.unionAll(table.limit(2).withColumns({
        "household_key": F.lit(None).cast("long"), "fold": F.lit(None).cast("int"),
        "early": F.lit(None).cast("boolean"),
    }))
    known = clv_ml.fit_data(odd.repartition(7), SMALL_SEARCH)
    assert list(known.fold[-2:]) == [boosting.NO_FOLD] * 2 and not known.flags["early"][-2:].any()
    assert len(known.target) == 402 and np.array_equal(known.target[:400], data.target)
    fits = [replace(early_fit(), number=k, fold=k - 1, max_trees=5) for k in range(4)]
    assert all(f.rows(known)[0][-2:].all() for f in fits)
    stored = replace(clv_ml.fit_rows(odd, SMALL_SEARCH), cuts=known.cuts)
    again = boosting.run_fits(spark, stored, fits, True).collect()
    found = boosting.run_fits(spark, known, fits, True).collect()
    assert sorted(again) == sorted(found) and len(found) == 4
    for r in found:
        trees, grown = boosting.boost(known, *fits[r["number"]].rows(known), fits[0].settings, 5, 20, 42)
        assert (boosting.trees_of(r), r["grown"]) == (trees, grown)


def test_a_table_without_rows_has_models_that_predict_zero(spark, table):
    none = clv_ml.fit_rows(table.filter("household_key < 0"), SMALL_SEARCH)
    row = boosting.run_fits(spark, none, [early_fit()], True).collect()
    assert [(r["base"], r["mae"], r["roots"]) for r in row] == [(0.0, None, [])]


def test_histograms_of_large_and_small_groups_are_plain_sums():
    draw = np.random.default_rng(8)
    for n_lines in (1, 4, 5):
        lines = [draw.integers(0, 9, 3000).astype(np.uint8) for _ in range(n_lines)]
        weights = boosting.BOTH + draw.integers(-1, 2, 3000)
        members = draw.permutation(3000)
        groups = [np.sort(members[:2000]), np.sort(members[2000:2700]), members[2700:2990], members[:0]]
        found = boosting._histograms(lines, weights, 9, groups)
        for g, own in enumerate(groups):
            for k, line in enumerate(lines):
                assert list(found[g, k]) == [weights[own][line[own] == b].sum() for b in range(9)]


def test_leaf_medians_of_odd_and_even_leaves():
    draw = np.random.default_rng(9)
    place = draw.integers(0, 40, 500)
    place[place == 3] = 4
    residual = draw.normal(size=500)
    found = boosting._leaf_medians(residual, place, 41)
    expected = [np.median(residual[place == k]) if (place == k).any() else 0.0 for k in range(41)]
    assert list(found) == expected
