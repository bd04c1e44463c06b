import random
from decimal import Decimal

import numpy as np
import pytest

from tillroll.operators import ranking


@pytest.fixture
def narrow_first(monkeypatch):
    """Start every rank in the narrowest bracket, whatever the size of its group."""
    monkeypatch.setattr(ranking, "SPAN", 0)


@pytest.fixture
def picks(monkeypatch):
    """The brackets of every round."""
    rounds, pick = [], ranking._pick

    def recorded(frame, brackets):
        rounds.append(dict(brackets))
        return pick(frame, brackets)

    monkeypatch.setattr(ranking, "_pick", recorded)
    return rounds


def brute_quintiles(values):
    """values: {key: value} -> {key: quintile} by unique rank and equal-width cuts."""
    order = sorted(values, key=lambda k: (values[k], k))
    n = len(order)
    return {
        k: 1 if n == 1 else max(1, -(-5 * (r - 1) // (n - 1))) for r, k in enumerate(order, 1)
    }


def frame_of(spark, values):
    return spark.createDataFrame(
        [(k, Decimal(str(v))) for k, v in values.items()], "household_key long, x decimal(18,4)"
    )


def check(spark, values):
    scored = ranking.add_quintiles(frame_of(spark, values), {"q": "x"}, "household_key")
    assert {r["household_key"]: r["q"] for r in scored.collect()} == brute_quintiles(values)


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 23])
def test_all_equal_values_go_by_key(spark, n):
    check(spark, {k * 3: 1 for k in range(n)})


@pytest.mark.parametrize("n", [7, 2502])
def test_quintile_sizes_with_remainder(spark, n):
    draw = random.Random(n)
    check(spark, {k: draw.randint(0, 10**6) for k in range(n)})


@pytest.mark.parametrize("top", [1, 3, 40, 10**6])
def test_large_groups_are_bracketed_exactly(spark, narrow_first, top):
    draw = random.Random(top)
    check(spark, {k * 7 + 1: draw.randint(0, top) for k in range(3000)})


def test_one_value_holds_most_rows(spark, narrow_first):
    draw = random.Random(1)
    check(spark, {k: 5 if k % 3 else draw.randint(0, 100) for k in range(2500)})


def test_several_measures_in_one_pass(spark):
    draw = random.Random(3)
    a = {k: draw.randint(0, 20) for k in range(200)}
    b = {k: draw.randint(0, 9999) for k in range(200)}
    frame = spark.createDataFrame([(k, a[k], b[k]) for k in a], "household_key long, a int, b int")
    scored = ranking.add_quintiles(frame, {"qa": "a", "qb": "b"}, "household_key").collect()
    assert {r["household_key"]: r["qa"] for r in scored} == brute_quintiles(a)
    assert {r["household_key"]: r["qb"] for r in scored} == brute_quintiles(b)


def test_empty_frame(spark):
    frame = spark.createDataFrame([], "household_key long, x decimal(18,4)")
    assert ranking.add_quintiles(frame, {"q": "x"}, "household_key").count() == 0


@pytest.mark.parametrize("early", [False, True])
def test_quantiles_interpolate_like_numpy(spark, request, early):
    if early:
        request.getfixturevalue("narrow_first")
    draw = random.Random(5)
    data = [(g, draw.choice([draw.gauss(0, 9), 4.0])) for g in "abc" for _ in range(301)]
    data += [("d", 2.0), ("e", 1.0), ("e", 2.0)]
    shares = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = ranking.quantiles(spark.createDataFrame(data, "g string, x double"), "x", shares, "g")
    for g in "abcde":
        expected = np.quantile([v for h, v in data if h == g], shares)
        assert found[g] == pytest.approx(list(expected))


def test_quantiles_of_nothing(spark):
    frame = spark.createDataFrame([(None,)], "x double")
    assert ranking.quantiles(frame, "x", [0.5]) == {"": [None]}


@pytest.mark.parametrize("early", [False, True])
def test_top_overlap_takes_ties_in_key_order(spark, request, early):
    if early:
        request.getfixturevalue("narrow_first")
    draw = random.Random(8)
    data = [(k, k % 3, float(draw.randint(0, 6)), float(draw.randint(0, 6))) for k in range(400)]
    frame = spark.createDataFrame(data, "household_key long, fold int, a double, p double")
    found = ranking.top_overlap(frame, "a", "p", "household_key", group="fold")
    for fold in range(3):
        part = [r for r in data if r[1] == fold]
        n = max(1, int(len(part) * 0.2))
        tops = [{r[0] for r in sorted(part, key=lambda r: (-r[c], r[0]))[:n]} for c in (2, 3)]
        assert found[str(fold)] == (n, len(tops[0] & tops[1]))


@pytest.mark.parametrize("n", [1, 2, 6, 30, 700])
def test_narrow_brackets_of_small_groups_widen_until_they_hold_the_rank(spark, narrow_first, n):
    draw = random.Random(n)
    check(spark, {k: draw.randint(0, 10**6) for k in range(n)})


@pytest.mark.parametrize("n, ties", [(25_000, False), (25_000, True), (300, True)])
def test_default_brackets(spark, n, ties):
    draw = random.Random(11)
    check(spark, {
        k: draw.choice([7, draw.randint(0, 10**7)]) if ties else draw.randint(0, 10**7) for k in range(n)
    })


def test_a_wrong_bracket_is_looked_at_again(spark, monkeypatch, picks):
    """Sketches that lie cost rounds, not results."""
    def lying(frame, shares):
        wide = [(90.0, 95.0), (0.0, 0.5), (40.0, None)]
        return {"a": (100, {p: wide for p in shares})}

    monkeypatch.setattr(ranking, "_sketch", lying)
    monkeypatch.setattr(ranking, "SPAN", 0)
    frame = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    wanted = {("a", 1): (100, 0.01), ("a", 20): (100, 0.2), ("a", 50): (100, 0.5), ("a", 93): (100, 0.93)}
    found = ranking._select(frame, wanted)
    assert found == {t: (float(t[1] - 1), t[1] - 1, 1) for t in wanted}
    assert [sorted(r for _, r in p) for p in picks] == [[1, 20, 50, 93], [1, 20, 50], [20, 50], [20]]
    with pytest.raises(ArithmeticError):
        ranking._select(frame, {("a", 101): (100, 1.0)})


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_GROUPS", 3)
    frame = spark.createDataFrame([(k, 1.0) for k in range(5)], "g int, x double")
    with pytest.raises(ValueError):
        ranking.quantiles(frame, "x", [0.5], "g")


def test_scores_stay_a_map_over_the_input(spark):
    values = {k: k for k in range(50)}
    frame = frame_of(spark, values)
    plan = ranking.add_quintiles(frame, {"q": "x"}, "household_key")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("levels", [3, 40, 10**9])
def test_auc_equals_all_pairs(spark, levels):
    draw = random.Random(levels)
    data = [(draw.randint(0, levels) / 7, int(draw.random() < 0.3)) for _ in range(5000)]
    ones = np.array([s for s, y in data if y])
    zeros = np.array([s for s, y in data if not y])
    ahead = (ones[:, None] > zeros).sum() + 0.5 * (ones[:, None] == zeros).sum()
    frame = spark.createDataFrame(data + [(None, 1)], "p double, y int")
    assert ranking.rank_sum_auc(frame, "p", "y") == pytest.approx(ahead / (len(ones) * len(zeros)), rel=1e-14)
    assert ranking.rank_sum_auc(frame, "p", "y", buckets=2) == ranking.rank_sum_auc(frame, "p", "y")


def test_auc_needs_both_labels(spark):
    frame = spark.createDataFrame([(0.5, 1)], "p double, y int")
    assert ranking.rank_sum_auc(frame, "p", "y") is None
    assert ranking.rank_sum_auc(frame.filter("false"), "p", "y") is None
