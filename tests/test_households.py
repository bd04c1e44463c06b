import datetime
import random
from collections import Counter
from decimal import Decimal

import pytest

from conftest import line, rows
from tillroll.operators import (
    basket, cohort, demographics, discount, distribution, household, products, rfm, scenarios,
    trends,
)


def test_one_basket_household_has_no_spread(make_tables, params):
    t = make_tables(transactions=[line(1, 1, 10, 5), line(1, 1, 10, 7)])
    spend = household.household_spend(basket.basket_fact(t.transactions, params), params)
    row = spend.first()
    assert row["n_baskets"] == 1 and row["y1_std_basket"] is None
    customers = household.impute_medians(household.customer_base(
        spend, household.department_counts(_departments(t)), t, params
    ))
    features = household.clv_features(customers, params).first()
    assert features["y1_std_basket"] == 0.0 and features["y1_spend_cv"] == 0.0
    assert features["y1_total_spend"] == 12.0 and features["y1_spend_trend"] == 0.0


def _departments(t):
    return basket.household_departments(t.transactions, t.products)


def test_lines_without_a_key_belong_to_no_basket(make_tables, params):
    lines = [line(1, 1, 10, 5), list(line(2, 2, 10, 7)), list(line(3, 3, 10, 7))]
    lines[1][0] = None
    lines[2][6] = None
    fact = basket.basket_fact(make_tables(transactions=lines).transactions, params)
    assert sorted(rows(fact, "household_key", "spend")) == [(1, 5), (3, 0)]


def test_year_half_and_recent_splits(make_tables, params):
    days = [1, 182, 183, 336, 337, 365, 366, 700]
    t = make_tables(transactions=[line(1, d, d, 10 ** i) for i, d in enumerate(days)])
    row = household.household_spend(basket.basket_fact(t.transactions, params), params).first()
    assert row["y1_spend"] == 111111 and row["y2_spend"] == 11000000
    assert row["y1_spend_h1"] == 11 and row["y1_spend_h2"] == 111100
    assert row["y1_last4wk_spend"] == 110000
    assert row["recency_days"] == 11 and row["is_churned"] == 0


def test_household_without_first_year_has_zero_features(make_tables, params):
    t = make_tables(transactions=[line(1, 1, 400, 5)], households=[
        (1, "35-44", "50-74K", None, None, None, None), (2, "65+", "250K+", None, None, None, None),
    ])
    spend = household.household_spend(basket.basket_fact(t.transactions, params), params)
    customers = household.impute_medians(household.customer_base(
        spend, household.department_counts(_departments(t)), t, params
    ))
    f = household.clv_features(customers, params).first()
    assert all(f[c] == 0.0 for c in household.CLV_FEATURES if c.startswith("y1_"))
    assert f["income_val"] == 62.0 and f["age_val"] == 39.5 and f["y2_spend"] == 5.0


def test_two_discount_definitions(make_tables, params):
    t = make_tables(transactions=[line(1, 1, 1, 10, disc=-3), line(1, 2, 2, 10, disc=1)])
    row = household.household_spend(basket.basket_fact(t.transactions, params), params).first()
    assert row["y1_total_disc"] == 2 and row["y1_disc_abs"] == 4


def test_medians_come_from_joined_households_only(make_tables, params):
    t = make_tables(
        transactions=[line(h, h, 1, 1) for h in (1, 2, 3)],
        households=[
            (1, "19-24", "Under 15K", None, None, None, None),
            (2, "25-34", "15-24K", None, None, None, None),
            (9, "65+", "250K+", None, None, None, None),
        ],
    )
    spend = household.household_spend(basket.basket_fact(t.transactions, params), params)
    base = household.customer_base(
        spend, household.department_counts(_departments(t)), t, params
    )
    found = {r["household_key"]: (r["income_val"], r["age_val"])
             for r in household.impute_medians(base).collect()}
    assert found == {1: (12.5, 21.5), 2: (19.5, 29.5), 3: (16.0, 25.5)}


def test_unmatched_products_join_no_group(make_tables, params, spark):
    t = make_tables(
        transactions=[line(1, 1, 1, 5, product=1), line(1, 1, 1, 7, product=99),
                      line(2, 2, 1, 3, product=2)],
        products=[(1, "GROCERY", "National", "x", "y"), (2, "GROCERY", "Private", "x", "y")],
    )
    by_department = _departments(t)
    customers = spark.createDataFrame(
        [(1, "Loyal"), (2, "Loyal")], "household_key long, rfm_segment string"
    )
    brands = products.brand_by_segment(by_department, customers)
    assert rows(brands, "brand", "sales_value", "seg_total", "pct") == [
        ("National", 5.0, 8.0, 62.5), ("Private", 3.0, 8.0, 37.5),
    ]
    category = products.category_by_segment(by_department, customers)
    assert rows(category, "department", "total_spend", "n_households", "avg_spend_per_hh") == [
        ("GROCERY", 8.0, 2, 4.0),
    ]
    assert sorted(rows(household.department_counts(by_department), "household_key", "n_departments")) == [
        (1, 1), (2, 1),
    ]


@pytest.mark.parametrize("disc,revenue,bucket", [
    (0, 10, "<5%"), ("0.5", 10, "<5%"), (1, 10, "5-10%"), ("1.5", 10, "10-15%"),
    (2, 10, "15-20%"), ("10.1", 10, "20%+"), ("10.2", 10, None), (0, 0, "<5%"), (3, 0, None),
])
def test_discount_bins_are_right_closed(spark, disc, revenue, bucket):
    frame = spark.createDataFrame(
        [(1, "Loyal", 1, Decimal(disc), Decimal(revenue), Decimal(100), Decimal(7))],
        "household_key long, rfm_segment string, y1_n_baskets long, y1_disc_abs decimal(18,4), "
        "y1_spend decimal(18,4), total_spend decimal(18,4), predicted_clv decimal(18,4)",
    )
    found = rows(discount.discount_sensitivity(frame), "disc_bucket")
    assert found == ([(bucket,)] if bucket else [])


def test_retention_fills_holes_with_zero(make_tables, params):
    t = make_tables(transactions=[
        line(1, 1, 1, 1), line(1, 2, 70, 1), line(2, 3, 5, 1), line(3, 4, 40, 1),
    ])
    activity = cohort.cohort_activity(t.transactions, params)
    kept = cohort.cohort_retention(activity, params)
    assert rows(kept, "cohort_month", "months_since", "retention_pct") == [
        ("2013-01", 0, 100.0), ("2013-01", 2, 50.0), ("2013-02", 0, 100.0), ("2013-02", 2, 0.0),
    ]
    wide = cohort.retention_matrix(kept).first()
    assert (wide["m0"], wide["m1"], wide["m2"]) == (100.0, None, 50.0)
    averages = cohort.retention_avg(kept).first()
    assert tuple(averages) == (2, 0.0, 0.0)


def test_month_sets_against_brute_force(spark, make_tables, params):
    """Long calendars need several words; lines without a key count nowhere."""
    p = params.with_(max_day=4000)
    draw = random.Random(3)
    lines = [line(h, 100 * h + k, draw.randint(1, 5000), 1) for h in range(30) for k in range(40)]
    lines.append((None, *line(1, 1, 5, 1)[1:]))
    t = make_tables(transactions=lines)
    months = {}
    for h, _, day, *_ in lines[:-1]:
        date = datetime.date(2013, 1, 1) + datetime.timedelta(day - 1)
        months.setdefault(h, set()).add(date.year * 12 + date.month - 1)
    expected = Counter()
    for held in months.values():
        first = min(held)
        for m in held:
            expected[f"{first // 12}-{first % 12 + 1:02d}", m - first] += 1
    found = cohort.cohort_activity(t.transactions, p).collect()
    assert {(r["cohort_month"], r["months_since"]): r["n_active"] for r in found} == expected


def test_month_sets_take_two_exchanges_and_no_window(spark, params, tmp_path):
    lines = "household_key long, basket_id long, day int, week_no int"
    spark.createDataFrame([(1, 1, 1, 1)], lines).write.parquet(f"{tmp_path}/lines")
    activity = cohort.cohort_activity(spark.read.parquet(f"{tmp_path}/lines"), params)
    plan = activity._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan


def test_a_day_beyond_the_calendar_is_an_error(make_tables, params):
    t = make_tables(transactions=[line(1, 1, 1, 1), line(1, 2, 40_000, 1)])
    with pytest.raises(Exception, match="day 40000 is outside the calendar"):
        cohort.cohort_activity(t.transactions, params).collect()


def test_small_cohorts_are_dropped(make_tables, params):
    lines = [line(h, h, 1, 1) for h in range(19)] + [line(100 + h, 100 + h, 40, 1) for h in range(20)]
    t = make_tables(transactions=lines)
    p = params.with_(min_cohort_size=20)
    kept = cohort.cohort_retention(cohort.cohort_activity(t.transactions, p), p)
    assert {r["cohort_month"] for r in kept.collect()} == {"2013-02"}


def test_weekly_trend_and_peak(make_tables, params):
    t = make_tables(transactions=[
        line(1, 1, 1, 10), line(1, 2, 2, 20), line(2, 3, 3, 5), line(2, 4, 8, 35),
    ])
    weekly = trends.weekly_trend(basket.basket_fact(t.transactions, params))
    assert rows(weekly, "week_no", "total_spend", "n_baskets", "n_households", "avg_basket") == [
        (1, 35.0, 3, 2, 11.67), (2, 35.0, 1, 1, 35.0),
    ]
    assert trends.peak_week(weekly).first()["peak_week"] == 1


def test_demographics_skip_missing_labels(spark, make_tables):
    t = make_tables(households=[
        (1, None, "50-74K", None, None, None, None), (2, "65+", None, None, None, None, None),
    ])
    customers = spark.createDataFrame(
        [(1, "Loyal"), (2, "Lost"), (3, "Lost")], "household_key long, rfm_segment string"
    )
    counts = demographics.segment_counts(customers, t.households, "income_desc")
    assert rows(counts, "rfm_segment", "income_desc", "n_households") == [("Loyal", "50-74K", 1)]
    assert rows(demographics.income_segment_pct(counts), "champions", "loyal", "at_risk", "lost") == [
        (0.0, 100.0, 0.0, 0.0),
    ]
    assert demographics.with_demographics(customers, t.households).count() == 3


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 9, 10, 50)], "x double")
    found = rows(distribution.histogram(frame, "x", 10, upper=10), "bin", "low", "n")
    assert [n for _, _, n in found] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 3]
    same = rows(distribution.histogram(spark.createDataFrame([(3.0,)], "x double"), "x", 2), "low", "high", "n")
    assert same == [(2.5, 3.0, 0), (3.0, 3.5, 1)]


def test_sample_is_repeatable_and_exact(spark):
    frame = spark.range(1000).withColumnRenamed("id", "k")
    first = {r["k"] for r in distribution.sample_rows(frame, "k", 100, 42).collect()}
    again = {r["k"] for r in distribution.sample_rows(frame.repartition(7), "k", 100, 42).collect()}
    other = {r["k"] for r in distribution.sample_rows(frame, "k", 100, 7).collect()}
    assert len(first) == 100 and first == again and first != other


CUSTOMERS = "household_key long, rfm_segment string, predicted_clv double, churn_probability double, is_churned int"
ROI = ("campaign_type string, avg_uplift_weekly double, avg_duration_weeks double, "
       "revenue_roi double, n_households long")


def test_scenarios(spark, params):
    customers = spark.createDataFrame([
        (1, "Champions", 100.0, 0.1, 0), (2, "Loyal", 3.0, 0.2, 0), (3, "At Risk", 50.0, 0.8, 1),
        (4, "Lost", 1.0, 0.9, 1),
    ], CUSTOMERS)
    roi = spark.createDataFrame([("TypeA", 2.0, 4.0, 5.0, 2), ("TypeB", 1.0, 3.0, 3.75, 2)], ROI)
    found = {r["scenario"]: tuple(r)[1:] for r in
             scenarios.financial_scenarios(customers, roi, params).collect()}
    assert found == {
        "Blanket TypeA": (4, 6, 32, 5.33, 0),
        "Targeted (RFM)": (3, 3, 14, 4.52, 3),
        "CLV-Gated": (2, 3, 16, 5.33, 3),
    }
    kept = scenarios.uplift_retained(customers, roi, params).first()
    assert kept["rev_retained_pct"] == pytest.approx(14 / 32 * 100)
    risk = scenarios.reengagement_economics(customers, params).first()
    assert tuple(risk) == (2, 51.0, pytest.approx(2.55), 3.0, pytest.approx(0.85))
    top = scenarios.high_risk_customers(customers, params, 1)
    assert rows(top, "household_key") == [(3,)]


def test_scenarios_without_a_campaign_type(spark, params):
    customers = spark.createDataFrame([(1, "Champions", 100.0, 0.1, 0)], CUSTOMERS)
    roi = spark.createDataFrame([("TypeA", -2.0, 4.0, -5.0, 2)], ROI)
    found = {r["scenario"]: r for r in
             scenarios.financial_scenarios(customers, roi, params).collect()}
    assert found["Targeted (RFM)"]["incremental_revenue"] == 0
    assert scenarios.uplift_retained(customers, roi, params).first()["rev_retained_pct"] == 0.0


def test_segment_thresholds_and_order(spark):
    frame = spark.createDataFrame([(s,) for s in (15, 13, 12, 10, 9, 7, 6, 3)], "rfm_score int")
    found = rows(frame.selectExpr(f"{rfm.segment_sql()} AS s"), "s")
    assert [s for (s,) in found] == [
        "Champions", "Champions", "Loyal", "Loyal", "At Risk", "At Risk", "Lost", "Lost",
    ]


def test_tied_households_rank_by_key(make_tables, params):
    t = make_tables(transactions=[line(h, h, 10, 5) for h in range(1, 7)])
    spend = household.household_spend(basket.basket_fact(t.transactions, params), params)
    scored = {r["household_key"]: (r["r_score"], r["f_score"], r["m_score"])
              for r in rfm.add_rfm(spend).collect()}
    assert scored == {1: (5, 1, 1), 2: (5, 1, 1), 3: (4, 2, 2), 4: (3, 3, 3), 5: (2, 4, 4), 6: (1, 5, 5)}
