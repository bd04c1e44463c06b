import pytest

from conftest import line, rows
from tillroll.operators import basket, campaign


def uplift_of(make_tables, params, lines, assigned, described):
    t = make_tables(
        transactions=lines,
        campaign_assignments=[("TypeA", h, c) for h, c in assigned],
        campaign_descriptions=[(kind, c, start, end) for kind, c, start, end in described],
    )
    days = basket.household_days(basket.basket_fact(t.transactions, params))
    return campaign.campaign_uplift(
        t.campaign_assignments, t.campaign_descriptions, days, params
    )


COLUMNS = ["household_key", "pre_weekly_spend", "during_weekly_spend", "uplift_weekly",
           "dur_weeks", "total_uplift"]


def test_zero_pre_spend_is_left_out_and_zero_during_is_kept(make_tables, params):
    u = uplift_of(
        make_tables, params,
        [line(1, 10, 105, 50), line(2, 20, 90, 80)],
        [(1, 1), (2, 1)], [("TypeA", 1, 100, 114)],
    )
    assert rows(u, *COLUMNS) == [(2, 10.0, 0.0, -10.0, 2.0, -20.0)]


def test_zero_pre_spend_can_be_kept(make_tables, params):
    u = uplift_of(
        make_tables, params.with_(exclude_zero_pre=False),
        [line(1, 10, 105, 50)], [(1, 1), (3, 1)], [("TypeA", 1, 100, 114)],
    )
    assert sorted(rows(u, *COLUMNS)) == [
        (1, 0.0, 25.0, 25.0, 2.0, 50.0), (3, 0.0, 0.0, 0.0, 2.0, 0.0),
    ]


def test_windows_are_clamped(make_tables, params):
    u = uplift_of(
        make_tables, params,
        [line(1, 10, 1, 16), line(1, 11, 20, 5), line(1, 12, 23, 5), line(1, 13, 24, 99)],
        [(1, 1)], [("TypeA", 1, 20, 23)],
    )
    assert rows(u, *COLUMNS) == [(1, 2.0, 10.0, 8.0, 1.0, 8.0)]


def test_window_edges(make_tables, params):
    """Pre window is [start - 56, start - 1], campaign window [start, end]."""
    u = uplift_of(
        make_tables, params,
        [line(1, 1, 43, 1000), line(1, 2, 44, 8), line(1, 3, 99, 8), line(1, 4, 100, 7),
         line(1, 5, 107, 7), line(1, 6, 108, 1000)],
        [(1, 1)], [("TypeA", 1, 100, 107)],
    )
    assert rows(u, *COLUMNS) == [(1, 2.0, 14.0, 12.0, 1.0, 12.0)]


def test_repeated_assignments_repeat_rows(make_tables, params):
    u = uplift_of(
        make_tables, params, [line(1, 1, 90, 8), line(1, 2, 101, 30)],
        [(1, 1), (1, 1)], [("TypeA", 1, 100, 114)],
    )
    assert u.count() == 2


def test_positive_uplift_pays(make_tables, params):
    lines = [line(h, h, 90, 80 + h) for h in range(1, 13)]
    lines += [line(h, 100 + h, 103, 40 + h) for h in range(1, 13)]
    u = uplift_of(
        make_tables, params, lines, [(h, c) for h in range(1, 13) for c in (1, 2)],
        [("TypeA", 1, 100, 114), ("TypeB", 2, 100, 114)],
    )
    by_type = campaign.uplift_by_type(u)
    roi = {r["campaign_type"]: r for r in campaign.campaign_roi(by_type, params).collect()}
    a, b = roi["TypeA"], roi["TypeB"]
    assert a["n_households"] == 12 and a["total_mailer_cost"] == 18.0
    assert a["revenue_roi"] > 0 and a["significant"] == 1
    assert a["gross_profit"] == pytest.approx(a["total_incremental_rev"] * 0.27, abs=0.01)
    assert b["net_roi"] > a["net_roi"]
    tests = {r["campaign_type"]: r for r in campaign.campaign_ttest(by_type).collect()}
    uplifts = [r["uplift_weekly"] for r in u.collect() if r["campaign_type"] == "TypeA"]
    m = sum(uplifts) / 12
    sd = (sum((x - m) ** 2 for x in uplifts) / 11) ** 0.5
    assert tests["TypeA"]["t_stat"] == pytest.approx(m / (sd / 12**0.5))


def test_single_row_has_no_test(make_tables, params):
    u = uplift_of(
        make_tables, params, [line(1, 1, 90, 8), line(1, 2, 101, 30)], [(1, 1)],
        [("TypeA", 1, 100, 114)],
    )
    row = campaign.campaign_roi(campaign.uplift_by_type(u), params).first()
    assert row["p_value"] is None and row["significant"] == 0


def test_uplift_joins_without_nested_loops(make_tables, params):
    u = uplift_of(make_tables, params, [line(1, 1, 90, 8)], [(1, 1)], [("TypeA", 1, 100, 114)])
    plan = u._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_coupon_days(make_tables, params):
    t = make_tables(
        transactions=[line(1, 1, 5, 10), line(1, 2, 5, 30), line(1, 3, 6, 6), line(2, 4, 5, 8)],
        coupon_redemptions=[(1, 5, 77, 1), (1, 5, 78, 1), (9, 5, 79, 1)],
        campaign_assignments=[("TypeA", 1, 1), ("TypeA", 1, 2), ("TypeB", 2, 3)],
    )
    days = basket.household_days(basket.basket_fact(t.transactions, params))
    row = campaign.coupon_day_uplift(days, t.coupon_redemptions).first()
    assert (row["coupon_avg"], row["regular_avg"], row["uplift"]) == (20.0, 7.0, 13.0)
    rate = campaign.coupon_redemption_rate(t.campaign_assignments, t.coupon_redemptions).first()
    assert tuple(rate) == (2, 2, 100.0)


def test_running_campaigns_per_week(spark):
    weekly = spark.createDataFrame([(w, float(w)) for w in (1, 2, 3, 9)], "week_no int, total_spend double")
    ranges = campaign.campaign_week_ranges(spark.createDataFrame(
        [("TypeA", 1, 7, 8), ("TypeC", 2, 14, 21)],
        "description string, campaign int, start_day int, end_day int",
    ))
    found = campaign.campaign_active_weeks(weekly, ranges)
    assert rows(found, "week_no", "n_active", "n_typea", "n_typec") == [
        (1, 1, 1, 0), (2, 2, 1, 1), (3, 1, 0, 1), (9, 0, 0, 0),
    ]
