import pytest
from pyspark.sql import functions as F

from conftest import line
from tillroll.operators import basket, skew


@pytest.fixture
def lines(spark):
    """Two fifths of the lines sell product 7; some know no product."""
    return spark.range(20_000).selectExpr(
        "id % 500 AS household_key", "id AS basket_id",
        "CASE WHEN id % 5 < 2 THEN 7 WHEN id % 97 = 0 THEN NULL ELSE id % 300 END AS product_id",
        "CAST(1 AS DECIMAL(18,4)) AS sales_value",
    )


@pytest.fixture
def products(spark):
    return spark.range(250).selectExpr(
        "id AS product_id", "concat('D', id % 9) AS department", "concat('B', id % 4) AS brand"
    )


def totals(frame):
    return {(r[0], r[1]): r[2] for r in frame.groupBy("department", "brand").agg(F.count("*")).collect()}


def test_heavy_keys_are_found(lines):
    assert skew.heavy_keys(lines, "product_id", 0.1) == [7]
    assert skew.heavy_keys(lines.filter("false"), "product_id", 0.1) == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_one(lines, products, how):
    plain = lines.join(products, "product_id", how)
    salted = skew.join_dimension(
        lines, products, "product_id", ["household_key", "basket_id"], how, broadcast_rows=0
    )
    assert totals(salted) == totals(plain) and set(salted.columns) == set(plain.columns)
    assert totals(skew.join_dimension(lines, products, "product_id", ["basket_id"], how)) == totals(plain)


def test_a_hot_product_spreads_over_tasks(spark, lines, products, monkeypatch):
    """Without broadcasts and run-time help no task gets more than a part of the hot product."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        salted = skew.join_dimension(
            lines, products, "product_id", ["household_key", "basket_id"], broadcast_rows=0
        )
        per_task = [r["count"] for r in salted.filter("product_id = 7").groupBy(
            F.spark_partition_id()
        ).count().collect()]
        assert len(per_task) >= 12 and max(per_task) < sum(per_task) / 4
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
        plan = basket.household_departments(lines, products)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert plan.count("Exchange hashpartitioning(household_key") == 1  # the roll-up
        assert plan.count("Exchange hashpartitioning(product_id") == 2  # lines and products, once each
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_dimensions_leave_the_lines_where_they_are(lines, products):
    plan = basket.household_departments(lines, products)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_labels_of_unmatched_lines(make_tables):
    t = make_tables(
        transactions=[line(1, 1, 1, 5, product=1), line(1, 2, 1, 7, product=99)],
        products=[(1, "GROCERY", "National", "x", "y")],
    )
    found = {r["department"]: r["sales_value"]
             for r in basket.household_departments(t.transactions, t.products).collect()}
    assert found == {"GROCERY": 5, None: 7}
    assert basket.labelled_lines(t.transactions, t.products, "inner").count() == 1
