import pytest
from pyspark.sql import functions as F

from tillroll.functions.numeric import hash_mod, ratio_or, round_half_even
from tillroll.functions.student_t import two_sided_p


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value,expected", [(0.125, 0.12), (0.375, 0.38), (-0.125, -0.12), (2.0, 2.0)])
def test_result_tables_round_half_to_even(spark, value, expected):
    assert one(spark, round_half_even(F.lit(value), 2)) == expected


def test_views_round_half_up(spark):
    assert float(spark.sql("SELECT round(CAST(0.125 AS DECIMAL(18,4)), 2) x").first()["x"]) == 0.13


def test_guarded_ratio(spark):
    assert one(spark, ratio_or(F.lit(6), F.lit(3), 9.0)) == 2.0
    assert one(spark, ratio_or(F.lit(6), F.lit(0), 9.0)) == 9.0
    assert one(spark, ratio_or(F.lit(6), F.lit(None).cast("double"), 9.0)) == 9.0


@pytest.mark.parametrize(
    "t,n,p",
    [
        (12.706, 2, 0.05), (4.303, 3, 0.05), (2.228, 11, 0.05), (-2.228, 11, 0.05),
        (3.169, 11, 0.01), (1.984, 101, 0.05), (1.959964, 10**6, 0.05), (0.0, 30, 1.0),
        (60.0, 500, 0.0),
    ],
)
def test_p_values_match_tables(spark, t, n, p):
    assert one(spark, two_sided_p(F.lit(t), F.lit(n))) == pytest.approx(p, abs=5e-5)


def test_p_value_needs_two_rows(spark):
    assert one(spark, two_sided_p(F.lit(1.0), F.lit(1))) is None


def test_hashes_with_different_seeds_are_unrelated(spark):
    frame = spark.range(1, 20_001).select(
        (hash_mod("id", 100, 43) < 15).alias("a"), (hash_mod("id", 100, 44) < 20).alias("b")
    )
    row = frame.agg(
        F.avg(F.col("a").cast("int")).alias("a"), F.avg(F.col("b").cast("int")).alias("b"),
        F.avg((F.col("a") & F.col("b")).cast("int")).alias("both"),
    ).first()
    assert row["a"] == pytest.approx(0.15, abs=0.01)
    assert row["b"] == pytest.approx(0.20, abs=0.01)
    assert row["both"] == pytest.approx(0.03, abs=0.01)
    big = spark.createDataFrame([(2**62,)], "id long").select(hash_mod("id", 5).alias("x"))
    assert 0 <= big.first()["x"] < 5
