"""Retail tables derived from a customer / orders / lineitem / part star schema.

Stands in for a loyalty-card export: an order is a basket, a customer a household, a part a product.
Every order and line is used. Key arithmetic only decides which households have demographics and which
were sent a campaign, because real panels cover both in part.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..params import Params
from ..schema import AGE_MIDPOINT, INCOME_MIDPOINT, MONEY, RetailTables
from ..session import bound_tasks, file_bytes, split_hot_partitions

STAR_PARAMS = Params(
    ref_date="1995-01-01", max_day=2405, cal_end_day=1202, half_day=601,
    churn_window=365, pre_weeks=26,
)

# Columns read from each table; declared, so that no job is spent on schema inference.
STAR_SCHEMA = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
                "l_extendedprice double, l_discount double",
    "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}

# Campaign ids by mailer type.
TYPE_A = [8, 13, 18, 26, 30]
TYPE_C = [3, 6, 14, 15, 20, 27]
N_CAMPAIGNS = 30


def _labels(names) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


CAMPAIGN_TYPE = (
    f"CASE WHEN campaign IN ({', '.join(map(str, TYPE_A))}) THEN 'TypeA' "
    f"WHEN campaign IN ({', '.join(map(str, TYPE_C))}) THEN 'TypeC' ELSE 'TypeB' END"
)


def read_star(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMA[table]).parquet(f"{folder}/{table}.parquet")


def _day(ref_date: str) -> str:
    return f"datediff(CAST(o_orderdate AS DATE), DATE '{ref_date}') + 1"


def transactions(lines: DataFrame, orders: DataFrame, ref_date: str) -> DataFrame:
    """Prices are whole cents and discounts whole percents: their products stay integers until one
    shift of the decimal point makes them money."""
    priced = lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "*",
        f"{_day(ref_date)} AS day",
        "CAST(rint(l_extendedprice * 100) AS BIGINT) AS cents",
        "CAST(rint(l_discount * 100) AS BIGINT) AS percent",
    )

    def money(ten_thousandths: str) -> str:
        shifted = f"CAST({ten_thousandths} AS DECIMAL(18,0)) * CAST('0.0001' AS DECIMAL(4,4))"
        return f"CAST({shifted} AS {MONEY.simpleString()})"

    return priced.selectExpr(
        "o_custkey AS household_key",
        "o_orderkey AS basket_id",
        "day",
        "CAST((day - 1) DIV 7 + 1 AS INT) AS week_no",
        "l_partkey AS product_id",
        "CAST(l_quantity AS BIGINT) AS quantity",
        f"{money('cents * (100 - percent)')} AS sales_value",
        f"{money('-(cents * percent * (o_custkey % 5))')} AS retail_disc",
        f"{money('0')} AS coupon_disc",
        f"{money('0')} AS coupon_match_disc",
        "l_suppkey AS store_id",
    )


def households(customer: DataFrame) -> DataFrame:
    """Demographics of every customer."""
    top = len(INCOME_MIDPOINT) - 1
    band = f"CAST(least({top}, greatest(0, floor((c_acctbal + 1000) / 917))) AS INT)"

    def pick(index: str, names) -> str:
        return f"{_labels(names)}[CAST({index} AS INT)]"

    return customer.selectExpr(
        "c_custkey AS household_key",
        f"{pick('c_custkey DIV 3 % 6', AGE_MIDPOINT)} AS age_desc",
        f"{pick(band, INCOME_MIDPOINT)} AS income_desc",
        f"{pick('c_custkey DIV 3 % 3', ['A', 'B', 'U'])} AS marital_status_code",
        "c_mktsegment AS hh_comp_desc",
        f"{pick('c_custkey DIV 3 % 2', ['Homeowner', 'Renter'])} AS homeowner_desc",
        f"{pick('c_custkey DIV 3 % 5', ['1', '2', '3', '4', '5+'])} AS household_size_desc",
    )


def campaign_assignments(customer: DataFrame) -> DataFrame:
    """Seven in ten customers get the campaigns c with (31*key + 17*c) % 5 = 0: six each."""
    return (
        customer.filter("c_custkey % 10 < 7")
        .selectExpr(
            "c_custkey AS household_key", f"explode(sequence(1, {N_CAMPAIGNS})) AS campaign"
        )
        .filter("(household_key * 31 + campaign * 17) % 5 = 0")
        .selectExpr(f"{CAMPAIGN_TYPE} AS description", "household_key", "campaign")
    )


def campaign_descriptions(spark: SparkSession) -> DataFrame:
    return (
        spark.range(1, N_CAMPAIGNS + 1, numPartitions=1)
        .selectExpr("CAST(id AS INT) AS campaign", "CAST(100 + 70 * id AS INT) AS start_day")
        .selectExpr(
            f"{CAMPAIGN_TYPE} AS description", "campaign", "start_day",
            "start_day + 32 + (7 * campaign) % 33 AS end_day",
        )
    )


def coupons(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey + 10000000000 AS coupon_upc", "p_partkey AS product_id",
        f"CAST(p_partkey % {N_CAMPAIGNS} + 1 AS INT) AS campaign",
    )


def coupon_redemptions(orders: DataFrame, ref_date: str) -> DataFrame:
    return orders.filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_custkey AS household_key", f"{_day(ref_date)} AS day",
        "o_orderkey + 10000000000 AS coupon_upc",
        f"CAST(o_orderkey % {N_CAMPAIGNS} + 1 AS INT) AS campaign",
    )


def products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS product_id", "p_type AS department", "p_brand AS brand",
        "p_name AS commodity_desc", "concat_ws('-', p_type, p_size) AS sub_commodity_desc",
    )


def star_tables(spark: SparkSession, folder: str, params: Params = STAR_PARAMS) -> RetailTables:
    folder = folder.rstrip("/")
    split_hot_partitions(spark)
    bound_tasks(spark, sum(file_bytes(spark, f"{folder}/{t}.parquet") for t in ("lineitem", "orders")))
    read = partial(read_star, spark, folder)
    return RetailTables(
        transactions=lambda: transactions(read("lineitem"), read("orders"), params.ref_date),
        households=lambda: households(read("customer")),
        campaign_assignments=lambda: campaign_assignments(read("customer")),
        campaign_descriptions=lambda: campaign_descriptions(spark),
        coupons=lambda: coupons(read("part")),
        coupon_redemptions=lambda: coupon_redemptions(read("orders"), params.ref_date),
        products=lambda: products(read("part")),
    )
