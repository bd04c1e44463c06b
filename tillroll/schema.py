"""Explicit schemas of the raw tables and the fixed value lists of the analysis."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType

MONEY = DecimalType(18, 4)

RAW_COLUMNS = {
    "transactions": {
        "household_key": LongType(), "basket_id": LongType(), "day": IntegerType(),
        "week_no": IntegerType(), "product_id": LongType(), "quantity": LongType(),
        "sales_value": MONEY, "retail_disc": MONEY, "coupon_disc": MONEY,
        "coupon_match_disc": MONEY, "store_id": LongType(),
    },
    "households": {
        "household_key": LongType(), "age_desc": StringType(), "income_desc": StringType(),
        "marital_status_code": StringType(), "hh_comp_desc": StringType(),
        "homeowner_desc": StringType(), "household_size_desc": StringType(),
    },
    "campaign_assignments": {
        "description": StringType(), "household_key": LongType(), "campaign": IntegerType(),
    },
    "campaign_descriptions": {
        "description": StringType(), "campaign": IntegerType(),
        "start_day": IntegerType(), "end_day": IntegerType(),
    },
    "coupons": {
        "coupon_upc": LongType(), "product_id": LongType(), "campaign": IntegerType(),
    },
    "coupon_redemptions": {
        "household_key": LongType(), "day": IntegerType(), "coupon_upc": LongType(),
        "campaign": IntegerType(),
    },
    "products": {
        "product_id": LongType(), "department": StringType(), "brand": StringType(),
        "commodity_desc": StringType(), "sub_commodity_desc": StringType(),
    },
}

# Columns a source may lack without the load failing.
OPTIONAL_COLUMNS = {
    "households": {
        "age_desc", "income_desc", "marital_status_code", "hh_comp_desc",
        "homeowner_desc", "household_size_desc",
    },
}

# Labels in display order and the bracket midpoints (thousands of dollars, years).
RFM_ORDER = ["Champions", "Loyal", "At Risk", "Lost"]
CAMPAIGN_TYPES = ["TypeA", "TypeB", "TypeC"]
INCOME_MIDPOINT = {
    "Under 15K": 12.5, "15-24K": 19.5, "25-34K": 29.5, "35-49K": 42.0,
    "50-74K": 62.0, "75-99K": 87.0, "100-124K": 112.0, "125-149K": 137.0,
    "150-174K": 162.0, "175-199K": 187.0, "200-249K": 224.0, "250K+": 275.0,
}
AGE_MIDPOINT = {
    "19-24": 21.5, "25-34": 29.5, "35-44": 39.5, "45-54": 49.5, "55-64": 59.5, "65+": 70.0,
}
DISCOUNT_BUCKETS = [
    (0.05, "<5%"), (0.10, "5-10%"), (0.15, "10-15%"), (0.20, "15-20%"), (1.01, "20%+"),
]


class RetailTables:
    """The seven raw inputs of an analysis; a table given as a function is built on first use."""

    transactions: DataFrame
    households: DataFrame
    campaign_assignments: DataFrame
    campaign_descriptions: DataFrame
    coupons: DataFrame
    coupon_redemptions: DataFrame
    products: DataFrame

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        missing = RAW_COLUMNS.keys() - sources.keys()
        if missing:
            raise ValueError(f"missing tables: {sorted(missing)}")
        self._sources = sources

    def __getattr__(self, name: str) -> DataFrame:
        if name not in RAW_COLUMNS:
            raise AttributeError(name)
        source = self._sources[name]
        frame = source if isinstance(source, DataFrame) else source()
        setattr(self, name, frame)
        return frame

    def items(self):
        return [(name, getattr(self, name)) for name in RAW_COLUMNS]
