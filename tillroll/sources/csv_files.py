"""CSV exports of the seven raw tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import OPTIONAL_COLUMNS, RAW_COLUMNS, RetailTables

# File names of the raw export.
FILES = {
    "transactions": "transaction_data.csv",
    "households": "hh_demographic.csv",
    "campaign_assignments": "campaign_table.csv",
    "campaign_descriptions": "campaign_desc.csv",
    "coupons": "coupon.csv",
    "coupon_redemptions": "coupon_redempt.csv",
    "products": "product.csv",
}


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Lower-case the header, keep the declared columns by name, cast them, NaN becomes NULL."""
    frame = frame.toDF(*[c.strip().lower() for c in frame.columns])
    optional = OPTIONAL_COLUMNS.get(table, set())
    picked = []
    for name, dtype in RAW_COLUMNS[table].items():
        if name in frame.columns:
            value = F.col(name)
            if frame.schema[name].dataType.simpleString() in ("double", "float"):
                value = F.nanvl(value, F.lit(None))
            picked.append(value.cast(dtype).alias(name))
        elif name not in optional:
            raise ValueError(f"{table}: column {name} is missing")
    return frame.select(*picked)


def read_csv_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Only the header line is read up front; types come from the declared schema, by name."""
    frame = (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("nanValue", "NaN")
        .csv(path)
    )
    return conform(frame.replace("NaN", None), table)


def read_csv_tables(spark: SparkSession, folder: str) -> RetailTables:
    folder = folder.rstrip("/")
    return RetailTables(
        **{t: partial(read_csv_table, spark, f"{folder}/{name}", t) for t, name in FILES.items()}
    )
