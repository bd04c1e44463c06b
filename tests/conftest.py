import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillroll.params import Params  # noqa: E402
from tillroll.schema import RAW_COLUMNS, RetailTables  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ddl(table):
    return ", ".join(f"{c} {t.simpleString()}" for c, t in RAW_COLUMNS[table].items())


def line(household, basket, day, value, product=1, quantity=1, disc=0):
    """One transaction line."""
    return (
        household, basket, day, (day - 1) // 7 + 1, product, quantity, Decimal(str(value)),
        Decimal(str(disc)), Decimal(0), Decimal(0), 1,
    )


@pytest.fixture
def make_tables(spark):
    """Retail tables from tiny row lists; tables not given are empty."""
    def make(**rows):
        return RetailTables(**{
            t: spark.createDataFrame(rows.get(t, []), ddl(t)) for t in RAW_COLUMNS
        })

    return make


@pytest.fixture
def params():
    return Params(ref_date="2013-01-01", min_cohort_size=1)


def rows(frame, *columns):
    return [tuple(r[c] for c in columns) for r in frame.collect()]


