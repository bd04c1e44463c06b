import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import line, rows
from tillroll.schema import RetailTables
from tillroll.plans.presets import export_csv, query
from tillroll.plans.views import register_views
from tillroll.session import folder_bytes, size_shuffles
from tillroll.sources.csv_files import FILES, read_csv_tables
from tillroll.sources.store import Store, buyer_segments_of, in_display_order, publish
from tillroll.staging import Stage, shared_folder

CSV = {
    "transactions": "HOUSEHOLD_KEY,BASKET_ID,DAY,PRODUCT_ID,QUANTITY,SALES_VALUE,STORE_ID,"
                    "RETAIL_DISC,TRANS_TIME,WEEK_NO,COUPON_DISC,COUPON_MATCH_DISC\n"
                    "1,10,3,100,2,1.39,364,-0.6,1631,1,0,0\n",
    "households": "AGE_DESC,INCOME_DESC,household_key\n65+,NaN,1\n,35-49K,2\n",
    "campaign_assignments": "DESCRIPTION,household_key,CAMPAIGN\nTypeA,1,26\n",
    "campaign_descriptions": "DESCRIPTION,CAMPAIGN,START_DAY,END_DAY\nTypeB,24,659,719\n",
    "coupons": "COUPON_UPC,PRODUCT_ID,CAMPAIGN\n10000089061,27160,4\n",
    "coupon_redemptions": "household_key,DAY,COUPON_UPC,CAMPAIGN\n1,421,10000085364,8\n",
    "products": "PRODUCT_ID,MANUFACTURER,DEPARTMENT,BRAND,COMMODITY_DESC,SUB_COMMODITY_DESC\n"
                "100,2,GROCERY,National,ICE,CUBES\n",
}


def write_csv(folder, **changed):
    for table, name in FILES.items():
        (folder / name).write_text(changed.get(table, CSV[table]))


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    write_csv(tmp_path)
    t = read_csv_tables(spark, str(tmp_path))
    row = t.transactions.first()
    assert row["week_no"] == 1 and float(row["sales_value"]) == 1.39 and row["store_id"] == 364
    assert "trans_time" not in t.transactions.columns
    assert sorted(rows(t.households, "household_key", "age_desc", "income_desc")) == [
        (1, "65+", None), (2, None, "35-49K"),
    ]
    assert dict(t.products.dtypes)["product_id"] == "bigint"


def test_a_missing_required_column_is_an_error(spark, tmp_path):
    write_csv(tmp_path, products="PRODUCT_ID,BRAND\n1,x\n")
    with pytest.raises(ValueError, match="department"):
        read_csv_tables(spark, str(tmp_path)).products


@pytest.fixture
def store(spark, request, tmp_path):
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    yield Store(spark, name, f"{tmp_path}/tables")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_raw_tables_load_once(spark, store, make_tables):
    first = make_tables(transactions=[line(1, 1, 1, 5)])
    second = make_tables(transactions=[line(1, 1, 1, 5), line(2, 2, 1, 5)])
    assert store.load_raw(first, buckets=4)
    assert not store.load_raw(second)
    assert store.raw().transactions.count() == 1
    assert store.load_raw(second, force_rebuild=True, buckets=4)
    assert store.raw().transactions.count() == 2
    plan = store.raw().transactions.groupBy("household_key").count()._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


def broken(frame):
    """The frame with a row that fails while it is written."""
    bad = frame.limit(1).select(*(
        F.when(F.col(frame.columns[0]).isNotNull(), F.raise_error(F.lit("power cut"))).cast(frame.schema[0].dataType)
        .alias(frame.columns[0]), *frame.columns[1:],
    ))
    return frame.union(bad)


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_failed_write_leaves_the_table_as_it_was(spark, store, make_tables, buckets):
    store.load_raw(make_tables(transactions=[line(1, 1, 1, 5)]), buckets=buckets)
    before = store.raw().transactions
    many = make_tables(transactions=[line(k, k, 1, 5) for k in range(1, 40)])
    with pytest.raises(Exception, match="power cut"):
        store.load_raw(
            RetailTables(**{**dict(many.items()), "transactions": broken(many.transactions)}),
            force_rebuild=True, buckets=buckets,
        )
    assert store.raw().transactions.count() == 1
    other = Store(spark, f"{store.database}_other", store.root)  # as another process sees it
    assert other.raw().transactions.count() == 1
    store.load_raw(many, force_rebuild=True, buckets=buckets)
    assert store.raw().transactions.count() == other.raw().transactions.count() == 39
    assert before.count() == 1  # a reader stays with its snapshot
    spark.sql(f"DROP DATABASE {other.database} CASCADE")


def test_old_snapshots_go(spark, store):
    for k in range(5):
        store.write("weekly_trend", spark.range(k + 1).withColumnRenamed("id", "week_no"))
    assert len(store.snapshots("weekly_trend")) == 2
    assert store.read("weekly_trend").count() == 5


def test_a_range_of_days_reaches_the_scan(spark, store, make_tables):
    store.load_raw(make_tables(transactions=[line(1, k, k, 5) for k in range(1, 50)]))
    some = store.raw().transactions.filter("day BETWEEN 3 AND 5")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,3)" in plan and some.count() == 3


LAYOUT_RUNS = """
import sys
from decimal import Decimal
from pyspark.sql import SparkSession
from tillroll.schema import RAW_COLUMNS, RetailTables
from tillroll.sources.store import Store
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.warehouse.dir", sys.argv[1] + "/" + sys.argv[2]).getOrCreate()
store = Store(spark, "laid_out", sys.argv[1] + "/tables")
if sys.argv[2] == "first":
    tables = {t: spark.createDataFrame([], ", ".join(f"{c} {k.simpleString()}" for c, k in cs.items()))
              for t, cs in RAW_COLUMNS.items()}
    tables["transactions"] = spark.createDataFrame(
        [(k % 9, k, k, 1, 1, 1, *[Decimal(1)] * 4, 1) for k in range(1, 200)], tables["transactions"].schema)
    store.load_raw(RetailTables(**tables), buckets=4)
found = store.raw().transactions.groupBy("household_key").count()
print("PLAN", "Exchange" in found._jdf.queryExecution().executedPlan().toString(), found.count())
"""


def test_another_process_reads_the_recorded_layout(tmp_path):
    repo = Path(__file__).resolve().parent.parent
    for run in ("first", "second"):
        said = subprocess.run(
            [sys.executable, "-c", LAYOUT_RUNS, str(tmp_path), run], cwd=repo, capture_output=True, text=True,
            timeout=180,
        ).stdout.split()
        assert said == ["PLAN", "False", "9"], run


TWO_RUNS = """
import sys
from pyspark.sql import SparkSession
from tillroll.schema import RAW_COLUMNS, RetailTables
from tillroll.sources.store import Store
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.sql.warehouse.dir", sys.argv[1] + "/other").getOrCreate()
empty = {t: spark.createDataFrame([], ", ".join(f"{c} {k.simpleString()}" for c, k in cs.items()))
         for t, cs in RAW_COLUMNS.items()}
store = Store(spark, "lasting", sys.argv[1] + "/tables")
print("READY", store.ready(), store.load_raw(RetailTables(**empty)))
store.write("rfm_segments", spark.range(3).withColumnRenamed("id", "household_key"))
print("ROWS", store.read("rfm_segments").count(), store.raw().transactions.count())
"""


def test_tables_outlast_the_process(tmp_path):
    repo = Path(__file__).resolve().parent.parent
    said = [
        subprocess.run(
            [sys.executable, "-c", TWO_RUNS, str(tmp_path)], cwd=repo, capture_output=True, text=True, timeout=120
        ).stdout.split() for _ in range(2)
    ]
    assert said[0] == ["READY", "False", "True", "ROWS", "3", "0"]
    assert said[1] == ["READY", "True", "False", "ROWS", "3", "0"]


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    (tmp_path / "part").write_bytes(bytes(1 << 20))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert folder_bytes(spark, str(tmp_path)) == 1 << 20
        assert size_shuffles(spark, str(tmp_path), cores=4) == 8
        assert size_shuffles(spark, str(tmp_path), cores=100, input_bytes=10**14) == 745_100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_results_are_replaced_and_tolerate_missing_columns(spark, store):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {store.database}")
    assert not store.ready()
    frame = spark.createDataFrame([(1, "Loyal", 9, 1)], "household_key long, rfm_segment string, junk int, campaign_engaged int")
    store.write("rfm_segments", frame)
    store.write("rfm_segments", frame)
    assert store.ready()
    assert store.read("rfm_segments").columns == ["household_key", "rfm_segment", "campaign_engaged"]
    assert store.read("rfm_segments").count() == 1


def test_publish_copies_and_derives_buyer_segments(spark, store, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {store.database}")
    store.write("rfm_segments", spark.createDataFrame(
        [(1, 5.0, 2, 1), (2, 6.0, 3, 0)],
        "household_key long, total_spend double, n_baskets long, campaign_engaged int",
    ))
    done = publish(store, lambda f, n: f.write.mode("overwrite").parquet(f"{tmp_path}/{n}"))
    assert done == ["rfm_segments", "buyer_segments"]
    assert sorted(rows(spark.read.parquet(f"{tmp_path}/buyer_segments"), "household_key", "buyer_type")) == [
        (1, "Campaign"), (2, "Organic"),
    ]


def test_unknown_engagement_gives_no_buyer_type(spark):
    frame = spark.createDataFrame([(1, 1.0, 1, None)], "household_key long, total_spend double, n_baskets long, campaign_engaged int")
    assert rows(buyer_segments_of(frame), "buyer_type") == [(None,)]


def test_display_order(spark):
    frame = spark.createDataFrame([(f"d{i:02d}", float(i)) for i in range(12)], "department string, total_spend double")
    shown = rows(in_display_order(frame, "category_spend"), "department")
    assert shown == [(f"d{i:02d}",) for i in range(11, 1, -1)]


def test_views_and_free_sql(spark, make_tables, params, tmp_path):
    register_views(spark, make_tables(
        transactions=[line(1, 1, 3, "0.125"), line(1, 2, 9, 2), line(2, 3, 9, 4, product=9)],
        products=[(1, "GROCERY", "National", "", "")],
        campaign_assignments=[("TypeA", 1, 1), ("TypeA", 1, 2)],
    ), params)
    summary = query(spark, "SELECT * FROM customer_summary WHERE household_key = 1;").first()
    assert (summary["total_spend"], summary["n_baskets"], summary["recency_days"]) == (2.13, 2, 702)
    assert summary["avg_basket"] == 1.06
    category = query(spark, "SELECT * FROM category_spend").collect()
    assert [(r["department"], r["n_baskets"], r["n_households"]) for r in category] == [("GROCERY", 2, 1)]
    buyers = query(spark, "SELECT household_key, buyer_type FROM buyer_segments ORDER BY 1")
    assert rows(buyers, "buyer_type") == [("Campaign",), ("Organic",)]
    export_csv(buyers, f"{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 2


def test_stage_writes_once_under_the_shared_folder(spark):
    calls = []
    stage = Stage(spark)

    def build():
        calls.append(1)
        return spark.range(3)

    assert stage.table("t", build).count() == 3
    assert stage.table("t", build).count() == 3
    assert len(calls) == 1
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    where = spark.sql(f"DESCRIBE DATABASE {stage.database}").collect()
    assert any(shared_folder(spark) in str(r) for r in where)
    stage.close()
    assert not spark.catalog.databaseExists(stage.database)


def test_shuffles_of_star_queries_grow_with_the_stored_lines(spark, tmp_path):
    from tillroll.session import MERGED_BYTES, MOST_SMALL_PARTITIONS, bound_tasks
    from tillroll.sources.star import star_tables

    partitions, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key) for key in (partitions, merged)}
    try:
        spark.conf.set(partitions, "4")
        for given, kept in (("64MB", MERGED_BYTES), ("1m", 1 << 20), ("67108864b", MERGED_BYTES)):
            spark.conf.set(merged, given)
            star_tables(spark, str(tmp_path))
            assert (spark.conf.get(partitions), spark.conf.get(merged)) == ("4", str(kept))
        for table in ("lineitem", "orders", "part"):
            (tmp_path / f"{table}.parquet").write_bytes(bytes(10 << 20))
        star_tables(spark, f"{tmp_path}/")
        assert spark.conf.get(partitions) == "5"
        assert bound_tasks(spark, 1 << 30) == 256 and bound_tasks(spark, 0) == 256
        assert bound_tasks(spark, 10**12) == MOST_SMALL_PARTITIONS
        assert bound_tasks(spark, 10**13) == 74_506
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
