"""Saved tables: raw loads, result tables, copies to another store.

Every write is a new snapshot in a folder of its own; a table is its newest snapshot that was committed
whole. A run that fails halfway leaves the one before in place, for this process and any other, and a
reader that has begun stays with the snapshot it found. The layout of a snapshot (buckets, sorting) is
recorded beside it, so another process reads the table with the same layout.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import RAW_COLUMNS, RetailTables

# Result tables with a declared column list; other tables are written as they are.
RESULT_COLUMNS = {
    "rfm_segments": [
        "household_key", "rfm_segment", "rfm_score", "r_score", "f_score", "m_score",
        "recency_days", "n_baskets", "total_spend", "avg_basket", "tenure_days",
        "campaign_engaged", "predicted_clv", "churn_probability", "is_churned",
    ],
    "clv_predictions": [
        "household_key", "predicted_clv", "actual_y2_spend", "abs_error", "in_test_set",
    ],
    "churn_scores": [
        "household_key", "churn_probability", "is_churned", "rfm_segment", "predicted_clv",
    ],
    "feature_importance": ["feature", "importance"],
    "financial_scenarios": [
        "scenario", "n_households", "mailer_cost", "incremental_revenue", "revenue_roi",
        "cost_saving",
    ],
}
RESULT_TABLES = [
    "rfm_segments", "clv_predictions", "clv_metrics", "feature_importance", "churn_scores",
    "campaign_roi", "campaign_uplift_detail", "cohort_results", "financial_scenarios",
    "cohort_retention", "weekly_trend", "monthly_segment_spend", "demographics_income",
    "demographics_age", "demographics_hh_comp", "clv_by_income", "brand_by_segment",
    "category_by_segment", "acquisition_trend", "acquisition_by_segment",
    "campaign_week_ranges", "discount_sensitivity",
]

# How each result table is read for display: sort columns and an optional row limit.
DISPLAY_ORDER = {
    "feature_importance": ([("importance", False), ("feature", True)], None),
    "campaign_roi": ([("revenue_roi", False), ("campaign_type", True)], None),
    "cohort_results": ([("first_quarter", True)], None),
    "category_spend": ([("total_spend", False), ("department", True)], 10),
    "cohort_retention": ([("cohort_month", True), ("months_since", True)], None),
    "weekly_trend": ([("week_no", True)], None),
    "monthly_segment_spend": ([("cal_month", True), ("rfm_segment", True)], None),
    "category_by_segment": (
        [("total_spend", False), ("rfm_segment", True), ("department", True)], None,
    ),
    "acquisition_trend": ([("first_cal_month", True)], None),
    "acquisition_by_segment": ([("first_cal_month", True), ("rfm_segment", True)], None),
}


def in_display_order(frame: DataFrame, name: str) -> DataFrame:
    if name not in DISPLAY_ORDER:
        return frame
    keys, limit = DISPLAY_ORDER[name]
    ordered = frame.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])
    return ordered if limit is None else ordered.limit(limit)


LAYOUT = "buckets int, bucket_by array<string>, sort_by array<string>"
KEPT = 2  # snapshots of a table; older ones go when a new one is committed


class Store:
    """One database of raw and result tables, each a series of snapshots below ``root``.

    ``root`` must be a folder that every executor reaches; by default it lies in the warehouse. The
    catalog only names the current snapshots: entries are made when a table is asked for.
    """

    def __init__(self, spark: SparkSession, database: str = "default", root: str | None = None):
        self.spark = spark
        self.database = database
        self.root = (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/{database}.tables").rstrip("/")
        local = "://" not in self.root and not self.root.startswith("file:")
        if root and (local or root.startswith("file:")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{root} is local to one machine: name a folder every executor can reach")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _path(self, place: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(place)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def snapshots(self, table: str) -> list[str]:
        """Committed snapshots, oldest first."""
        folder, system = self._path(f"{self.root}/{table}")
        if not system.exists(folder):
            return []
        names = sorted(f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory())
        return [
            n for n in names
            if n.startswith("data-") and system.exists(self._path(f"{self.root}/{table}/{n}/_SUCCESS")[0])
        ]

    def _layout(self, table: str, snapshot: str) -> tuple[int, list[str], list[str]]:
        place = f"{self.root}/{table}/{snapshot.replace('data-', 'layout-')}"
        row = self.spark.read.schema(LAYOUT).json(place).first()
        return row["buckets"], row["bucket_by"], row["sort_by"]

    def _register(self, table: str, snapshot: str) -> None:
        """Point the catalog entry at a snapshot, with its layout; nothing is read but the schema."""
        name, place = self.name(table), f"{self.root}/{table}/{snapshot}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        if self.spark.catalog.tableExists(name):
            found = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
            if ("snapshot", snapshot) in {(r["key"], r["value"]) for r in found}:
                return
            self.spark.sql(f"DROP TABLE {name}")  # the entry; files outside the catalog stay
        buckets, bucket_by, sort_by = self._layout(table, snapshot)
        schema = self.spark.read.parquet(place).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        clustered = ""
        if buckets:
            by = f"CLUSTERED BY ({', '.join(bucket_by)})"
            clustered = f"{by} SORTED BY ({', '.join(sort_by)}) INTO {buckets} BUCKETS"
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {clustered} LOCATION '{place}'"
            f" TBLPROPERTIES ('snapshot' = '{snapshot}')"
        )

    def _save(
        self, frame: DataFrame, table: str, buckets: int = 0, bucket_by: list[str] | None = None,
        sort_by: list[str] | None = None,
    ) -> None:
        """Write a snapshot beside the others; the commit of its last file makes it the table."""
        bucket_by, sort_by = bucket_by or [], sort_by or []
        number = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        place = f"{self.root}/{table}"
        self.spark.createDataFrame(
            [(buckets, bucket_by, sort_by)], LAYOUT
        ).coalesce(1).write.json(f"{place}/layout-{number}")
        target = f"{place}/data-{number}"
        if buckets:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
            beside = self.name(f"{table}_{uuid.uuid4().hex[:8]}")
            try:
                frame.write.bucketBy(buckets, *bucket_by).sortBy(*sort_by).option(
                    "path", target
                ).saveAsTable(beside)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
        else:
            laid_out = frame.sortWithinPartitions(*sort_by) if sort_by else frame
            laid_out.write.parquet(target)
        for old in self.snapshots(table)[:-KEPT]:
            for folder in (old, old.replace("data-", "layout-")):
                path, system = self._path(f"{place}/{folder}")
                system.delete(path, True)

    def has(self, table: str) -> bool:
        found = self.snapshots(table)
        if found:
            self._register(table, found[-1])
        return bool(found)

    def ready(self) -> bool:
        """True once an analysis has been written."""
        return self.has("rfm_segments")

    def load_raw(self, tables: RetailTables, force_rebuild: bool = False, buckets: int = 0) -> bool:
        """Write the raw tables once; False when they were already there.

        Transactions are sorted by day inside their files, so the file statistics let a range of days
        skip what lies outside it. With ``buckets`` they are also laid out by household, so every
        household-keyed aggregation and join of a later run starts without a shuffle.
        """
        if not force_rebuild and all(self.has(t) for t in RAW_COLUMNS):
            return False
        for table, frame in tables.items():
            lines = table == "transactions"
            self._save(
                frame, table, buckets if lines else 0,
                ["household_key"] if lines and buckets else [], ["day"] if lines else [],
            )
        return True

    def raw(self) -> RetailTables:
        return RetailTables(**{t: self.table(t) for t in RAW_COLUMNS})

    def table(self, table: str) -> DataFrame:
        """The current snapshot; a frame made earlier stays with the one it was made from."""
        if not self.has(table):
            raise ValueError(f"no table {table} in {self.root}")
        return self.spark.table(self.name(table))

    def write(self, table: str, frame: DataFrame) -> None:
        """Replace a result table; a declared column the frame lacks is left out."""
        if table in RESULT_COLUMNS:
            frame = frame.select(*[c for c in RESULT_COLUMNS[table] if c in frame.columns])
        self._save(frame, table)

    def read(self, table: str) -> DataFrame:
        return in_display_order(self.table(table), table)


def buyer_segments_of(rfm_segments: DataFrame) -> DataFrame:
    """Buyer type from the engagement flag."""
    engaged = F.col("campaign_engaged").cast("int")
    return rfm_segments.select(
        "household_key", "total_spend", "n_baskets",
        F.when(engaged == 1, "Campaign").when(engaged == 0, "Organic").alias("buyer_type"),
    )


def publish(
    store: Store, write: Callable[[DataFrame, str], None], extra: Iterable[str] = ("category_spend",)
) -> list[str]:
    """Copy every result table through ``write(frame, name)``, then derive buyer_segments.

    ``write`` is any Spark writer: ``lambda f, n: f.write.mode("overwrite").parquet(f"{dst}/{n}")``
    or the same with ``.format("jdbc")``.
    """
    done = []
    for table in [*RESULT_TABLES, *extra]:
        if store.has(table):
            write(store.table(table), table)
            done.append(table)
    write(buyer_segments_of(store.table("rfm_segments")), "buyer_segments")
    return [*done, "buyer_segments"]
