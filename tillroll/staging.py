"""Tables written mid-job, so that several readers share one pass over the facts.

A written table cuts lineage and outlives any executor; readers get column pruning and parquet
statistics, which a cached or checkpointed frame would not give them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local session gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return context.getCheckpointDir()


class Stage:
    """A scratch database in the shared folder: writes each named frame once, hands out the table."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.database = f"stage_{uuid.uuid4().hex}"
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str, build) -> DataFrame:
        """``build`` is called, and its result written, only on the first request for ``name``."""
        if name not in self._tables:
            if not self._tables:
                root = f"{shared_folder(self.spark).rstrip('/')}/{self.database}"
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{root}'")
            build().write.saveAsTable(f"{self.database}.{name}", format="parquet", mode="overwrite")
            self._tables[name] = self.spark.table(f"{self.database}.{name}")
        return self._tables[name]

    def close(self) -> None:
        """Drop the tables and their files; frames that read them cannot run any more."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        self._tables.clear()
