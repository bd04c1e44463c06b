"""Session settings for a run of a known input size."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024

# What a task that joins and groups lines takes at once. A sort and the hash maps behind it need 20 to 30
# times the bytes that were read or shuffled, so the usual 64 MB of a merged partition ask for 1.5 GB.
SCAN_BYTES = 4 * 1024 * 1024  # stored bytes of the fact tables to one shuffle partition
MERGED_BYTES = 8 * 1024 * 1024  # shuffled bytes that small partitions are merged to
MOST_SMALL_PARTITIONS = 10_000  # beyond, partitions grow to TARGET_PARTITION_BYTES and sorts spill


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Enough partitions to keep each near 128 MB, at least two waves, rounded up to whole waves."""
    wanted = max(-(-input_bytes // TARGET_PARTITION_BYTES), 2 * cores)
    return -(-wanted // cores) * cores


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes below a folder, as its file system counts them."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    return system.getContentSummary(path).getLength()


def file_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of a file or folder, 0 where there is none."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    return system.getContentSummary(path).getLength() if system.exists(path) else 0


def size_shuffles(spark: SparkSession, folder: str, cores: int = 0, input_bytes: int = 0) -> int:
    """Set the number of shuffle partitions from the size of the input; cores default to the cluster's."""
    wanted = shuffle_partitions(
        input_bytes or folder_bytes(spark, folder), cores or spark.sparkContext.defaultParallelism
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


# What the jobs count on: run-time replanning, and splitting of a partition that one hot key fills,
# also where the aggregation behind the join would have liked to keep its partitioning.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def split_hot_partitions(spark: SparkSession) -> None:
    """Turn the skew settings on in a session that was built elsewhere, and keep merged partitions small."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    own = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]
    spark.conf.set(key, str(min(own, MERGED_BYTES)))


def bound_tasks(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions with the input, so that what a task holds does not grow;
    a session that already asks for more keeps its own. Returns the number."""
    wanted = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        min(-(-input_bytes // SCAN_BYTES), MOST_SMALL_PARTITIONS),
        -(-input_bytes // TARGET_PARTITION_BYTES),
    )
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def build_session(
    app: str = "tillroll",
    master: str | None = None,
    input_bytes: int = 0,
    cores: int = 8,
    checkpoint_dir: str | None = None,
    driver_memory: str | None = None,
) -> SparkSession:
    """A session with run-time replanning on; AQE merges partitions that turn out small."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores)),
        **SKEW_SETTINGS,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
