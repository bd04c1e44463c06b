"""Histograms, medians, reference lines, reproducible samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import hash_mod
from .ranking import quantiles


def histogram(frame: DataFrame, value: str, bins: int, upper: float | None = None) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed.

    ``upper`` clips large values first. Empty bins are kept with count 0.
    """
    v = F.col(value).cast("double")
    if upper is not None:
        v = F.least(v, F.lit(float(upper)))
    values = frame.select(v.alias("v")).filter(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).select(
        F.struct(
            F.when(F.col("low") < F.col("high"), F.col("low")).otherwise(F.col("low") - 0.5)
            .alias("low"),
            F.when(F.col("low") < F.col("high"), F.col("high")).otherwise(F.col("high") + 0.5)
            .alias("high"),
        ).alias("span")
    ).scalar()
    low = span.getField("low")
    width = (span.getField("high") - low) / F.lit(float(bins))
    index = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = frame.sparkSession.range(bins, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return (
        edges.join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("low"),
            (low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def medians(frames: dict[str, tuple[DataFrame, str]]) -> list[tuple[str, float | None]]:
    """Exact median per named measure."""
    return [(name, quantiles(f, c, [0.5])[""][0]) for name, (f, c) in frames.items()]


def upper_clip(frame: DataFrame, value: str, probability: float = 0.99) -> float | None:
    """The quantile above which a chart clips its values (P25)."""
    return quantiles(frame, value, [probability])[""][0]


def describe(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, spread and exact quartiles per column, one row per column."""
    numeric = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot([], columns, "measure", "value")
    stats = long.groupBy("measure").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"), F.min("value").alias("low"), F.max("value").alias("high"),
    )
    found = quantiles(long, "value", [0.25, 0.5, 0.75], "measure")
    quartiles = frame.sparkSession.createDataFrame(
        [(m, *row) for m, row in found.items()],
        "measure string, q1 double, median double, q3 double",
    )
    return stats.join(quartiles, "measure", "left")


def sample_rows(frame: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run (S19): each task keeps its n smallest
    hashes and the results are merged."""
    return (
        frame.withColumn("_h", hash_mod(key, 4294967296, seed))
        .orderBy("_h", key).limit(n).drop("_h")
    )
