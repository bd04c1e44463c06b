"""Joins of the fact lines with a dimension whose keys are unevenly sold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000  # a dimension of no more rows goes to every task whole
HEAVY_KEYS = 256  # keys the frequency sketch may report
SALTS = 64


def heavy_keys(facts: DataFrame, key: str, share: float, most: int = HEAVY_KEYS) -> list:
    """At most ``most`` keys that may hold at least ``share`` of the rows, from one bounded sketch.

    The sketch reads nothing but the key and never underrates a key by more than its error, so a key
    above the share is reported; one reported in vain costs some copies of its dimension row.
    """
    row = facts.select(F.col(key).alias("k")).filter("k IS NOT NULL").agg(
        F.count("k").alias("n"), F.expr(f"approx_top_k(k, {most}, {20 * most})").alias("top")
    ).first()
    return [t["item"] for t in row["top"] or [] if t["count"] >= share * row["n"]]


def join_dimension(
    facts: DataFrame, dimension: DataFrame, key: str, spread: list[str], how: str = "left",
    broadcast_rows: int | None = None, salts: int = SALTS,
) -> DataFrame:
    """``facts`` with the columns of ``dimension`` (one row per ``key``), however skewed the keys are.

    A dimension of counted, bounded size is broadcast: the facts do not move. A larger one is joined by
    exchange; there the rows of heavy keys are dealt by a salt from the ``spread`` columns, and only
    those keys' dimension rows are copied once per salt.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    if dimension.count() <= limit:
        return facts.join(F.broadcast(dimension), key, how)
    heavy = heavy_keys(facts, key, 1 / (2 * salts))
    is_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    salt = F.when(is_heavy, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return facts.withColumn("_salt", salt).join(
        dimension.withColumn("_salt", F.explode(copies)), [key, "_salt"], how
    ).drop("_salt")
