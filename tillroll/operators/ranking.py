"""Exact global order statistics and quantile groups without a global sort.

A rank window without partitions would put every row into one task. Here a quantile sketch brackets
each wanted rank, one aggregation counts what lies below and inside the brackets, and only the few
distinct values inside are put in order. A rank that turns out to lie outside its bracket is looked
for again in a wider one, the last of which encloses everything, so the sketch decides how little is
sorted, never the result. Groups of all sizes take the same way. Ties on the value are resolved by
the key in the same way, so a value that a third of all rows share is one counter, not one task.
What reaches the driver is one row per group and wanted rank, of at most ``MOST_GROUPS`` groups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

ACCURACY = 10_000
# Half widths of the brackets that are tried one after the other, as shares of a group; after them
# comes one that encloses everything. A rank starts at the first that spans ``SPAN`` ranks.
WIDTHS = (5 / ACCURACY, 0.02, 0.2)
SPAN = 4
MOST_GROUPS = 10_000


@dataclass(frozen=True)
class Cut:
    """The row at one rank: its value, and its key where rows tie on the value."""

    value: Any
    key: Any = None


@dataclass(frozen=True)
class Point:
    """A wanted position: about ``share`` of the way up, exactly at ``rank(n)`` of n rows."""

    share: float
    rank: Callable[[int], int]


def local_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A few driver-side rows as an inline table, whose size the planner knows exactly: it joins
    by broadcast, never by shuffling the other side."""
    names, types = zip(*(column.split(" ", 1) for column in schema.split(", ")))
    lines = ", ".join(
        "(" + ", ".join(literal(v, t) for v, t in zip(row, types)) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {lines} AS rows({', '.join(names)})")


def literal(value, dtype: str) -> str:
    """An exact SQL literal."""
    if value is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(value, str):
        text = value.replace("\\", "\\\\").replace("'", "\\'")
    else:
        text = format(value, "f") if isinstance(value, Decimal) else repr(value)
    return f"CAST('{text}' AS {dtype})"


def _sketch(frame: DataFrame, shares: list[float]) -> dict[str, tuple[int, dict]]:
    """Rows per group, and for each share the brackets of ``WIDTHS`` (None: no end)."""
    grid = sorted({
        min(max(p + side, 0.0), 1.0) for p in shares for w in WIDTHS for side in (-w, w)
    })
    rows = frame.groupBy("g").agg(
        F.count("v").alias("n"), F.percentile_approx("v", grid, ACCURACY).alias("marks")
    ).limit(MOST_GROUPS + 1).collect()
    if len(rows) > MOST_GROUPS:
        raise ValueError(f"order statistics of more than {MOST_GROUPS} groups")

    def mark(marks, at: float):
        return marks[grid.index(at)] if 0 < at < 1 else None

    return {
        r["g"]: (r["n"], {
            p: [(mark(r["marks"], p - w), mark(r["marks"], p + w)) for w in WIDTHS] for p in shares
        })
        for r in rows
    }


def _pick(frame: DataFrame, brackets: dict[tuple[str, int], tuple]) -> dict:
    """For each (group, rank) the value at that rank, the rows below it and the rows equal to it.

    ``frame`` has columns ``g`` (string) and ``v`` (any ordered numeric), without NULLs. Ranks that
    lie outside their bracket are left out.
    """
    if not brackets:
        return {}
    vtype = frame.schema["v"].dataType.simpleString()
    bounds = local_rows(
        frame.sparkSession,
        f"bg string, rank bigint, low {vtype}, high {vtype}",
        [(g, rank, low, high) for (g, rank), (low, high) in brackets.items()],
    )
    counts = (
        frame.join(bounds, F.expr("g = bg AND (high IS NULL OR v <= high)"))
        .groupBy("g", "rank", F.expr("CASE WHEN low IS NULL OR v >= low THEN v END AS v"))
        .agg(F.expr("count(*) AS n"))
    )
    running = "sum(n) OVER (PARTITION BY g, rank ORDER BY v NULLS FIRST) AS upto"
    found = (
        counts.selectExpr("*", running).filter("upto >= rank")
        .groupBy("g", "rank").agg(F.expr("min(struct(upto, v, n)) AS hit"))
    )
    return {
        (row["g"], row["rank"]): (row["hit"]["v"], row["hit"]["upto"] - row["hit"]["n"], row["hit"]["n"])
        for row in found.collect() if row["hit"]["v"] is not None
    }


def _select(frame: DataFrame, wanted: dict[tuple[str, int], tuple[int, float]], sketch=None) -> dict:
    """``_pick`` for ranks of any place; ``wanted`` has the group's size and about the share of each.

    Brackets widen until every rank is found. The sketch is made only if a bracket needs it.
    """
    width = {
        t: next((k for k, w in enumerate(WIDTHS) if w * n >= SPAN), len(WIDTHS))
        for t, (n, _) in wanted.items()
    }
    result: dict = {}
    while len(result) < len(wanted):
        left = [t for t in wanted if t not in result]
        if sketch is None and any(width[t] < len(WIDTHS) for t in left):
            sketch = _sketch(frame, sorted({share for _, share in wanted.values()}))
        brackets = {
            t: sketch[t[0]][1][wanted[t][1]][width[t]] if width[t] < len(WIDTHS) else (None, None)
            for t in left
        }
        found = _pick(frame, brackets)
        for t in left:
            if t in found:
                result[t] = found[t]
            elif brackets[t] == (None, None):
                raise ArithmeticError(f"no rank {t[1]} in {t[0]}: it has fewer rows")
            width[t] += 1
    return result


def _at_points(frame: DataFrame, points: list[Point]) -> tuple[dict[str, int], dict]:
    """Group sizes and the picked values at every point of every group."""
    sketch = _sketch(frame, sorted({p.share for p in points}))
    sizes = {g: n for g, (n, _) in sketch.items() if n}
    wanted = {(g, p.rank(n)): (n, p.share) for g, n in sizes.items() for p in points}
    return sizes, _select(frame, wanted, sketch)


def rank_cuts(
    frame: DataFrame,
    measures: dict[str, str],
    key: str,
    points: list[Point],
    group: str | None = None,
) -> tuple[dict[str, int], dict[tuple[str, int], Cut]]:
    """Rows at given ranks under the order (measure, key), per measure or per group of one measure.

    ``measures`` and ``group`` are SQL; with a group there is one measure. All measures share one
    type. Returns group sizes and a cut per (group, rank).
    """
    pairs = ", ".join(
        f"struct({f"'{m}'" if group is None else f'CAST({group} AS STRING)'} AS g, {sql} AS v)"
        for m, sql in measures.items()
    )
    long = (
        frame.selectExpr(f"{key} AS k", f"explode(array({pairs})) AS p")
        .selectExpr("p.g", "p.v", "k").filter("v IS NOT NULL AND g IS NOT NULL")
    )
    sizes, values = _at_points(long.select("g", "v"), points)
    keys = _tied_keys(long, {
        t: hit for t, hit in values.items() if t[1] - hit[1] < hit[2]
    })
    return sizes, {t: Cut(hit[0], keys.get(t)) for t, hit in values.items()}


def _tied_keys(long: DataFrame, tied: dict) -> dict:
    """The key at each rank that falls inside a run of equal values."""
    if not tied:
        return {}
    names = {f"{g}#{rank}": (g, rank) for g, rank in tied}
    ties = local_rows(
        long.sparkSession,
        f"tg string, name string, tv {long.schema['v'].dataType.simpleString()}",
        [(g, f"{g}#{rank}", hit[0]) for (g, rank), hit in tied.items()],
    )
    keys = long.join(ties, F.expr("g = tg AND v = tv")).selectExpr("name AS g", "k AS v")
    wanted = {}
    for name, t in names.items():
        rank, n = t[1] - tied[t][1], tied[t][2]
        wanted[name, rank] = (n, rank / n)
    return {names[name]: hit[0] for (name, _), hit in _select(keys, wanted).items()}


def beyond(value: str, key: str, dtype: str, cut: Cut) -> str:
    """SQL that is true for rows after the cut row in (value, key) order."""
    at = literal(cut.value, dtype)
    if cut.key is None:
        return f"({value} > {at})"
    return f"({value} > {at} OR ({value} = {at} AND {key} > {cut.key}))"


def group_limit(n: int, k: int, groups: int) -> int:
    """Last rank of group k when the unique ranks 1..n are cut into equal-width intervals."""
    return k * (n - 1) // groups + 1


def add_quintiles(
    frame: DataFrame, measures: dict[str, str], key: str, groups: int = 5
) -> DataFrame:
    """Add a 1..``groups`` column per measure (name -> SQL); ties go by key.

    Map-only on ``frame``."""
    dtype = "decimal(28,4)"
    typed = {m: f"CAST({column} AS {dtype})" for m, column in measures.items()}
    points = [
        Point(k / groups, lambda n, k=k: group_limit(n, k, groups)) for k in range(1, groups)
    ]
    sizes, cuts = rank_cuts(frame, typed, key, points)
    scores = []
    for m, value in typed.items():
        n = sizes.get(m, 0)
        steps = [
            f"CAST({beyond(value, key, dtype, cuts[m, group_limit(n, k, groups)])} AS INT)"
            for k in range(1, groups) if n > 1
        ]
        scores.append(" + ".join(["1", *steps]) + f" AS {m}")
    return frame.selectExpr("*", *scores)


def top_overlap(
    frame: DataFrame,
    actual: str,
    predicted: str,
    key: str,
    fraction: float = 0.2,
    group: str | None = None,
) -> dict[str, tuple[int, int]]:
    """Per group: size of the true top fraction, and how many of its rows the prediction also puts
    into its own top fraction (W6, R-7). One group named '' without ``group``.

    Equal values are taken in key order, so the top set always has exactly that size.
    """
    label = "''" if group is None else f"CAST({group} AS STRING)"

    def size(n: int) -> int:
        return max(1, int(n * fraction))

    falling = {c: f"(-CAST({c} AS DOUBLE))" for c in (actual, predicted)}
    found = {
        c: rank_cuts(frame, {c: value}, key, [Point(fraction, size)], label)
        for c, value in falling.items()
    }
    sizes = found[actual][0]
    inside = [
        " AND ".join([
            f"{label} = {literal(g, 'string')}",
            *[
                f"NOT {beyond(value, key, 'double', found[c][1][g, size(n)])}"
                for c, value in falling.items()
            ],
        ])
        for g, n in sizes.items()
    ]
    both = frame.filter(" OR ".join(f"({x})" for x in inside) or "false").selectExpr(
        f"{label} AS g"
    ).groupBy("g").agg(F.expr("count(*) AS n"))
    hits = {r["g"]: r["n"] for r in both.collect()}
    return {g: (size(n), hits.get(g, 0)) for g, n in sizes.items()}


def quantiles(
    frame: DataFrame, value: str, shares: list[float], group: str | None = None
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation per group; one group '' without ``group``."""
    label = "''" if group is None else f"CAST({group} AS STRING)"
    long = frame.selectExpr(f"{label} AS g", f"CAST({value} AS DOUBLE) AS v").filter(
        "v IS NOT NULL AND g IS NOT NULL"
    )

    def below(n: int, p: float) -> int:
        return int((n - 1) * p) + 1

    points = [
        Point(p, lambda n, p=p, up=up: min(below(n, p) + up, n)) for p in shares for up in (0, 1)
    ]
    sizes, hits = _at_points(long, points)
    result: dict[str, list[float | None]] = {}
    for g, n in sizes.items():
        row = []
        for p in shares:
            rank = below(n, p)
            low, high = hits[g, rank][0], hits[g, min(rank + 1, n)][0]
            row.append(low + (high - low) * ((n - 1) * p - (rank - 1)))
        result[g] = row
    if group is None and not result:
        result[""] = [None] * len(shares)
    return result


def rank_sum_auc(frame: DataFrame, score: str, label: str, buckets: int = 256) -> float | None:
    """Exact area under the ROC curve: the share of (1, 0) pairs that the score puts in order, ties
    counting half; None without both labels.

    Rows combine to counts per score first. Scores are dealt into buckets at their own quantiles, so the
    running count of zeros below a score is a window inside a bucket plus one number per bucket.
    """
    counts = frame.select(
        F.col(score).cast("double").alias("score"), F.col(label).cast("int").alias("label")
    ).filter("score IS NOT NULL AND label IS NOT NULL").groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")
    )
    marks = counts.agg(F.percentile_approx(
        "score", [k / buckets for k in range(1, buckets)], ACCURACY
    )).first()[0] or []
    cuts = F.array(*(F.lit(float(m)) for m in sorted(set(marks)))).cast("array<double>")
    dealt = counts.withColumn("bucket", F.size(F.filter(cuts, lambda c: c < F.col("score"))))
    earlier = Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("below", F.coalesce(F.sum("zeros").over(earlier), F.lit(0)))
    # Twice the pairs in order inside each bucket; zeros of earlier buckets are added on the driver.
    rows = inside.groupBy("bucket").agg(
        F.expr("sum(CAST(ones AS DECIMAL(18,0)) * CAST(2 * below + zeros AS DECIMAL(19,0)))")
        .alias("pairs"), F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"),
    ).collect()  # at most ``buckets`` rows
    pairs = zeros = ones = 0
    for row in sorted(rows):
        pairs += int(row["pairs"]) + 2 * int(row["ones"]) * zeros
        ones, zeros = ones + int(row["ones"]), zeros + int(row["zeros"])
    return pairs / (2 * ones * zeros) if ones and zeros else None
