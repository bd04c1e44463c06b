"""Helpers the operators share: written intermediate tables, whole rows as one column, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.staging import shared_folder

SPACES = r"[\x20\x09-\x0D]+"  # what separates words in most contracts


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the one every executor can reach."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: cuts lineage and outlives any executor."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def whole_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text, row): the whole input row is kept in one column, so its names cannot clash."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.struct("*").alias("row"),
    )


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) with a null text as the empty one."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Alternating large-star and small-star steps: every edge is moved to the smallest neighbour of its
    ends until each node hangs on its component's smallest node, in a number of rounds that grows
    with the logarithm of the graph. A hub is an ordinary key: minima are pre-aggregated and the
    join back is one that run-time replanning can split. Each round is a written table.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    current = written(pairs, "edges")
    state = None
    while True:
        found = current.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))
        ).first()
        if found == state or not found[0]:
            roots = current.select(F.col("v").alias("u"), "v").distinct()
            return current.union(roots).toDF("node", "component")
        state = found
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        ).where("u <> v").distinct()
        large = written(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).union(least).distinct()
        current = written(small, "small_star")


def bound_to(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scanned(items: Column, zero: Column, step, out_type: str) -> Column:
    """One output per item from a running state: ``step(state, item)`` gives (new state, output).

    Works in blocks of about the square root of the length, because appending to an array copies it.
    ``state`` keeps the type of ``zero``; ``items`` should be a column that is there, as it is named
    several times.
    """
    size = F.size(items)
    width = F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(1))
    none = F.array().cast(f"array<{out_type}>")

    def one(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.array_append(acc["out"], out).alias("out"))

    def block(acc: Column, b: Column) -> Column:
        return F.aggregate(
            F.slice(items, b * width + 1, width),
            F.struct(acc["state"].alias("state"), none.alias("out")), one,
            lambda d: F.struct(
                d["state"].alias("state"), F.array_append(acc["out"], d["out"]).alias("out")
            ),
        )

    start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("out"))
    blocks = F.sequence(F.lit(0), F.floor((size - 1) / width).cast("int"))
    return F.when(size > 0, F.aggregate(blocks, start, block, lambda acc: F.flatten(acc["out"]))).otherwise(none)


SPANS = "array<struct<start:int,end:int,found:string>>"


NEARBY = 24  # code points before a match
AROUND = "array<struct<start:int,end:int,found:string,before:string,after:string>>"


def spans_of(text: Column, pattern: Column, around: bool = False) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as (start, end, found), in code points.

    With ``around`` also what stands ``before`` (up to ``NEARBY`` code points of the gap, the match and
    the gap before it) and the one code point ``after``, from the parts and not from the whole text.

    The gaps that ``split`` leaves and the matches themselves alternate, so their lengths give the
    places. The pattern must not match the empty string.
    """
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
    )

    def walk(p: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            start = acc["at"] + F.char_length(F.get(p["gaps"], k))
            found = F.get(p["found"], k)
            end = start + F.char_length(found)
            fields = [start.alias("start"), end.alias("end"), found.alias("found")]
            if around:
                none = F.lit("")
                earlier = F.concat(*(
                    F.coalesce(part, none) for part in (
                        F.right(F.get(p["gaps"], k - 1), F.lit(NEARBY)), F.get(p["found"], k - 1),
                        F.right(F.get(p["gaps"], k), F.lit(NEARBY)),
                    )
                ))
                later = F.concat(
                    F.substring(F.get(p["gaps"], k + 1), 1, 1),
                    F.substring(F.coalesce(F.get(p["found"], k + 1), none), 1, 1),
                )
                fields += [F.right(earlier, F.lit(NEARBY)).alias("before"), F.substring(later, 1, 1).alias("after")]
            span = F.struct(*fields)
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        kind = AROUND if around else SPANS
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        last = F.size(p["found"]) - 1
        return F.when(
            last >= 0, F.aggregate(F.sequence(F.lit(0), last), zero, step, lambda acc: acc["out"])
        ).otherwise(F.array().cast(kind))

    return bound_to(parts, walk)
