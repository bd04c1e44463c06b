"""Benchmark decontamination: fingerprints of item-sized windows, Hamming blocks, exact verification.

An item of n words is looked for in windows of n words. A window reaches the least similarity only
if most of its shingles are the item's, so windows are formed where a document shares shingles with
an item, at every start from which enough of them are inside; this loses none. Each window gets a
64-bit SimHash of its shingles and probes the index of that item's blocks: 64 bits in
``radius + 1`` blocks, of which one must agree within ``radius`` differing bits. The item is part of
the key, because blocks of three bits alone would bring every window to every item of its size. Candidates within
the radius are verified by weighted Jaccard similarity, a shingle weighing as often as it occurs.

Everything is a DataFrame or SQL function. The item tables are written first, so Spark knows their
size and broadcasts them below its threshold, or joins by sorting beyond it. Document shingles are
joined where they are made; only shared ones are shuffled.

Defined results: texts are lower-cased, words are separated by white space. Items or documents of
fewer words than a shingle have no shingle and match nothing; a document shorter than an item is one
window. Null texts count as empty. Rows without a doc_id or item_id are left out of the report and
kept by the filter. Repeated rows count once, items with equal texts each report. Ties in
similarity go to the first window. Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import SPACES, bound_to, written

SHINGLE = 5
LEAST = 8  # tenths: similarity of 0.8 or more
RADIUS = 20


def _shingles(frame: DataFrame, key: str, text_column: str, *others: str) -> DataFrame:
    """(key, others, shingles): 64-bit hashes of the shingles of each text by place, null if it has none."""
    words = F.array_remove(F.split(
        F.lower(F.coalesce(F.col(text_column).cast("string"), F.lit(""))), SPACES, -1
    ), "")

    # One expression with the words bound inside, so a filter that the optimizer copies below the
    # projection does not split the text once for each shingle.
    def hashed(w: Column) -> Column:
        return F.when(F.size(w) >= SHINGLE, F.transform(
            F.sequence(F.lit(0), F.size(w) - SHINGLE),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))),
        ))

    return frame.where(F.col(key).isNotNull()).select(
        key, *others, bound_to(words, hashed).alias("shingles")
    )


def _fingerprint(shingles: Column) -> Column:
    """64-bit SimHash: a bit is set where more than half of the shingles have it."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"),
        lambda a, x: a.bitwiseOR(x),
    )


def _masks(radius: int) -> list[int]:
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _block_of_agreement(difference: Column, radius: int) -> Column:
    """The first block in which two fingerprints agree, from their exclusive or."""
    chain = None
    for k, mask in enumerate(_masks(radius)):
        test = difference.bitwiseAND(F.lit(mask).cast("long")) == 0
        chain = F.when(test, k) if chain is None else chain.when(test, k)
    return chain


def _blocks(mark: Column, radius: int) -> Column:
    return F.array(*(
        F.struct(F.lit(k).alias("block"), mark.bitwiseAND(F.lit(m).cast("long")).alias("value"))
        for k, m in enumerate(_masks(radius))
    ))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: int = LEAST,
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_windows) of every document that holds an item."""
    items = written(
        _shingles(benchmark, "item_id", "text").where("shingles IS NOT NULL").distinct().withColumn(
            "m", F.size("shingles")
        ), "items",
    )
    by_shingle = written(
        items.select("item_id", "m", F.explode("shingles").alias("h")).distinct(), "item_shingles"
    )
    index = written(items.select(
        "item_id", "m", _fingerprint(F.col("shingles")).alias("item_mark"), "shingles"
    ).select(
        "item_id", "m", "item_mark", F.col("shingles").alias("item_shingles"),
        F.explode(_blocks(F.col("item_mark"), radius)).alias("b"),
    ).select("item_id", "m", "item_mark", "item_shingles", "b.block", "b.value"), "item_index")

    shingled = _shingles(docs, "doc_id", "text")
    hits = shingled.select(
        "doc_id", F.size("shingles").alias("size"), F.posexplode_outer("shingles").alias("p", "h")
    ).join(by_shingle, "h")
    # A window of least(m, size) shingles shares at least this part of both sets.
    enough = F.lit(10 + least) * F.col("shared") >= F.lit(least) * (F.col("m") + F.least("m", "size"))
    pairs = hits.groupBy("doc_id", "item_id", "m", "size").agg(
        F.count("*").alias("shared"), F.collect_set("p").alias("places")
    ).where(enough)
    # The k-th next place of a sorted list tells all starts whose window holds k places: those up to
    # the j-th place from which the window reaches the one k - 1 further on. Linear in the places.
    starts = F.expr(
        "array_distinct(flatten(transform(sequence(0, size(places) - k), j ->"
        " CASE WHEN greatest(0, places[j + k - 1] - m + 1) <= least(places[j], greatest(0, size - m))"
        " THEN sequence(greatest(0, places[j + k - 1] - m + 1), least(places[j], greatest(0, size - m)))"
        " ELSE array() END)))"
    )
    needed = F.ceil(F.lit(least) * (F.col("m") + F.least("m", "size")) / F.lit(10 + least)).cast("int")
    wanted = pairs.withColumn("places", F.array_sort("places")).withColumn("k", needed).where(
        "size(places) >= k"
    ).select("doc_id", "item_id", "m", "size", F.explode(starts).alias("a")).groupBy("doc_id", "size").agg(
        F.collect_set(F.struct("item_id", "m", "a")).alias("windows")
    )
    # Only documents that may hold an item are shingled again.
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text"))
    again = _shingles(texts.join(wanted, F.col("id") == F.col("doc_id")), "doc_id", "text", "size", "windows")
    found = again.select("doc_id", "size", "shingles", F.explode_outer("windows").alias("w")).where(
        F.size("shingles") == F.col("size")
    ).select(
        "doc_id", F.col("w.item_id").alias("item_id"), F.col("w.m").alias("m"), F.col("w.a").alias("a"),
        F.slice("shingles", F.col("w.a") + 1, F.col("w.m")).alias("window"),
    )
    marked = found.select("*", _fingerprint(F.col("window")).alias("mark"))
    probed = marked.select("*", F.explode(_blocks(F.col("mark"), radius)).alias("b")).select(
        "doc_id", "item_id", "m", "a", "window", "mark", "b.block", "b.value"
    )
    difference = F.col("mark").bitwiseXOR(F.col("item_mark"))
    near = probed.join(index, ["item_id", "m", "block", "value"]).where(
        (F.bit_count(difference) <= radius)
        & (_block_of_agreement(difference, radius) == F.col("block"))
    )

    def times(shingles: Column, h: Column) -> Column:
        return F.size(F.filter(shingles, lambda x: x == h))

    shared = F.aggregate(
        F.array_distinct("item_shingles"), F.lit(0),
        lambda a, h: a + F.least(times(F.col("item_shingles"), h), times(F.col("window"), h)),
    )
    scored = near.select(
        "doc_id", "item_id", "a", bound_to(shared, lambda c: F.struct(
            c.alias("shared"), (F.col("m") + F.size("window") - c).alias("all")
        )).alias("s"),
    ).where(F.lit(10) * F.col("s.shared") >= F.lit(least) * F.col("s.all"))
    similarity = F.col("s.shared").cast("double") / F.col("s.all").cast("double")
    return scored.groupBy("doc_id", "item_id").agg(
        F.max(similarity).alias("similarity"),
        F.min_by(F.col("a"), F.struct(-similarity, F.col("a"))).cast("long").alias("start_word"),
        F.count_distinct("a").cast("long").alias("n_windows"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark."""
    leaks = contaminated(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("leaked"), "left_anti")


def op8_decontaminate(spark, sf_dir):
    return contaminated(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )


# The same rows by comparing every window of shared shingles, without fingerprints.
OP8_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), item_words AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), doc_shingles AS (
  SELECT DISTINCT doc_id, len(w) - 4 AS size, unnest(range(0, len(w) - 4)) AS p,
    unnest(list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))) AS s
  FROM doc_words WHERE len(w) >= 5
), item_shingles AS (
  SELECT item_id, m, s, count(*) AS times FROM (
    SELECT item_id, len(w) - 4 AS m,
      unnest(list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))) AS s
    FROM item_words WHERE len(w) >= 5
  ) GROUP BY ALL
), hits AS (
  SELECT doc_id, item_id, size, m, p, s, times FROM doc_shingles JOIN item_shingles USING (s)
), starts AS (
  SELECT DISTINCT doc_id, item_id, p - d AS a
  FROM (SELECT doc_id, item_id, size, m, p, unnest(range(0, m)) AS d FROM hits)
  WHERE p - d >= 0 AND p - d <= greatest(0, size - m)
), counted AS (
  SELECT doc_id, item_id, a, size, m, s, least(times, count(*)) AS shared
  FROM starts JOIN hits USING (doc_id, item_id) WHERE p >= a AND p < a + m
  GROUP BY doc_id, item_id, a, size, m, s, times
), compared AS (
  SELECT doc_id, item_id, a, sum(shared) AS c, m + least(m, size) - sum(shared) AS every
  FROM counted GROUP BY doc_id, item_id, a, size, m
)
SELECT doc_id, item_id, max(c::DOUBLE / every::DOUBLE) AS similarity,
  CAST(first(a ORDER BY c::DOUBLE / every::DOUBLE DESC, a) AS BIGINT) AS start_word,
  count(DISTINCT a) AS n_windows
FROM compared WHERE 10 * c >= 8 * every GROUP BY doc_id, item_id
"""
