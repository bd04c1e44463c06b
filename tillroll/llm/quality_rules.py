"""Quality rules: text statistics as columns and a decision list learned from labelled ones.

Every statistic is a Column expression and the learned list is a chain of conditional expressions,
so the main path is one scan without a shuffle. Sequential covering works on the driver, on at most
``sample`` labelled rows of a dozen numbers each; counts and verdicts cover every document.

Defined results: a null text counts as empty; an empty text has zero words and fails the base rule;
a null label row, or a label without a document, teaches nothing; without both kinds of label the
list is empty and only the base rule rejects. Repeated rows give repeated results. Ties between
conditions go to the first feature, then the lower threshold. Extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import id_and_text, whole_rows, words_of

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "words", "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share",
    "words_per_line", "upper_share", "marks_per_word",
)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"features.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class CoverParams:
    """``sample`` bounds the labelled rows that the driver sees; the rest shapes the rules."""

    sample: int = 4000
    thresholds: int = 24
    max_conditions: int = 3
    max_rules: int = 12
    min_precision: float = 0.9
    min_cover: int = 4


def _measured(frame: DataFrame) -> DataFrame:
    """Adds ``stats`` and ``features`` to a frame that has ``text``; other columns stay."""
    kept = [c for c in frame.columns if c != "text"]
    text = F.col("text")

    def occurring(characters: str) -> Column:
        return F.char_length(text) - F.char_length(F.translate(text, characters, ""))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = frame.select(
        *kept,
        words_of(text).alias("words"),
        lines.alias("lines"),
        F.when(text.rlike("[#*$%&|<>]"), occurring(SYMBOLS)).otherwise(0).cast("long").alias("n_symbols"),
        occurring("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        occurring("!?.,;:").alias("n_marks"),
    )
    # The threes are numbered by position; equal ones meet when they are sorted by hash.
    threes = split.select(
        *kept, "n_symbols", "n_upper", "n_marks",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(words) > 3 THEN transform(sequence(0, size(words) - 3),"
            " i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"
        ).alias("threes"),
    )
    base = ["word_chars", "n_symbols", "n_upper", "n_marks", "n_words", "n_distinct", "n_lines", "n_dup_lines"]
    ordered = threes.select(
        *kept, *base,
        F.expr(
            "CASE WHEN size(array_distinct(threes)) < size(threes)"
            " THEN sort_array(transform(threes, (h, i) -> struct(h, i))) END"
        ).alias("ordered"),
    )
    repeated = ordered.select(*kept, *base, F.expr(
        "sort_array(transform(filter(ordered, (x, i) -> x.h = get(ordered, i - 1).h"
        " OR x.h = get(ordered, i + 1).h), x -> x.i))"
    ).alias("at"))
    covered = F.expr(
        "coalesce(aggregate(transform(at, (p, i) -> least(3, coalesce(get(at, i + 1) - p, 3))),"
        " 0, (x, y) -> x + y), 0)"
    ).cast("long")
    counted = repeated.select(*kept, *base, covered.alias("n_repeat_words"))

    def share(part: str, whole: str) -> Column:
        return F.col(part).cast("double") / F.greatest(F.col(whole), F.lit(1)).cast("double")

    features = {
        "words": F.col("n_words").cast("double"),
        "mean_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "upper_share": share("n_upper", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
    }
    return counted.select(
        *kept,
        F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").alias("stats"),
        F.struct(*(features[f].alias(f) for f in FEATURES)).alias("features"),
    )


def base_failed() -> Column:
    return (F.col("stats.n_words") < 50) | (
        100 * F.col("stats.n_repeat_words") > 50 * F.col("stats.n_words")
    )


def learn(docs: DataFrame, labels: DataFrame, params: CoverParams = CoverParams()) -> list:
    """An ordered list of rules, each a tuple of conditions that together mark a bad document.

    Learns from the ``params.sample`` labelled documents of the smallest hashed ids; quality 0 is
    bad. Two thirds of them grow rules, the rest prunes and admits them.
    """
    chosen = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    ).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    rows = _measured(id_and_text(docs).join(chosen, "doc_id")).select(
        "features.*", F.expr("quality = 0").alias("bad"), base_failed().alias("settled"),
        F.pmod(F.hash("doc_id"), F.lit(3)).alias("fold"),
    ).limit(2 * params.sample).collect()
    rows = [r for r in rows if not r["settled"]]  # the base rule rejects these anyway
    if not rows:
        return []
    x = np.array([[r[f] for f in FEATURES] for r in rows], dtype=float)
    bad = np.array([r["bad"] for r in rows], dtype=bool)
    grow = np.array([r["fold"] > 0 for r in rows], dtype=bool)
    order = np.lexsort(x.T)  # rows come back in any order
    return cover(x[order], bad[order], grow[order], params)


def _conditions(x: np.ndarray, every: np.ndarray, count: int) -> list[Condition]:
    """Conditions at the quantiles of ``x``, ends included, that tell rows of ``every`` apart."""
    found = []
    for j, feature in enumerate(FEATURES):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, count + 2), method="lower"))
        for cut in cuts:
            if 0 < (every[:, j] > cut).sum() < len(every):
                found += [Condition(feature, True, float(cut)), Condition(feature, False, float(cut))]
    return found


def cover(x: np.ndarray, bad: np.ndarray, grow: np.ndarray, params: CoverParams) -> list:
    """Sequential covering: grow a conjunction by information gain, prune it, take its rows away."""
    # Bad rows are few: cuts come from both kinds, so that the tails where they sit are covered.
    parts = [x[grow & bad], x[grow & ~bad]]
    if not all(len(p) for p in parts):
        return []
    conditions, seen = [], set()
    for part in parts:
        for c in _conditions(part, x[grow], params.thresholds):
            if c not in seen:
                seen.add(c)
                conditions.append(c)
    if not conditions:
        return []
    at = {f: j for j, f in enumerate(FEATURES)}
    masks = np.array([
        x[:, at[c.feature]] > c.threshold if c.above else x[:, at[c.feature]] <= c.threshold
        for c in conditions
    ])
    left, rules = np.ones(len(x), dtype=bool), []
    failed = np.zeros(len(conditions), dtype=bool)  # as the first condition of a rule
    while len(rules) < params.max_rules:
        picked, inside = [], left.copy()
        while len(picked) < params.max_conditions:
            live = inside & grow
            p0, n0 = (live & bad).sum(), (live & ~bad).sum()
            if not p0 or not n0:
                break
            p = (masks[:, live & bad]).sum(1).astype(float)
            n = (masks[:, live & ~bad]).sum(1).astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
            gain = np.where(p >= params.min_cover, gain, -1)
            if not picked:
                gain = np.where(failed, -1, gain)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9:
                break
            picked.append(best)
            inside &= masks[best]
        if not picked:
            break

        def worth(some: list[int]) -> float:
            hit = left.copy()
            for k in some:
                hit &= masks[k]
            if (hit & bad & ~grow).any():  # a rule for few rows may miss the pruning rows
                hit &= ~grow
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(picked) > 1 and worth(picked[:-1]) >= worth(picked):
            picked.pop()
        hit = left.copy()
        for k in picked:
            hit &= masks[k]
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        if p < params.min_cover or p < params.min_precision * (p + n) or worth(picked) <= 0:
            failed[picked[0]] = True
            continue
        rules.append(tuple(conditions[k] for k in picked))
        left &= ~hit
    return rules


def rule_number(rules: list) -> Column:
    """The first rule that fires, from 1; 0 if none does."""
    chain = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        chain = F.when(test, k) if chain is None else chain.when(test, k)
    return F.lit(0) if chain is None else chain.otherwise(0)


def judge(docs: DataFrame, rules: list) -> DataFrame:
    """One row per document: its statistics, whether the base rule failed, the learned rule, kept."""
    rule = F.when(base_failed(), F.lit(None).cast("int")).otherwise(rule_number(rules))
    return _measured(id_and_text(docs)).select(
        "doc_id", "stats.*", base_failed().alias("base_failed"), rule.alias("rule"),
        (~base_failed() & (rule_number(rules) == 0)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: list) -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the learned list rejects."""
    rows = whole_rows(docs).select("text", "row")
    verdict = ~base_failed() & (rule_number(rules) == 0)
    # The verdict is a generated column: a filter on it is not copied below the projections, where
    # the statistics would be computed once more for each place that names them.
    judged = _measured(rows).select("row", F.explode_outer(F.array(verdict)).alias("kept"))
    return judged.where("kept").select("row.*")


def op10_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, learn(docs, labels))
