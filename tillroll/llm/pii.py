"""Personal data: format rules, and a boosted candidate model that adds spans the rules miss.

The four base kinds are patterns with checks. Beside them, looser generators propose candidates that
may overlap; boosted trees score each from its format and its surroundings; scores are calibrated on
rows that the trees did not see, and a candidate is taken where the calibrated chance of being
personal data reaches the threshold. The trees become one conditional expression, so finding and
redacting is one scan with Column expressions, without shuffle or Python. Fitting uses Spark ML on
the candidates of all documents, equal ones counted once with their number as weight.

The training label is weak and does not ask whether a base pattern matches: the last part of an address
must be a known top-level domain once at and dot are undone, card digits must pass the Luhn check, a
number must have the digits of a phone number and either a form that only such numbers have or a word
for it before it. A word for something else (order, part, page) before it speaks against it. What a base
rule confirms counts as personal data too. The checks are no features. The threshold must hold for all
held-out candidates and for those alone that may be added, as they overlap no base span. Each kind has
its own threshold; one with fewer than ``enough`` held-out candidates takes that of all kinds together.

Defined results: a null text counts as empty and holds nothing; without candidates of both labels in
the corpus only base spans are returned. Base spans of different kinds may overlap. Candidates that
overlap no base span are taken in order of start; of two that overlap, the better score stays, then the
earlier start, then the longer one. Repeated rows give repeated results. Extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import SPANS, bound_to, id_and_text, scanned, spans_of, whole_rows

KINDS = ("email", "ip", "card", "phone")
# Base patterns, fixed by the contract. Possessive repeats and the guard before a match only spare
# needless retries: a match can start inside a run only where the one before it ended. A possessive
# group is also matched by a loop, where a greedy one recurses once per repeat.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried at all.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

# Looser generators, with the kind that their spans are reported as.
GENERATORS = (
    ("email", r"(?i)[a-z0-9._%+-]++ ?(?:@|[(\[]at[)\]]| at ) ?[a-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]| dot ) ?[a-z0-9-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,4}+(?:[.,] ?[0-9]{1,4}+){3}(?![0-9.])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{2,6}){2,5}+"),
    ("phone", r"(?<![0-9A-Za-z])(?:\+|00|\()?[0-9][0-9]{0,3}+(?:[\x20()./-]{1,2}[0-9]{2,5}+){2,5}"),
)
ANY_SIGN = r"@|(?i:[(\[ ]at[)\] ])|[0-9][^A-Za-z]{0,3}[0-9]"

FEATURES = (
    "length", "digits", "separators", "dots", "groups", "letters", "has_at", "has_plus",
    "has_bracket", "k_email", "k_ip", "k_card", "k_phone", "word_before", "left_letter",
    "right_letter", "tail",
)
NEAR = r"(?i)(mail|phone|tel|call|fax|mobile|contact|card|visa|credit|account|host|addr|ip)[^\n]{0,12}$"

# Evidence for the training label.
TOP_LEVEL = (
    r"(com|org|net|edu|gov|mil|int|info|biz|io|co|me|dev|app|eu|uk|us|ca|au|nz|de|at|ch|fr|be|nl|lu|es|pt|it|pl|cz|sk|hu|ro"
    r"|gr|dk|se|no|fi|ie|ru|ua|tr|il|in|cn|jp|kr|br|mx|ar|za|example|test)$"
)
CALLED = {
    "email": r"(?i)(mail|contact|write to|reach)[^\n]{0,12}$",
    "ip": r"(?i)\b(ip|host|addr|address|server)[^\n0-9]{0,12}$",
    "card": r"(?i)(card|visa|credit|amex)[^\n0-9]{0,12}$",
    "phone": r"(?i)\b(phone|tel|call|fax|mobile|contact|dial|ring|sms|whatsapp)[^\n0-9]{0,12}$",
}
OTHERWISE = r"(?i)\b(order|invoice|part|page|item|serial|version|isbn|id|ref|case|lot|model|ticket|room)\b[^\n0-9]{0,8}$"
PHONE_FORMS = r"^(\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|00[1-9][0-9]{0,2}([ ()./-]{1,2}[0-9]{2,5}){2,5})$"


@dataclass(frozen=True)
class PiiParams:
    trees: int = 8
    depth: int = 3
    min_precision: float = 0.97
    enough: int = 30


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    digits = F.reverse(_digits(found))
    doubled = F.transform(F.split(digits, ""), lambda d, i: F.when(
        i % 2 == 1, F.lit(2) * d.try_cast("int") - F.when(d.try_cast("int") > 4, 9).otherwise(0)
    ).otherwise(d.try_cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(found, r"\."),
            lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"),
        )
    if kind == "card":
        return F.char_length(_digits(found)).between(13, 19) & _luhn(found)
    if kind == "phone":
        return F.char_length(_digits(found)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end, found) of one base kind; null where the text lacks its sign."""
    spans = spans_of(text, F.lit(PATTERNS[kind]))
    if kind != "email":
        spans = F.filter(spans, lambda s: _valid(kind, s["found"]))
    sign = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(SIGNS[kind])
    return F.when(sign, spans)


def _evidence(kind: str, found: Column, before: Column) -> Column:
    """Whether the text itself speaks for personal data, whatever the base pattern says."""
    called, digits = before.rlike(CALLED[kind]), F.char_length(_digits(found))
    if kind == "email":
        plain = F.regexp_replace(F.lower(found), r" ?[(\[]at[)\]] ?| at ", "@")
        plain = F.regexp_replace(F.regexp_replace(plain, r" ?[(\[]dot[)\]] ?| dot ", "."), " ", "")
        told = found.rlike(r"(?i)@|[(\[]at[)\]]|[(\[]dot[)\]]| dot ") | called
        return told & plain.rlike(r"^[^@]+@[^@]+\." + TOP_LEVEL)
    if kind == "ip":
        return _valid(kind, F.regexp_replace(found, "[.,] ?", ".")) & (~F.contains(found, F.lit(",")) | called)
    if kind == "card":
        return _valid(kind, found) & ~before.rlike(OTHERWISE)
    known = found.rlike(PHONE_FORMS) & digits.between(9, 17) | called & digits.between(7, 15)
    return known & ~before.rlike(OTHERWISE)


def _candidates(text: Column, evidence: bool = False) -> Column:
    """Array of (kind, start, end, features) from every generator, with ``told`` for the label."""
    def describe(kind: str, s: Column) -> Column:
        found, before, after = s["found"], s["before"], s["after"]

        def count(pattern: str) -> Column:
            return F.char_length(F.regexp_replace(found, pattern, "")).cast("double")

        values = {
            "length": F.char_length(found).cast("double"),
            "digits": count("[^0-9]"),
            "separators": count("[A-Za-z0-9.@+]"),
            "dots": count(r"[^.]"),
            "groups": F.size(F.split(found, "[^0-9]+")).cast("double"),
            "letters": count("[^A-Za-z]"),
            "has_at": F.contains(found, F.lit("@")).cast("double"),
            "has_plus": F.startswith(found, F.lit("+")).cast("double"),
            "has_bracket": F.contains(found, F.lit("(")).cast("double"),
            **{f"k_{k}": F.lit(float(k == kind)) for k in KINDS},
            "word_before": before.rlike(NEAR).cast("double"),
            "left_letter": before.rlike("[A-Za-z0-9]$").cast("double"),
            "right_letter": after.rlike("^[A-Za-z0-9]").cast("double"),
            "tail": F.char_length(F.regexp_extract(found, "[A-Za-z]*$", 0)).cast("double"),
        }
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.struct(*(values[f].alias(f) for f in FEATURES)).alias("features"),
            *([_evidence(kind, found, before).alias("told")] if evidence else []),
        )

    def described(kind: str, pattern: str) -> Column:
        return F.transform(spans_of(text, F.lit(pattern), around=True), lambda s: describe(kind, s))

    return F.concat(*(described(kind, pattern) for kind, pattern in GENERATORS))


def _located(frame: DataFrame, evidence: bool = False) -> DataFrame:
    """Adds a base array per kind and ``candidates`` to a frame that has ``text``."""
    text = F.col("text")
    return frame.select(
        "*", *(base_spans(text, k).alias(k) for k in KINDS),
        F.when(text.rlike(ANY_SIGN), _candidates(text, evidence)).alias("candidates"),
    )


def _none_if_null(kind: str) -> Column:
    return F.coalesce(F.col(kind), F.array().cast(SPANS))


def _overlaps(s: Column, t: Column) -> Column:
    return (s["start"] < t["end"]) & (t["start"] < s["end"])


def _tree(node) -> str:
    """A fitted tree as a conditional expression over ``c.features``."""
    if node.numDescendants() == 0:
        return f"{float(node.prediction())!r}D"
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return (
        f"CASE WHEN c.features.{name} <= {float(split.threshold())!r}D THEN {_tree(node.leftChild())}"
        f" ELSE {_tree(node.rightChild())} END"
    )


def _threshold(rows: list, min_precision: float) -> float | None:
    """Lowest score above which the calibrated share of right candidates is high enough."""
    found, n, hits, free_n, free_hits = None, 0, 0.0, 0, 0.0
    for score, (rows_here, right, free, free_right) in sorted(rows, reverse=True):
        n, hits = n + rows_here, hits + right
        free_n, free_hits = free_n + free, free_hits + free_right
        if hits >= min_precision * n and free_hits >= min_precision * free_n:
            found = score
    return found


def thresholds(held: list, params: PiiParams) -> dict[str, float]:
    """Threshold per kind from (kind, score, candidates, right ones, free ones, right free ones)."""
    total: dict[float, list] = {}
    for _, score, *numbers in held:
        total[score] = [a + b for a, b in zip(total.get(score, [0] * 4), numbers)]
    overall, out = _threshold(list(total.items()), params.min_precision), {}
    for kind in KINDS:
        own = [(score, numbers) for k, score, *numbers in held if k == kind]
        enough = sum(numbers[0] for _, numbers in own) >= params.enough
        found = _threshold(own, params.min_precision) if enough else overall
        if found is not None:
            out[kind] = found
    return out


def fit(docs: DataFrame, params: PiiParams = PiiParams()) -> tuple[str, dict[str, float]] | None:
    """(score expression over a candidate ``c``, threshold per kind), or None without anything to learn.

    Learns from the candidates of all rows: two thirds grow the trees, one third sets the thresholds.
    """
    # Rows without an id are dealt to the folds by their text.
    texts = id_and_text(docs).where(F.col("text").rlike(ANY_SIGN)).withColumn(
        "fold", F.pmod(F.when(F.col("doc_id").isNull(), F.hash("text")).otherwise(F.hash("doc_id")), F.lit(3))
    )
    base = F.concat(*(_none_if_null(k) for k in KINDS))
    confirmed = F.col("c.told") | F.exists(
        base, lambda b: (b["start"] == F.col("c.start")) & (b["end"] == F.col("c.end"))
    )
    free = ~F.exists(base, lambda b: _overlaps(b, F.col("c")))
    rows = _located(texts, evidence=True).select("fold", *KINDS, F.explode_outer("candidates").alias("c")).where(
        "c IS NOT NULL"
    ).select(
        "fold", confirmed.cast("double").alias("label"), free.cast("int").alias("free"), "c.kind", "c.features.*",
    )
    # Equal candidates become one row with their number as weight.
    counted = rows.groupBy("fold", "label", "free", "kind", *FEATURES).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    flat = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(counted).select(
        "fold", "label", "free", "n", "x", F.struct("kind", F.struct(*FEATURES).alias("features")).alias("c")
    ).persist()
    try:
        kinds = {(r["held"], r["label"]) for r in flat.groupBy(
            (F.col("fold") == 0).alias("held"), "label"
        ).count().collect()}
        if len(kinds) < 4:
            return None
        model = GBTClassifier(
            featuresCol="x", labelCol="label", weightCol="n", maxIter=params.trees, maxDepth=params.depth, seed=7
        ).fit(flat.where("fold > 0").select("x", "label", "n"))
        margin = " + ".join(
            f"{w!r}D * ({_tree(tree._call_java('rootNode'))})"
            for w, tree in zip(model.treeWeights, model.trees)
        )
        held = [tuple(r) for r in flat.where("fold = 0").select(
            F.expr(margin).alias("score"), "label", "free", "n", "c.kind"
        ).groupBy("kind", F.round("score", 6).alias("score")).agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("hits"),
            F.sum(F.col("n") * F.col("free")).alias("free"),
            F.sum(F.col("n") * F.col("label") * F.col("free")).alias("free_hits"),
        ).collect()]
    finally:
        flat.unpersist()
    found = thresholds(held, params)
    return (margin, found) if found else None


SCORED = "struct<start:int,base:boolean,end:int,score:double,kind:string>"
FLAGGED = f"struct<hit:boolean,x:{SCORED}>"


def _behind_base(items: Column) -> Column:
    """Items in order of start, each with whether a base span that starts before it reaches it."""
    def step(reach: Column, x: Column):
        flagged = F.struct((x["start"] < reach).alias("hit"), x.alias("x"))
        return F.when(x["base"], F.greatest(reach, x["end"])).otherwise(reach), flagged

    return scanned(items, F.lit(-1), step, FLAGGED)


def _before_base(items: Column) -> Column:
    """Items in falling order of start, also flagged where they reach the base span that follows."""
    def step(next_start: Column, f: Column):
        x = f["x"]
        hit = f["hit"] | (x["end"] > next_start)
        return F.when(x["base"], x["start"]).otherwise(next_start), F.struct(hit.alias("hit"), x.alias("x"))

    return scanned(items, F.lit(2**31 - 1), step, FLAGGED)


def _stop() -> Column:
    """An item behind all others."""
    return F.struct(
        F.lit(2**31 - 1).alias("start"), F.lit(False).alias("base"), F.lit(2**31 - 1).alias("end"),
        F.lit(0.0).alias("score"), F.lit("").alias("kind"),
    )


def _best(items: Column) -> Column:
    """Candidates in order of start: of two that overlap the better one goes on; a span is given out
    when the next one starts behind it, else null."""
    def step(last: Column, x: Column):
        apart = last.isNull() | (x["start"] >= last["end"])
        better = (x["score"] > last["score"]) | (
            (x["score"] == last["score"]) & (x["start"] == last["start"]) & (x["end"] > last["end"])
        )
        return F.when(apart | better, x).otherwise(last), F.when(apart, last)

    return scanned(items, F.lit(None).cast(SCORED), step, SCORED)


def find(frame: DataFrame, model: tuple[str, dict[str, float]] | None) -> DataFrame:
    """Adds ``base`` (array of kind, start, end, in kind order) and ``extra`` to a frame with text."""
    others = [c for c in frame.columns]
    located = _located(frame)

    def named(kind: str) -> Column:
        return F.transform(_none_if_null(kind), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ))

    base = F.concat(*(named(k) for k in KINDS))
    if model is None:
        empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
        return located.select(*others, base.alias("base"), empty.alias("extra"))
    margin, by_kind = model
    scored = F.expr(f"transform(candidates, c -> struct({margin} AS score, c.kind, c.start, c.end))")
    based = located.select(*others, base.alias("base"), scored.alias("scored"))

    def taken(c: Column) -> Column:
        chain = F.lit(False)
        for kind, threshold in by_kind.items():
            chain = chain | ((c["kind"] == kind) & (c["score"] >= threshold - 5e-7))
        return chain

    def item(x: Column, is_base: bool) -> Column:
        return F.struct(
            x["start"].alias("start"), F.lit(is_base).alias("base"), x["end"].alias("end"),
            (F.lit(0.0) if is_base else x["score"]).alias("score"), x["kind"].alias("kind"),
        )

    # Candidates sort behind base spans of the same start; a longer one goes before a shorter one.
    together = F.array_sort(
        F.concat(F.transform("base", lambda x: item(x, True)), F.transform(
            F.filter("scored", taken), lambda x: item(x, False)
        )),
        lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int"))
        .when(x["base"] != y["base"], F.when(x["base"], -1).otherwise(1))
        .when(x["end"] != y["end"], F.signum(y["end"] - x["end"]).cast("int"))
        .when(x["kind"] < y["kind"], -1).when(x["kind"] > y["kind"], 1).otherwise(0),
    )
    # One sweep per step, each a column of its own.
    swept = based.select(
        *others, "base", F.when(F.exists("scored", taken), together).alias("items")
    )
    swept = swept.withColumn("items", F.reverse(_behind_base(F.col("items"))))
    swept = swept.withColumn("items", _before_base(F.col("items")))
    swept = swept.withColumn("items", F.array_append(F.reverse(F.transform(
        F.filter("items", lambda f: ~f["hit"] & ~f["x"]["base"]), lambda f: f["x"]
    )), _stop()))
    swept = swept.withColumn("items", _best(F.col("items")))
    extra = F.transform(F.filter("items", lambda x: x.isNotNull()), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")
    ))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return swept.select(*others, "base", F.coalesce(extra, none).alias("extra"))


def redact(docs: DataFrame, model: tuple[str, dict[str, float]] | None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans become one, named after the kind that starts first. A column ``n_chars``, if
    there is one, follows the new length.
    """
    found = find(whole_rows(docs).select("text", "row"), model).select(
        "text", "row",
        F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")
        ))).alias("spans"),
    )
    text = F.col("text")

    def step(at: Column, s: Column):
        """The gap before the span and its name, nothing for a span inside the one before; the state
        is where the text goes on."""
        gap = F.substring(text, at + 1, s["start"] - at)
        piece = F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.greatest(-s["back"], at), F.when(s["start"] >= at, piece).otherwise("")

    last = F.greatest(F.array_max(F.transform("spans", lambda s: -s["back"])), F.lit(0))
    cleaned = F.when(F.size("spans") > 0, F.concat(
        F.array_join(scanned(F.col("spans"), F.lit(0), step, "string"), ""),
        F.substring(text, last + 1, F.char_length(text)),
    )).otherwise(F.col("row.text"))
    done = found.select("row", cleaned.alias("cleaned"))
    new = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("long")}
    return done.select(*(
        new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns
    ))


def op3_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find(id_and_text(docs), fit(docs))

    def name(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    by_kind = F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(
        F.array_position(F.array(*(F.lit(k) for k in KINDS)), s["kind"]).alias("order"),
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
    )))
    return found.select(
        "doc_id", *(count(k) for k in KINDS),
        F.sha2(F.array_join(F.transform("base", name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(by_kind, name), ",").alias("spans"),
    )
