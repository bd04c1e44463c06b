"""License scan: ordered signature rules behind a literal prefilter, overlaps settled by priority.

A rule is a pattern with a label, a priority, a confidence, and literals that each of its matches
holds: one of its form and one of several of its family. A text without any literal of a form is done
after one pass; in the others only the rules whose literals occur are matched. A detection
that lies inside another one of the same or higher priority is suppressed. Everything is a Column
expression over one row: no shuffle, no Python.

Defined results: a null text counts as empty; an empty text has no words, no labels and score 0.
Letters A-Z match in either case, all other characters as they are. Repeated rows give repeated
results. Of equal intervals with equal priority the rule that comes first stays. Extra columns are
left alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.common import id_and_text, scanned, spans_of

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

# Base phrases with their labels and confidences, fixed by the contract.
PHRASES = (
    (("cc", "by"), "cc-by", 0.5),
    (("general", "public", "license"), "gpl", 0.7),
    (("all", "rights", "reserved"), "reserved", 0.6),
)

# label, short id, full name, address; patterns over lower-cased text.
FAMILIES = (
    ("apache-2.0", r"apache-2\.0", r"apache (?:software )?licen[sc]e,? ?(?:v\.? ?|version )?2(?:\.0)?", r"apache\.org/licenses/license-2"),
    ("apache-1.1", r"apache-1\.1", r"apache (?:software )?licen[sc]e,? ?(?:v\.? ?|version )?1\.1", r"apache\.org/licenses/license-1\.1"),
    ("mit", r"mit", r"mit licen[sc]e", r"opensource\.org/licenses?/mit"),
    ("mit-0", r"mit-0", r"mit no attribution(?: licen[sc]e)?", r"spdx\.org/licenses/mit-0"),
    ("bsd-2-clause", r"bsd-2-clause", r"(?:simplified|2-clause|two-clause) bsd licen[sc]e", r"opensource\.org/licenses?/bsd-2"),
    ("bsd-3-clause", r"bsd-3-clause", r"(?:new|modified|revised|3-clause|three-clause) bsd licen[sc]e", r"opensource\.org/licenses?/bsd-3"),
    ("bsd-4-clause", r"bsd-4-clause", r"(?:original|4-clause|four-clause) bsd licen[sc]e", r"spdx\.org/licenses/bsd-4"),
    ("bsd", r"bsd", r"bsd(?:-style)? licen[sc]e", r"freebsd\.org/copyright/"),
    ("isc", r"isc", r"isc licen[sc]e", r"opensource\.org/licenses?/isc"),
    ("gpl-2.0", r"gpl-2\.0(?:-only|-or-later)?", r"gnu general public licen[sc]e,? ?(?:v\.? ?|version )2(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"),
    ("gpl-2.0", r"gplv2\+?", r"gnu gpl,? ?(?:v\.? ?|version )2(?:\.0)?", r"gnu\.org/licenses/old-licenses/gpl-2"),
    ("gpl-3.0", r"gpl-3\.0(?:-only|-or-later)?", r"gnu general public licen[sc]e,? ?(?:v\.? ?|version )3(?:\.0)?", r"gnu\.org/licenses/gpl-3"),
    ("gpl-3.0", r"gplv3\+?", r"gnu gpl,? ?(?:v\.? ?|version )3(?:\.0)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl", r"gpl", r"(?:gnu )?general public licen[sc]e", r"gnu\.org/(?:licenses/gpl|copyleft/gpl)"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later)?", r"gnu lesser general public licen[sc]e,? ?(?:v\.? ?|version )2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later)?", r"gnu lesser general public licen[sc]e,? ?(?:v\.? ?|version )3(?:\.0)?", r"gnu\.org/licenses/lgpl-3"),
    ("lgpl", r"lgpl(?:v[23])?\+?", r"gnu lgpl", r"gnu\.org/licenses/lgpl"),
    ("lgpl", r"lesser gpl", r"(?:gnu )?lesser general public licen[sc]e", r"gnu\.org/copyleft/lesser"),
    ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later)?", r"(?:gnu )?affero general public licen[sc]e(?:,? ?(?:v\.? ?|version )3(?:\.0)?)?", r"gnu\.org/licenses/agpl"),
    ("agpl-3.0", r"agpl(?:v3)?\+?", r"gnu agpl(?:,? ?(?:v\.? ?|version )3(?:\.0)?)?", r"gnu\.org/licenses/agpl-3"),
    ("fdl", r"gfdl(?:-1\.[123])?", r"gnu free documentation licen[sc]e", r"gnu\.org/licenses/fdl"),
    ("mpl-1.1", r"mpl-1\.1", r"mozilla public licen[sc]e,? ?(?:v\.? ?|version )1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", r"mpl-2\.0", r"mozilla public licen[sc]e,? ?(?:v\.? ?|version )2\.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl", r"mpl", r"mozilla public licen[sc]e", r"mozilla\.org/mpl"),
    ("epl-1.0", r"epl-1\.0", r"eclipse public licen[sc]e,? ?(?:-? ?v\.? ?|version )?1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"epl-2\.0", r"eclipse public licen[sc]e,? ?(?:-? ?v\.? ?|version )?2\.0", r"eclipse\.org/legal/epl-2"),
    ("cddl", r"cddl(?:-1\.[01])?", r"common development and distribution licen[sc]e", r"opensource\.org/licenses?/cddl"),
    ("cpl-1.0", r"cpl-1\.0", r"common public licen[sc]e(?:,? ?(?:v\.? ?|version )?1\.0)?", r"opensource\.org/licenses?/cpl"),
    ("eupl", r"eupl(?:-1\.[012])?", r"european union public licen[sc]e", r"joinup\.ec\.europa\.eu/\S*eupl"),
    ("artistic", r"artistic-[12]\.0", r"(?:clarified )?artistic licen[sc]e", r"opensource\.org/licenses?/artistic"),
    ("bsl-1.0", r"bsl-1\.0", r"boost software licen[sc]e", r"boost\.org/license_1_0"),
    ("busl-1.1", r"busl-1\.1", r"business source licen[sc]e", r"mariadb\.com/bsl"),
    ("unlicense", r"unlicense", r"the unlicense", r"unlicense\.org"),
    ("wtfpl", r"wtfpl", r"do what the fuck you want to public licen[sc]e", r"wtfpl\.net"),
    ("zlib", r"zlib", r"zlib(?:/libpng)? licen[sc]e", r"zlib\.net/zlib_license"),
    ("python-2.0", r"psf-2\.0|python-2\.0", r"python software foundation licen[sc]e", r"python\.org/psf/license"),
    ("postgresql", r"postgresql", r"postgresql licen[sc]e", r"postgresql\.org/about/licence"),
    ("sspl-1.0", r"sspl-1\.0", r"server side public licen[sc]e", r"mongodb\.com/licensing/server-side"),
    ("ofl-1.1", r"ofl-1\.1", r"sil open font licen[sc]e", r"scripts\.sil\.org/ofl"),
    ("odbl-1.0", r"odbl-1\.0", r"open database licen[sc]e", r"opendatacommons\.org/licenses/odbl"),
    ("cc0-1.0", r"cc0(?:[- ]1\.0)?", r"cc0 1\.0 universal", r"creativecommons\.org/publicdomain/zero"),
    ("public-domain", r"public[- ]domain dedication", r"(?:in|into|to) the public domain", r"creativecommons\.org/publicdomain/mark"),
    ("cc-by-4.0", r"cc[- ]by[- ]4\.0", r"creative commons attribution 4\.0(?: international)?", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-3.0", r"cc[- ]by[- ]3\.0", r"creative commons attribution 3\.0(?: unported)?", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-sa", r"cc[- ]by-sa(?:[- ][234]\.[05])?", r"creative commons attribution[- ]share ?alike", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-nc", r"cc[- ]by-nc(?:[- ][234]\.[05])?", r"creative commons attribution[- ]non-?commercial", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nd", r"cc[- ]by-nd(?:[- ][234]\.[05])?", r"creative commons attribution[- ]no ?deriv(?:ative)?s", r"creativecommons\.org/licenses/by-nd"),
    ("cc-by-nc-sa", r"cc[- ]by-nc-sa(?:[- ][234]\.[05])?", r"creative commons attribution[- ]non-?commercial[- ]share ?alike", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", r"cc[- ]by-nc-nd(?:[- ][234]\.[05])?", r"creative commons attribution[- ]non-?commercial[- ]no ?deriv(?:ative)?s", r"creativecommons\.org/licenses/by-nc-nd"),
    ("proprietary", r"licenseref-proprietary", r"proprietary and confidential", r"example\.invalid/proprietary"),
)

GRANT = (
    r"(?:licen[sc]ed|released|distributed|available|provided|published|shared|offered) under"
    r" (?:the )?(?:terms of )?(?:the )?"
)


def literals(pattern: str) -> tuple[str, ...]:
    """One literal for each alternative of ``pattern``: every match holds at least one of them.

    Knows what the families use: escapes, classes, groups (which are skipped) and quantifiers.
    """
    runs, depth, at = [[""]], 0, 0
    while at < len(pattern):
        c, width = pattern[at], 1
        plain = None
        if c == "\\":
            width = 2
            plain = None if pattern[at + 1].isalnum() else pattern[at + 1]
        elif c == "[":
            width = pattern.index("]", at) - at + 1
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|":
            if not depth:
                runs.append([])
        elif c not in "?*+.^$":
            plain = c
        after = pattern[at + width:at + width + 1]
        if plain is not None and not depth and after not in ("?", "*"):
            runs[-1][-1:] = [(runs[-1] or [""])[-1] + plain]
        else:
            runs[-1].append("")
        at += width
    return tuple(max(r, key=len) for r in runs)


def rules() -> list[tuple[str, tuple[str, tuple[str, ...]], str, int, float]]:
    """(label, literals, pattern, priority, confidence), the most telling form of a family first.

    ``literals`` is the literal of the form and those of the family; a match holds the first and at
    least one of the others.
    """
    made = []
    for label, short, name, address in FAMILIES:
        edge = r"(?![a-z0-9])"
        of_short, of_name, of_address = literals(short), literals(name), literals(address)
        form = next((k for k in ("licen", "creative commons") if all(k in x for x in of_name)), None)
        form = form or of_name[0]
        made += [
            (label, ("spdx-license-identifier:", of_short), rf"spdx-license-identifier: ?(?:{short}){edge}", 100, 1.0),
            (label, ("://", of_address), rf"https?://(?:www\.)?{address}", 90, 0.95),
            (label, (" under ", of_name + of_short), rf"{GRANT}(?:(?:{name})|(?:{short})(?: licen[sc]e)?){edge}", 80, 0.9),
            (label, (form, of_name), rf"(?<![a-z0-9])(?:{name}){edge}", 60, 0.7),
            (label, (" licen", of_short), rf"(?<![a-z0-9-])(?:{short})(?: licen[sc]e){edge}", 50, 0.6),
        ]
    return made


def any_sign() -> str:
    """What a text must hold for any rule to be tried: the literal of some form."""
    forms = {form for _, (form, _), _, _, _ in rules()}
    least = sorted(f for f in forms if not any(g != f and g in f for g in forms))
    return "(?i)" + "|".join(f.replace(".", r"\.") for f in least)


def _rule_column() -> Column:
    return F.array(*(
        F.struct(
            F.lit(k).alias("rank"), F.lit(label).alias("label"), F.lit(form).alias("form"),
            F.array(*(F.lit(x) for x in family)).alias("family"),
            F.lit(pattern).alias("pattern"), F.lit(priority).alias("priority"),
            F.lit(confidence).alias("confidence"),
        )
        for k, (label, (form, family), pattern, priority, confidence) in enumerate(rules())
    ))


def _count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, BETWEEN + "+", -1), ""))


def _phrase(words: tuple[str, ...]) -> str:
    return rf"(?i)(?<!{WORD})" + rf"{BETWEEN}++".join(words) + rf"(?!{WORD})"


HIT = "struct<start:int,end:int,label:string,priority:int,confidence:double,rank:int>"


def _detections(low: Column) -> Column:
    """Matches of every rule whose literals occur, in the order that ``_settled`` takes them."""
    live = F.filter(_rule_column(), lambda r: F.contains(low, r["form"]) & F.exists(
        r["family"], lambda x: F.contains(low, x)
    ))

    def found(r: Column) -> Column:
        return F.transform(spans_of(low, r["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), r["label"].alias("label"),
            r["priority"].alias("priority"), r["confidence"].alias("confidence"),
            r["rank"].alias("rank"),
        ))

    hits = F.flatten(F.transform(live, found))
    # In order of start; of one start the longest first, then the highest.
    return F.array_sort(F.transform(hits, lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("back"), (-x["priority"]).alias("below"),
        x["rank"].alias("rank"), x.alias("hit"),
    )))


def _settled(ordered: Column) -> Column:
    """Detections that lie inside no other of the same or higher priority.

    In this order an interval is inside another one if some end so far reaches its own, so one running
    end per priority settles all of them in one sweep.
    """
    levels = sorted({priority for _, _, _, priority, _ in rules()}, reverse=True)

    def step(ends: Column, x: Column):
        end, priority = x["hit"]["end"], x["hit"]["priority"]
        inside = F.lit(False)
        for p in levels:
            inside = inside | ((priority <= p) & (ends[f"p{p}"] >= end))
        further = F.struct(*(
            F.when(priority == p, F.greatest(ends[f"p{p}"], end)).otherwise(ends[f"p{p}"]).alias(f"p{p}")
            for p in levels
        ))
        return further, F.struct(inside.alias("inside"), x["hit"].alias("hit"))

    zero = F.struct(*(F.lit(-1).alias(f"p{p}") for p in levels))
    return scanned(ordered, zero, step, f"struct<inside:boolean,hit:{HIT}>")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, phrases, detections): phrase places with their words, and rule detections.

    ``phrases`` has one entry per base phrase: label, places, first and last start in words.
    ``detections`` has start, end, label, priority, confidence and rank of every surviving match.
    """
    text = F.col("text")
    counted = id_and_text(docs, id_column, text_column).select(
        "doc_id", "text", _count_words(text).cast("long").alias("n_words"),
        F.when(text.rlike(any_sign()), F.translate(
            text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        )).alias("low"),
        *(
            F.when(text.rlike(_phrase(p)), F.split(text, _phrase(p), -1)).alias(f"gaps_{k}")
            for k, (p, _, _) in enumerate(PHRASES)
        ),
    )
    phrases = F.array(*(
        F.struct(
            F.lit(label).alias("label"),
            F.lit(confidence).alias("confidence"),
            (F.size(F.coalesce(f"gaps_{k}", F.array(F.lit("")))) - 1).cast("long").alias("places"),
            _count_words(F.get(f"gaps_{k}", F.lit(0))).cast("long").alias("first"),
            (F.col("n_words") - len(words) - _count_words(
                F.element_at(f"gaps_{k}", -1)
            )).alias("last"),
        )
        for k, (words, label, confidence) in enumerate(PHRASES)
    ))
    found = counted.select(
        "doc_id", "n_words", phrases.alias("phrases"),
        F.when(F.col("low").isNotNull(), _detections(F.col("low"))).alias("ordered"),
    ).withColumn("ordered", F.when(F.size("ordered") > 0, _settled(F.col("ordered"))))
    kept = F.array_sort(F.transform(F.filter("ordered", lambda k: ~k["inside"]), lambda k: k["hit"]))
    return found.select("doc_id", "n_words", "phrases", kept.alias("detections"))


def op4_license_rules(spark, sf_dir):
    scanned = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    present = F.filter("phrases", lambda p: p["places"] > 0)
    base = F.array_sort(F.transform(present, lambda p: p["label"]))
    ruled = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    sure = F.array_max(F.concat(
        F.array(F.lit(0.0)),
        F.transform(present, lambda p: p["confidence"]),
        F.coalesce(F.transform("detections", lambda d: d["confidence"]), F.array().cast("array<double>")),
    ))
    none = F.size(present) == 0
    return scanned.select(
        "doc_id", "n_words",
        F.aggregate("phrases", F.lit(0).cast("long"), lambda a, p: a + p["places"]).alias("n_base"),
        F.when(~none, F.array_min(F.transform(present, lambda p: p["first"]))).alias("first_word"),
        F.when(~none, F.array_max(F.transform(present, lambda p: p["last"]))).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, ruled))), ",").alias("labels"),
        sure.alias("score"),
    )
