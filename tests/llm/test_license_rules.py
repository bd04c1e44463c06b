import re

from llm_cases import *  # noqa: F403
from tillroll.llm import license_rules

PHRASES = {
    ("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved",
}


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [
        (i, label) for p, label in PHRASES.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p
    ]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def base(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_query_matches_brute_force(spark, small_texts):
    rows = by_id(license_rules.op4_license_rules(spark, SMALL))
    for i, text in small_texts.items():
        assert base(rows[i]) == brute(text)
        assert set(filter(None, rows[i]["base_labels"].split(","))) <= set(rows[i]["labels"].split(","))
        assert 0 <= rows[i]["score"] <= 1


def labels(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = by_id(license_rules.op4_license_rules(spark, str(tmp_path)))
    for i, text in enumerate(texts):
        assert base(rows[i]) == brute(text or "")
    return [rows[i]["labels"] for i in range(len(texts))]


def test_rules_priorities_and_containment(spark, tmp_path):
    found = labels(spark, tmp_path, [
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: MIT",
        "under the GNU Lesser General Public License, version 3", "CC-BY, cc by! CC\n\nBY and accby cc byx",
        "All rights reserved. all   RIGHTS-reserved", "Kc by éall rights reserved", "nothing to see",
        "https://creativecommons.org/licenses/by-sa/4.0/ and released under the MIT License", "", None,
    ])
    assert found == ["apache-2.0", "mit", "gpl,lgpl-3.0", "cc-by", "reserved", "", "", "cc-by-sa,mit", "", ""]


def test_hundreds_of_rules():
    made = license_rules.rules()
    assert len(made) > 200 and all(re.compile(p) for _, _, p, _, _ in made)


def test_edges(edge_docs, empty_docs, edge_texts):
    assert license_rules.scan(edge_docs).count() == len(edge_texts)
    assert license_rules.scan(empty_docs).collect() == []


def samples(pattern):
    """Texts that ``pattern`` matches: every branch once, optional parts with and without."""
    def many(nodes):
        made = {""}
        for op, arg in nodes:
            name = str(op)
            if name == "LITERAL":
                here = {chr(arg)}
            elif name == "IN":
                here = {next(chr(v) for o, v in arg if str(o) == "LITERAL")} if all(
                    str(o) == "LITERAL" for o, _ in arg) else {"x"}
            elif name == "SUBPATTERN":
                here = many(arg[-1])
            elif name == "BRANCH":
                here = {t for branch in arg[1] for t in many(branch)}
            elif name == "MAX_REPEAT":
                low, high, inner = arg
                here = (many(inner) if high else set()) | ({""} if not low else set())
            else:
                assert name in ("ASSERT", "ASSERT_NOT"), name
                here = {""}
            made = {a + b for a in made for b in here}
            if len(made) > 60:
                made = set(sorted(made)[:: len(made) // 60 + 1]) | {max(made, key=len), min(made, key=len)}
        return made

    return many(re._parser.parse(pattern))


def test_every_match_holds_the_literals_of_its_rule():
    for label, (form, family), pattern, _, _ in license_rules.rules():
        texts = samples(pattern)
        assert texts and all(re.search(pattern, t) for t in texts), pattern
        for t in texts:
            assert form in t and any(x in t for x in family), (label, t)


def test_tags_without_the_name_of_the_family(spark, tmp_path):
    tags = ["GPL-2.0-only", "GPL-3.0", "MPL-2.0", "EPL-2.0", "EUPL-1.2", "BSL-1.0", "BUSL-1.1", "PSF-2.0", "SSPL-1.0", "OFL-1.1", "ODbL-1.0", "CPL-1.0", "GFDL-1.3"]
    found = labels(spark, tmp_path, [f"# SPDX-License-Identifier: {t}" for t in tags])
    assert found == ["gpl-2.0", "gpl-3.0", "mpl-2.0", "epl-2.0", "eupl", "bsl-1.0", "busl-1.1", "python-2.0", "sspl-1.0", "ofl-1.1", "odbl-1.0", "cpl-1.0", "fdl"]


def test_a_match_of_any_rule_is_reported(spark):
    cases = [
        (k, t) for k, (_, _, p, _, _) in enumerate(license_rules.rules())
        for t in sorted(samples(p), key=lambda t: (len(t), t))[:: max(1, len(samples(p)) - 1)]
    ]
    assert all(re.search(license_rules.any_sign(), t) for _, t in cases)
    made = license_rules.rules()
    frame = spark.createDataFrame([(n, t.upper()) for n, (_, t) in enumerate(cases)], "doc_id long, text string")
    rows = by_id(license_rules.scan(frame))
    for n, (k, text) in enumerate(cases):
        m = re.search(made[k][2], text)
        assert any(
            d["start"] <= m.start() and d["end"] >= m.end() and d["priority"] >= made[k][3]
            for d in rows[n]["detections"] or []
        ), (made[k][0], text)


def test_texts_without_the_old_signs(spark, tmp_path):
    found = labels(spark, tmp_path, [
        "proprietary and confidential", "CC0 1.0 Universal", "provided under MPL-2.0", "offered under GPL-3.0",
        "https://mariadb.com/bsl", "https://www.wtfpl.net", "https://joinup.ec.europa.eu/collection/eupl",
        "https://mongodb.com/licensing/server-side-public",
    ])
    assert found == ["proprietary", "cc0-1.0", "mpl-2.0", "gpl-3.0", "busl-1.1", "wtfpl", "eupl", "sspl-1.0"]


def test_settled_detections_against_all_pairs(spark):
    """One sweep leaves the same detections as comparing every hit with every other."""
    import random

    from pyspark.sql import functions as F

    draw, rows = random.Random(4), []
    for k in range(40):
        hits = []
        for rank in draw.sample(range(250), draw.randint(0, 25)):
            start = draw.randint(0, 30)
            hits.append((start, start + draw.randint(1, 12), draw.choice([100, 90, 80, 60, 50]), rank))
        rows.append((k, hits))
    frame = spark.createDataFrame(
        [(k, [(s, e, f"l{r}", p, 0.5, r) for s, e, p, r in hits]) for k, hits in rows],
        f"k long, hits array<{license_rules.HIT}>",
    )
    ordered = frame.select("k", F.array_sort(F.transform("hits", lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("back"), (-x["priority"]).alias("below"),
        x["rank"].alias("rank"), x.alias("hit"),
    ))).alias("ordered"))
    settled = ordered.select("k", license_rules._settled(F.col("ordered")).alias("s")).collect()
    found = {r["k"]: {x["hit"]["rank"] for x in r["s"] if not x["inside"]} for r in settled}
    for k, hits in rows:
        def beaten(x):
            return any(
                y[0] <= x[0] and y[1] >= x[1] and y[3] != x[3] and (
                    y[2] > x[2] or y[2] == x[2] and (y[1] - y[0] > x[1] - x[0] or y[3] < x[3])
                ) for y in hits
            )

        assert found[k] == {x[3] for x in hits if not beaten(x)}, k
