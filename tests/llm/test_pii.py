import hashlib
import re

from pyspark.sql import Window, functions as F

from llm_cases import *  # noqa: F403
from tillroll.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "a@b.c_d@e.f g..h@i-j.k.l", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004 1 2 3", "+1 (555) 010-9999, +12 3 +123456789",
    "𝒳é mail ü.x@y.zz then 10.0.0.1", "@@ a@b @c.d", "7" * 4000, "a" * 5000 + "@x.yz", "9.9" * 2000,
    "+1" + "-" * 3000, "1" + " 1" * 3000,
]


def check(rows, texts):
    for i, text in texts.items():
        expected = brute(text)
        r = rows[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), text[:80]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(e.startswith(k) for e in expected) for k in PATTERNS]
        assert set(expected) <= set(r["spans"].split(",") if r["spans"] else [])


def test_query_matches_brute_force(spark, small_texts):
    check(by_id(pii.op3_pii(spark, SMALL)), small_texts)


def test_tricky_texts(spark):
    frame = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    found = {r["doc_id"]: r["base"] for r in pii.find(frame, None).collect()}
    for i, text in enumerate(TRICKY):
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in found[i]] == brute(text), text[:60]


def test_model_adds_spans_and_keeps_base(spark):
    rows = [(k, f"call me on +1 555 010 {1000 + k} or mail user{k}@mail{k}.example.com today") for k in range(150)]
    rows += [(1000 + k, f"look at page{k} dot number {k}, card 4111 1111 1111 11{10 + k % 90}x") for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    assert model is not None
    unseen = spark.createDataFrame([(1, "plain words only"), (2, "a.b@c.de and +1 555 010 2345")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find(unseen, model).collect()}
    assert not found[1]["base"] and not found[1]["extra"]
    assert [s["kind"] for s in found[2]["base"]] == ["email", "phone"]
    cleaned = by_id(pii.redact(docs, model))
    assert all("@" not in r["text"] and "<EMAIL>" in r["text"] for i, r in cleaned.items() if i < 1000)
    assert all(r["text"].startswith("look at page") for i, r in cleaned.items() if i >= 1000)


def test_edges(edge_docs, edge_texts):
    cleaned = pii.redact(edge_docs, pii.fit(edge_docs))
    assert cleaned.columns == edge_docs.columns
    rows = cleaned.collect()
    assert len(rows) == len(edge_texts)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["text"] is None and by[2]["text"] == ""
    assert by[9]["text"] == "Ünïcödé 日本語 𝒳 text mail <EMAIL>" and by[9]["n_chars"] == len(by[9]["text"])
    assert by[9]["row"] == "r9"


def test_empty(empty_docs):
    assert pii.fit(empty_docs) is None
    assert pii.redact(empty_docs, None).collect() == []


def test_obfuscated_and_national_forms_are_added(spark):
    plain = [f"mail user{k}@mail{k}.example.com or call +1 555 010 {1000 + k}" for k in range(150)]
    hidden = [f"write to {'j' * (k % 9)}{'.' * (k % 2)}ane{k % 7} [at] example{'e' * (k % 5)} [dot] com today" for k in range(150)]
    national = [f"call (555) 123-{1000 + k} or 0044 20 7946 {1000 + k}" for k in range(150)]
    clean = [f"look{'k' * (k % 9)}{'.a' * (k % 2)} [at] page{'e' * (k % 5)}{k % 7} [dot] chapter, part 12 34 56 {1000 + k}, order 2024/11/{10 + k % 19} 77" for k in range(150)]
    docs = spark.createDataFrame(list(enumerate(plain + hidden + national + clean)), "doc_id long, text string")
    model = pii.fit(docs)
    unseen = spark.createDataFrame([
        (1, "write to bob.x [at] firm [dot] com today"), (2, "call (555) 987-6543 or 0044 20 7946 0999"),
        (3, "look [at] page7 [dot] chapter, part 12 34 56 9999, order 2024/11/12 77"),
    ], "doc_id long, text string")
    found = by_id(pii.find(unseen, model))
    assert [s["kind"] for s in found[1]["extra"]] == ["email"]
    assert [s["kind"] for s in found[2]["extra"]] == ["phone", "phone"]
    assert not found[3]["extra"]


def test_an_address_with_many_labels_in_a_fresh_session(tmp_path):
    """A greedy group would recurse once per label and kill the executor's thread."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "from pyspark.sql import SparkSession, functions as F\n"
        "from tillroll.llm import pii\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "docs = spark.createDataFrame([(1, 'a@b' + '.c' * 20000)], 'doc_id long, text string')\n"
        "row = pii.find(pii.id_and_text(docs), None).select(F.size('base').alias('n'), F.col('base')[0]['end'].alias('e')).first()\n"
        "print('FOUND', row['n'], row['e'])\n"
    )
    repo = Path(__file__).resolve().parent.parent.parent
    said = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, timeout=180)
    assert "FOUND 1 40003" in said.stdout


MODEL = ("CASE WHEN c.features.digits > 3 THEN 1.0D ELSE 0.5D END",
         {"phone": 0.9, "email": 0.4, "card": 0.9})


def test_candidates_leave_base_spans_alone_and_never_overlap(spark):
    part = "call (555) 123-4567 or jane@x.org and bob [at] site [dot] com, 4111 1111 1111 1111. "
    docs = spark.createDataFrame([(k, part * k) for k in (0, 1, 40)], "doc_id long, text string")
    for row in pii.find(pii.id_and_text(docs), MODEL).collect():
        k, extra = row["doc_id"], [(s["start"], s["end"]) for s in row["extra"]]
        assert len(row["base"]) == 2 * k and len(extra) == 2 * k and extra == sorted(extra)
        assert all(a[1] <= b[0] for a, b in zip(extra, extra[1:]))
        assert not any(s < b["end"] and b["start"] < e for s, e in extra for b in row["base"])


def test_thresholds_per_kind():
    params = pii.PiiParams(min_precision=0.9, enough=10)
    held = [("email", s, 10, 10.0, 0, 0.0) for s in (3.0, 2.0, 1.0)]
    held += [("phone", 2.5, 10, 10.0, 10, 10.0), ("phone", 1.5, 10, 2.0, 10, 2.0), ("ip", 2.0, 2, 2.0, 0, 0.0)]
    found = pii.thresholds(held, params)
    assert (found["email"], found["phone"]) == (1.0, 2.5)
    assert found["ip"] == found["card"]  # too few of their own: that of all kinds together
    assert pii.thresholds([("phone", 1.0, 50, 0.0, 50, 0.0)], params) == {}


def test_all_documents_teach_the_model(spark):
    """Wrong candidates are found only beyond the 2,000 smallest hashed ids, and in rows without an id."""
    numbered = spark.range(2400).select(
        F.col("id").alias("doc_id"), F.row_number().over(Window.orderBy(F.xxhash64("id"))).alias("n")
    )
    texts = F.when(F.col("n") <= 2000, "mail a@b.com now").otherwise("order 12 345 678 90 of it")
    docs = numbered.select("doc_id", texts.alias("text"))
    assert pii.fit(docs) is not None
    nameless = F.when(F.col("n") <= 2000, F.col("doc_id"))
    own = F.when(F.col("n") > 2000, F.concat("text", F.lit(" "), F.col("doc_id"))).otherwise(F.col("text"))
    apart = docs.join(numbered, "doc_id").select(own.alias("text"), nameless.alias("doc_id"))
    assert pii.fit(apart) is not None
