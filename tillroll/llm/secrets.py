"""Secret scan: all rules in one pass of one deterministic automaton over the bytes.

Texts of a batch are laid end to end, parted by a byte that no text contains and no rule matches, and
scanned once (``automaton.py``). Where a rule's accepting run stops, a match ends; the reversed
automaton of that rule, run back from there as far as the last match of its kind, finds the leftmost
start. Length checks then drop matches that are too short, without looking for others in their place.

A rule beyond the base starts only at the beginning of a text or after a byte that is none of
``A-Za-z0-9_.~+/%-``. Without that, every rule that runs on over such bytes may be under way beside
any other, and the subsets of rules under way, thus the states, double with each rule.

Defined results: a null text counts as empty; an empty text has no spans. Matches of one kind never
overlap; those of different kinds may. Repeated rows give repeated results. Extra columns are left
alone. Memory is bounded by ``STRETCH`` bytes of text or the longest single text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.automaton import Automaton
from tillroll.llm.common import id_and_text

STRETCH = 8 << 20
GAP = b"\xff"  # never part of UTF-8
VALUE = "[A-Za-z0-9+/_.=-]"
BEFORE = r"[\x00-\x24\x26-\x2A\x2C\x3A-\x40\x5B-\x5E\x60\x7B-\x7D\x7F-\xFF]"

# kind, pattern, least length in bytes; the first three are the base, fixed by the contract.
RULES = (
    ("assign", f"(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?{VALUE}+", 0),
    ("access", "AKIA[A-Z0-9]+", 20),
    ("hex", "[0-9a-f]+", 24),
    # code hosts and package registries
    ("github", "gh[oprsu]_[A-Za-z0-9]+", 40),
    ("github_pat", "github_pat_[A-Za-z0-9_]+", 60),
    ("gitlab", "glpat-[A-Za-z0-9_-]+", 26),
    ("npm", "npm_[A-Za-z0-9]+", 40),
    ("pypi", "pypi-[A-Za-z0-9_-]+", 60),
    ("docker", "dckr_pat_[A-Za-z0-9_-]+", 32),
    ("atlassian", "ATATT3[A-Za-z0-9_=-]+", 60),
    ("linear", "lin_api_[A-Za-z0-9]+", 40),
    # cloud services
    ("access_temporary", "ASIA[A-Z0-9]+", 20),
    ("google", "AIza[A-Za-z0-9_-]+", 39),
    ("google_client", "GOCSPX-[A-Za-z0-9_-]+", 35),
    ("google_token", r"ya29\.[A-Za-z0-9_-]+", 40),
    ("storage_account", "AccountKey=[A-Za-z0-9+/]+==", 60),
    ("digitalocean", "do[opr]_v1_[a-f0-9]+", 60),
    ("vault", r"hvs\.[A-Za-z0-9_-]+", 30),
    ("doppler", r"dp\.pt\.[A-Za-z0-9]+", 40),
    ("grafana", "glsa_[A-Za-z0-9]+_[a-f0-9]+", 40),
    ("newrelic", "NRAK-[A-Z0-9]+", 32),
    ("huggingface", "hf_[A-Za-z0-9]+", 37),
    # payment and shops
    ("stripe", "[sr]k_(live|test)_[A-Za-z0-9]+", 32),
    ("square", "sq0(atp|csp)-[A-Za-z0-9_-]+", 29),
    ("braintree", r"access_token\$(production|sandbox)\$[a-z0-9]+\$[a-f0-9]+", 40),
    ("shopify", "shp(at|ca|pa|ss)_[a-fA-F0-9]+", 38),
    # mail and chat
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
    ("slack_app", "xapp-[0-9]-[A-Za-z0-9-]+", 30),
    ("slack_hook", r"(https://)?hooks\.slack\.com/services/[A-Za-z0-9]+/[A-Za-z0-9]+/[A-Za-z0-9]+", 50),
    ("discord_hook", r"(https://)?discord(app)?\.com/api/webhooks/[0-9]+/[A-Za-z0-9_-]+", 60),
    ("telegram", "[0-9]+:AA[A-Za-z0-9_-]+", 43),
    ("twilio", "(AC|SK)[0-9a-f]+", 34),
    ("sendgrid", r"SG\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 50),
    ("mailgun", "key-[0-9a-z]+", 36),
    ("mailchimp", "[0-9a-f]+-us[0-9]+", 36),
    # keys, signed tokens, addresses with a password
    ("pem", "-----BEGIN [A-Z ]+-----", 20),
    ("putty", "PuTTY-User-Key-File-[0-9]", 20),
    ("age", "AGE-SECRET-KEY-1[A-Z0-9]+", 60),
    ("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    ("bearer", r"(?i)authorization: ?bearer [A-Za-z0-9._~+/-]+", 40),
    ("database", r"(postgres(ql)?|mysql|mongodb(\+srv)?|redis|amqps?)://[A-Za-z0-9._%-]*:[A-Za-z0-9._%!*-]+@[A-Za-z0-9.-]+", 20),
    ("url_password", r"https?://[A-Za-z0-9._%-]+:[A-Za-z0-9._%!*-]+@[A-Za-z0-9.-]+", 20),
)
BASE = ("assign", "access", "hex")
VALUE_LENGTH = 6
_VALUE_AT = re.compile(rb"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?")

_ONE_CLASS = re.compile(r"\[[^\]]+\]\+")


@lru_cache(maxsize=4)
def compiled(rules: tuple = RULES) -> tuple:
    """The searching automaton of all rules and the reversed one of each; a job builds them once."""
    backwards, patterns = [], []
    for kind, pattern, _ in rules:
        if kind not in BASE:
            fold = pattern[:4] if pattern.startswith("(?i)") else ""
            pattern = f"{fold}{BEFORE}({pattern[len(fold):]})"
        patterns.append(pattern)
        a = Automaton([pattern], search=False, backwards=True)
        backwards.append((a.table.tolist(), a.classes.tolist(), a.start, a.accepts.tolist(), a.width))
    return Automaton(patterns, search=True), backwards


def spans(texts: list[bytes], automata: tuple, rules: tuple = RULES) -> list[list[tuple[int, int, int]]]:
    """Per text, (start, end, rule) in bytes, by start and then by rule."""
    forward, back = automata
    buffer = GAP + GAP.join(texts) + GAP
    data = np.frombuffer(buffer, dtype=np.uint8)
    # Ends are read off the changes of the accepting set.
    accepts = forward.accepts[forward.run(data) // forward.width]
    begins = np.cumsum([1] + [len(t) + 1 for t in texts])
    found: list[list] = [[] for _ in texts]
    live = np.flatnonzero(accepts)
    for k, (kind, pattern, least) in enumerate(rules):
        inside = live[(accepts[live] >> k & 1) == 1]
        ends = inside[(accepts[inside + 1] >> k & 1) == 0]
        if _ONE_CLASS.fullmatch(pattern):  # the run is the match: short ones go before any walk
            first = inside[(accepts[inside - 1] >> k & 1) == 0]
            ends = ends[ends + 1 - first >= least]
        table, classes, start, final, width = back[k]
        owner = np.searchsorted(begins, ends, side="right") - 1
        lead = int(kind not in BASE)  # the byte before the match is part of what the automaton sees
        before, last = -1, 0
        for end, doc in zip(ends.tolist(), owner.tolist()):
            if doc != before:
                before, last = doc, int(begins[doc])
            state, at, begin = start, end, -1
            while at >= last - lead:
                state = table[state + classes[buffer[at]]]
                if not state:
                    break
                if final[state // width]:
                    begin = at
                at -= 1
            if begin < 0:
                continue
            begin += lead
            last = end + 1
            if end + 1 - begin < least:
                continue
            if kind == "assign" and end + 1 - _VALUE_AT.match(buffer, begin).end() < VALUE_LENGTH:
                continue
            found[doc].append((begin - int(begins[doc]), last - int(begins[doc]), k))
    for row in found:
        row.sort(key=lambda s: (s[0], s[2]))
    return found


def _code_points(text: bytes, row: list) -> list[tuple[int, int, int]]:
    if not row or text.isascii():
        return row
    at = np.cumsum(np.r_[0, (np.frombuffer(text, np.uint8) & 0xC0) != 0x80])
    return [(int(at[s]), int(at[e]), k) for s, e, k in row]


def find(
    docs: DataFrame, rules: tuple = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, spans): an array of kind, start, end in code points, by start and then rule order."""
    texts = id_and_text(docs, id_column, text_column)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    names, automata = [r[0] for r in rules], compiled(rules)

    def run(batches):
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            at = 0
            while at < len(column):
                stretch, held = [], 0
                while at < len(column) and (not stretch or held < STRETCH):
                    stretch.append(column[at].as_py())
                    held += len(stretch[-1])
                    at += 1
                rows = [
                    [{"kind": names[k], "start": s, "end": e} for s, e, k in _code_points(t, row)]
                    for t, row in zip(stretch, spans(stretch, automata, rules))
                ]
                ids = batch.column(0).slice(at - len(stretch), len(stretch))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(rows, pa.list_(kind))], ["doc_id", "spans"]
                )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run, f"doc_id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def op6_secrets(spark, sf_dir):
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def named(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *(count(k) for k in BASE),
        F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", named), ",").alias("spans"),
    )
