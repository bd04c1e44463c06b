import hashlib
import random
import re

import pytest

from llm_cases import *  # noqa: F403
from tillroll.llm import secrets
from tillroll.llm.automaton import Automaton

BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
LEAST = {k: least for k, _, least in secrets.RULES}


def expression(pattern):
    fold = "(?i)" if pattern.startswith("(?i)") else ""
    return f"{fold}(?<![A-Za-z0-9_.~+/%-])(?:{pattern[len(fold):]})"


PATTERNS = {k: re.compile((BASE.get(k) or expression(p)).encode()) for k, p, _ in secrets.RULES}


def brute(text, kinds=PATTERNS):
    out = []
    for n, kind in enumerate(kinds):
        for m in PATTERNS[kind].finditer(text):
            if len(m[0]) >= LEAST[kind] and (kind != "assign" or len(m[2]) >= 6):
                out.append((m.start(), m.end(), n))
    return sorted(out, key=lambda s: (s[0], s[2]))


FRAGMENTS = [
    b"password", b"PassWD", b"secret", b"token", b"api_key", b"apikey", b'"', b"'", b" ", b"  ", b":", b"=",
    b"abcdef", b"0123456789abcdef" * 2, b"AKIA", b"ABCDEFGH12345678", b"x", b".", b"ghp_" + b"A1" * 20,
    b"AIza" + b"b" * 36, b"-----BEGIN RSA PRIVATE KEY-----", "é".encode(), b"\n", b"deadbeef", b"-", b"xoxb-123-",
]


def test_spans_match_regular_expressions():
    random.seed(5)
    automata = secrets.compiled()
    for _ in range(30):
        texts = [b"".join(random.choices(FRAGMENTS, k=random.randint(0, 60))) for _ in range(40)]
        assert secrets.spans(texts, automata) == [brute(t) for t in texts]


@pytest.mark.parametrize("lanes", [1, 3, 64])
def test_strips_agree_with_one_pass(lanes):
    import numpy as np

    a = Automaton(["(?i)ab+c|x{3,}", "b[a-c]?d"], search=True)
    data = np.frombuffer(bytes(random.Random(1).choices(b"abcdxABX ", k=997)), np.uint8)
    state, plain = a.start, []
    for byte in data:
        state = int(a.table[state + a.classes[byte]])
        plain.append(state)
    assert a.run(data, lanes).tolist() == plain


def test_query_matches_brute_force(spark, small_texts):
    rows = by_id(secrets.op6_secrets(spark, SMALL))
    for i, text in small_texts.items():
        raw = text.encode()
        points = [(len(raw[:a].decode()), len(raw[:b].decode()), k) for a, b, k in brute(raw, list(BASE))]
        names = [f"{list(BASE)[k]}:{a}:{b}" for a, b, k in points]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in BASE] == [sum(n.startswith(k) for n in names) for k in BASE]
        assert set(names) <= set(rows[i]["spans"].split(",")) | {""}


HEX, LETTERS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
# Per kind of its own: how to make one from a random source, and a clean look-alike.
SAMPLES = {
    "github": ("ghp_{a36}", "ghp_{a12}"), "github_pat": ("github_pat_{a60}", "github_pat_{a20}"),
    "gitlab": ("glpat-{a20}", "glpat-{a5}"), "npm": ("npm_{a36}", "npm_install"),
    "pypi": ("pypi-{a70}", "pypi-mirror"), "docker": ("dckr_pat_{a27}", "dckr_pat_x"),
    "atlassian": ("ATATT3{a60}", "ATATT3x"), "linear": ("lin_api_{a40}", "lin_api_key"),
    "access_temporary": ("ASIA{u16}", "ASIA PACIFIC"), "google": ("AIza{a35}", "AIzawa"),
    "google_client": ("GOCSPX-{a28}", "GOCSPX-"), "google_token": ("ya29.{a40}", "ya29.5"),
    "storage_account": ("AccountKey={a86}==", "AccountKey=none"),
    "digitalocean": ("dop_v1_{h64}", "dop_v1_beef"), "vault": ("hvs.{a40}", "hvs.md"),
    "doppler": ("dp.pt.{a40}", "dp.pt.br"), "grafana": ("glsa_{a32}_{h8}", "glsa_x_1"),
    "newrelic": ("NRAK-{u27}", "NRAK-1"), "huggingface": ("hf_{a34}", "hf_hub"),
    "stripe": ("sk_live_{a24}", "sk_live_mode"), "square": ("sq0atp-{a22}", "sq0atp-"),
    "braintree": ("access_token$production${h16}${h32}", "access_token$production$"),
    "shopify": ("shpat_{h32}", "shpat_1"), "slack": ("xoxb-{a24}", "xoxb-"),
    "slack_app": ("xapp-1-{a30}", "xapp-1-x"),
    "slack_hook": ("https://hooks.slack.com/services/T{u8}/B{u8}/{a24}", "hooks.slack.com/services/"),
    "discord_hook": ("https://discord.com/api/webhooks/123456789012345678/{a60}", "discord.com/api/webhooks/1"),
    "telegram": ("123456789:AA{a33}", "12:AA"), "twilio": ("AC{h32}", "ACe"),
    "sendgrid": ("SG.{a22}.{a43}", "SG.x.y"), "mailgun": ("key-{h32}", "key-word"),
    "mailchimp": ("{h32}-us12", "be-us1"), "pem": ("-----BEGIN PRIVATE KEY-----", "-----BEGIN"),
    "putty": ("PuTTY-User-Key-File-2", "PuTTY-User-Key"), "age": ("AGE-SECRET-KEY-1{u58}", "AGE-SECRET-KEY-1"),
    "signed_token": ("eyJ{a20}.eyJ{a30}.{a40}", "eyJ.eyJ"), "bearer": ("Authorization: Bearer {a40}", "Authorization: Bearer x"),
    "database": ("postgresql://app:{a12}@db.example.org", "postgresql://db.example.org/app"),
    "url_password": ("https://bot:{a12}@example.org", "https://example.org:8080/x@y"),
}


def made(template, draw):
    kinds = {"a": LETTERS + LETTERS.upper() + "0123456789", "u": LETTERS.upper() + "0123456789", "h": HEX}
    return re.sub(r"\{([auh])(\d+)\}", lambda m: "".join(draw.choices(kinds[m[1]], k=int(m[2]))), template)


def test_every_kind_finds_its_own_and_leaves_look_alikes():
    kinds = [k for k, _, _ in secrets.RULES]
    assert set(SAMPLES) == set(kinds) - set(secrets.BASE) and len(SAMPLES) >= 30
    draw, automata = random.Random(8), secrets.compiled()
    for kind, (secret, clean) in SAMPLES.items():
        value, plain = made(secret, draw), made(clean, draw)
        hits, none = secrets.spans([f"see ({value}) here".encode(), f"see ({plain}) here".encode()], automata)
        found = [(a, b) for a, b, k in hits if kinds[k] == kind]
        assert len(found) == 1 and found[0][1] == 5 + len(value), kind
        assert not [k for _, _, k in none if kinds[k] == kind], kind


def test_all_kinds_together_match_regular_expressions():
    draw, automata = random.Random(9), secrets.compiled()
    parts = [made(t, draw).encode() for pair in SAMPLES.values() for t in pair] + FRAGMENTS
    for _ in range(6):
        texts = [b"".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(30)]
        assert secrets.spans(texts, automata) == [brute(t) for t in texts]


def test_edges(spark, edge_docs, edge_texts, empty_docs):
    assert secrets.find(edge_docs).count() == len(edge_texts)
    assert secrets.find(empty_docs).collect() == []
    frame = spark.createDataFrame([(1, "𝒳é token = abcdef1"), (2, None)], "doc_id long, text string")
    rows = by_id(secrets.find(frame))
    assert [tuple(s) for s in rows[1]["spans"]] == [("assign", 3, 18)] and rows[2]["spans"] == []
