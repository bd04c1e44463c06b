"""Conversation repair against an exhaustive search over short conversations and a plain pass."""

import hashlib
import random
import re
import zlib
from heapq import heappop, heappush

import pytest
from llm_cases import *  # noqa: F401,F403

from tillroll.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string, header boolean, audit string, k long"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        drawn = zlib.crc32(key.encode()) % 20
        if drawn == 0:
            continue
        text = "" if drawn == 1 else re.sub("[.!?]", "", text) if drawn == 2 else text
        out += [(conv, turn, "user" if drawn == 4 else role, text)] * (2 if drawn == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (
        r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()
    ))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else "none")
        seen.add((role, text))
    return out


def accepts(roles):
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def prefix_of_valid(roles):
    return re.fullmatch("s?(ua)*u?", roles) is not None


def best(rows, found):
    """(cost, audit, repaired lines): least cost, then least letters, by exhaustive best-first search."""
    queue, done = [(0, "", 0, "", ())], {}
    while queue:
        cost, audit, at, roles, lines = heappop(queue)
        shape = (at, roles if len(roles) < 2 else ("s" if roles[0] == "s" else "") + roles[-1] * 2)
        if done.setdefault(shape, (cost, audit)) != (cost, audit):
            continue
        if at == len(rows) and accepts(roles):
            return cost, audit, lines
        for name in ("user", "assistant"):
            if prefix_of_valid(roles + name[0]):
                heappush(queue, (cost + 5, audit + "I", at, roles + name[0], (*lines, f"{name}:")))
        if at < len(rows):
            _, _, role, text = rows[at]
            heappush(queue, (cost + 2, audit + "D", at + 1, roles, lines))
            if found[at] in ("none", "truncated"):
                extra = 5 if found[at] == "truncated" else 0
                for letter, name, spent in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if name and prefix_of_valid(roles + name[0]):
                        heappush(queue, (cost + spent + extra, audit + letter, at + 1,
                                         roles + name[0], (*lines, f"{name}:{text}")))
    raise AssertionError("no repair")


def expected(original):
    """{conv_id: the contract's columns} for rows (conv_id, turn, role, text) before the damage."""
    out = {}
    for conv in {r[0] for r in original}:
        rows = in_order(damage([r for r in original if r[0] == conv]))
        found = faults(rows)
        turns = {r[1] for r in rows if r[1] is not None}
        initials = "".join(r[2][:1] or "-" for r in rows)
        cost, audit, lines = best(rows, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def results(frame):
    return {r["conv_id"]: tuple(r[k] for k in COLUMNS) for r in frame.collect()}


def write(spark, rows, folder):
    frame = spark.createDataFrame([(*r, True, "x", 1) for r in rows], SCHEMA)
    frame.write.parquet(f"{folder}/conversations.parquet")
    return str(folder)


def test_every_conversation(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet")
    original = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert results(c.op12_conversations(spark, SMALL)) == expected(original)


def random_rows(rng, convs, longest):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["a.", "b!", "c", "d?  ", "", " \t", None, "e. f", "g\n", "long " * 50 + "."]
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, longest)):
            if rng.random() < 0.8:
                turn = rng.choice([turn, turn, turn, None, turn + 3])
                rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def test_nulls_ties_and_strange_roles(spark, tmp_path):
    rows = random_rows(random.Random(2), 150, 9)
    assert results(c.op12_conversations(spark, write(spark, rows, tmp_path))) == expected(rows)


def test_conversation_over_many_chunks_and_tasks(spark, tmp_path):
    rng = random.Random(7)
    rows = [(1, t, ("user", "assistant")[(t + (t > 150)) % 2], f"t{t}.") for t in range(300)]
    rows += [(2, t, "user", "same.") for t in range(120)] + [(3, 0, "system", "s.")]
    rows += [(4, None, rng.choice(["user", "assistant"]), f"{t}{rng.choice('.,')}") for t in range(200)]
    frame = spark.read.parquet(f"{write(spark, rows, tmp_path)}/conversations.parquet")
    wanted = {k: v[:-1] for k, v in expected(rows).items()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for chunk in (1, 3, 40):
            found = c.audits(c.damaged(frame), chunk=chunk).collect()
            assert {r["conv_id"]: tuple(r[k] for k in COLUMNS[:-1]) for r in found} == wanted
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "An answer."),
            (2, 5, "assistant", "Alone.")]
    frame = spark.createDataFrame([(*r, True, "x", 1) for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in c.repair(frame).collect())
    assert found == [
        (1, 0, 0, "user", "Hi.", "K"), (1, 1, 2, "assistant", "An answer.", "R"),
    ]
    for row in c.audits(frame).collect():
        assert row["audit"] == {1: "KDR", 2: "D"}[row["conv_id"]]


def test_empty_table(spark, tmp_path):
    folder = write(spark, [], tmp_path)
    assert c.op12_conversations(spark, folder).collect() == []
    assert c.repair(spark.read.parquet(f"{folder}/conversations.parquet")).collect() == []


def test_fix_up_stops_where_vectors_are_parallel():
    costs, rng = c.Costs(), random.Random(1)
    symbols = bytes(rng.choice([4, 8, 4, 8, 5, 10, 12, 0]) for _ in range(5000))
    old, new = c.FINAL, c.normal([7, 3, 0, 9])
    start, rows = costs.fix_up(symbols, old, new, costs.run(symbols, old))
    assert start == costs.run(symbols, new) and rows < 500


@pytest.mark.parametrize("letters", ["", "ua", "au", "sua", "s", "uu", "aa", "suau", "xuax"])
def test_shapes(letters):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "xtra"}
    rows = [(1, k, names[x], f"{k}.") for k, x in enumerate(letters)]
    symbols = bytes(4 * "sua".find(x) if x in "sua" else 12 for x in letters)
    audit, cost, _ = c.Costs().trace(symbols, c.FINAL, True, c.START)
    assert (cost, audit) == best(rows, ["none"] * len(rows))[:2]


def test_sql_agrees(spark, tmp_path):
    import duckdb

    rows = random_rows(random.Random(3), 60, 8)
    folder = write(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    assert {r[0]: tuple(r[1:]) for r in con.execute(c.OP12_SQL).fetchall()} == expected(rows)
