"""Conversation repair: the search against all edit lists, long conversations, awkward rows, and SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tallybank.llm import op12_repair
from tallybank.llm.queries import QUERIES, oracle_sql
from tests.compare import difference, oracle_connection
from tests.conftest import CHECKED, SMALL

TALK = "conv_id long, turn long, role string, text string"


def by_brute_force(nodes):
    """Every list of up to one insertion before each message and two at the end; None if it is not legal."""
    options = [[p + e for p in ("", "I", "II") for e in ("DKR" if f != "gone" else "D")] for _, f in nodes]
    best = None
    for choice in itertools.product(*options, ("", "I", "II")):
        made, cost = "", 0
        for edits, (initial, fault) in zip(choice, [*nodes, ("", "")], strict=True):
            for edit in edits:
                new = "a" if made[-1:] == "u" else "u"
                made += {"D": "", "I": new, "R": new, "K": initial if edit == "K" else ""}[edit]
                made += "?" if edit == "K" and not initial else ""
                cost += {"D": 2, "I": 5, "R": 1, "K": 0}[edit] + (5 if fault == "cut" and edit in "KR" else 0)
        if re.fullmatch("(s?(ua)+)?", made):
            found = (cost, "".join(choice))
            best = found if best is None else min(best, found)
    return best


def by_table(nodes):
    """Least cost and list by a plain forward table, for longer lists."""
    now = {0: (0, "")}
    for initial, fault in nodes:
        after = {}
        for state, (cost, audit) in now.items():
            for inserted in range(3):
                for edit, more, to in op12_repair.steps(initial, fault, state):
                    if edit != "I":
                        found = (cost + more, audit + edit)
                        after[to] = min(after.get(to, found), found)
                state, cost, audit = op12_repair.NEXT[state][0], cost + 5, audit + "I"
        now = after
    ends = []
    for state, (cost, audit) in now.items():
        for inserted in range(3):
            if state in (0, 3):
                ends.append((cost, audit))
            state, cost, audit = op12_repair.NEXT[state][0], cost + 5, audit + "I"
    return min(ends)


def drawn(draw, most):
    return [(draw.choice(["s", "u", "u", "a", "a", "t", ""]), draw.choice(["", "", "", "gone", "cut"])) for _ in range(draw.randint(0, most))]


def test_search_equals_brute_force():
    draw = random.Random(1)
    for _ in range(150):
        nodes = drawn(draw, 4)
        assert op12_repair.search(nodes, op12_repair.START, True)[0] == by_brute_force(nodes), nodes


def test_search_equals_a_table_on_longer_lists():
    draw = random.Random(2)
    for _ in range(300):
        nodes = drawn(draw, 40)
        assert op12_repair.search(nodes, op12_repair.START, True)[0] == by_table(nodes), nodes


def test_blocks_chain_to_the_whole():
    """From every state to every state, the least over the blocks is the least over the whole."""
    draw = random.Random(3)
    for _ in range(150):
        nodes = drawn(draw, 30) + [("u", "")]
        cut = draw.randint(1, len(nodes) - 1) if len(nodes) > 1 else 0
        first = op12_repair.search(nodes[:cut], 0, False) if cut else {0: (0, "")}
        joined = [
            (cost + more, audit + rest)
            for state, (cost, audit) in first.items()
            for more, rest in op12_repair.search(nodes[cut:], state, True).values()
        ]
        assert min(joined) == by_table(nodes)


def test_a_block_of_awkward_messages_is_searched_soon():
    draw = random.Random(4)
    for kinds in (["s"], ["u"], ["u", "a"], ["s", "u", "a", "t"]):
        nodes = [(draw.choice(kinds), draw.choice(["", "", "cut", "gone"])) for _ in range(op12_repair.BLOCK)]
        assert op12_repair.search(nodes, 0, True)[0] == by_table(nodes)
        op12_repair.search(nodes, op12_repair.ASSISTANT, False)


def expected(rows):
    """rows (conv_id, turn, role, text) after damage: a plain form of the whole result."""
    talks = {}
    for conv_id, turn, role, text in rows:
        talks.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv_id, messages in talks.items():
        messages.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        seen, nodes, counts = set(), [], Counter()
        for _, role, text in messages:
            rest = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            nodes.append((role[:1], {"blank": "gone", "duplicate": "gone", "truncated": "cut", "": ""}[fault]))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(nodes, nodes[1:], strict=False))
        turns = [m[0] for m in messages if m[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = by_table(nodes)
        made, at = [], 0
        for edit in audit:
            new = "assistant" if made and made[-1][0].startswith("u") else "user"
            if edit == "I":
                made.append((new, ""))
                continue
            if edit in "KR":
                made.append((messages[at][1] if edit == "K" else new, messages[at][2]))
            at += 1
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest, made))
    return sorted(out, key=repr)


def repaired(spark, rows):
    found = op12_repair.repair(spark.createDataFrame(rows, TALK))
    digests = {r.conv_id: r.sha256 for r in found.digests().collect()}
    messages = {}
    for r in found.messages().orderBy("conv_id", "place").collect():
        messages.setdefault(r.conv_id, []).append((r.role, r.text))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    rows = [tuple(r) for r in found.summary.select(*columns).collect()]
    return sorted(((*r, digests[r[0]], messages.get(r[0], [])) for r in rows), key=repr)


def talk(draw, conv_id, size):
    roles, texts = ["system", "user", "assistant", "tool", None, ""], ["Yes.", "No!", "why", " ", None, "", "so?\n"]
    made = []
    for turn in range(size):
        role = draw.choice(roles) if draw.random() < 0.2 else ("user", "assistant")[turn % 2]
        text = draw.choice(texts) if draw.random() < 0.2 else f"text {turn}."
        made.append((conv_id, draw.choice([turn, turn, turn, turn + 2, None]), role, text))
    return made


def test_conversations_of_all_lengths(spark, monkeypatch):
    draw = random.Random(5)
    rows = [m for c, size in enumerate([1, 2, 3, 5, 8, 30, 255, 256, 257, 700, 1300]) for m in talk(draw, c, size)]
    rows += talk(draw, None, 600) + [(50, 0, "user", "same.")] * 520 + [(51, t, None, None) for t in range(300)]
    draw.shuffle(rows)
    assert repaired(spark, rows) == expected(rows)


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None),
        (2, None, "user", "a" * 300_000),
        (2, None, "user", "a" * 300_000),
        (3, 5, "", "x."),
        (4, 9, "user", "你好。"),
        (5, -3, "assistant", "x?  \n"),
        (None, 1, "user", "q."),
        (None, 2, "assistant", "r."),
    ]
    assert repaired(spark, rows) == expected(rows)
    assert repaired(spark, []) == []


def test_damage_and_query_equal_sql(spark, tmp_path):
    for base in (SMALL, CHECKED):
        found = QUERIES["op12_repair"](spark, base)
        assert difference(found, oracle_connection(base), oracle_sql()["op12_repair"]) is None


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    draw = random.Random(6)
    rows = [m for c in range(60) for m in talk(draw, c if c else None, draw.choice([1, 1, 4, 300]))]
    rows += [(next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "Gone.")]
    data = spark.createDataFrame(rows, TALK).withColumns({"rank": F.lit(1), "block": F.lit(2), "n": F.lit(3)})
    data.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    connection = oracle_connection("/none")
    connection.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    found = QUERIES["op12_repair"](spark, str(tmp_path))
    assert found.filter("audit = ''").count() > 0
    assert difference(found, connection, oracle_sql()["op12_repair"]) is None


