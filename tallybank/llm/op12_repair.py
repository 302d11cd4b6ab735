"""Faults of conversations, and the cheapest edits that give each one a legal structure.

Legal are no messages, or an optional system message and then user and assistant in turn, assistant last: by the first
letters of the roles, `(s?(ua)+)?`. Messages are taken by turn, nulls first, then by role and text. A message's first
fault counts: blank (nothing but space and \\x09-\\x0D), duplicate (role and text occur earlier), truncated (its last other
character is not `.`, `!` or `?`). Edits are D(elete) at 2, which blank and duplicate messages must have, I(nsert) of an
empty user or assistant message anywhere at 5, K(eep) at 0 and R(erole) to user or assistant at 1; a truncated message
that stays costs 5 more. Of the cheapest lists of edits the least in ASCII order is taken; its letters are the audit.

The search is depth-first branch and bound with an explicit stack. Edits are tried in ASCII order, so prefixes come to a
node (message, state) in ASCII order too, and a table of the least cost seen there shows a later prefix that is not
cheaper to be worse. A prefix is left when its cost and a lower bound of the rest reach the incumbent; the bound is exact
up to the end of a run of `RUN` messages and takes the cheapest state at the start of each later run. The first incumbent
is the cost of following the bound greedily. When the stack is empty the incumbent is proved to be the least.

A conversation of up to `BLOCK` messages is searched whole. A longer one is cut into blocks by rank, so that no task holds
it: each block is searched from every state to every state, and the best chain of blocks is followed with one small row per
block. No list of edits of a block is a prefix of another, as each ends with the edit of a message; so taking the least
list per block and state loses nothing. Faults that need the whole conversation come from a join on a hash of the text.
The message-by-message results of long conversations are read back in order by one task that holds one message at a time:
a digest of a whole conversation needs that.

Rows: null role and text count as one space. A null conv_id is a conversation; equal rows are duplicates of each other. A
role's first letter is its first character, none if it is empty. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybank.llm.ranks import ranked
from tallybank.llm.stored import stored

BLOCK = 256
RUN = 8
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a message of that first letter, where it is legal.
LEGAL = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state and role of the next user or assistant message.
NEXT = tuple((ASSISTANT, "assistant") if state == USER else (USER, "user") for state in range(4))
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
NEVER = 1 << 60
MUST_GO, CUT_OFF, SOUND = "gone", "cut", ""

Step = tuple[str, int, int]
Ways = dict[int, tuple[int, str]]


def steps(initial: str, fault: str, state: int) -> list[Step]:
    """(edit, cost, state after it) of the edits of one message, in ASCII order; an insertion comes before the message."""
    out = [("D", DELETE, state), ("I", INSERT, NEXT[state][0])]
    if fault != MUST_GO:
        more = UNFINISHED if fault == CUT_OFF else 0
        if initial in LEGAL[state]:
            out.append(("K", more, LEGAL[state][initial]))
        out.append(("R", REROLE + more, NEXT[state][0]))
    return out


def lower_bounds(table: list[list[list[Step]]], closing: list[int]) -> list[list[int]]:
    """Least cost of the rest from each (message, state), where each run may start in any state. `closing`: at the end."""
    n = len(table)
    bounds = [closing] * (n + 1)
    after = list(closing)
    for row in range(n - 1, -1, -1):
        if (row + 1) % RUN == 0 and row + 1 < n:
            after = [min(bounds[row + 1])] * 4
        here = [min(cost + after[to] for edit, cost, to in table[row][state] if edit != "I") for state in range(4)]
        for _ in range(2):
            here = [min(here[state], INSERT + here[NEXT[state][0]]) for state in range(4)]
        bounds[row] = after = here
    return bounds


def search(messages: list[tuple[str, str]], entry: int, last: bool) -> Ways:
    """The least (cost, edits) from state `entry` over all messages (initial, fault).

    Of the last block, over the ends that are legal, under the key START; of another one, for each state at its end.
    """
    n = len(messages)
    table = [[steps(initial, fault, state) for state in range(4)] for initial, fault in messages]
    closing = [0, 2 * INSERT, INSERT, 0] if last else [0] * 4
    bounds = lower_bounds(table, closing)
    found: Ways = {}
    limit = first_limits(table, bounds, entry, last)
    least = [[NEVER] * 4 for _ in range(n + 1)]
    path: list[str] = []
    stack: list[tuple[int, int, int, int, str]] = [(0, entry, 0, 0, "")]
    while stack:
        row, state, cost, depth, edit = stack.pop()
        if cost >= least[row][state] or cost + bounds[row][state] >= reach(limit, state, last):
            continue
        least[row][state] = cost
        del path[max(depth - 1, 0) :]
        if edit:
            path.append(edit)
        if row < n:
            for edit, more, to in reversed(table[row][state]):
                stack.append((row + (edit != "I"), to, cost + more, depth + 1, edit))
            continue
        if last and state in (SYSTEM, USER):
            stack.append((row, NEXT[state][0], cost + INSERT, depth + 1, "I"))
            continue
        end = START if last else state
        if cost < limit[end]:
            limit[end] = cost
            found[end] = (cost, "".join(path))
    return found


def reach(limit: list[int], state: int, last: bool) -> int:
    """A prefix in `state` is of use below this cost."""
    if last:
        return limit[START]
    ends = (range(4), (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))[state]
    return max(limit[end] for end in ends)


def first_limits(table: list[list[list[Step]]], bounds: list[list[int]], entry: int, last: bool) -> list[int]:
    """One more than the cost of some list of edits to each end: each message's edit as the bound likes it best."""
    n, state, cost = len(table), entry, 0
    # Delete all, but for one system message; insert one or two.
    limit = [DELETE * n + more + 1 for more in (0, UNFINISHED, 2 * INSERT, 2 * INSERT)]
    for row in range(n - (not last and n > 0)):
        inserted = 0
        while True:
            choices = [s for s in table[row][state] if inserted < 2 or s[0] != "I"]
            edit, more, to = min(choices, key=lambda s: s[1] + bounds[row + (s[0] != "I")][s[2]])
            state, cost, inserted = to, cost + more, inserted + 1
            if edit != "I":
                break
    if last:
        return [cost + (0, 2 * INSERT, INSERT, 0)[state] + 1] * 4
    for _ in range(3):
        for edit, more, to in table[n - 1][state] if n else []:
            if edit != "I":
                limit[to] = min(limit[to], cost + more + 1)
        state, cost = NEXT[state][0], cost + INSERT
    return limit


class Editor:
    """Applies edits in order; keeps the state, so that inserted and reroled messages get their roles."""

    def __init__(self) -> None:
        self.state = START

    def apply(self, edits: str, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What becomes of one message by the edits before it, its own, and those that close the conversation."""
        for edit in edits:
            if edit == "D":
                continue
            if edit == "K":
                self.state = LEGAL[self.state][role[:1]]
                yield role, text
            else:
                self.state, new = NEXT[self.state]
                yield (new, "") if edit == "I" else (new, text)


@dataclass
class Message:
    turn: int | None
    role: str
    text: str
    repeated: bool | None


def faults(messages: list[Message]) -> list[str]:
    """The first fault of each: b(lank), d(uplicate), t(runcated), or none. `repeated` is known for long conversations."""
    seen: set[tuple[str, str]] = set()
    out = []
    for m in messages:
        rest = m.text.rstrip(BLANKS)
        repeated = (m.role, m.text) in seen if m.repeated is None else m.repeated
        if m.repeated is None:
            seen.add((m.role, m.text))
        out.append("b" if not rest else "d" if repeated else "" if rest[-1] in ".!?" else "t")
    return out


COUNTED = "blank long, duplicate long, truncated long, illegal long"
BLOCKS = (
    f"conv_id long, block long, blocks long, {COUNTED}, first_initial string, last_initial string, first_turn long, "
    "last_turn long, turns long, ways array<struct<entry:int,exit:int,cost:long,audit:string>>, "
    "repaired array<struct<role:string,text:string>>"
)
BLOCKS_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "block", "blocks", "blank", "duplicate", "truncated", "illegal")]
    + [("first_initial", pa.string()), ("last_initial", pa.string())]
    + [(c, pa.int64()) for c in ("first_turn", "last_turn", "turns")]
    + [
        ("ways", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ]
)


def legal_pair(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def judged(key: tuple, blocks: int, messages: list[Message]) -> dict:
    """One row of BLOCKS: what a block of a conversation holds and the ways through it."""
    found = faults(messages)
    initials = [m.role[:1] for m in messages]
    kinds = [MUST_GO if f in ("b", "d") else CUT_OFF if f else SOUND for f in found]
    known = [m.turn for m in messages if m.turn is not None]
    nodes = list(zip(initials, kinds, strict=True))
    last, ways, repaired = key[1] + 1 == blocks, [], None
    for entry in (START,) if key[1] == 0 else range(4):
        for end, (cost, audit) in search(nodes, entry, last).items():
            ways.append({"entry": entry, "exit": end, "cost": cost, "audit": audit})
    if blocks == 1:
        editor = Editor()
        pieces = per_message(ways[0]["audit"])
        made = [x for edits, m in zip(pieces, messages, strict=True) for x in editor.apply(edits, m.role, m.text)]
        repaired = [{"role": role, "text": text} for role, text in made]
    return {
        "conv_id": key[0],
        "block": key[1],
        "blocks": blocks,
        "blank": found.count("b"),
        "duplicate": found.count("d"),
        "truncated": found.count("t"),
        "illegal": sum(not legal_pair(a, b) for a, b in zip(initials, initials[1:], strict=False)),
        "first_initial": initials[0],
        "last_initial": initials[-1],
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "turns": len(set(known)),
        "ways": ways,
        "repaired": repaired,
    }


def per_message(audit: str) -> list[str]:
    """The edits of each message: insertions before it and its own; insertions at the end belong to the last one."""
    out, begin = [], 0
    for at, edit in enumerate(audit):
        if edit != "I":
            out.append(audit[begin : at + 1])
            begin = at + 1
    if begin < len(audit):
        out[-1] += audit[begin:]
    return out


def in_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first `width` columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and row[:width] != key:
                yield key, held
                held = []
            key = row[:width]
            held.append(row)
    if held:
        yield key, held


def judge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, block, rank, n, turn, role, text, repeated), sorted, to BLOCKS."""
    out = []
    for key, rows in in_groups(batches, 2):
        out.append(judged(key, -(-rows[0][3] // BLOCK), [Message(*row[4:]) for row in rows]))
        if len(out) == 200:
            yield pa.RecordBatch.from_pylist(out, BLOCKS_ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, BLOCKS_ARROW)


CHAIN = "conv_id long, block long, entry int, exit int, more_illegal long, same_turn long"


def chain_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, block, first_initial, last_initial, first_turn, last_turn, ways), sorted, to the chosen way of each
    block. Of a conversation, only four steps back per block are kept."""

    def chosen(conv_id: int | None, back: list[dict[int, int]], joints: list[tuple[int, int]]) -> pa.RecordBatch:
        state, rows = START, []
        for block in range(len(back) - 1, -1, -1):
            entry = back[block][state]
            rows.append((conv_id, block, entry, state, *joints[block]))
            state = entry
        names = [c.split()[0] for c in CHAIN.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    now, key = None, None
    for row in (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)):
        conv_id, block, first_initial, last_initial, first_turn, last_turn, ways = row
        if block == 0:
            if now is not None:
                yield chosen(key, back, joints)
            key, back, joints, now, turn = conv_id, [], [], {START: (0, 0)}, None
            joints.append((0, 0))
        else:
            joints.append((int(not legal_pair(initial, first_initial)), int(first_turn is not None and first_turn == turn)))
        best: dict[int, tuple] = {}
        for way in ways:
            if way["entry"] in now:
                cost, place = now[way["entry"]]
                total = (cost + way["cost"], place, way["audit"], way["entry"])
                best[way["exit"]] = min(best.get(way["exit"], total), total)
        # Lists of edits that end with a message's edit are never prefixes of each other: their order is that of their parts.
        order = sorted((place, audit, end) for end, (_, place, audit, _) in best.items())
        back.append({end: entry for end, (_, _, _, entry) in best.items()})
        now = {end: (best[end][0], place) for place, (_, _, end) in enumerate(order)}
        initial, turn = last_initial, turn if last_turn is None else last_turn
    if now is not None:
        yield chosen(key, back, joints)


def edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, rank, role, text, edits), sorted, to the repaired messages in order."""
    key, editor, place = None, None, 0
    for batch in batches:
        out = []
        for conv_id, rank, role, text, edits in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rank == 0:
                key, editor, place = conv_id, Editor(), 0
            for new_role, new_text in editor.apply(edits, role, text):
                out.append((key, place, new_role, new_text))
                place += 1
        if out:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.record_batch(columns, ["conv_id", "place", "role", "text"])


def hash_messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, place, role, text), sorted, to the sha256 of `role:text` joined by newlines; one message is held."""

    def row(conv_id: int | None, digest: hashlib._Hash) -> pa.RecordBatch:
        return pa.record_batch([pa.array([conv_id], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "sha256"])

    key, digest = None, None
    for batch in batches:
        for conv_id, place, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if place == 0:
                if digest is not None:
                    yield row(key, digest)
                key, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield row(key, digest)


@dataclass
class Repaired:
    """`summary`: a row per conversation. `long`: the repaired messages (conv_id, place, role, text) of those of more than
    BLOCK messages; of the others they are the column `repaired` of the summary."""

    summary: DataFrame
    long: DataFrame

    def messages(self) -> DataFrame:
        short = self.summary.select("conv_id", F.posexplode("repaired").alias("place", "message"))
        return short.select("conv_id", F.col("place").cast("long").alias("place"), "message.role", "message.text").unionByName(
            self.long
        )

    def digests(self) -> DataFrame:
        """(conv_id, sha256) of every conversation, of `role:text` joined by newlines."""
        lines = F.transform("repaired", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
        none = hashlib.sha256().hexdigest()
        short = self.summary.filter("repaired is not null")
        short = short.select("conv_id", F.sha2(F.array_join(lines, "\n"), 256).alias("sha256"))
        ordered = _in_order(self.long, ["conv_id"], "place").mapInArrow(hash_messages, "conv_id long, sha256 string")
        rest = self.summary.filter("repaired is null").select("conv_id")
        found = ordered.select(F.col("conv_id").alias("of"), "sha256")
        rest = rest.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
        return short.unionByName(rest.select("conv_id", F.coalesce("sha256", F.lit(none)).alias("sha256")))


def _in_order(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in (*keys, *order)])


def repair(conversations: DataFrame) -> Repaired:
    """Judge and repair all conversations (conv_id, turn, role, text)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    placed, _ = stored(ranked(rows, ["conv_id"], order, "conversation-rows"), "conversation-ranks")
    short, long = placed.filter(F.col("n") <= BLOCK), placed.filter(F.col("n") > BLOCK)
    with_flags = short.withColumn("repeated", F.lit(None).cast("boolean")).unionByName(_flagged(long))
    block = F.expr(f"rank div {BLOCK}").alias("block")
    columns = ["conv_id", block, "rank", "n", "turn", "role", "text", "repeated"]
    sorted_rows = _in_order(with_flags.select(*columns), ["conv_id", "block"], "rank")
    blocks, _ = stored(sorted_rows.mapInArrow(judge_blocks, BLOCKS), "conversation-blocks")

    counted = ["blank", "duplicate", "truncated", "illegal"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    way = F.col("ways")[0]
    whole = blocks.filter("blocks = 1").select(
        "conv_id", gaps, *counted, way["cost"].alias("cost"), way["audit"].alias("audit"), "repaired"
    )
    parts = _chosen(blocks.filter("blocks > 1"))
    joined = parts.groupBy("conv_id").agg(
        F.min("first_turn").alias("first_turn"),
        F.max("last_turn").alias("last_turn"),
        F.sum("turns").alias("turns"),
        *[F.sum(c).alias(c) for c in (*counted, "cost")],
        F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("audits"),
    )
    in_parts = joined.select(
        "conv_id",
        gaps,
        *counted,
        "cost",
        F.array_join(F.transform("audits", lambda p: p["audit"]), "").alias("audit"),
        F.lit(None).cast(whole.schema["repaired"].dataType).alias("repaired"),
    )
    return Repaired(whole.unionByName(in_parts), _edited(long, parts))


def _flagged(long: DataFrame) -> DataFrame:
    """Mark rows whose role and text occur earlier in their conversation."""
    hashed = long.withColumn("hash", F.sha2(F.col("text").cast("binary"), 256))
    firsts = hashed.groupBy("conv_id", "role", "hash").agg(F.min("rank").alias("first"))
    firsts = firsts.toDF("of_conv", "of_role", "of_hash", "first")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("role") == F.col("of_role"))
    joined = hashed.join(firsts, same & (F.col("hash") == F.col("of_hash")))
    return joined.select(*long.columns, (F.col("rank") > F.col("first")).alias("repeated"))


def _chosen(blocks: DataFrame) -> DataFrame:
    """Blocks of long conversations with the cost and audit of the way that the best chain takes through them."""
    ordered = _in_order(blocks.select("conv_id", "block", "first_initial", "last_initial", "first_turn", "last_turn", "ways"), ["conv_id"], "block")
    chain = ordered.mapInArrow(chain_blocks, CHAIN)
    chain = chain.withColumnsRenamed({"conv_id": "of_conv", "block": "of_block"})
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block"))
    way = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (w["exit"] == F.col("exit")))[0]
    parts = blocks.join(chain, same).select(
        "conv_id",
        "block",
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + F.col("more_illegal")).alias("illegal"),
        "first_turn",
        "last_turn",
        (F.col("turns") - F.col("same_turn")).alias("turns"),
        way["cost"].alias("cost"),
        way["audit"].alias("audit"),
    )
    return stored(parts, "conversation-chains")[0]


def _edited(long: DataFrame, parts: DataFrame) -> DataFrame:
    """The repaired messages of long conversations."""
    edits = F.regexp_extract_all("audit", F.lit("I*[DKR](?:I+$)?"), F.lit(0))
    per_row = parts.select(F.col("conv_id").alias("of_conv"), "block", F.posexplode(edits).alias("at", "edits"))
    per_row = per_row.select("of_conv", (F.col("block") * BLOCK + F.col("at")).alias("of_rank"), "edits")
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("rank") == F.col("of_rank"))
    joined = long.join(per_row, same).select("conv_id", "rank", "role", "text", "edits")
    return _in_order(joined, ["conv_id"], "rank").mapInArrow(
        edit_rows, "conv_id long, place long, role string, text string"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage rows by the crc32 of `conv_id:turn`, modulo 20, for tests of the repair: 0 drops a row, 1 empties its text,
    2 removes its `.`, `!` and `?`, 3 repeats it, 4 gives it the role user. Nulls count as one space."""
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
