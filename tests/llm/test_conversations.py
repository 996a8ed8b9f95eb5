"""Repairs against a search over all edit strings."""

import hashlib
import heapq
import random
import re

from pyspark.sql import functions as F

from postlake.llm import conversations as C
from postlake.llm.queries import QUERIES
from tests.llm.helpers import empty

SCHEMA = "conversation_id string, turn long, role string, text string, cost int, audit string, _key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", "k") for r in rows], SCHEMA)


def plain(rows):
    """Cheapest first, then least letters: every partial edit string in a queue."""
    rows = sorted(((None if t is None else t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    first = [r[:1] for _, r, _ in rows]
    queue, settled = [(0, "", 0, ())], set()
    while True:
        cost, audit, at, out = heapq.heappop(queue)
        state = (at, "".join(r[0] for r, _ in out)[-1:], bool(out))
        if state in settled:
            continue
        settled.add(state)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out)):
            break
        steps = [(2, "I", at, (r, "")) for r in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            late = faults[at] == "truncated"
            steps.append((3, "D", at + 1, None))
            if faults[at] not in ("blank", "duplicate"):
                steps.append((late, "K", at + 1, (role or "?", text)))
                steps += [(2 + late, "R", at + 1, (r, text)) for r in ("user", "assistant")]
        for price, letter, then, put in steps:
            longer = (*out, put) if put else out
            if re.fullmatch("s?(ua)*u?", "".join(r[0] for r, _ in longer)):
                heapq.heappush(queue, (cost + price, audit + letter, then, longer))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in C.FAULTS),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def repaired(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_random_conversations_equal_the_search(spark):
    draw = random.Random(5)
    talks = {}
    for n in range(250):
        roles = draw.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant", "tool", None, "", "system"]])
        talks[f"c{n}"] = [
            (draw.choice([None, t, t, t, t * 2]), draw.choice(roles), draw.choice([None, "", " \n", "a.", "b!", "c?  ", "d", "é", f"{t}."]))
            for t in range(draw.randrange(8))
        ]
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    draw.shuffle(rows)
    got = repaired(C.repair_conversations(frame(spark, rows)))
    assert got.keys() == {c for c, talk in talks.items() if talk}
    for c, row in got.items():
        assert row == plain(talks[c]), (c, talks[c])


def test_proper_conversation_is_kept(spark):
    rows = [(None, 0, "system", "s."), (None, 1, "user", "q?"), (None, 2, "assistant", "a.")]
    got = repaired(C.repair_conversations(frame(spark, rows)))
    text = "system:s.\nuser:q?\nassistant:a."
    assert got == {None: (0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(text.encode()).hexdigest())}


def test_lost_rows_leave_their_conversation(spark):
    rows = [("a", 0, "user", "q."), ("b", 0, "user", "q."), ("b", 3, "user", "q."), ("b", 5, "assistant", "r" * 200_000 + ".")]
    got = repaired(C.repair_conversations(frame(spark, rows), F.col("turn") == 0))
    assert got["a"] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    # The copy that was lost makes the other no duplicate.
    assert got["b"][:7] == (1, 0, 0, 0, 0, 0, "KK")


def test_long_conversation_across_batches(spark):
    draw = random.Random(6)
    rows = [("long", t, draw.choice(["user", "assistant"]), f"{t % 4000} w.") for t in range(6_000)] + [("short", 1, "user", "x.")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = repaired(C.repair_conversations(frame(spark, rows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got["long"][2] == 6_000 - len({r[2:] for r in rows[:-1]})
    # The same costs by a plain table over the rows.
    costs, seen = {0: 0}, set()
    for _, _, role, text in rows[:-1]:
        grown = {s: min(costs.get(p, 1 << 30) + 2 * n for p in range(4) for n in range(3) if C._after(p, n) == s) for s in range(4)}
        new = {s: c + 3 for s, c in grown.items()}
        if (role, text) not in seen:
            for s, c in grown.items():
                to = C.NEXT[s]
                new[to] = min(new[to], c + (0 if C.NAMES[to] == role else 2))
        seen.add((role, text))
        costs = new
    assert got["long"][5] == min(costs[s] + 2 * C.ENDING[s] for s in range(4))
    assert got["short"][6] == "KI"


def test_empty_table(spark):
    assert C.repair_conversations(empty(frame(spark, [("a", 0, "user", "x.")]))).count() == 0


def test_query_returns_every_conversation(spark):
    out = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.001")
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert out.count() == given.select("conv_id").distinct().count()
    # Damage as the contract words it, on plain rows.
    import zlib
    talks = {}
    for conv, turn, role, text in given.select("conv_id", "turn", "role", "text").collect():
        mark = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        talk = talks.setdefault(conv, [])
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        talk += [] if mark == 0 else [(turn, "user" if mark == 4 else role, text)] * (2 if mark == 3 else 1)
    for row in out.collect():
        assert tuple(row)[1:] == plain(talks[row.conv_id])
