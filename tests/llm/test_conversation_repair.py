"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from tableguard.llm import conversation_repair as C

WHITE = " \t\n\x0b\x0c\r"


def search(rows):
    """Cheapest (cost, letters) that leave ``(s?(ua)+)?``, by trying every edit; rows (initial, fault)."""
    @lru_cache(None)
    def best(i, done, inserts):
        tries = []
        if i == len(rows) and (done == "" or done[-1] == "a"):
            tries.append((0, ""))
        nxt = "a" if done[-1:] == "u" else "u"
        if inserts < 3:
            c, x = best(i, ("s" if done[:1] == "s" else "-") + nxt, inserts + 1)
            tries.append((c + 3, "I" + x))
        if i < len(rows):
            initial, fault = rows[i]
            c, x = best(i + 1, done, 0)
            tries.append((c + 4, "D" + x))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                c, x = best(i + 1, "-" + nxt, 0)
                tries.append((c + 3 + extra, "R" + x))
                if initial == nxt:
                    tries.append((c + extra, "K" + x))
                if initial == "s" and done == "":
                    c, x = best(i + 1, "s", 0)
                    tries.append((c + extra, "K" + x))
        return min(tries, default=(10 ** 9, ""))
    return best(0, "", 0)


def expected(table):
    """{conv_id: digest row} of a list of (conv_id, turn, role, text)."""
    held = {}
    for conv, turn, role, text in table:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(key.encode()) % 20
        rows = held.setdefault(conv, [])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in held.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, marks = set(), []
        for _, role, text in rows:
            end = text.rstrip(WHITE)
            marks.append((role[:1], "blank" if not end else "duplicate" if (role, text) in seen
                          else "truncated" if end[-1] not in ".!?" else ""))
            seen.add((role, text))
        cost, audit = search(tuple(marks))
        lines, at = [], 0
        for x in audit:
            follows = "assistant" if lines and lines[-1][2] == "u" else "user"
            if x == "I":
                lines.append((follows, "", follows[0]))
                continue
            _, role, text = rows[at]
            at += 1
            if x == "K":
                lines.append((role, text, role[:1]))
            elif x == "R":
                lines.append((follows, text, follows[0]))
        turns = [t for t, *_ in rows if t is not None]
        faults = [f for _, f in marks]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(marks, marks[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in lines).encode()).hexdigest())
    return out


def digest(spark, table, **options):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in table],
                               "conv_id long, turn long, role string, text string, present string, part int, lines int")
    damaged = C.damage(df)
    rows = C.digest(C.repair(damaged, damaged["present"], **options)).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def conversations(seed, n):
    rnd = random.Random(seed)
    table = []
    for conv in [None, *range(n)]:
        turn = 0
        for _ in range(rnd.choice([1, 2, 4, 9, 14])):
            turn += rnd.choice([1, 1, 1, 2, 5])
            table.append((conv, None if rnd.random() < 0.03 and not any(r[0] == conv and r[1] is None for r in table) else turn,
                          rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                          rnd.choice(["Yes.", "No!", "Why?", "cut off", "", " \n", None, "a. \t", f"t{turn}?", f"é{conv} {turn}."])))
    return table


@pytest.mark.parametrize("options", [{}, {"segment_rows": 1}, {"segment_rows": 3}, {"segment_bytes": 4}])
def test_against_search(spark, options):
    table = conversations(len(options) + options.get("segment_rows", 0), 60)
    assert digest(spark, table, **options) == expected(table)


def test_whole_table(spark):
    from tableguard.llm.queries import QUERIES
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, "/root/testdata/sf0.001").collect()
    assert {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in got} == expected(table)


def test_one_long_conversation_with_repeated_rows(spark):
    table = [(7, i // 3, "user" if i % 2 else "assistant", "same." if i % 3 else f"t{i}") for i in range(60)] + [(7, 99, "user", "Hi.")] * 40
    a = digest(spark, table, segment_rows=4)
    b = digest(spark, table)
    assert a == b and len(a[7][6]) >= 40
    assert a[7][5] == search(tuple(_marks(table)))[0]


def _marks(table):
    """Marks of a table in the operator's order, by its own segments."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    d = C.damage(df)
    rows = d.where("present").selectExpr("turn", "role", "text", "xxhash64(role, text) h").orderBy("turn", "h").collect()
    seen = set()
    for r in rows:
        end = r.text.rstrip(WHITE)
        yield (r.role[:1], "blank" if not end else "duplicate" if (r.role, r.text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((r.role, r.text))


def test_repaired_lines_and_string_ids(spark):
    df = spark.createDataFrame([("a", 1, "system", "S."), ("a", 2, "user", "Q?"), ("a", 3, "user", "R?"), ("c", 1, "user", "Q?"), ("b", 1, "assistant", "x")],
                               "conv_id string, turn int, role string, text string")
    got = {r.conv_id: r for r in C.repair(df).collect()}
    assert got["a"].audit == "KKR" and got["a"].cost == 3
    assert [(x.role, x.text) for x in got["a"].lines] == [("system", "S."), ("user", "Q?"), ("assistant", "R?")]
    assert (got["c"].audit, [(x.role, x.text) for x in got["c"].lines]) == ("KI", [("user", "Q?"), ("assistant", "")])
    assert (got["b"].audit, got["b"].cost, got["b"].lines) == ("D", 4, [])


def test_empty_table_and_dropped_conversation(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.digest(C.repair(C.damage(df))).count() == 0
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert digest(spark, [(conv, 1, "user", "x")]) == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
