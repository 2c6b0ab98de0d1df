"""Conversation structure repair: the cheapest edits that give each conversation's roles the form
``(s?(ua)+)?``, decided by one integer minimum.

Every path of edits through a conversation has one scalar weight, a big integer: the high digits are the
path's cost, the low digits (three bits each, a fixed number of places) its audit letters from the left, with
zeros behind its end.  An edit adds its cost and its letter's digit at the path's next place; the smallest
weight that reaches a state is that state's, and the smallest at an accepting state decides cost, edits and
ties (ASCII-least letters) at once.  Paths of equal cost are never a prefix of one another, because more
letters for the same rows are inserts, which cost; so the minimum may be taken state by state.

Plan.  Rows are range-partitioned and sorted by (conversation, turn, hash of role and text, number), so a
conversation may lie in several tasks, and a run of equal rows too.  Each task cuts its rows into segments of
at most ``segment_rows`` rows and about ``segment_bytes`` of text.  A conversation that is one segment away
from the edges of its task is solved there.  For the others, a segment's weights between every pair of states
are taken (with duplicates found by the first place of each role and text over all segments), composed along
the conversation in a balanced tree, and the chosen path is given back to the segments.  Only these weights
meet in one task; texts are shuffled once, and joined to the chosen path only for cut conversations.

Edits: K keep 0, R rerole to user or assistant 3, D delete 4 (required for blank and duplicate rows), I insert
an empty user or assistant row 3; a truncated row that is not deleted adds 3.

Defined cases: nulls of role and text are one space; a null turn comes first and counts in no gap; rows of
one turn are ordered by a hash of role and text, so equal rows are adjacent; rows of a null conv_id are one
conversation; a role's initial is its first character; rows with ``present`` false are left out, but their
conversation is reported; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .arrays import materialize

SEGMENT_ROWS, SEGMENT_BYTES = 512, 4 << 20
# The edits' letters and costs, the roles that edits give, what ends a sentence, white space.
LETTERS = "\0DIKR"              # a letter's digit is its place; 0 pads
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
TRUNCATED_COST = 3
ENDS, SPACES = ".!?", " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
# States: nothing yet, after s, after u, after a.  Both accept: nothing, after a.
START, S, U, A = range(4)
ACCEPT = (START, A)
NEXT = {START: U, S: U, U: A, A: U}        # the role that comes next, by insert or rerole
ROLE = {U: "user", A: "assistant"}
FAULTS = ("", "blank", "duplicate", "truncated")

ROWS = "array<struct<turn: bigint, role: string, text: string>>"
STATS = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "min_turn", "max_turn")


# -- the decision --------------------------------------------------------------------------
def solve(rows: list[tuple[str, bool, bool]], starts=range(4)) -> tuple[int, dict]:
    """rows of (role initial, must go, truncated) -> (places, {(p, q): (weight, letters)}): the least weight
    of the edits that lead from state p before the rows to state q behind them."""
    places = len(rows) + 2 * (len(rows) + 1)      # more than two inserts in a row never pay
    cost = 3 * places
    out = {}
    for p in starts:
        best = {p: (0, 0)}

        def edit(into: dict, q: int, state: tuple[int, int], letter: int, price: int) -> None:
            weight, n = state
            weight += (price << cost) + (letter << (3 * (places - 1 - n)))
            if q not in into or weight < into[q][0]:
                into[q] = weight, n + 1

        for i in range(len(rows) + 1):
            for _ in range(2):
                for q, state in list(best.items()):
                    edit(best, NEXT[q], state, INSERT, COST[INSERT])
            if i == len(rows):
                break
            initial, must_go, truncated = rows[i]
            after: dict[int, tuple[int, int]] = {}
            more = TRUNCATED_COST if truncated else 0
            for q, state in best.items():
                edit(after, q, state, DELETE, COST[DELETE])
                if not must_go:
                    to = NEXT[q]
                    edit(after, to, state, REROLE, COST[REROLE] + more)
                    if initial == "s" and q == START:
                        edit(after, S, state, KEEP, COST[KEEP] + more)
                    elif initial == ("u" if to == U else "a"):
                        edit(after, to, state, KEEP, COST[KEEP] + more)
            best = after
        out |= {(p, q): x for q, x in best.items()}
    return places, out


def letters(weight: int, n: int, places: int) -> str:
    digits = (weight & ((1 << 3 * places) - 1)) >> 3 * (places - n)
    return "".join(LETTERS[digits >> 3 * (n - 1 - i) & 7] for i in range(n))


def weigh(cost: int, edits: str, places: int) -> tuple[int, int]:
    digits = 0
    for x in edits:
        digits = digits << 3 | LETTERS.index(x)
    return (cost << 3 * places) + (digits << 3 * (places - len(edits))), len(edits)


def compose(tables: list[tuple[int, dict]]):
    """Least weights through consecutive segments, as a balanced tree of (places, {(p, q): (weight, letters,
    state between)}, left, right)."""
    if len(tables) == 1:
        places, best = tables[0]
        return places, {k: (*x, None) for k, x in best.items()}, None, None
    half = len(tables) // 2
    left, right = compose(tables[:half]), compose(tables[half:])
    (lp, lt, *_), (rp, rt, *_) = left, right
    best: dict = {}
    for (p, mid), (w, n, _) in lt.items():
        high, low = w >> 3 * lp, w & ((1 << 3 * lp) - 1)
        for (m, q), (v, k, _) in rt.items():
            if m == mid:
                weight = ((high + (v >> 3 * rp) << 3 * (lp + rp)) + (low << 3 * rp)
                          + ((v & ((1 << 3 * rp) - 1)) << 3 * (lp - n)))
                if (p, q) not in best or weight < best[p, q][0]:
                    best[p, q] = weight, n + k, mid
    return lp + rp, best, left, right


def chosen(tree, p: int, q: int) -> Iterator[tuple[int, int, str]]:
    """(state before, state behind, letters) of each segment on the best path from p to q."""
    places, best, left, right = tree
    weight, n, mid = best[p, q]
    if left is None:
        yield p, q, letters(weight, n, places)
    else:
        yield from chosen(left, p, mid)
        yield from chosen(right, mid, q)


def least(tree) -> tuple[int, int]:
    """(final state, cost) of the best path from the start."""
    places, best, *_ = tree
    weight, q = min((best[START, q][0], q) for q in ACCEPT if (START, q) in best)
    return q, weight >> 3 * places


# -- rows ----------------------------------------------------------------------------------
def fault(role: str, text: str, fresh: bool) -> int:
    end = text.rstrip(SPACES)
    return 1 if not end else 2 if not fresh else 3 if end[-1] not in ENDS else 0


def stats_of(rows: list[dict], faults: list[int]) -> dict:
    """Counts of a segment's rows; ``head`` and ``tail`` are what its neighbours need."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    initials = [r["role"][:1] for r in rows]
    return {"n": len(rows), "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "turns": len(set(turns)), "min_turn": min(turns, default=None), "max_turn": max(turns, default=None),
            "head": initials[0] if rows else "", "tail": initials[-1] if rows else ""}


def joined_stats(segments: list[dict]) -> dict:
    """Counts of a conversation from those of its segments in order."""
    out, tail, last = dict.fromkeys(STATS[:6], 0), None, None
    low = high = None
    for s in segments:
        if not s["n"]:
            continue
        for k in STATS[:6]:
            out[k] += s[k]
        if tail is not None:
            out["illegal"] += tail + s["head"] not in LEGAL
        tail = s["tail"]
        if s["turns"]:
            out["turns"] -= last is not None and last == s["min_turn"]
            last = high = s["max_turn"]
            low = s["min_turn"] if low is None else low
    out["gaps"] = high - low + 1 - out["turns"] if low is not None else 0
    return out


def repaired(rows: list[dict], edits: str, state: int) -> list[dict]:
    """The lines that the edits leave, from the state before them."""
    lines, at = [], 0
    for x in edits:
        if x == "I":
            state = NEXT[state]
            lines.append({"role": ROLE[state], "text": ""})
            continue
        r = rows[at]
        at += 1
        if x == "K":
            state = S if r["role"][:1] == "s" else NEXT[state]
            lines.append({"role": r["role"], "text": r["text"]})
        elif x == "R":
            state = NEXT[state]
            lines.append({"role": ROLE[state], "text": r["text"]})
    return lines


def marked(rows: list[dict], faults: list[int]) -> list[tuple[str, bool, bool]]:
    return [(r["role"][:1], f in (1, 2), f == 3) for r, f in zip(rows, faults)]


SUMMARY = "segments long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def summary_of(stats: dict, segments: int, cost: int, audit: str) -> dict:
    return {"segments": segments} | {k: stats[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal")} | {"cost": cost, "audit": audit}


def _batches(items: Iterator[dict], schema: pa.Schema, bytes_of=lambda x: 64) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for x in items:
        held.append(x)
        size += bytes_of(x)
        if len(held) >= 4096 or size > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_LINE = pa.struct([("role", pa.string()), ("text", pa.string())])
_ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_SUMMARY = [("segments", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
            ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]


def _segments(rows: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """One row for each segment: solved conversations with their summary and lines, others (``whole`` false)
    with their rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)), ("part", pa.int32()), ("seq", pa.int64()),
                        ("whole", pa.bool_()), ("rows", pa.list_(_ROW)), ("lines", pa.list_(_LINE)), *_SUMMARY])

    def task(batches):
        part = TaskContext.get().partitionId()

        def found() -> Iterator[dict]:
            held, size, number, current, open_start = [], 0, 0, None, True
            started = False

            def segment(whole: bool) -> dict:
                base = {"conv_id": current, "part": part, "seq": number, "whole": whole, "rows": None, "lines": None}
                if not whole:
                    return base | {"rows": held}
                seen, faults = set(), []
                for r in held:
                    key = r["role"], r["text"]
                    faults.append(fault(*key, key not in seen))
                    seen.add(key)
                tree = compose([solve(marked(held, faults), (START,))])
                q, cost = least(tree)
                (_, _, audit), = chosen(tree, START, q)
                return base | {"lines": repaired(held, audit, START)} | summary_of(
                    joined_stats([stats_of(held, faults)]), 1, cost, audit)

            for b in batches:
                for r in b.to_pylist():
                    conv, present = r.pop("conv_id"), r.pop("present")
                    if started and conv != current:
                        yield segment(not open_start)
                        held, size, number, open_start = [], 0, number + 1, False
                    started, current = True, conv
                    if present:
                        if held and (len(held) >= most_rows or size + len(r["text"]) > most_bytes):
                            open_start = True       # the conversation has other segments
                            yield segment(False)
                            held, size, number = [], 0, number + 1
                        held.append(r)
                        size += len(r["text"])
            if started:
                yield segment(False)

        yield from _batches(found(), schema, lambda x: sum(len(r["text"]) for r in (x["rows"] or x["lines"] or ())) + 64)

    return rows.mapInArrow(task, f"conv_id {kind}, part int, seq long, whole boolean, rows {ROWS}, "
                                 f"lines array<struct<role: string, text: string>>, {SUMMARY}")


def _weights(cut: DataFrame) -> DataFrame:
    """(conv_id, part, seq, faults, stats, table) of each segment of a cut conversation."""
    at = cut.select("part", "seq", "conv_id", F.posexplode("rows").alias("i", "r"))
    at = at.groupBy("conv_id", F.md5(F.concat(F.length("r.role").cast("string"), F.lit(":"), "r.role", "r.text")).alias("h")).agg(
        F.min(F.struct("part", "seq", "i")).alias("f"))
    fresh = at.groupBy(F.col("f.part").alias("part"), F.col("f.seq").alias("seq")).agg(F.collect_list("f.i").alias("fresh"))
    kind = cut.schema["conv_id"].dataType.simpleString()
    stat = [(k, pa.int64()) for k in STATS] + [("head", pa.string()), ("tail", pa.string())]
    entry = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
    schema = pa.schema([("conv_id", to_arrow_type(cut.schema["conv_id"].dataType)), ("part", pa.int32()), ("seq", pa.int64()),
                        ("places", pa.int64()), ("stats", pa.struct(stat)), ("entries", pa.list_(entry))])

    def task(batches):
        for b in batches:
            out = []
            for x in b.to_pylist():
                own = set(x["fresh"] or ())
                faults = [fault(r["role"], r["text"], i in own) for i, r in enumerate(x["rows"])]
                places, best = solve(marked(x["rows"], faults))
                out.append({"conv_id": x["conv_id"], "part": x["part"], "seq": x["seq"], "places": places,
                            "stats": stats_of(x["rows"], faults),
                            "entries": [{"p": p, "q": q, "cost": w >> 3 * places, "edits": letters(w, n, places)}
                                        for (p, q), (w, n) in best.items()]})
            yield pa.RecordBatch.from_pylist(out, schema)

    stats = ", ".join(f"{k}: bigint" for k in STATS) + ", head: string, tail: string"
    return cut.join(fresh, ["part", "seq"], "left").select("conv_id", "part", "seq", "rows", "fresh").mapInArrow(
        task, f"conv_id {kind}, part int, seq long, places long, stats struct<{stats}>, "
              "entries array<struct<p: int, q: int, cost: bigint, edits: string>>")


def _paths(weights: DataFrame) -> DataFrame:
    """(part, seq, number, state, edits) of each segment on its conversation's best path; the summary stands in
    the row of the first segment."""
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("number", pa.int64()), ("state", pa.int32()),
                        ("edits", pa.string()), *_SUMMARY])

    def conversation(rows: list[dict]) -> Iterator[dict]:
        tree = compose([(r["places"], {(e["p"], e["q"]): weigh(e["cost"], e["edits"], r["places"]) for e in r["entries"]})
                        for r in rows])
        q, cost = least(tree)
        steps = list(chosen(tree, START, q))
        summary = summary_of(joined_stats([r["stats"] for r in rows]), len(rows), cost, "".join(x for *_, x in steps))
        for i, (r, (p, _, edits)) in enumerate(zip(rows, steps)):
            yield {"part": r["part"], "seq": r["seq"], "number": i, "state": p, "edits": edits} | (
                summary if not i else dict.fromkeys(summary) | {"segments": len(rows)})

    def task(batches):
        def found():
            held: list[dict] = []
            for b in batches:
                for r in b.to_pylist():
                    if held and r["conv_id"] != held[0]["conv_id"]:
                        yield from conversation(held)
                        held = []
                    held.append(r)
            if held:
                yield from conversation(held)
        yield from _batches(found(), schema)

    return (weights.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(
        task, f"part int, seq long, number long, state int, edits string, {SUMMARY}"))


def _edited(cut: DataFrame, paths: DataFrame) -> DataFrame:
    """The segments of cut conversations with their lines."""
    kind = cut.schema["conv_id"].dataType.simpleString()
    names = [n for n, _ in _SUMMARY]
    schema = pa.schema([("conv_id", to_arrow_type(cut.schema["conv_id"].dataType)), ("number", pa.int64()),
                        ("lines", pa.list_(_LINE)), *_SUMMARY])

    def task(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([
                {"conv_id": x["conv_id"], "number": x["number"], "lines": repaired(x["rows"], x["edits"], x["state"])}
                | {k: x[k] for k in names} for x in b.to_pylist()], schema)

    return cut.select("conv_id", "part", "seq", "rows").join(paths, ["part", "seq"]).mapInArrow(
        task, f"conv_id {kind}, number long, lines array<struct<role: string, text: string>>, {SUMMARY}")


def repair(turns: DataFrame, present: Column | None = None, segment_rows: int = SEGMENT_ROWS,
           segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """turns (conv_id, turn, role, text) -> (conv_id, number, lines, segments, gaps, blank, duplicate, truncated,
    illegal, cost, audit): a conversation's repaired lines in ``segments`` segments numbered from 0; counts, cost
    and audit stand in the row of segment 0."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"),
                        space("text").alias("text"), (F.lit(True) if present is None else present).alias("present"))
    rows = rows.withColumn("text", F.when(F.col("present"), F.col("text")).otherwise(F.lit("")))
    rows = rows.withColumns({"h": F.xxhash64("role", "text"), "id": F.monotonically_increasing_id()})
    order = ["conv_id", F.col("turn").asc_nulls_first(), "h", "id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = materialize(_segments(rows.select("conv_id", "turn", "role", "text", "present"), segment_rows, segment_bytes), "conversations")
    cut = pieces.where("NOT whole")
    edited = _edited(cut, materialize(_paths(_weights(cut)), "edits"))
    columns = ["conv_id", "number", "lines", *(n for n, _ in _SUMMARY)]
    return pieces.where("whole").withColumn("number", F.lit(0).cast("long")).select(*columns).unionByName(edited.select(*columns))


# -- the query's damage and digest -----------------------------------------------------------
def damage(turns: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 leaves the row out (``present``
    false), 1 empties its text, 2 takes its ``[.!?]`` away, 3 repeats it, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(space("text"), ENDS, "")).otherwise(space("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(space("role"))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"),
                        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def digest(segments: DataFrame) -> DataFrame:
    """One row for each conversation, with the hash of its lines ``role:text``.  A conversation of several
    segments is hashed piece by piece, in order, by the task that reads its segments."""
    import hashlib

    text = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    pieces = segments.select("conv_id", "number", F.size("lines").alias("n"), text.alias("text"), *(n for n, _ in _SUMMARY))
    names = [n for n, _ in _SUMMARY]
    kind, conv_type = segments.schema["conv_id"].dataType.simpleString(), to_arrow_type(segments.schema["conv_id"].dataType)

    def task(batches):
        def found():
            now, sha, some = None, None, False
            for b in batches:
                for x in b.to_pylist():
                    if x["number"] == 0:
                        if now is not None:
                            yield now | {"repaired_sha256": sha.hexdigest()}
                        now, sha, some = {k: x[k] for k in ("conv_id", *names)}, hashlib.sha256(), False
                    if x["n"]:
                        sha.update((("\n" if some else "") + x["text"]).encode())
                        some = True
            if now is not None:
                yield now | {"repaired_sha256": sha.hexdigest()}

        kinds = [("conv_id", conv_type), *_SUMMARY, ("repaired_sha256", pa.string())]
        for b in _batches(found(), pa.schema(kinds)):
            yield b.drop_columns(["segments"])

    long = (pieces.where("segments > 1").repartition("conv_id").sortWithinPartitions("conv_id", "number")
            .mapInArrow(task, f"conv_id {kind}, {SUMMARY}, repaired_sha256 string".replace("segments long, ", "")))
    short = pieces.where("segments = 1").select("conv_id", *names[1:], F.sha2("text", 256).alias("repaired_sha256"))
    return short.unionByName(long)
