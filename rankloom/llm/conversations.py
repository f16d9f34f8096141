"""Repair of conversations by generalised LR parsing over a role grammar.

A conversation's roles should spell ``(s?(ua)+)?``: an optional system row, then user and assistant in turn.
``GRAMMAR`` says so, :class:`Automaton` is its LR(0) automaton, and a conversation is repaired by parsing its
rows with weighted edits: keep a row (free), give it another role, delete it, or insert a row without text.  All
edits are followed at once in a graph-structured stack; stacks with equal tops are merged by the least (cost,
audit), the audit being the initials of the edits in order (Delete, Insert, Keep, Rerole).

Merging loses nothing.  Stacks with equal tops take the same continuations in this grammar, so only cost and
audit can differ later; and of two audits of equal cost over the same rows neither begins with the other (what
follows would be insertions, which cost), so the lesser of the two stays the lesser.

Plan.  A conversation may hold a third of all rows, so none is gathered into a task:

1. Equal rows (same conversation, turn, role, text) become one row with a count.  What was said earlier is found by
   an aggregate on (conversation, role, digest of the text), joined back.
2. The rows are range-partitioned and sorted by (conversation, turn, role, text), and read as a stream in
   segments of at most ``SEGMENT`` rows and ``SEGMENT_BYTES`` of text.  A segment that starts its conversation is parsed
   from the empty stack; any other from every stack top, as what comes before it is not known there.
3. Per conversation the segments' (from, to, cost, audit) moves, without texts, are chained to the cheapest
   whole audit, and each segment is told its part of it.
4. Every segment is repaired on its own.  Only a digest over a whole conversation has to read its segments in
   order; it keeps one hash state and no texts.

Edge cases.  A null role or text counts as one space; rows are ordered by turn (nulls first), then role, then text.
A null conv_id is a conversation of its own.  Repeated rows are duplicates.  Very long conversations and texts
take more segments.  A conversation without rows gives one row of zeros.  An empty table gives no rows.
Columns other than the four are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, map_arrow

# C: conversation, G: opened dialogue, P: a user row and its answer.
GRAMMAR = (("C", ()), ("C", ("G",)), ("G", ("s", "P")), ("G", ("P",)), ("G", ("G", "P")), ("P", ("u", "a")))
NAMES = {"u": "user", "a": "assistant"}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
LEGAL = {"su", "ua", "au"}
SEGMENT, SEGMENT_BYTES = 2048, 4 << 20


class Automaton:
    """The LR(0) automaton of a grammar; a stack is a tuple of states."""

    def __init__(self, grammar=GRAMMAR):
        self.grammar = grammar
        heads = {head for head, _ in grammar}

        def closed(items):
            items = set(items)
            todo = list(items)
            while todo:
                rule, dot = todo.pop()
                body = grammar[rule][1]
                if dot < len(body) and body[dot] in heads:
                    new = {(n, 0) for n, (head, _) in enumerate(grammar) if head == body[dot]} - items
                    items |= new
                    todo += new
            return frozenset(items)

        start = grammar[0][0]
        states = [closed((n, 0) for n, (head, _) in enumerate(grammar) if head == start)]
        self.goto: dict[tuple[int, str], int] = {}
        for number, items in enumerate(states):  # grows while it is read
            for symbol in sorted({grammar[r][1][d] for r, d in items if d < len(grammar[r][1])}):
                target = closed((r, d + 1) for r, d in items if d < len(grammar[r][1]) and grammar[r][1][d] == symbol)
                if target not in states:
                    states.append(target)
                self.goto[number, symbol] = states.index(target)
        done = lambda items: [r for r, d in items if d == len(grammar[r][1])]
        # A state with one whole rule and nothing else to do reduces at once.
        self.reduces = {n: done(items)[0] for n, items in enumerate(states) if len(items) == 1 and done(items)}
        self.accepting = {n for n, items in enumerate(states) if any(grammar[r][0] == start for r in done(items))}
        # One stack for each top that can stand between two rows, the empty one first.
        self.stacks = {0: (0,)}
        for stack in (todo := [(0,)]):
            for terminal in "sua":
                new = self.shift(stack, terminal)
                if new and new[-1] not in self.stacks:
                    self.stacks[new[-1]] = new
                    todo.append(new)

    @functools.cache
    def shift(self, stack: tuple[int, ...], terminal: str) -> tuple[int, ...] | None:
        """The stack after ``terminal`` and the reductions it allows; None where it is not allowed."""
        state = self.goto.get((stack[-1], terminal))
        if state is None:
            return None
        stack += (state,)
        while stack[-1] in self.reduces:
            head, body = self.grammar[self.reduces[stack[-1]]]
            stack = stack[:-len(body)]
            stack += (self.goto[stack[-1], head],)
        return stack


AUTOMATON = Automaton()


def _insertions(front: dict) -> None:
    """Add to the tops of the stack what insertions reach."""
    todo = list(front)
    while todo:
        cost, audit, stack = front[todo.pop()]
        for terminal in NAMES:
            new = AUTOMATON.shift(stack, terminal)
            if new and (new[-1] not in front or (cost + INSERT, audit + "I") < front[new[-1]][:2]):
                front[new[-1]] = (cost + INSERT, audit + "I", new)
                todo.append(new[-1])


def parse(rows: list[tuple[str, bool, bool, int]], top: int = 0) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) to each reachable stack top from ``top``.

    A row is (role's initial, whether it must go, whether it is truncated, copies): copies after the first must go.
    """
    front = {top: (0, "", AUTOMATON.stacks[top])}
    _insertions(front)
    for initial, must_go, truncated, copies in rows:
        new: dict = {}

        def offer(cost, audit, stack):
            if stack and (stack[-1] not in new or (cost, audit) < new[stack[-1]][:2]):
                new[stack[-1]] = (cost, audit, stack)

        more, tail = DELETE * (copies - 1), "D" * (copies - 1)
        for cost, audit, stack in front.values():
            cost += more
            offer(cost + DELETE, audit + "D" + tail, stack)
            if must_go:
                continue
            if truncated:
                cost += TRUNCATED
            offer(cost, audit + "K" + tail, AUTOMATON.shift(stack, initial))
            for terminal in NAMES:
                offer(cost + REROLE, audit + "R" + tail, AUTOMATON.shift(stack, terminal))
        front = new
        _insertions(front)
    return {state: (cost, audit) for state, (cost, audit, _) in front.items()}


def repaired(rows: list[dict], audit: str, top: int = 0):
    """``(edit, role, text)`` of what the edits of ``audit`` leave of ``rows``, read from stack top ``top``."""
    stack, edits = AUTOMATON.stacks[top], iter(audit)
    wanted = lambda: next(t for t in NAMES if AUTOMATON.shift(stack, t))

    def inserts():
        nonlocal stack
        for edit in edits:
            if edit != "I":
                return edit
            terminal = wanted()
            stack = AUTOMATON.shift(stack, terminal)
            out.append(("I", NAMES[terminal], ""))

    out: list[tuple[str, str, str]] = []
    for row in rows:
        for _ in range(row["copies"]):
            edit = inserts()
            if edit in ("K", "R"):
                terminal = row["role"][:1] if edit == "K" else wanted()
                stack = AUTOMATON.shift(stack, terminal)
                out.append((edit, row["role"] if edit == "K" else NAMES[terminal], row["text"]))
    inserts()
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, drawn by CRC-32 of ``conv_id:turn``; equal rows as one with ``copies``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    spelled = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    draw = F.crc32(F.encode(spelled, "UTF-8")) % 20
    return conversations.where(draw != 0).select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(draw == 3, 2).otherwise(1).cast("long").alias("copies"))


def collapsed(rows: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turn, role, text[, copies])``, equal ones counted and nulls as one space."""
    copies = F.sum("copies") if "copies" in rows.columns else F.count(F.lit(1))
    return (rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
                        *(["copies"] if "copies" in rows.columns else [])).groupBy("conv_id", "turn", "role", "text").agg(copies.alias("copies")))


_SEGMENT = ("conv_id {id}, starts boolean, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, "
            "first_role string, last_role string, moves array<struct<p:int,q:int,cost:long,audit:string>>, "
            "rows array<struct<role:string,text:string,copies:long>>")


def _segments(batches, schema: pa.Schema):
    """Stream of rows in order -> one row per segment."""
    held, size, conv, starts, seen = [], 0, None, False, False

    def segment():
        kinds = [(r["role"][:1], r["blank"] or r["duplicate"], r["truncated"], r["copies"]) for r in held]
        turns = sorted({r["turn"] for r in held if r["turn"] is not None})
        roles = [k[0] for k in kinds]
        moves = [{"p": p, "q": q, "cost": cost, "audit": audit} for p in ([0] if starts else AUTOMATON.stacks)
                 for q, (cost, audit) in parse(kinds, p).items()]
        return {"conv_id": conv, "starts": starts, "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(turns),
                "blank": sum(r["copies"] for r in held if r["blank"]),
                "duplicate": sum(0 if r["blank"] else r["copies"] - (not r["duplicate"]) for r in held),
                "truncated": sum(not must_go and cut for _, must_go, cut, _ in kinds),
                "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])) + sum((k[3] - 1) * (2 * k[0] not in LEGAL) for k in kinds),
                "first_role": roles[0], "last_role": roles[-1], "moves": moves,
                "rows": [{"role": r["role"], "text": r["text"], "copies": r["copies"]} for r in held]}

    done, bytes_done = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            other = not seen or row["conv_id"] != conv
            if held and (other or len(held) >= SEGMENT or size >= SEGMENT_BYTES):
                done.append(segment())
                bytes_done += size
                held, size, starts = [], 0, False
                if len(done) >= 2000 or bytes_done >= SEGMENT_BYTES:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, bytes_done = [], 0
            if other:  # the first conversation of a partition may go on from the one before
                conv, starts, seen = row["conv_id"], seen, True
            held.append(row)
            size += len(row["text"])
    if held:
        done.append(segment())
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def segments(files: Scratch, rows: DataFrame) -> DataFrame:
    """A written table of segments in order of ``seq``, from rows as :func:`collapsed` gives them."""
    rows = files(rows.withColumn("digest", F.unhex(F.md5(F.encode("text", "UTF-8")))))
    said = ["conv_id", "role", "digest"]
    first = files(rows.groupBy(*said).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    first = first.select(*(F.col(c).alias("f_" + c) for c in said), "first")
    same = functools.reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col("f_" + c)) for c in said))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    judged = rows.join(first, same, "left").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "copies", blank.alias("blank"),
        (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("duplicate"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"))
    judged = files(judged)  # written, as ranges are drawn from a pass of their own
    order = ["conv_id", "turn", "role", "text"]
    dealt = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType.fromDDL(_SEGMENT.format(id=rows.schema["conv_id"].dataType.simpleString()))

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        yield from _segments(batches, to_arrow_schema(schema))

    out = files(map_arrow(dealt, run, schema).withColumn("seq", F.monotonically_increasing_id()))
    files.drop(judged)
    return out


def _chained(parts: list[dict]) -> tuple[int, str, list[tuple[int, str]]]:
    """Least (cost, audit) over a conversation's segments, and each segment's entry top and part of the audit."""
    front = {0: (0, "", ())}
    for part in parts:
        new: dict = {}
        for move in part["moves"]:
            if move["p"] in front:
                cost, audit, path = front[move["p"]]
                cost, audit = cost + move["cost"], audit + move["audit"]
                if move["q"] not in new or (cost, audit) < new[move["q"]][:2]:
                    new[move["q"]] = (cost, audit, (path, (move["p"], move["audit"])))
        front = new
    cost, audit, path = min(v for q, v in front.items() if q in AUTOMATON.accepting)
    steps = []
    while path:
        path, step = path
        steps.append(step)
    return cost, audit, steps[::-1]


def chains(files: Scratch, segs: DataFrame) -> DataFrame:
    """A written table: per segment ``seq``, entry ``top`` and its part of the ``audit``; on a conversation's last segment
    also the conversation's totals (``total`` is null elsewhere)."""
    total = "total struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"
    schema = T.StructType([segs.schema["conv_id"], *T.StructType.fromDDL("seq long, top int, part string, " + total).fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, held = to_arrow_schema(schema), []

        def whole():
            cost, audit, steps = _chained(held)
            dated = [s for s in held if s["turns"]]
            shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
            gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - sum(s["turns"] for s in dated) + shared if dated else 0
            sums = {c: sum(s[c] for s in held) for c in ("blank", "duplicate", "truncated", "illegal")}
            sums["illegal"] += sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(held, held[1:]))
            for n, (s, (top, part)) in enumerate(zip(held, steps)):
                last = n + 1 == len(held)
                yield {"conv_id": s["conv_id"], "seq": s["seq"], "top": top, "part": part, "total": sums | {"gaps": gaps, "cost": cost, "audit": audit} if last else None}

        out = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    out += whole()
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist(list(whole()), arrow)

    narrow = segs.drop("rows", "starts").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return files(map_arrow(narrow, run, schema))


def _applied(segs: DataFrame, chained: DataFrame) -> DataFrame:
    """``(conv_id, seq, turns array<struct<edit, role, text>>)``: each segment repaired."""
    schema = T.StructType([segs.schema["conv_id"], *T.StructType.fromDDL("seq long, turns array<struct<edit:string,role:string,text:string>>").fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"conv_id": r["conv_id"], "seq": r["seq"],
                                               "turns": [dict(zip(("edit", "role", "text"), t)) for t in repaired(r["rows"], r["part"], r["top"])]}
                                              for r in batch.to_pylist()], arrow)

    return map_arrow(segs.select("conv_id", "seq", "rows").join(chained.select("seq", "top", "part"), "seq").select("conv_id", "seq", "rows", "top", "part"), run, schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two written tables: ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per conversation with
    rows, and its repaired rows ``(conv_id, seq, pos, edit, role, text)`` in order of seq and pos (deleted rows are gone)."""
    with Scratch(conversations.sparkSession) as files:
        segs = segments(files, collapsed(conversations))
        chained = chains(files, segs)
        turns = files.keep(files(_applied(segs, chained).select("conv_id", "seq", F.posexplode("turns").alias("pos", "turn")).select("conv_id", "seq", "pos", "turn.*")))
        return files.keep(files(chained.where("total IS NOT NULL").select("conv_id", "total.*"))), turns


def _digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` of ``role:text`` lines, a conversation's segments read in order."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    texts = turns.where(F.size("turns") > 0).select("conv_id", "seq", F.array_join(line, "\n").alias("lines"))
    schema = T.StructType([turns.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, state, conv, out = to_arrow_schema(schema), None, None, []
        for batch in batches:
            for at, lines in zip(batch.column("conv_id").to_pylist(), batch.column("lines")):
                if state is not None and at == conv:
                    state.update(b"\n")
                else:
                    if state is not None:
                        out.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
                    conv, state = at, hashlib.sha256()
                state.update(lines.as_buffer())
            if out:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": state.hexdigest()}], arrow)

    return map_arrow(texts.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "lines"), run, schema)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The contract's row for every original conversation, after the contract's damage."""
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    with Scratch(conversations.sparkSession) as files:
        segs = segments(files, collapsed(damaged(conversations)))
        chained = chains(files, segs)
        digests = files(_digests(_applied(segs, chained)))
        totals = chained.where("total IS NOT NULL").select(F.col("conv_id").alias("t_id"), "total.*")
        found = (conversations.select("conv_id").distinct().join(totals, F.col("conv_id").eqNullSafe(F.col("t_id")), "left")
                 .join(digests.withColumnRenamed("conv_id", "d_id"), F.col("conv_id").eqNullSafe(F.col("d_id")), "left"))
        empty = F.lit(hashlib.sha256(b"").hexdigest())
        return files.keep(files(found.select("conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                                             F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))))
