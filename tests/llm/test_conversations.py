import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from rankloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, audit string, seq long, digest string"
WORD = re.compile(r"[^\x20\x09-\x0d]")
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def edits_of(kinds):
    """Every edit sequence with at most two insertions in a gap -> (cost, audit, initials): no parsing."""
    gaps = [()] + [(t,) for t in "ua"] + list(itertools.product("ua", repeat=2))
    choices = []
    for initial, must_go, truncated in kinds:
        own = [("D", "", 4)]
        if not must_go:
            own += [("K", initial, 3 * truncated), ("R", "u", 3 + 3 * truncated), ("R", "a", 3 + 3 * truncated)]
        choices += [[("I" * len(g), "".join(g), 3 * len(g)) for g in gaps], own]
    choices.append([("I" * len(g), "".join(g), 3 * len(g)) for g in gaps])
    for combined in itertools.product(*choices):
        yield sum(c[2] for c in combined), "".join(c[0] for c in combined), "".join(c[1] for c in combined)


def least(kinds):
    return min((cost, audit) for cost, audit, initials in edits_of(kinds) if re.fullmatch("(s?(ua)+)?", initials))


def of_top(found):
    return min(v for q, v in found.items() if q in C.AUTOMATON.accepting)


def test_cheapest_edits_against_all_edits():
    rng = random.Random(4)
    for n in range(120):
        kinds = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n % 4)]
        assert of_top(C.parse([(*k, 1) for k in kinds])) == least(kinds)


def shortest(kinds):
    """A plain table over (rows read, regular-expression state); longer conversations than all edits can be listed for."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "e", ("e", "u"): "u"}
    best = {"0": (0, "")}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for t in "ua":
                    to = step.get((state, t))
                    if to and (to not in best or (cost + 3, audit + "I") < best[to]):
                        best[to] = (cost + 3, audit + "I")
        return best

    best = inserted(best)
    for initial, must_go, truncated in kinds:
        new = defaultdict(list)
        for state, (cost, audit) in best.items():
            new[state].append((cost + 4, audit + "D"))
            if not must_go:
                for edit, t in (("K", initial), ("R", "u"), ("R", "a")):
                    if (state, t) in step:
                        new[step[state, t]].append((cost + COSTS[edit] + 3 * truncated, audit + edit))
        best = inserted({state: min(v) for state, v in new.items()})
    return min(best[s] for s in ("0", "e") if s in best)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if draw == 3 else 1)
    return out


def brute(rows):
    """The contract, one conversation at a time."""
    result = []
    after = defaultdict(list)
    for row in damage(rows):
        after[row[0]].append(row[1:])
    for conv in {r[0] for r in rows}:
        own = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            words = WORD.findall(text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = shortest(kinds)
        lines, said, todo = [], "", iter(own)
        for edit in audit:
            row = next(todo) if edit != "I" else None
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if said[-1:] == "u" else "user"
            said += role[:1]
            lines.append(f"{role}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", said)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        result.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=repr)


def got(df):
    return sorted(map(tuple, C.repair_damaged(df).collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(3)


def random_rows(seed, convs=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(longest)):
            rows.append((conv, turn + (turn > 6) * 2, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No!", "What?", "cut off", "é ß.  ", "ok. \n", " ", "", None, "a. b"])))
    return rows


def test_documents_of_the_driver(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("segment", [1, 3, 2048])
def test_any_cut_into_segments(spark, monkeypatch, segment):
    """Segments cut everywhere, one or three rows long, give what whole conversations give."""
    rows = random_rows(segment)
    segs = {}
    monkeypatch.setattr(C, "SEGMENT", segment)  # in this process: _segments is called here, not in a worker
    import pyarrow as pa
    for conv, own in itertools.groupby(sorted(damage(rows), key=lambda r: (r[0], r[1], r[2], r[3])), key=lambda r: r[0]):
        seen, dicts = set(), []
        for _, turn, role, text in own:
            words = WORD.findall(text)
            dicts.append({"conv_id": conv, "turn": turn, "role": role, "text": text, "copies": 1, "blank": not words,
                          "duplicate": (role, text) in seen, "truncated": bool(words) and words[-1] not in ".!?"})
            seen.add((role, text))
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType
        schema = to_arrow_schema(StructType.fromDDL(C._SEGMENT.format(id="long")))
        parts = [s for b in C._segments([pa.RecordBatch.from_pylist(dicts)], schema) for s in b.to_pylist()]
        assert segment > 1 or len(parts) == len(dicts)
        segs[conv] = C._chained(parts)[:2]
    want = {r[0]: (r[6], r[7]) for r in brute(rows)}
    assert segs == {k: v for k, v in want.items() if k in segs}


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = random_rows(11) + [(None, None, "user", "Hi."), (None, None, None, None), (None, 3, "assistant", "Well."), (None, 3, "assistant", "Well."),
                              (900, None, "user", "One."), (900, None, "user", "One."), (900, 5, "user", "One."), (900, 5, "assistant", "Two."),
                              (901, 1, "assistant", "x" * 300_000 + "."), (901, 2, "user", "y" * 300_000)]
    assert got(table(spark, rows)) == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [(7, n, rng.choice(["user", "assistant"]), f"{rng.randrange(400)}" + rng.choice([".", "", "!"])) for n in range(6000)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(table(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_empty_tables_and_conversations(spark):
    assert got(table(spark, [])) == []
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    assert got(table(spark, [(gone, 0, "user", "Hi.")])) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again?"), (1, 2, "user", "Hi."), (2, 0, "system", "Be kind."), (2, 1, "user", "So.")]
    totals, turns = C.repair(table(spark, rows))
    assert sorted((r.conv_id, r.cost, r.audit) for r in totals.collect()) == [(1, 7, "KRD"), (2, 3, "KKI")]
    assert [tuple(r) for r in turns.select("conv_id", "edit", "role", "text").orderBy("conv_id", "seq", "pos").collect()] == [
        (1, "K", "user", "Hi."), (1, "R", "assistant", "Again?"), (2, "K", "system", "Be kind."), (2, "K", "user", "So."), (2, "I", "assistant", "")]
