"""Secret scan over a trigram inverted index, with DataFrame functions only.

1. From each rule's regex a Boolean trigram query is derived (an OR of ANDs): every match must
   contain, ignoring case, all trigrams of one clause.  A rule with a clause that has no trigram
   gets no query and is scanned in full.
2. The index holds, for every trigram that some query names, the documents that contain it.
3. A clause's postings are intersected: a document that has as many of the clause's trigrams as
   the clause names is a candidate of the rule.
4. Candidates, and all documents for rules without a query, are verified by the regex itself.

Spans are code points, end exclusive, over the whole text.  Per rule, matches are leftmost and
non-overlapping; those whose value is shorter than the rule's minimum are dropped afterwards, so
a dropped match still consumes its characters.

Edge cases: a null or empty text has no span.  A null document id is an id like any other
(null-safe joins).  Repeated ids share one candidate entry, which only widens the candidates;
every input row gives one output row with the spans of its own text; an empty table gives none.  Very long texts
are scanned whole, in work that grows with the text and its secrets.  Spans that begin at one place are ordered as their
rules.  Extra columns are kept, whatever their names; ``scan`` replaces a column that has the name of its result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, checked_broadcast, free_name, whole_text


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` matches a secret; the group ``value`` needs ``min_length`` characters."""

    kind: str
    pattern: str
    value: int
    min_length: int


RULES = (
    SecretRule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # A run of [0-9a-f] is one match, so asking for 32 in the regex drops the same runs.
    SecretRule("hex", r"[0-9a-f]{32,}", 0, 32),
)

# Clauses that a regex may be expanded into; a part that would exceed it counts as "anything".
MAX_CLAUSES = 256
ANYTHING = "\0"


def _product(left: set[str], right: set[str]) -> set[str]:
    if len(left) * len(right) > MAX_CLAUSES:
        return {a + ANYTHING for a in left}
    return {a + b for a in left for b in right}


def _expand(parsed) -> set[str]:
    """Strings that describe every match: literal characters in lower case, or ANYTHING."""
    out = {""}
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            part = {chr(arg).lower()}
        elif name == "SUBPATTERN":
            part = _expand(arg[-1])
        elif name == "BRANCH":
            part = set().union(*(_expand(branch) for branch in arg[1]))
        elif name == "AT":
            part = {""}
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            body = _expand(inner)
            if (least, int(most)) == (0, 1):
                part = body | {""}
            elif least:
                part = reduce(_product, [body] * min(least, 4))
                part = part if least == most and least <= 4 else {p + ANYTHING for p in part}
            else:
                part = {ANYTHING}
        else:
            part = {ANYTHING}
        out = _product(out, part if len(part) <= MAX_CLAUSES else {ANYTHING})
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of clauses, each an AND of trigrams; None where some match need not contain any."""
    clauses = {frozenset(run[i:i + 3] for run in text.split(ANYTHING) for i in range(len(run) - 2))
               for text in _expand(re._parser.parse(pattern))}
    if frozenset() in clauses:
        return None
    return sorted((c for c in clauses if not any(other < c for other in clauses)), key=sorted)


def trigram_index(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings ``(trigram, key)`` of the given trigrams, each document once per row it has.

    The look-ahead finds overlapping trigrams in one pass over the lowered text. ``lower`` may map
    further characters to a-z, which can only add postings.
    """
    first = "".join(sorted({re.escape(t[0]) for t in trigrams}))
    pattern = f"(?=[{first}])(?=({'|'.join(re.escape(t) for t in trigrams)}))"
    found = F.array_distinct(F.regexp_extract_all(F.lower(whole_text(text)), F.lit(pattern), F.lit(1)))
    return docs.select(F.col(key), F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame | None:
    """``(key, rules)``: for each document with a satisfied clause, the bit set of its rules.

    None when no rule has a trigram query.  A written table.
    """
    clauses = [(r, n, clause) for r, rule in enumerate(rules) for n, clause in enumerate(trigram_query(rule.pattern) or [])]
    if not clauses:
        return None
    trigrams = sorted(set().union(*(clause for _, _, clause in clauses)))
    uses = {t: [(r, n, len(clause)) for r, n, clause in clauses if t in clause] for t in trigrams}
    used_by = F.create_map(*(x for t, rows in uses.items() for x in (F.lit(t), F.array(*(
        F.struct(F.lit(r).alias("rule"), F.lit(n).alias("clause"), F.lit(need).alias("need")) for r, n, need in rows)))))
    postings = trigram_index(docs, trigrams, key, text).select(F.col(key), F.explode(used_by[F.col("trigram")]).alias("use"))
    satisfied = (postings.groupBy(key, "use").agg(F.count("*").alias("n")).where("n >= use.need")
                 .select(F.col(key), F.expr("shiftleft(1L, use.rule)").alias("rule")))
    with Scratch(docs.sparkSession) as files:
        return files.keep(files(satisfied.groupBy(key).agg(F.bit_or("rule").alias("rules"))))


# Positions are running sums, taken in blocks of so many items: within a block and over the blocks an array grows by one
# entry at a time, which copies it, so the work for n items is n * BLOCK / 2 + (n / BLOCK) ** 2 / 2 small steps.
BLOCK = 128
CHUNK = 1024  # code points
SPAN = "struct<start:int,ord:int,stop:int,kind:string>"


def _running(items: Column, advance, entries, kind: str) -> Column:
    """All of ``entries(at, item)`` (arrays of ``kind``), where ``at`` is 0 before the first item and ``advance(at, item)``
    after an item.  ``items`` is a column that exists, as it is read many times; advancing is adding or taking the greater."""
    nothing = F.expr(f"cast(array() as array<{kind}>)")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda n: F.slice(items, n * BLOCK + 1, BLOCK))
    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
    add = lambda held, block: F.struct(F.aggregate(block, held["at"], advance).alias("at"), F.concat(held["starts"], F.array(held["at"])).alias("starts"))
    starts = F.aggregate(blocks, none, add, lambda held: held["starts"])
    grow = lambda held, item: F.struct(advance(held["at"], item).alias("at"), F.concat(held["out"], entries(held["at"], item)).alias("out"))
    found = F.transform(F.arrays_zip(blocks.alias("items"), starts.alias("at")), lambda block: F.aggregate(
        block["items"], F.struct(block["at"].alias("at"), nothing.alias("out")), grow, lambda held: held["out"]))
    return F.when(F.size(items) > 0, F.flatten(found)).otherwise(nothing)


def _sizes(text: Column, rule: SecretRule) -> Column:
    """(gap, match, value) lengths of the rule's matches, in order; no value after the last gap. Null without a match."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else matches
    rows = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    sizes = F.transform(rows, lambda r: F.struct(F.length(r["gap"]).alias("gap"), F.coalesce(F.length(r["match"]), F.lit(0)).alias("match"),
                                                 F.coalesce(F.length(r["value"]), F.lit(-1)).alias("value")))
    return F.when(F.regexp_like(text, pattern), sizes)


def _spans(sizes: Column, rule: SecretRule, order: int) -> Column:
    """Array of (start, order, end, kind) of the rule's matches that are long enough."""
    def entries(at, row):
        start = at + row["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), (start + row["match"]).alias("stop"), F.lit(rule.kind).alias("kind"))
        return F.filter(F.array(span), lambda _: row["value"] >= rule.min_length)

    return _running(sizes, lambda at, row: at + row["gap"] + row["match"], entries, SPAN)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with the column ``into``: all spans (start, ord, stop, kind) by start, then rule order."""
    hits = candidates(docs, rules, key, text)
    base = docs.select(*(c for c in docs.columns if c != into))
    bits, own = free_name(docs.columns, "rules_of_row"), free_name(docs.columns, "key_of_row")
    if hits is None:
        judged = base.withColumn(bits, F.lit(0).cast("long"))
    else:
        side = hits.select(F.col(key).alias(own), F.col("rules").alias(bits))
        judged = base.join(checked_broadcast(side), F.col(key).eqNullSafe(F.col(own)), "left").drop(own)
    sizes = []
    for n, rule in enumerate(rules):
        wanted = _sizes(whole_text(text), rule)
        if trigram_query(rule.pattern) is not None:
            wanted = F.when(F.col(bits).bitwiseAND(1 << n) != 0, wanted)
        sizes.append(wanted.alias(f"rule{n}"))
    # Behind a generator the lengths are taken once, however often the positions read them.
    cut = free_name([*judged.columns, into], "match_sizes")
    made = judged.select("*", F.explode_outer(F.array(F.struct(*sizes))).alias(cut))
    spans = [F.coalesce(_spans(F.col(cut)[f"rule{n}"], rule, n), F.expr(f"cast(array() as array<{SPAN}>)")) for n, rule in enumerate(rules)]
    return made.withColumn(into, F.array_sort(F.concat(*spans))).drop(bits, cut)


def secret_spans(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts per kind, all spans as text, and their digest."""
    found = scan(docs.select("doc_id", "text")).withColumn("spans", _listed(F.col("found")))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(r.kind) for r in RULES),
                        F.sha2(F.encode("spans", "UTF-8"), 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, mark: str = "[secret]", rules=RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``mark`` (overlapping spans: one mark) and
    ``n_chars``, where there is such a column, counted anew for changed texts.  Rows, order of columns
    and texts without a secret stay as they are.

    A text with secrets is cut into chunks once, and what stands between two secrets is taken from the chunks
    that it spans, so the work grows with the text and not with its secrets times its length.
    """
    found, clean, cut = (free_name(docs.columns, c) for c in ("found_spans", "clean_text", "text_chunks"))
    secret = F.size(found) > 0
    chunks = F.when(secret, F.regexp_extract_all(whole_text(), F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    # Behind a generator the spans and chunks are made once, however often they are used.
    both = F.explode_outer(F.array(F.struct(F.col(found).alias("spans"), chunks.alias("chunks")))).alias(cut)
    made = scan(docs, rules, into=found).select(*docs.columns, found).select(*docs.columns, both)
    spans, chunks, secret = F.col(cut)["spans"], F.col(cut)["chunks"], F.size(F.col(cut)["spans"]) > 0

    def between(start, stop):
        first = F.floor(start / CHUNK).cast("int")
        held = F.array_join(F.slice(chunks, first + 1, F.floor((stop - 1) / CHUNK).cast("int") - first + 1), "")
        return F.when(stop > start, F.substring(held, start - first * CHUNK + 1, stop - start)).otherwise("")

    advance = lambda at, span: F.greatest(at, span["stop"])
    entries = lambda at, span: F.filter(F.array(F.concat(between(at, span["start"]), F.lit(mark))), lambda _: span["start"] >= at)
    ends = F.aggregate(spans, F.lit(0), advance)
    size = (F.size(chunks) - 1) * CHUNK + F.length(F.element_at(chunks, -1))
    text = F.concat(F.array_join(_running(spans, advance, entries, "string"), ""), between(ends, size))
    out = made.withColumn(clean, F.when(secret, text).otherwise(F.col("text")))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(clean).alias("text"))
        elif c == "n_chars":
            columns.append(F.when(secret, F.length(clean).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rules(ord, kind, pat, grp, need) AS (VALUES
  (0, 'assign', '((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 16),
  (2, 'hex', '[0-9a-f]+', 0, 32)),
m AS (
  SELECT doc_id, 0 AS ord, 'assign' AS kind, 8 AS need, string_split_regex(t, (SELECT pat FROM rules WHERE ord = 0)) AS gaps,
         regexp_extract_all(t, '((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS ms,
         regexp_extract_all(t, '((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS vs FROM d
  UNION ALL
  SELECT doc_id, 1, 'access', 16, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) FROM d
  UNION ALL
  SELECT doc_id, 2, 'hex', 32, string_split_regex(t, '[0-9a-f]{32,}'), regexp_extract_all(t, '[0-9a-f]{32,}', 0), regexp_extract_all(t, '[0-9a-f]{32,}', 0) FROM d),
p AS (SELECT doc_id, ord, kind, need, unnest(gaps[1:len(ms)]) AS gap, unnest(ms) AS m, unnest(vs) AS v, unnest(range(len(ms))) AS i FROM m WHERE len(ms) > 0),
s AS (SELECT doc_id, ord, kind, need, m, v, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, ord ORDER BY i) AS stop FROM p),
k AS (SELECT doc_id, ord, kind, stop - length(m) AS start, stop FROM s WHERE length(v) >= need),
g AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
             string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, ord) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
