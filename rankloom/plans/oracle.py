"""DuckDB SQL equivalents of the named queries (the correctness oracle).

These strings are test fixtures for an independent engine, not a planner:
the driver runs each next to the Spark query on the same Parquet tables.

Two translation points need care:

* DuckDB's regex engine has no look-around, so the tokenizer is written as an
  extraction pattern that yields exactly the pieces of Java's
  ``split("\\s*\\b\\s*")``: runs of word characters, and runs of other
  characters with the whitespace that touches a word trimmed off (kept at the
  line's start and end, and for a whitespace-only line).
* Java prints a float with the fewest digits that read back to the same
  float (``3.2148438``); DuckDB prints the exact binary value
  (``3.21484375``).  ``java_float_to_double`` picks the shortest
  round-half-even decimal that casts back to the same float.
"""

from __future__ import annotations

# Character classes of the tokenizer; a mark counts as a word character here, wherever it stands.
_W = r"\p{L}\p{Nd}\p{Mn}_"
_S = r" \t\n\x0B\f\r"
TOKEN_EXTRACT_PATTERN = (
    f"[{_W}]+|^[{_S}]+$|(?:^[{_S}]*)?[^{_W}{_S}](?:[^{_W}]*[^{_W}{_S}])?(?:[{_S}]*$)?"
)
LINE_SPLIT = r"\r\n|\r|\n"


def java_float_to_double(expr: str) -> str:
    """SQL for ``Double.parseDouble(Float.toString(expr))`` (expr is a FLOAT)."""
    x = f"CAST({expr} AS DOUBLE)"
    whens = " ".join(f"WHEN CAST(round_even({x}, {k}) AS FLOAT) = {expr} THEN round_even({x}, {k})"
                     for k in range(0, 10))
    return f"(CASE {whens} ELSE {x} END)"


def token_ctes(table: str, doc: str, text: str, prefix: str) -> str:
    """CTEs ``{prefix}_lines`` and ``{prefix}_tokens(doc, word)``."""
    return f"""{prefix}_lines AS (
    SELECT {doc} AS doc, unnest(string_split_regex({text}, '{LINE_SPLIT}')) AS line FROM {table}),
{prefix}_tokens AS (
    SELECT doc, word FROM (
        SELECT doc, unnest(regexp_extract_all(line, '{TOKEN_EXTRACT_PATTERN}')) AS word FROM {prefix}_lines)
    WHERE word <> '')"""


DOC_TOKENS = token_ctes("documents", "doc_id", "text", "doc")
POSTINGS = "postings AS (SELECT word, doc, count(*) AS n FROM doc_tokens GROUP BY word, doc)"
TF = "tf AS (SELECT word, doc, n, CAST(1 + log10(n) AS FLOAT) AS tf FROM postings)"
DF = "dfreq AS (SELECT word, count(*) AS df FROM postings GROUP BY word)"
NDOCS = "ndocs AS (SELECT count(DISTINCT doc_id) AS n_docs FROM documents)"
IDF = "idf AS (SELECT word, df, n_docs, log10(1 + (n_docs // df)) AS idf FROM dfreq, ndocs)"
TFIDF = f"""tfidf AS (SELECT tf.word, tf.doc, tf.tf, {java_float_to_double('tf.tf')} * idf.idf AS tfidf
    FROM tf JOIN idf ON tf.word = idf.word)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def text_chain(*tail: str) -> str:
    return _with(DOC_TOKENS, POSTINGS, TF, DF, NDOCS, IDF, TFIDF, *tail)


def score_cte(filter_sql: str, name: str = "scores") -> str:
    return f"""{name} AS (SELECT doc, CAST(sum(CAST(CAST(tfidf AS FLOAT) AS DOUBLE)) AS FLOAT) AS score
    FROM tfidf WHERE {filter_sql} GROUP BY doc)"""


def in_list(words) -> str:
    return "word IN (" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


SOURCE_TOKENS = token_ctes("documents", "source", "text", "source")
BENCH_TOKENS = token_ctes("benchmark", "item_id", "text", "bench")
BENCH_KEYWORDS = token_ctes("benchmark", "item_id", "text", "bench") + \
    ",\nkeywords AS (SELECT DISTINCT word FROM bench_tokens)"

# ---- link side -------------------------------------------------------------

EDGES = """edges AS (
    SELECT 'O' || l_orderkey AS src, 'P' || l_partkey AS dst FROM lineitem
    UNION ALL SELECT 'P' || l_partkey, 'S' || l_suppkey FROM lineitem
    UNION ALL SELECT 'S' || l_suppkey, 'P' || l_partkey FROM lineitem WHERE l_linenumber = 1
    UNION ALL SELECT 'O' || o_orderkey, 'C' || o_custkey FROM orders)"""

WIKI_LINES = """wiki_rows AS (
    SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, o_custkey AS c,
           (l_orderkey * 8 + l_linenumber) * 1000
           + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS line_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
wiki_parts AS (
    SELECT line_id, o, p, s, '<title>P' || p || '</title> ' AS named,
           '<text>[[P' || s || ']][[S' || s || ']]</text> [[C' || c || ']] <text>[[P' || (o % 50 + 1) || ']]</text>' AS body FROM wiki_rows),
wiki_lines AS (
    SELECT line_id, CASE o % 13
        WHEN 0 THEN ''
        WHEN 1 THEN body
        WHEN 2 THEN named || '<title>O' || o || '</title> ' || body
        WHEN 3 THEN '<title> P' || p || ' </title> ' || body
        WHEN 4 THEN named || '<text>[[P ' || s || ']]</text>'
        WHEN 5 THEN named || '<text>plain</text>'
        ELSE named || body END AS line
    FROM wiki_parts)"""

# The markup patterns, written out here a second time so that a wrong one differs from the engine's.
TITLE = "'<title>(.*?)</title>'"
TEXT = r"'<text+\s*[^>]*>(.*?)</text>'"
LINK = r"'\[\[(.*?)\]\]'"
HREF = """'href="([^"]*)"'"""


def parsed_pages(rule: str) -> str:
    """CTE ``pages(title, links)`` for one parsing rule."""
    if rule == "first_section":
        title = f"trim(regexp_extract(line, {TITLE}, 1))"
        links = f"regexp_extract_all(regexp_extract(line, {TEXT}, 1), {LINK}, 1)"
    elif rule == "whole_line":
        title = f"regexp_extract(line, {TITLE}, 1)"
        links = f"regexp_extract_all(line, {LINK}, 1)"
    else:
        title = f"array_to_string(regexp_extract_all(line, {TITLE}, 1), ',')"
        links = f"regexp_extract_all(coalesce(array_to_string(regexp_extract_all(line, {TEXT}, 1), chr(10)), ''), {LINK}, 1)"
    return f"""pages AS (SELECT line_id, {title} AS title, {links} AS links
    FROM wiki_lines WHERE line IS NOT NULL AND line <> '' AND regexp_matches(line, {TITLE}))"""


def parsed_rows_sql(rule: str) -> str:
    """``(title, pos, dst)``: one row per link of each parsed page line (0-based position)."""
    return _with(WIKI_LINES, parsed_pages(rule)) + \
        "SELECT title, unnest(generate_series(0, len(links) - 1)) AS pos, unnest(links) AS dst FROM pages"


def adjacency_sql(rule: str) -> str:
    return _with(WIKI_LINES, parsed_pages(rule)) + \
        "SELECT title, len(links) AS out_degree, coalesce(array_to_string(links, '@!#'), '') AS links_text FROM pages"


def _double(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


TELE, DAMP = _double(0.15), _double(0.85)


def rounded(expr: str, digits: int) -> str:
    """Rounded alike on both sides: many ranks are short decimals that end in 5 just below ``digits``, so
    a value far under the last place decides such ties."""
    return f"round({expr} + 1e-12, {digits})"


def _cited_only_ctes(edges: str, n_sql: str, rounds: int) -> list[str]:
    """r1 ... r{rounds}: only cited pages, each link once."""
    ctes = [f"e AS (SELECT DISTINCT src, dst FROM {edges})",
            "deg AS (SELECT src, count(*) AS deg FROM e GROUP BY src)",
            f"w AS (SELECT e.src, e.dst, {_double(1)} / deg.deg AS w FROM e JOIN deg ON e.src = deg.src)",
            f"nn AS ({n_sql})",
            f"""r1 AS MATERIALIZED (SELECT dst AS page,
    {TELE} + {DAMP} * (sum(w) * ({_double(1)} / (SELECT n FROM nn))) AS rank FROM w GROUP BY dst)"""]
    return ctes + [f"""r{k} AS MATERIALIZED (SELECT w.dst AS page, {TELE} + {DAMP} * sum(p.rank * w.w) AS rank
    FROM w JOIN r{k - 1} p ON w.src = p.page GROUP BY w.dst)""" for k in range(2, rounds + 1)]


def _all_pages_ctes(mode: str, rounds: int) -> list[str]:
    """r1 ... r{rounds} from ``nodes``, ``nn``, ``s1`` (sums of round 1) and ``w`` (shares of later rounds)."""
    uncited = TELE if mode == "all_nodes" else f"({_double(1)} / (SELECT n FROM nn))"
    fallback = TELE if mode == "all_nodes" else "r.rank"
    ctes = [f"""r1 AS MATERIALIZED (SELECT nodes.page, coalesce({TELE} + {DAMP} * s1.s, {uncited}) AS rank
    FROM nodes LEFT JOIN s1 ON nodes.page = s1.dst)"""]
    return ctes + [f"""r{k} AS MATERIALIZED (SELECT r.page, coalesce({TELE} + {DAMP} * s.s, {fallback}) AS rank
    FROM r{k - 1} r LEFT JOIN (SELECT w.dst, sum(p.rank * w.w) AS s FROM w JOIN r{k - 1} p ON w.src = p.page
    GROUP BY w.dst) s ON r.page = s.dst)""" for k in range(2, rounds + 1)]


def pagerank_ctes(mode: str, rounds: int) -> list[str]:
    """``edges`` and r1 ... r{rounds} (one materialised CTE each) of one PageRank mode over them."""
    if mode == "cited_only":
        return [EDGES] + _cited_only_ctes("edges", "SELECT count(*) AS n FROM edges", rounds)
    n_sql = "SELECT count(*) AS n FROM nodes" if mode == "all_nodes" else "SELECT count(DISTINCT src) AS n FROM edges"
    return [EDGES,
            "m AS (SELECT src, dst, count(*) AS m FROM edges GROUP BY src, dst)",
            "deg AS (SELECT src, sum(m) AS deg FROM m GROUP BY src)",
            "w AS (SELECT m.src, m.dst, m.m / deg.deg AS w FROM m JOIN deg ON m.src = deg.src)",
            "nodes AS (SELECT src AS page FROM edges UNION SELECT dst AS page FROM edges)",
            f"nn AS ({n_sql})",
            f"s1 AS (SELECT dst, sum(w) * ({_double(1)} / (SELECT n FROM nn)) AS s FROM w GROUP BY dst)",
            ] + _all_pages_ctes(mode, rounds)


def pagerank_sql(mode: str, rounds: int = 10, digits: int = 6) -> str:
    return _with(*pagerank_ctes(mode, rounds)) + f"SELECT page, {rounded('rank', digits)} AS rank FROM r{rounds}"


def converge_sql(tol: float, select: str) -> str:
    """``select`` from ``stopped(page, rank)``: cited_only until the total changes by ``tol`` at most, however many rounds that takes."""
    total = "sum(CAST(rank AS DECIMAL(38,18))) OVER ()"
    ctes = pagerank_ctes("cited_only", 1)
    ctes.append(f"""rounds AS (
    SELECT 1 AS k, page, rank, total, CAST(total AS DOUBLE) AS moved FROM (SELECT page, rank, {total} AS total FROM r1)
    UNION ALL
    SELECT k, page, rank, total, CAST(abs(total - before) AS DOUBLE) AS moved FROM (SELECT k, page, rank, before, {total} AS total FROM (
        SELECT max(p.k) + 1 AS k, w.dst AS page, {TELE} + {DAMP} * sum(p.rank * w.w) AS rank, max(p.total) AS before
        FROM rounds p JOIN w ON w.src = p.page WHERE p.moved > {tol} GROUP BY w.dst)))""")
    ctes.append("stopped AS (SELECT page, rank FROM rounds WHERE k = (SELECT max(k) FROM rounds))")
    return _with(*ctes).replace("WITH ", "WITH RECURSIVE ", 1) + select


def fixed_point_sql(tol: float, select: str) -> str:
    """``select`` from ``stopped(page, rank)``: all_nodes until no page's rank changes by more than ``tol``."""
    ctes = pagerank_ctes("all_nodes", 1)
    ctes.append(f"""rounds AS (
    SELECT 1 AS k, page, rank, {_double(1)} AS moved FROM r1
    UNION ALL
    SELECT k, page, rank, max(abs(rank - before)) OVER () AS moved FROM (
        SELECT r.k + 1 AS k, r.page, coalesce({TELE} + {DAMP} * s.s, {TELE}) AS rank, r.rank AS before
        FROM (SELECT * FROM rounds WHERE moved > {tol}) r
        LEFT JOIN (SELECT w.dst, sum(p.rank * w.w) AS s FROM w JOIN rounds p ON w.src = p.page GROUP BY w.dst) s ON r.page = s.dst))""")
    ctes.append("stopped AS (SELECT page, rank FROM rounds WHERE k = (SELECT max(k) FROM rounds))")
    return _with(*ctes).replace("WITH ", "WITH RECURSIVE ", 1) + select


def pagerank_lines_sql(mode: str, rounds: int = 10, digits: int = 6) -> str:
    """PageRank from the page lines: line-level shares in round 1, one line per title later."""
    rule = {"keep_uncited": "first_section", "all_nodes": "whole_line", "cited_only": "all_sections"}[mode]
    ctes = [WIKI_LINES, parsed_pages(rule),
            "links AS (SELECT line_id AS k, title AS src, unnest(links) AS dst FROM pages)"]
    if mode == "cited_only":
        ctes += _cited_only_ctes("links", "SELECT count(*) AS n FROM wiki_lines", rounds)
    else:
        n_sql = (f"SELECT count(DISTINCT regexp_extract(line, {TITLE}, 1)) AS n FROM wiki_lines WHERE regexp_matches(line, {TITLE})"
                 if mode == "keep_uncited" else f"""SELECT count(DISTINCT v) AS n FROM (
    SELECT unnest(regexp_extract_all(line, {TITLE}, 1)) AS v FROM wiki_lines
    UNION ALL SELECT unnest(regexp_extract_all(line, {LINK}, 1)) AS v FROM wiki_lines)""")
        keep = ("SELECT min(k) AS k FROM links GROUP BY src" if mode == "all_nodes"
                else "SELECT max(line_id) AS k FROM pages GROUP BY title")
        ctes += ["lm AS (SELECT k, src, dst, count(*) AS m FROM links GROUP BY k, src, dst)",
                 "ldeg AS (SELECT k, sum(m) AS deg FROM lm GROUP BY k)",
                 f"nn AS ({n_sql})",
                 f"s1 AS (SELECT dst, sum(m / deg) * ({_double(1)} / (SELECT n FROM nn)) AS s FROM lm JOIN ldeg USING (k) GROUP BY dst)",
                 f"kept AS ({keep})",
                 "m AS (SELECT src, dst, m FROM lm WHERE k IN (SELECT k FROM kept))",
                 "deg AS (SELECT src, sum(m) AS deg FROM m GROUP BY src)",
                 "w AS (SELECT m.src, m.dst, m.m / deg.deg AS w FROM m JOIN deg ON m.src = deg.src)",
                 "nodes AS (SELECT title AS page FROM pages UNION SELECT dst AS page FROM links)",
                 ] + _all_pages_ctes(mode, rounds)
    return _with(*ctes) + f"SELECT page, {rounded('rank', digits)} AS rank FROM r{rounds}"


def java_text(expr: str) -> str:
    """SQL for Java's text of a double (or a float, as the double its text stands for) of at most 6 places:
    from 0.001 on as DuckDB prints it, below in scientific form."""
    micros = f"CAST(round({expr} * 1000000) AS BIGINT)"
    mantissa = f"CAST(CAST({micros} / pow(10, length(CAST({micros} AS VARCHAR)) - 1) AS DOUBLE) AS VARCHAR)"
    return (f"CASE WHEN {expr} >= 0.001 OR {expr} = 0 THEN CAST({expr} AS VARCHAR) "
            f"ELSE {mantissa} || 'E-' || CAST(7 - length(CAST({micros} AS VARCHAR)) AS VARCHAR) END")
