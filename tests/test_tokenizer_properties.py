"""Property test: the three spellings of the tokenizer agree on random lines.

* Spark ``split`` with the reference pattern ``\\s*\\b\\s*`` (what runs on JDK 17),
* Spark ``split`` with the spelled-out word boundary (used where ``\\b`` is ASCII-only),
* the DuckDB extraction pattern of the SQL oracle.

Combining marks: JDK 17's ``\\b`` counts a mark as a word character only after a letter or digit (and
marks).  Both Spark spellings do; the extraction pattern of the oracle, whose engine has no
look-behind, does not, so marks are in the alphabet of the Spark comparison only.
"""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.functions.tokenize import REFERENCE_TOKEN_PATTERN, TOKEN_SPLIT_PATTERN
from rankloom.plans.oracle import TOKEN_EXTRACT_PATTERN

ALPHABET = list("abzAZ019_éßñ日本") + [" ", " ", "\t", "\x0b", "\f"] + list(".,;:!?'-\"()[]<>/#&")
LINES = st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=24), min_size=40, max_size=40)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LINES)
def test_three_tokenizer_spellings_agree(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    rows = df.select("i", F.split("l", REFERENCE_TOKEN_PATTERN).alias("a"),
                     F.split("l", TOKEN_SPLIT_PATTERN).alias("b")).collect()
    spark_ref = {r.i: [t for t in r.a if t] for r in rows}
    spark_alt = {r.i: [t for t in r.b if t] for r in rows}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, l VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(lines)))
    duck = {i: list(toks) for i, toks in con.execute(
        f"SELECT i, regexp_extract_all(l, '{TOKEN_EXTRACT_PATTERN}') FROM t").fetchall()}
    for i, line in enumerate(lines):
        assert spark_alt[i] == spark_ref[i], repr(line)
        assert duck[i] == spark_ref[i], repr(line)


MARKS = list("aZ9_é本") + ["\u0301", "\u0308", "\u20dd", "\u0903"] + [" ", "\t", ".", "-", "\u00a0", "\u3000", "\u203f"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=MARKS, min_size=0, max_size=14), min_size=60, max_size=60))
def test_spelled_out_boundary_with_combining_marks(spark, lines):
    df = spark.createDataFrame([(l,) for l in lines], "l string")
    for r in df.select("l", F.split("l", REFERENCE_TOKEN_PATTERN).alias("a"), F.split("l", TOKEN_SPLIT_PATTERN).alias("b")).collect():
        assert [t for t in r.a if t] == [t for t in r.b if t], repr(r.l)
