"""URL filter by hash prefixes of host-suffix and path-prefix expressions.

Every url is expanded into expressions: a suffix of its host at a label boundary followed by a
prefix of its path.  Only shapes that some rule has (so many labels, so many path characters) are
made, which loses no rule and bounds the expressions by the rules.  Expressions meet rules by an
equi-join on a short hash prefix; the full SHA-256 digests then have to agree, and of the rules
that fit the longest (host and path together) decides, at equal length the one with the longer
host, then block before allow.

Parsing: host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
A-Z lowered; path goes from there to ``?``, ``#`` or the end.  A null url, or one without ``://``, has
empty host and path, so no rule fits and the default verdict holds.  Every input row gives one
output row, also for repeated or null ids, an empty table none; very long urls are parsed whole; columns other than the
id and the url are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"),
         UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))
PREFIX_HEX = 8  # 32 bits of the digest are the join key
SALTS = 32      # for rule lists too long to broadcast


def parse(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", ascii_lower(host)).withColumn("path", path)


def _expressions(shapes: list[tuple[int, int]]) -> Column:
    """The expressions of a row, one for each shape (labels, path characters) that fits it."""
    def one(labels: int, chars: int) -> Column:
        enough = (F.size(F.split("host", "\\.", -1)) >= labels) & (F.length("path") >= chars)
        made = F.concat(F.substring_index("host", ".", -labels), F.lit("\n"), F.substring("path", 1, chars))
        return F.when(enough, made)
    return F.array_distinct(F.array_compact(F.array(*(one(*s) for s in shapes))))


def rule_table(spark, rules) -> DataFrame:
    """One row per rule: prefix, digest, text, verdict and precedence."""
    rows = [(r.host + "\n" + r.path, r.text, r.verdict, len(r.text), len(r.host), int(r.verdict == "block")) for r in rules]
    df = spark.createDataFrame(rows, "expression string, rule string, verdict string, size int, host_size int, blocks int")
    digest = F.sha2(F.encode("expression", "UTF-8"), 256)
    return df.select(F.substring(digest, 1, PREFIX_HEX).alias("prefix"), digest.alias("digest"),
                     F.struct("size", "host_size", "blocks", "rule", "verdict").alias("judgement"))


def judge(pages: DataFrame, rules=RULES, default: str = "allow", key: str = "page_id", url: str = "url",
          broadcast_rules: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict of every url.

    Up to ``broadcast_rules`` rules are sent to every task; a longer list is shuffled, copied ``SALTS``
    times so that an expression which a third of the urls share is spread over as many keys.
    """
    spark = pages.sparkSession
    parsed = parse(pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))).drop("url")
    if not rules:
        return parsed.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    numbered = parsed.withColumn("row", F.monotonically_increasing_id())
    asked = (numbered.withColumn("expression", F.explode_outer(_expressions(shapes)))
             .withColumn("digest", F.sha2(F.encode("expression", "UTF-8"), 256)).drop("expression")
             .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))
    table = rule_table(spark, rules).withColumnRenamed("digest", "rule_digest")
    on = ["prefix"]
    if len(rules) <= broadcast_rules:
        table = F.broadcast(table)
    else:
        asked = asked.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)))
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        on = ["prefix", "salt"]
    met = asked.join(table, on, "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("judgement"))
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(confirmed).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


SQL = """
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(v, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, host, p.path, r.h || r.p AS rule, r.v,
             row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(p.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
