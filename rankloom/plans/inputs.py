"""Inputs the named queries derive from the driver's Parquet tables: plain scans, whole tables.

* documents -> ``(doc, text)``
* lineitem, orders -> a link graph: an order links to the part of each of its items and to its
  customer, a part to its supplier, and the supplier of each order's first item back to that part.
  Orders are cited by nobody, customers link to nothing, parts and suppliers form cycles, and links
  repeat, so the three PageRank modes differ in N, in their pages and in their ranks.
* lineitem, orders -> page lines in the wiki format, one line per item (``wiki_lines``), with every
  irregularity the parsing rules treat: blank lines, lines without a title or with two, titles and
  targets with spaces, lines without links, links outside any text section, a second section.
  A page is a part; its title repeats, as a part is in several orders, with different links: to the
  part numbered like the supplier, the supplier, the customer and one of the first fifty parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.text import documents

# Lines of orders in this residue class have the irregularity named (others are regular).
SHAPES = {"blank": 0, "untitled": 1, "two_titles": 2, "title_spaces": 3, "target_spaces": 4, "no_links": 5}
SHAPE_CLASSES = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(table(spark, sf_dir, "documents"))


def benchmark_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc"), "text")


def _node(letter: str, key: str):
    return F.concat(F.lit(letter), F.col(key).cast("string"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` bag of links; each table is scanned once, an item's links come from its one row."""
    order, part, supplier = _node("O", "l_orderkey"), _node("P", "l_partkey"), _node("S", "l_suppkey")
    link = lambda a, b: F.struct(a.alias("src"), b.alias("dst"))
    links = F.array(link(order, part), link(part, supplier), F.when(F.col("l_linenumber") == 1, link(supplier, part)))
    items = (table(spark, sf_dir, "lineitem").select(F.explode(links).alias("link"))
             .filter(F.col("link").isNotNull()).select("link.src", "link.dst"))
    orders = table(spark, sf_dir, "orders").select(_node("O", "o_orderkey").alias("src"), _node("C", "o_custkey").alias("dst"))
    return items.unionByName(orders)


def wiki_lines(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """``(line)``, or ``(line_id, line)``: one page line per lineitem row.

    The number follows order, item number, part and supplier; rows that agree in all four have the
    same line, so it does not matter which of them comes first.
    """
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = items.join(orders, "l_orderkey")
    shape = F.col("l_orderkey") % SHAPE_CLASSES
    title, order, supplier, customer = (_node(*x) for x in (("P", "l_partkey"), ("O", "l_orderkey"), ("S", "l_suppkey"), ("C", "o_custkey")))
    text = lambda s: F.lit(s)
    body = F.concat(text("<text>[["), _node("P", "l_suppkey"), text("]][["), supplier, text("]]</text> [["), customer,
                    text("]] <text>[["), F.concat(text("P"), (F.col("l_orderkey") % 50 + 1).cast("string")), text("]]</text>"))
    named = F.concat(text("<title>"), title, text("</title> "))
    line = (F.when(shape == SHAPES["blank"], text(""))
            .when(shape == SHAPES["untitled"], body)
            .when(shape == SHAPES["two_titles"], F.concat(named, text("<title>"), order, text("</title> "), body))
            .when(shape == SHAPES["title_spaces"], F.concat(text("<title> "), title, text(" </title> "), body))
            .when(shape == SHAPES["target_spaces"], F.concat(named, text("<text>[[P "), F.col("l_suppkey").cast("string"), text("]]</text>")))
            .when(shape == SHAPES["no_links"], F.concat(named, text("<text>plain</text>")))
            .otherwise(F.concat(named, body)))
    # Behind a generator the line is made once: the optimizer copies no expression through it.
    line = F.explode_outer(F.array(line))
    if not numbered:
        return rows.select(line.alias("line"))
    item = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey")
    number = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000 + F.row_number().over(item)
    return rows.select(number.alias("line_id"), line.alias("line"))
