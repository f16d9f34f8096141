"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences, built with
DataFrame functions only.

A text is split into sections at blank lines, a section into paragraphs at line ends, a paragraph
into sentences at ``". "``, a sentence into blocks of ``BLOCK`` characters, so that a text without line
ends or full stops has more than one leaf too.  A block's hash is the SHA-256 of its bytes; an inner
node's is the SHA-256 of its children's hashes, in order.  The splits can be undone, so two texts
have equal roots exactly when they are equal (but for collisions of SHA-256).

The fingerprint is text: ``root|paragraph paragraph ...|block block ...``, the root in full, the
branches by the first ``BRANCH_HEX`` digits in document order.  Equal roots need no look below;
otherwise paragraphs, then blocks that occur on one side only locate the edits.
``likeness`` is 1 at equal roots and else the share of block hashes in common,
2 |A and B| / (|A| + |B|) over distinct hashes.

Edge cases: a null text is the empty text, a tree with one empty block.  Rows with equal ids are
ordered by their text's digest, a null id comes after all others.  Every input row gives one output
row, an empty table none; very long texts are cut into blocks whole; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, whole_text

BRANCH_HEX = 8
BLOCK = 64
SLICES_PER_PARTITION = 4


def _sha(value: Column) -> Column:
    return F.sha2(F.encode(value, "UTF-8"), 256)


def fingerprint(text: Column) -> Column:
    """The serialised Merkle tree of a text column without nulls."""
    blocks = lambda sentence: F.when(sentence == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(sentence, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    parts = lambda value, pattern, inner: F.transform(F.split(value, pattern, -1), inner)
    hashed = parts(text, "\n\n", lambda section: parts(section, "\n", lambda paragraph: parts(
        paragraph, "\\. ", lambda sentence: F.transform(blocks(sentence), _sha))))
    # From the leaves up; a paragraph keeps its leaves' hashes beside its own.
    node = lambda children: _sha(F.array_join(children, ""))
    nodes = F.transform(hashed, lambda section: F.transform(section, lambda paragraph: F.struct(
        node(F.transform(paragraph, node)).alias("node"), F.flatten(paragraph).alias("leaves"))))
    return F.transform(F.array(nodes), _serialise)[0]


def _serialise(nodes: Column) -> Column:
    """``nodes``: the tree's paragraphs (node, leaves) by section."""
    node = lambda children: _sha(F.array_join(children, ""))
    listed = lambda hashes: F.array_join(F.transform(hashes, lambda h: F.substring(h, 1, BRANCH_HEX)), " ")
    root = node(F.transform(nodes, lambda section: node(F.transform(section, lambda p: p["node"]))))
    flat = F.flatten(nodes)
    return F.concat_ws("|", root, listed(F.transform(flat, lambda p: p["node"])),
                       listed(F.flatten(F.transform(flat, lambda p: p["leaves"]))))


def leaves(print_: Column) -> Column:
    return F.array_distinct(F.split(F.substring_index(print_, "|", -1), " "))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 exactly for fingerprints of equal texts or of texts with the same set of blocks."""
    def compare(pair: Column) -> Column:
        common = F.size(F.array_intersect(pair["a"], pair["b"]))
        return F.when(pair["same"], F.lit(1.0)).otherwise(2.0 * common / (F.size(pair["a"]) + F.size(pair["b"])))

    same = F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1)
    # As an array of one, so that the lists of leaves are made once.
    return F.transform(F.array(F.struct(leaves(a).alias("a"), leaves(b).alias("b"), same.alias("same"))), compare)[0]


def differing(a: Column, b: Column) -> Column:
    """Numbers, from 0, of the paragraphs of ``a`` whose branch is not in ``b``: where ``a`` was edited."""
    of = lambda p: F.split(F.substring_index(F.substring_index(p, "|", 2), "|", -1), " ")
    marked = F.transform(of(a), lambda h, i: F.when(~F.array_contains(of(b), h), i))
    return F.array_compact(marked)


def _slices(docs: DataFrame) -> Column:
    """A number that falls with the id, in about equal shares of rows: ids are cut at quantiles.

    The cut points are as many as there are slices, whatever the input's size.
    """
    spark = docs.sparkSession
    n = SLICES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q")).first().q or []
    cuts = sorted(set(cuts), reverse=True)
    if not cuts:
        return F.lit(0)
    points = F.array(*(F.lit(c) for c in cuts))
    above = F.size(F.filter(points, lambda c: c > F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, print and the next document's: ``next_text`` and ``next_print``, in order of
    descending id, the first one after the last.

    One shuffle carries the texts to their slice of ids.  The first row of a slice is also sent to the slice
    before, as its last row, so every row finds the next one in its own slice.
    """
    slice_ = _slices(docs)
    numbered = docs.select("doc_id", whole_text().alias("text"), slice_.alias("slice"))
    # Numbers only, one row per slice: its first id, and the slice before it (for the first slice the last).
    firsts = docs.select("doc_id", slice_.alias("slice")).groupBy("slice").agg(F.max("doc_id").alias("first_id"))
    one = Window.orderBy("slice")
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    with Scratch(docs.sparkSession) as files:
        firsts = files.keep(files(firsts.withColumn("before", F.coalesce(F.lag("slice").over(one), F.last("slice").over(whole)))))
    guests = (numbered.join(F.broadcast(firsts.withColumnRenamed("slice", "at")),
                            (F.col("slice") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
              .select("doc_id", "text", F.col("before").alias("slice"), F.lit(True).alias("guest")))
    rows = numbered.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("print", fingerprint(F.col("text")))
    by_slice = Window.partitionBy("slice").orderBy("guest", F.col("doc_id").desc_nulls_last(), "print")
    looked = rows.withColumn("next", F.lead(F.struct("text", "print")).over(by_slice)).where(~F.col("guest"))
    return looked.select("doc_id", "text", "print", F.col("next.text").alias("next_text"), F.col("next.print").alias("next_print"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns: each text against its edited form and against the next document."""
    edited = F.concat(F.expr("left(text, length(text) - int(length(text) / 3))"), F.expr("left(next_text, int(length(text) / 3))"))
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", edited).drop("text", "next_text")
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"))).withColumnRenamed("print", "fingerprint")
    return rows.select("doc_id", "n_chars", _sha(F.col("edited")).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))


_TREE = """
  SELECT doc_id, t, sha256(list_aggregate(list_transform(n, lambda s: sha256(list_aggregate(list_transform(s, lambda p: p.node), 'string_agg', ''))), 'string_agg', '')) || '|'
         || list_aggregate(list_transform(flatten(n), lambda p: left(p.node, 8)), 'string_agg', ' ') || '|'
         || list_aggregate(list_transform(flatten(list_transform(flatten(n), lambda p: p.leaves)), lambda h: left(h, 8)), 'string_agg', ' ') AS print
  FROM (SELECT doc_id, t, list_transform(h, lambda s: list_transform(s, lambda p: {
            'node': sha256(list_aggregate(list_transform(p, lambda b: sha256(list_aggregate(b, 'string_agg', ''))), 'string_agg', '')),
            'leaves': flatten(p)})) AS n
        FROM (SELECT doc_id, t, list_transform(string_split(t, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
                 lambda p: list_transform(string_split(p, '. '), lambda x: list_transform(
                   CASE WHEN x = '' THEN [''] ELSE regexp_extract_all(x, '(?s).{1,64}') END, lambda b: sha256(b))))) AS h
              FROM {rows}))
"""
_LIKE = """CASE WHEN split_part({a}, '|', 1) = split_part({b}, '|', 1) THEN 1.0::DOUBLE ELSE
  2.0::DOUBLE * len(list_intersect(list_distinct(string_split(split_part({a}, '|', 3), ' ')), list_distinct(string_split(split_part({b}, '|', 3), ' '))))
  / (len(list_distinct(string_split(split_part({a}, '|', 3), ' '))) + len(list_distinct(string_split(split_part({b}, '|', 3), ' ')))) END"""

SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
own AS ({_TREE.replace('{rows}', 'd')}),
nx AS (SELECT *, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nt, coalesce(lead(print) OVER w, first_value(print) OVER w) AS np
       FROM own WINDOW w AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, left(t, (length(t) - length(t) // 3)::BIGINT) || left(nt, (length(t) // 3)::BIGINT) AS t FROM nx),
ed AS ({_TREE.replace('{rows}', 'e')})
SELECT doc_id, length(nx.t)::BIGINT AS n_chars, sha256(ed.t) AS edited_sha256, nx.print AS fingerprint, ed.print AS edited_fingerprint,
       {_LIKE.replace('{a}', 'nx.print').replace('{b}', 'ed.print')} AS near_edited,
       {_LIKE.replace('{a}', 'nx.print').replace('{b}', 'nx.np')} AS near_next
FROM nx JOIN ed USING (doc_id)
"""
