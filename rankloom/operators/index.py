"""A persistent inverted index for search (P4, P5, J1, A5, O3): written once, read by many searches.

Documents are dealt out by a hash of their key into groups of about ``GROUP_DOCS``; within a group they are numbered by
descending length, so that those with high term frequencies stand together, and cut into blocks of
``1 << BLOCK_BITS``.  Words have dense ids.  Tables, all bucketed and sorted:

=========  ===================================  ==========================================
documents  doc_no, doc                          by doc_no
lexicon    word_id, word, df                    by word
postings   slot, doc_no, tf                     by slot; sorted by slot, doc_no
blocks     slot, block, max_tf, n               by slot; sorted by slot, block
meta       one row of sizes                     (plain)
=========  ===================================  ==========================================

A slot is a word's part in one span of ``SPAN_GROUPS`` groups: a search reads only the buckets of its slots and does not
shuffle postings (only sums per document), while the postings of a word found in every document are spread over as many
buckets as it has slots.

Building shuffles the texts once, by group (and part of it, where a group has very much text), and counts words where the
texts are.  The counts are written, joined with the lexicon by word, and dealt out by slot.

``top_k`` answers any number of queries at once without scoring every document: a block's bound for a query is
what a document with the block's greatest term frequencies would score.  The blocks with the greatest bounds are
scored first; the k-th best score there is a threshold, and blocks whose bound is below it cannot hold one of the
first k.  The rest is scored too, so the result is that of a full ranking.

Edge cases.  Documents without tokens count in N and are never found.  Rows without a document key are not indexed; rows that
share a key are one document, as in ``search``.  Words not in the index are ignored; a query without words gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..bucketed import open_bucketed, write_bucketed
from ..functions.tokenize import query_words
from ..functions.weights import float_text_to_double, idf as idf_col, log_tf
from ..session import free_shuffles, parallelism, path_exists
from ..tables import Tables, in_order
from .pagerank import _conf
from .text import MAX_IN_LIST, ROW_TEXT, doc_frequency, row_counts, tokens

BLOCK_BITS = 8               # a block holds 256 documents at most
RANK_BITS = 16               # a group holds 65,536 documents at most: many times GROUP_DOCS
GROUP_DOCS, SPAN_GROUPS = 4096, 64
GROUP_BYTES = 64 << 20       # of one group's text that one task reads
TASK_BYTES = 8 << 20         # of text per task, on average
GROUP_SHARES = 32            # shares of a group, by document, that are dealt out: tasks differ less than with whole groups
TASK_WANTED = 200_000        # (query, slot, block) rows that one task scores
ROWS_PER_BUCKET = 1_000_000  # of documents, words and postings
WORD_BYTES = 8 << 20         # shuffled bytes, by word, that one task sorts; partitions of more than twice that are split
SPAN_BITS = 20               # slot = word_id << SPAN_BITS | span
BROADCAST_ROWS = 100_000     # measured (slot, block, query) rows of a few numbers
CHUNK = 4096                 # rows of one key that are gathered and cut to k at a time

_BUCKETED = {"documents": (["doc_no"], "doc_no long, doc {doc}"),
             "lexicon": (["word"], "word_id long, word string, df long"),
             "postings": (["slot", "doc_no"], "slot long, doc_no long, tf float"),
             "blocks": (["slot", "block"], "slot long, block long, max_tf float, n long")}


def top_rows(tables: Tables, rows: DataFrame, key: str, score: str, then: str, k: int, chunk: int = CHUNK) -> DataFrame:
    """The first k rows ``(key, pos, score, then)`` of each key, by descending score and ascending ``then``; a written table.

    ``rows`` is a written table, unique in (key, then).  Each round deals a key's rows out into groups of about
    ``chunk`` rows and keeps k of each group, until no key has more than one group.
    """
    chunk = max(chunk, 8 * k)
    while True:
        most = rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0
        groups = -(-most // chunk)
        place = F.struct((-F.col(score)).alias("down"), F.col(then).alias("then"))
        best = rows.groupBy(key, F.pmod(F.xxhash64(then), F.lit(max(1, groups))).alias("part")).agg(
            F.slice(F.array_sort(F.collect_list(place)), 1, k).alias("best"))
        rows = tables(best.select(key, F.posexplode("best").alias("pos", "x")).select(key, (F.col("pos") + 1).alias("pos"), (-F.col("x.down")).alias(score), F.col("x.then").alias(then)))
        if groups <= 1:
            return rows


@dataclass
class TopK:
    """Result of :meth:`SearchIndex.top_k`."""

    rows: DataFrame    # (query_id, pos, doc, score), pos from 1; a written table
    blocks: int        # blocks that hold a word of a query, over all queries
    blocks_read: int   # of these, those that were scored


class SearchIndex:
    def __init__(self, spark: SparkSession, folder: str):
        """Open the index in ``folder``, also one that another application wrote."""
        self.spark, self.folder = spark, folder.rstrip("/")
        self.meta = spark.read.parquet(f"{self.folder}/meta").first()

    def table(self, table: str) -> DataFrame:
        order, schema = _BUCKETED[table]
        return open_bucketed(self.spark, f"{self.folder}/{table}", schema.format(doc=self.meta.doc_type), self.meta[table + "_buckets"], order[:1], order)

    # ---- building -------------------------------------------------------------

    @classmethod
    def build(cls, docs: DataFrame, folder: str, group_docs: int = GROUP_DOCS, span_groups: int = SPAN_GROUPS, group_bytes: int = GROUP_BYTES,
              buckets: int | None = None) -> "SearchIndex":
        """Index ``docs(doc, text)`` into ``folder``, a folder of the shared file system that does not exist yet.

        The corpus is tokenized once.  ``buckets``: of the postings (default: one per ``ROWS_PER_BUCKET``, at
        least the default parallelism); the documents have one per ``ROWS_PER_BUCKET`` postings, too.
        """
        spark, folder = docs.sparkSession, folder.rstrip("/")
        if path_exists(spark, folder):
            raise FileExistsError(folder)
        docs = docs.where("doc IS NOT NULL")
        several = lambda rows: max(1, -(-rows // ROWS_PER_BUCKET))
        with Tables(spark) as tables:
            lengths = tables(docs.groupBy("doc").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("length"), F.count(F.lit(1)).alias("rows")))
            n_docs = lengths.count()
            groups = max(1, -(-n_docs // group_docs))
            spans = -(-groups // span_groups)
            if spans >= 1 << SPAN_BITS:
                raise ValueError("too many spans: larger groups or spans are needed")
            group = F.pmod(F.xxhash64("doc"), F.lit(groups)).alias("group")
            rank = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("length"), F.asc("doc"))) - 1
            single = (F.col("rows") == 1) & (F.col("length") <= ROW_TEXT)
            placed = tables(lengths.select("doc", "length", single.alias("single"), group).select("group", "doc", "length", "single", rank.alias("rank")))
            if (placed.agg(F.max("rank")).first()[0] or 0) >= 1 << RANK_BITS:
                raise ValueError("groups are too large: lower group_docs")
            doc_no = F.shiftleft("group", RANK_BITS).bitwiseOR(F.col("rank"))
            n_bytes = placed.agg(F.sum("length")).first()[0] or 0
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-n_bytes // TASK_BYTES))
            parts = F.ceil(F.sum("length") / group_bytes).cast("int")
            large = tables(placed.groupBy("group").agg(parts.alias("parts")).where("parts > 1"))
            with _conf(spark, _BY_GROUP):
                texts, large = docs.select("doc", "text", group), F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
                numbers = placed.select("group", "doc", doc_no.alias("doc_no"), "single")
                counts = _counts(texts, numbers.where("single"), large, tasks)
                if not placed.where("NOT single").isEmpty():
                    counts = counts.unionByName(_counts(texts, numbers.where("NOT single").drop("single"), large, tasks))
                counts = tables(counts)
            free_shuffles(spark)
            n_counts = counts.count()
            n_buckets = buckets or max(parallelism(spark), several(n_counts))
            # What is joined with the documents is dealt out as they are, and it may be as many rows as the postings.
            n_shares = several(max(n_docs, n_counts))
            _write(placed.select(doc_no.alias("doc_no"), "doc"), folder, "documents", n_shares)
            with _conf(spark, _BY_WORD | {"spark.sql.shuffle.partitions": str(tasks)}):
                lexicon, n_words = in_order(tables, doc_frequency(counts), ["word"], "word_id")
                _write(lexicon, folder, "lexicon", several(n_words))
                slot = F.shiftleft("word_id", SPAN_BITS).bitwiseOR(F.floor(F.shiftright("doc_no", RANK_BITS) / span_groups))
                postings = counts.join(lexicon.select("word", "word_id"), "word").select(slot.alias("slot"), "doc_no", log_tf("n").alias("tf"))
                postings = _write(postings, folder, "postings", n_buckets)
            tables.drop(counts)
            free_shuffles(spark)
            bounds = postings.groupBy("slot", F.shiftright("doc_no", BLOCK_BITS).alias("block")).agg(F.max("tf").alias("max_tf"), F.count(F.lit(1)).alias("n"))
            _write(bounds, folder, "blocks", n_buckets, dealt=True)
            sizes = {"n_docs": n_docs, "n_words": n_words, "span_groups": span_groups, "spans": spans, "documents_buckets": n_shares,
                     "lexicon_buckets": several(n_words), "postings_buckets": n_buckets, "blocks_buckets": n_buckets, "doc_type": docs.schema["doc"].dataType.simpleString()}
            spark.createDataFrame([tuple(sizes.values())], ", ".join(f"{c} {'string' if c == 'doc_type' else 'long'}" for c in sizes)).coalesce(1).write.parquet(f"{folder}/meta")
        return cls(spark, folder)

    # ---- reading --------------------------------------------------------------

    def _idf(self, words: DataFrame) -> DataFrame:
        """``words`` (with column df) with their ``idf``."""
        return words.withColumn("n_docs", F.lit(self.meta.n_docs)).withColumn("idf", idf_col("n_docs", "df")).drop("n_docs", "df")

    def _slots(self, words: DataFrame) -> DataFrame:
        """``words`` (with column word_id) with a row for each slot."""
        spans = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.meta.spans - 1).cast("long")))
        return words.withColumn("span", spans).withColumn("slot", F.shiftleft("word_id", SPAN_BITS).bitwiseOR(F.col("span"))).drop("span")

    def _span(self) -> Column:
        """The span of a block."""
        return F.floor(F.shiftright("block", RANK_BITS - BLOCK_BITS) / self.meta.span_groups)

    def search(self, words: Iterable[str] | str | None = None, keywords: DataFrame | None = None, keyword_col: str = "word") -> DataFrame:
        """``(doc, score)`` as :func:`rankloom.operators.text.search` gives it, from the index.

        A word list is looked up first, and only its slots' buckets are read.  A keyword table is joined with the
        lexicon, and its slots with the postings, which stay where they are.
        """
        postings = self.table("postings")
        if words is not None:
            asked = query_words(words)
            if len(asked) > MAX_IN_LIST:
                listed = self.spark.createDataFrame([(w,) for w in asked], "word string")
                return self.search(keywords=listed if keywords is None else listed.join(keywords.select(F.col(keyword_col).alias("word")), "word", "left_semi"))
            wanted = self.table("lexicon").where(F.col("word").isin(asked))
            if keywords is not None:
                wanted = wanted.join(keywords.select(F.col(keyword_col).alias("word")), "word", "left_semi")
            found = [(r.word_id, r.df) for r in wanted.collect()]  # no more rows than words asked for
            weights = self._idf(self.spark.createDataFrame(found, "word_id long, df long"))
            slots = [w << SPAN_BITS | s for w, _ in found for s in range(self.meta.spans)]
            if len(slots) <= MAX_IN_LIST:
                postings = postings.where(F.col("slot").isin(slots))
            hits = postings.withColumn("word_id", F.shiftright("slot", SPAN_BITS)).join(F.broadcast(weights), "word_id")
        elif keywords is not None:
            asked = keywords.select(F.col(keyword_col).alias("word")).distinct()
            hits = postings.join(self._slots(self._idf(self.table("lexicon").join(asked, "word").select("word_id", "df"))), "slot")
        else:
            hits = postings.withColumn("idf", F.lit(0.0)).limit(0)
        scores = hits.groupBy("doc_no").agg(_score().alias("score"))
        return scores.join(self.table("documents"), "doc_no").select("doc", "score")

    def top_k(self, queries: DataFrame, k: int, seed_blocks: int | None = None) -> TopK:
        """The first k documents of each query ``(query_id, word)``, by descending score, then document key.

        ``seed_blocks``: blocks of a query that are scored to find its threshold (default: enough for 4 k documents, at least 2).
        """
        seed_blocks = seed_blocks or max(2, -(-4 * k >> BLOCK_BITS))
        with Tables(self.spark) as tables:
            asked = queries.select("query_id", "word").where("query_id IS NOT NULL").distinct()
            words = tables(self._idf(asked.join(self.table("lexicon"), "word").select("query_id", "word_id", "df")))
            top = float_text_to_double("max_tf") * F.col("idf")
            bounds = self.table("blocks").join(self._slots(words), "slot").groupBy("query_id", "block").agg(F.sum(top.cast("float")).alias("bound"))
            bounds = tables(bounds)
            seeds = top_rows(tables, bounds, "query_id", "bound", "block", seed_blocks)
            first = self._scores(tables, words, seeds, k)
            threshold = self._threshold(tables, first, k)
            rest = bounds.join(seeds.select("query_id", "block"), ["query_id", "block"], "left_anti").join(threshold, "query_id", "left")
            # The bound is a sum in another order: a relative 1e-9 is far above what that changes.
            rest = tables(rest.where("threshold IS NULL OR bound * (1 + 1e-9) >= threshold").select("query_id", "bound", "block"))
            scored = tables(first.unionByName(self._scores(tables, words, rest, k)))
            # All that tie with the k-th come along until their keys are known.
            threshold = self._threshold(tables, scored, k)
            near = scored.join(threshold, "query_id", "left").where("threshold IS NULL OR score >= threshold").select("query_id", "doc_no", "score")
            named = tables(near.join(self.table("documents"), "doc_no").select("query_id", "score", "doc"))
            rows = tables.keep(top_rows(tables, named, "query_id", "score", "doc", k))
            return TopK(rows.select("query_id", "pos", "doc", "score"), bounds.count(), seeds.count() + rest.count())

    def _threshold(self, tables: Tables, scores: DataFrame, k: int) -> DataFrame:
        """``(query_id, threshold)``: the k-th best score, of queries that have k."""
        best = top_rows(tables, scores, "query_id", "score", "doc_no", k)
        return best.groupBy("query_id").agg(F.min("score").alias("threshold"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).drop("n")

    def _scores(self, tables: Tables, words: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
        """``(query_id, doc_no, score)`` of the documents in the chosen ``(query_id, block)``; a written table.

        With many of them, the postings asked for are dealt out by block, each once however many queries ask for it, and of
        a block's documents only those reach the table that score as much as its k-th (others cannot be among the first k).
        """
        wanted = chosen.select("query_id", "block").join(words, "query_id").select(
            "query_id", F.shiftleft("word_id", SPAN_BITS).bitwiseOR(self._span()).alias("slot"), "block", "idf")
        wanted = tables(wanted.join(self.table("blocks").select("slot", "block"), ["slot", "block"], "left_semi"))
        size = wanted.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("slot").alias("slots")).first()
        postings = self.table("postings").withColumn("block", F.shiftright("doc_no", BLOCK_BITS))
        if size.slots <= MAX_IN_LIST:  # then their buckets alone are read
            postings = postings.where(F.col("slot").isin([r.slot for r in wanted.select("slot").distinct().collect()]))
        if size.rows <= BROADCAST_ROWS:
            hits = postings.join(F.broadcast(wanted), ["slot", "block"])
            return tables(hits.groupBy("query_id", "doc_no").agg(_score().alias("score")))
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-size.rows // TASK_WANTED))
        # Bucketing by slot, or dealing out by block, is enough for the joins by slot and block.
        with _conf(self.spark, _BY_GROUP):
            asked = tables(wanted.select("slot", "block").distinct())
            hits = (postings.join(asked, ["slot", "block"], "left_semi").repartition(tasks, "block")
                    .join(wanted.repartition(tasks, "block"), ["slot", "block"]))
            scores = hits.groupBy("block", "query_id", "doc_no").agg(_score().alias("score"))
            best = scores.groupBy("block", "query_id").agg(F.sort_array(F.collect_list(F.struct("score", "doc_no")), asc=False).alias("best"))
            best = best.select("query_id", "best", F.get("best", F.lit(k - 1)).getField("score").alias("least"))
            kept = F.filter("best", lambda x: F.col("least").isNull() | (x["score"] >= F.col("least")))
            return tables(best.select("query_id", F.explode(kept).alias("x")).select("query_id", "x.doc_no", "x.score"))

    def rank(self, words: Iterable[str] | str, k: int) -> DataFrame:
        """``(doc, score)``: the first k documents for a word list, in order."""
        queries = self.spark.createDataFrame([(0, w) for w in query_words(words)], "query_id int, word string")
        return self.top_k(queries, k).rows.select("doc", "score").orderBy(F.desc("score"), F.asc("doc"))


def _counts(docs: DataFrame, numbers: DataFrame, large: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(word, doc_no, n)`` of ``docs(group, doc, text)``, numbered by ``numbers(group, doc, doc_no[, single])``.

    Texts and numbers are dealt out by group over ``tasks`` partitions (default: the session's number), and that is enough for the join and for counting after it (plan it
    under ``_BY_GROUP``).  Groups with very much text, ``large(group, parts)``, are dealt out over several parts; the
    counts of a document's parts are added up by an exchange of their own.  Numbers with a column ``single`` are
    those of documents of one row: each is counted by itself, in its row.
    """
    single = "single" in numbers.columns
    share = F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(GROUP_SHARES)).cast("int").alias("share")
    known = docs.join(large, "group", "left")
    part = F.coalesce(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts")).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)).alias("part")
    dealt, over = ["group", "share", "part"], [tasks] if tasks else []
    texts = known.select("group", share, part.alias("part"), "parts", "doc", "text").repartition(*over, *dealt)
    numbers = numbers.join(large, "group", "left").select("group", share, copies, "doc", "doc_no").repartition(*over, *dealt)
    numbered = texts.join(numbers, [*dealt, "doc"]).select(*dealt, "parts", F.col("doc_no").alias("doc"), "text")
    if single:
        return row_counts(numbered.select("doc", "text")).withColumnRenamed("doc", "doc_no")
    counts = tokens(numbered, *dealt, "parts").withColumnRenamed("doc", "doc_no").groupBy(*dealt, "parts", "word", "doc_no").agg(F.count(F.lit(1)).alias("n"))
    if large.isEmpty():
        return counts.select("word", "doc_no", "n")
    added = counts.where("parts IS NOT NULL").groupBy("word", "doc_no").agg(F.sum("n").alias("n"))
    return counts.where("parts IS NULL").select("word", "doc_no", "n").unionByName(added)


_BY_GROUP = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


_BY_WORD = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(WORD_BYTES),
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * WORD_BYTES), "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


def _score() -> Column:
    """A5, from columns tf and idf; see ``text._score`` on the summation."""
    return F.sum((float_text_to_double("tf") * F.col("idf")).cast("float")).cast("float")


def _write(df: DataFrame, folder: str, table: str, buckets: int, dealt: bool = False) -> DataFrame:
    order = _BUCKETED[table][0]
    return write_bucketed(df, f"{folder}/{table}", buckets, order[:1], order, dealt)
