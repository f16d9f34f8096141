"""Text retrieval chain as DataFrame operators.

P1 doc_word_count -> P2 term_frequency -> P3 tfidf -> P4 search -> P5 rank_documents.

Input is a documents frame ``(doc, text)``; ``doc`` is any orderable key
(``doc_id`` of the ``documents`` table, or a file name from a text folder).
A document is tokenised line by line, as a line reader would feed it.

Plan shape (see ``explain`` in the tests):

* tokens: two narrow ``Generate`` steps (lines, then tokens) inside one
  codegen stage; no UDF.
* counts: a document that is one row is counted where it is, by sorting its tokens; postings of
  all words are not shuffled.  Documents of several rows, very long texts and searches for some words take
  a hash aggregate on (word, doc) with a map-side partial aggregate.
* TF-IDF: the aggregated postings are written once (Parquet, see ``tables``) and everything
  else reads that copy, so the corpus is tokenized once.  Document frequency is an
  aggregate on ``word`` over it (partial aggregation collapses hot words before the
  shuffle), materialised and measured in bytes, then joined back on ``word``: broadcast
  when small (postings are not shuffled), else a join of two plain exchanges, whose
  hot-word partitions AQE splits.  A window ``count(*) OVER (PARTITION BY word)`` would
  put every posting of a hot word into one task.
* corpus size: one-row global aggregate over the documents (not the
  postings, so documents without tokens count), cross-joined as a
  broadcast: its size is one row by construction.
* search: the word filter (or keyword semi-join) sits right above the token
  ``Generate``; only matching postings are written and weighted.

What an operator writes goes into the caller's ``tables`` (a :class:`rankloom.tables.Tables` block, which deletes
it), or, where none is given, is deleted when the application ends: the lazy result reads it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokenize import query_words, split_lines, split_tokens, text_tokens, token_split_pattern
from ..functions.weights import float_text_to_double, idf as idf_col, log_tf
from ..tables import Tables, in_order


def documents(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Adapt any table to the ``(doc, text)`` shape the text operators take."""
    return df.select(F.col(doc).alias("doc"), F.col(text).alias("text"))


def lines(docs: DataFrame, *more: str) -> DataFrame:
    """``(doc, line)``: one row per line of every document; columns ``more`` are kept."""
    return docs.select("doc", *more, F.explode(split_lines("text")).alias("line"))


def tokens(docs: DataFrame, *more: str) -> DataFrame:
    """``(doc, word)``, one row per token occurrence; columns ``more`` are kept."""
    pattern = token_split_pattern(docs.sparkSession)
    return (lines(docs, *more)
            .select("doc", *more, F.explode(split_tokens("line", pattern)).alias("word"))
            .filter(F.col("word") != ""))


# Longest text, in bytes, whose tokens are sorted within its row.
ROW_TEXT = 1 << 20


def row_counts(docs: DataFrame) -> DataFrame:
    """``(word, doc, n)``: occurrences of each token in each row of ``docs``; nothing is shuffled.

    A row's tokens are sorted, so a word's occurrences are a run.
    """
    words = F.sort_array(text_tokens("text", token_split_pattern(docs.sparkSession)))
    # Behind a generator an array is made once: the optimizer copies no expression through it.
    rows = docs.select("doc", F.explode(F.array(words)).alias("words")).where(F.size("words") > 0)
    later = F.filter(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.get("words", i) != F.get("words", i - 1))
    starts = F.when(F.size("words") == 1, F.array(F.lit(0))).otherwise(F.concat(F.array(F.lit(0)), later))
    rows = rows.select("doc", "words", F.explode(F.array(starts)).alias("starts"))
    runs = rows.select("doc", "words", "starts", F.posexplode("starts").alias("run", "start"))
    n = F.coalesce(F.get("starts", F.col("run") + 1), F.size("words")) - F.col("start")
    return runs.select(F.get("words", F.col("start")).alias("word"), "doc", n.cast("long").alias("n")).where("word != ''")


def doc_word_count(docs: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``(word, doc, n)``: occurrences of each token in each document.

    Keys are read first, to tell which of them several rows share.
    """
    keys = docs.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc").alias("doc_"), F.lit(True).alias("shared_"))
    shared, long = F.lit(False), F.coalesce(F.octet_length("text") > ROW_TEXT, F.lit(False))
    with Tables(docs.sparkSession) as own:
        keys = (tables or own)(keys)
        n_shared = keys.count()
        if n_shared and not tables:
            own.keep(keys)
    if n_shared:
        docs = docs.join(F.broadcast(keys) if n_shared <= BROADCAST_KEYS else keys, F.col("doc").eqNullSafe(F.col("doc_")), "left")
        shared = F.coalesce("shared_", shared)
    together = tokens(docs.where(shared | long).select("doc", "text")).groupBy("word", "doc").agg(F.count(F.lit(1)).alias("n"))
    return row_counts(docs.where(~(shared | long)).select("doc", "text")).unionByName(together)


def term_frequency(docs: DataFrame, words: Iterable[str] | None = None,
                   keywords: DataFrame | None = None, tables: Tables | None = None) -> DataFrame:
    """``(word, doc, n, tf)`` with ``tf = float32(1 + log10(n))``.

    ``words`` / ``keywords`` restrict the postings to query words before the
    aggregation (C3, J1); given both, a word has to be in both.  A list of more than
    ``MAX_IN_LIST`` words becomes a keyword table.
    """
    if words is None and keywords is None:
        return doc_word_count(docs, tables).withColumn("tf", log_tf("n"))
    toks = tokens(docs)
    if words is not None:
        words = sorted(set(words))
        if len(words) <= MAX_IN_LIST:
            toks = toks.filter(F.col("word").isin(words))
        else:
            toks = toks.join(_word_list(docs.sparkSession, words), "word", "left_semi")
    if keywords is not None:
        toks = toks.join(keywords, "word", "left_semi")
    counts = toks.groupBy("word", "doc").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("tf", log_tf("n"))


def _word_list(spark, words: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "word string")


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row ``(n_docs)``: number of distinct documents, with or without tokens."""
    return docs.agg(F.count_distinct("doc").alias("n_docs"))


def doc_frequency(postings: DataFrame) -> DataFrame:
    """A3: ``(word, df)``: number of documents holding each word."""
    return postings.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def inverse_doc_frequency(docs: DataFrame, postings: DataFrame | None = None,
                          all_docs: DataFrame | int | None = None) -> DataFrame:
    """``(word, df, n_docs, idf)`` with ``idf = log10(1 + n_docs div df)``.

    N is the number of documents in ``docs``, or in ``all_docs`` when given:
    a ``(doc)`` frame, or a number such as ``sources.count_files(...)``.
    """
    postings = postings if postings is not None else term_frequency(docs)
    if isinstance(all_docs, int):
        n = docs.sparkSession.range(1).select(F.lit(all_docs).cast("long").alias("n_docs"))
    else:
        n = corpus_size(all_docs if all_docs is not None else docs)
    return (doc_frequency(postings)
            .crossJoin(F.broadcast(n))  # one row: a global aggregate without keys
            .withColumn("idf", idf_col("n_docs", "df")))


# Largest word table (vocabulary with idf, or keyword set) broadcast, in bytes.
BROADCAST_VOCABULARY_BYTES = 96 << 20
# Fixed part of a broadcast row: hash map slot, row header, offset and the double.
ROW_BYTES = 48
# Most document keys that are broadcast.
BROADCAST_KEYS = 100_000
# Longest word list put into one IN predicate.
MAX_IN_LIST = 1000


def _materialise(df: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``df`` written and read back."""
    if tables is not None:
        return tables(df)
    tables = Tables(df.sparkSession)
    return tables.keep(tables(df))


def in_key_order(counts: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``(pos, word, doc, ...)``: all rows by (word, doc) in byte order, numbered from 1.

    Range-partitioned and written; only the number of rows of each partition comes to the driver.
    """
    return in_order(tables or Tables(counts.sparkSession), counts, ["word", "doc"], "pos", first=1)[0]


def _measured(words: DataFrame, broadcast_bytes: int, tables: Tables | None = None) -> tuple[DataFrame, bool]:
    """Materialise a word-keyed table and tell whether it is small enough to broadcast.

    The size is measured on the materialised rows (bytes of the words plus a fixed
    part per row), not estimated, so a broadcast never depends on a guess.
    """
    words = _materialise(words, tables)
    size = words.agg(F.coalesce(F.sum(F.octet_length("word") + F.lit(ROW_BYTES)), F.lit(0)).alias("b")).first()["b"]
    return words, size <= broadcast_bytes


def tfidf(docs: DataFrame, postings: DataFrame | None = None, all_docs: DataFrame | int | None = None,
          broadcast_bytes: int = BROADCAST_VOCABULARY_BYTES, tables: Tables | None = None) -> DataFrame:
    """``(word, doc, tf, tfidf)``.

    ``tfidf = double(text(tf)) * idf``: TF goes through its float32 text form,
    as the reference stores it between jobs (F9).

    ``postings`` (default: of all words) are materialised here and read twice, so the
    corpus is tokenized once; see the module docstring for the join.
    """
    postings = _materialise((postings if postings is not None else term_frequency(docs, tables=tables)).select("word", "doc", "tf"), tables)
    weights, small = _measured(inverse_doc_frequency(docs, postings, all_docs).select("word", "idf"), broadcast_bytes, tables)
    if small:
        weights = F.broadcast(weights)
    return (postings.join(weights, "word")
            .select("word", "doc", "tf",
                    (float_text_to_double("tf") * F.col("idf")).alias("tfidf")))


def _score(weighted: DataFrame) -> DataFrame:
    # A5: the reference adds float32 values; their double sum is exact for
    # realistic ranges, so summing in double and rounding once is the same
    # number without the order dependence of float32 accumulation.
    return weighted.groupBy("doc").agg(F.sum(F.col("tfidf").cast("float")).cast("float").alias("score"))


def search(docs: DataFrame, words: Iterable[str] | str | None = None,
           keywords: DataFrame | None = None, keyword_col: str = "word",
           all_docs: DataFrame | int | None = None,
           broadcast_bytes: int = BROADCAST_VOCABULARY_BYTES, tables: Tables | None = None) -> DataFrame:
    """``(doc, score)``: sum of TF-IDF over the query words, documents with a hit only.

    Give the query as ``words`` (a list, F27 rules apply) or as a ``keywords`` DataFrame (semi-join,
    J1); given both, only words in both count.  No words means an empty result (Q11).
    """
    q = None
    if words is not None:
        q = query_words(words)
        if not q:
            return _empty_scores(docs)
    if q is None and keywords is None:
        return _empty_scores(docs)
    if keywords is None:
        return _score(tfidf(docs, term_frequency(docs, words=q), all_docs, broadcast_bytes, tables))
    # A keyword table is data: measure it.  Small -> broadcast semi-join right on the tokens; large ->
    # semi-join the written postings, so that a shuffle moves postings, not raw tokens, from plain
    # exchanges whose hot words can be split.
    kw = keywords.select(F.col(keyword_col).alias("word")).filter(F.col("word").isNotNull()).distinct()
    kw, small = _measured(kw, broadcast_bytes, tables)
    if small:
        postings = term_frequency(docs, words=q, keywords=F.broadcast(kw))
    else:
        postings = _materialise(term_frequency(docs, words=q, tables=tables), tables).join(kw, "word", "left_semi")
    return _score(tfidf(docs, postings, all_docs, broadcast_bytes, tables))


def _empty_scores(docs: DataFrame) -> DataFrame:
    return docs.select("doc", F.lit(None).cast("float").alias("score")).limit(0)


def rank_documents(docs: DataFrame, words: Iterable[str] | str | None = None,
                   keywords: DataFrame | None = None, ties: str = "all",
                   k: int | None = None, all_docs: DataFrame | int | None = None,
                   tables: Tables | None = None) -> DataFrame:
    """P5/O1: search result in descending score order (ties broken by ascending doc).

    ``ties="one"`` keeps a single document per distinct score (the largest
    doc key), like the reference's rank job (A12).  ``k`` keeps the first k
    rows (O3, top-k).
    """
    if ties not in ("all", "one"):
        raise ValueError("ties must be 'all' or 'one'")
    scores = search(docs, words, keywords, all_docs=all_docs, tables=tables)
    if ties == "one":
        scores = scores.groupBy("score").agg(F.max("doc").alias("doc")).select("doc", "score")
    ordered = scores.orderBy(F.desc("score"), F.asc("doc"))
    return ordered.limit(k) if k is not None else ordered


def keyword_table(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word)``: distinct tokens of a table of texts, for ``search(keywords=...)``."""
    return tokens(texts.select(F.lit(0).alias("doc"), F.col(text).alias("text"))).select("word").distinct()
