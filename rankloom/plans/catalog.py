"""Named queries over the driver's tables: Spark DataFrame + DuckDB SQL per name.

Every query reads whole tables (``documents``, ``benchmark``, ``pages``,
``lineitem``, ``orders``) or data Spark derives from them.  Derived doubles
whose last bit depends on the engine's ``log10`` or summation order are
rounded the same way on both sides (to 9 places; ranks printed as float32 to 6 before that).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text_formats as X
from ..operators import links as L
from ..operators import pagerank as PR
from ..operators import residual as RR
from ..operators import text as T
from ..operators.dictionary import Dictionary
from ..operators.index import SPAN_BITS, SearchIndex
from ..operators.rank_store import RankStore
from ..operators.statistics import STANDARD_ERROR, CorpusStatistics, distinct_sketch, merged_estimate
from ..operators.text import documents
from ..tables import Tables
from . import inputs as I
from . import oracle as O

# Query parameters (chosen from the corpus: frequent words in three
# languages plus a rare one).
SEARCH_WORDS = ["the", "erthat", "la"]
RANK_WORDS = ["de", "of", "und", "is"]
TOP_K = 10
WEIGHT_DIGITS = 9
RANK_DIGITS = 9
FLOAT_DIGITS = 6
ROUNDS = 10
# pagerank_converge stops when the total changes by this much at most.  At sf0.001 to sf0.1 that takes 27 to 55
# rounds, and the changes there and in the round before lie 5 % or more away from it (tested), so rounding cannot
# move the stop.
CONVERGE_TOL = 0.5

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---- text chain ------------------------------------------------------------

@register("tokens", O._with(O.DOC_TOKENS) + "SELECT doc, word FROM doc_tokens")
def q_tokens(spark, d):
    return T.tokens(I.docs(spark, d))


@register("doc_word_count", O._with(O.DOC_TOKENS, O.POSTINGS) + "SELECT word, doc, n FROM postings")
def q_doc_word_count(spark, d):
    return T.doc_word_count(I.docs(spark, d))


@register("term_frequency", O._with(O.DOC_TOKENS, O.POSTINGS, O.TF) + "SELECT word, doc, n, tf FROM tf")
def q_term_frequency(spark, d):
    return T.term_frequency(I.docs(spark, d))


@register("doc_frequency", O._with(O.DOC_TOKENS, O.POSTINGS, O.DF) + "SELECT word, df FROM dfreq")
def q_doc_frequency(spark, d):
    return T.doc_frequency(T.term_frequency(I.docs(spark, d)))


@register("corpus_size", O._with(O.NDOCS) + "SELECT n_docs FROM ndocs")
def q_corpus_size(spark, d):
    return T.corpus_size(I.docs(spark, d))


@register("idf", O._with(O.DOC_TOKENS, O.POSTINGS, O.DF, O.NDOCS, O.IDF)
          + f"SELECT word, df, n_docs, round(idf, {WEIGHT_DIGITS}) AS idf FROM idf")
def q_idf(spark, d):
    return T.inverse_doc_frequency(I.docs(spark, d)).select(
        "word", "df", "n_docs", F.round("idf", WEIGHT_DIGITS).alias("idf"))


@register("tfidf", O.text_chain() + f"SELECT word, doc, tf, round(tfidf, {WEIGHT_DIGITS}) AS tfidf FROM tfidf")
def q_tfidf(spark, d):
    return T.tfidf(I.docs(spark, d)).select("word", "doc", "tf", F.round("tfidf", WEIGHT_DIGITS).alias("tfidf"))


@register("search", O.text_chain(O.score_cte(O.in_list(SEARCH_WORDS))) + "SELECT doc, score FROM scores")
def q_search(spark, d):
    return T.search(I.docs(spark, d), SEARCH_WORDS)


@register("search_keyword_table",
          O.text_chain(O.BENCH_KEYWORDS, O.score_cte("word IN (SELECT word FROM keywords)"))
          + "SELECT doc, score FROM scores")
def q_search_keyword_table(spark, d):
    kw = T.keyword_table(I.benchmark_texts(spark, d))
    return T.search(I.docs(spark, d), keywords=kw)


@register("rank_documents", O.text_chain(O.score_cte(O.in_list(RANK_WORDS)))
          + "SELECT doc, score FROM scores ORDER BY score DESC, doc")
def q_rank_documents(spark, d):
    return T.rank_documents(I.docs(spark, d), RANK_WORDS)


@register("rank_one_per_score", O.text_chain(O.score_cte(O.in_list(RANK_WORDS)))
          + "SELECT max(doc) AS doc, score FROM scores GROUP BY score ORDER BY score DESC")
def q_rank_one_per_score(spark, d):
    return T.rank_documents(I.docs(spark, d), RANK_WORDS, ties="one")


@register("top_k_documents", O.text_chain(O.score_cte(O.in_list(RANK_WORDS)))
          + f"SELECT row_number() OVER (ORDER BY score DESC, doc) AS pos, doc, score FROM scores "
            f"ORDER BY score DESC, doc LIMIT {TOP_K}")
def q_top_k_documents(spark, d):
    top = T.rank_documents(I.docs(spark, d), RANK_WORDS, k=TOP_K)
    # numbering k rows (k is the feature's bound) in one window is fine
    return top.select(F.row_number().over(Window.orderBy(F.desc("score"), F.asc("doc"))).alias("pos"),
                      "doc", "score")


# ---- link extraction -------------------------------------------------------

@register("page_titles", f"SELECT page_id, regexp_extract(html, {O.TITLE}, 1) AS title FROM pages")
def q_page_titles(spark, d):
    return L.html_titles(I.table(spark, d, "pages"))


@register("page_links", f"""SELECT page_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS target
FROM (SELECT page_id, regexp_extract_all(html, {O.HREF}, 1) AS l FROM pages)""")
def q_page_links(spark, d):
    return L.html_links(I.table(spark, d, "pages"))


def _wiki_rows(rule: str) -> QueryFn:
    def fn(spark, d):
        return L.explode_links(L.parse_pages(I.wiki_lines(spark, d), rule), "title", pos=True)
    return fn


register("wiki_parse_first", O.parsed_rows_sql("first_section"))(_wiki_rows("first_section"))
register("wiki_parse_line", O.parsed_rows_sql("whole_line"))(_wiki_rows("whole_line"))
register("wiki_parse_all", O.parsed_rows_sql("all_sections"))(_wiki_rows("all_sections"))


@register("wiki_adjacency", O.adjacency_sql("first_section"))
def q_wiki_adjacency(spark, d):
    return L.adjacency(L.parse_pages(I.wiki_lines(spark, d), "first_section"))


@register("wiki_edges", O._with(O.WIKI_LINES, O.parsed_pages("all_sections"))
          + "SELECT title AS src, unnest(links) AS dst FROM pages")
def q_wiki_edges(spark, d):
    return L.page_edges(L.parse_pages(I.wiki_lines(spark, d), "all_sections")).select("src", "dst")


@register("node_count_titles", O._with(O.WIKI_LINES)
          + f"SELECT count(DISTINCT regexp_extract(line, {O.TITLE}, 1)) AS n FROM wiki_lines "
            f"WHERE regexp_matches(line, {O.TITLE})")
def q_node_count_titles(spark, d):
    return L.title_count(I.wiki_lines(spark, d))


@register("node_count_union", O._with(O.WIKI_LINES)
          + f"""SELECT count(DISTINCT v) AS n FROM (
    SELECT unnest(regexp_extract_all(line, {O.TITLE}, 1)) AS v FROM wiki_lines
    UNION ALL SELECT unnest(regexp_extract_all(line, {O.LINK}, 1)) AS v FROM wiki_lines)""")
def q_node_count_union(spark, d):
    return L.title_target_count(I.wiki_lines(spark, d))


@register("line_count", O._with(O.WIKI_LINES) + "SELECT count(*) AS n FROM wiki_lines")
def q_line_count(spark, d):
    return L.line_count(I.wiki_lines(spark, d))


# ---- graph -----------------------------------------------------------------

@register("edge_distinct", O._with(O.EDGES) + "SELECT DISTINCT src, dst FROM edges")
def q_edge_distinct(spark, d):
    return I.graph_edges(spark, d).distinct()


@register("target_distinct", O._with(O.EDGES) + "SELECT DISTINCT dst FROM edges")
def q_target_distinct(spark, d):
    return I.graph_edges(spark, d).select("dst").distinct()


@register("out_degree", O._with(O.EDGES) + "SELECT src, count(*) AS out_degree FROM edges GROUP BY src")
def q_out_degree(spark, d):
    return I.graph_edges(spark, d).groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


@register("edge_list_text", O._with(O.EDGES) + f"SELECT DISTINCT src || '#####' || dst AS edge_line FROM edges")
def q_edge_list_text(spark, d):
    return I.graph_edges(spark, d).select(X.edge_line().alias("edge_line")).distinct()


def _initial_ranks(edges: DataFrame) -> DataFrame:
    """Pages (sources) at 1/N, N = all nodes."""
    nodes = edges.select(F.col("src").alias("p")).union(edges.select(F.col("dst").alias("p"))).distinct()
    n = nodes.agg(F.count(F.lit(1)).alias("n"))
    return (edges.select(F.col("src").alias("page")).distinct()
            .crossJoin(F.broadcast(n))  # one row
            .select("page", (F.lit(1.0) / F.col("n")).alias("rank")))


_INIT_SQL = [O.EDGES,
             "nodes AS (SELECT src AS page FROM edges UNION SELECT dst AS page FROM edges)",
             "nn AS (SELECT count(*) AS n FROM nodes)",
             "init AS (SELECT DISTINCT src AS page, CAST(1.0 AS DOUBLE) / (SELECT n FROM nn) AS rank FROM edges)",
             "m AS (SELECT src, dst, count(*) AS m FROM edges GROUP BY src, dst)",
             "deg AS (SELECT src, sum(m) AS deg FROM m GROUP BY src)",
             "w AS (SELECT m.src, m.dst, m.m / deg.deg AS w FROM m JOIN deg ON m.src = deg.src)",
             "contrib AS (SELECT w.src, w.dst, i.rank * w.w AS c FROM w JOIN init i ON w.src = i.page)"]


@register("links_join_ranks", O._with(*_INIT_SQL) + f"SELECT src, dst, round(c, {WEIGHT_DIGITS}) AS c FROM contrib")
def q_links_join_ranks(spark, d):
    e = I.graph_edges(spark, d)
    return PR.contributions(e, _initial_ranks(e)).select("src", "dst", F.round("c", WEIGHT_DIGITS).alias("c"))


@register("rank_step", O._with(*_INIT_SQL, "s AS (SELECT dst, sum(c) AS s FROM contrib GROUP BY dst)")
          + f"""SELECT coalesce(i.page, s.dst) AS page,
    round(coalesce(CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * s.s, CAST(0.15 AS DOUBLE)), {RANK_DIGITS}) AS rank
FROM init i FULL OUTER JOIN s ON i.page = s.dst""")
def q_rank_step(spark, d):
    e = I.graph_edges(spark, d)
    return PR.rank_step(e, _initial_ranks(e), "all_nodes").select(
        "page", F.round("rank", RANK_DIGITS).alias("rank"))


def _pagerank_run(spark, d, mode: str, **settings) -> PR.PageRankRun:
    e = I.graph_edges(spark, d)
    n = L.line_count(e).first()["n"] if mode == "cited_only" else None  # lines of the edge list
    return PR.pagerank_run(e, mode=mode, n=n, **settings)


def _round(rank, digits: int = RANK_DIGITS):
    """As ``oracle.rounded``."""
    return F.round(rank + F.lit(1e-12), digits)


def _rounded(ranks: DataFrame, digits: int = RANK_DIGITS) -> DataFrame:
    return ranks.select("page", _round(F.col("rank"), digits).alias("rank"))


def _pagerank(mode: str) -> QueryFn:
    def fn(spark, d):
        return _rounded(_pagerank_run(spark, d, mode, iterations=ROUNDS).ranks.orderBy(F.desc("rank"), F.asc("page")))
    return fn


def _pagerank_lines(mode: str) -> QueryFn:
    def fn(spark, d):
        return _rounded(PR.pagerank_lines(I.wiki_lines(spark, d, numbered=True), mode=mode, iterations=ROUNDS))
    return fn


for _mode in PR.MODES:
    register(f"pagerank_{_mode}", O.pagerank_sql(_mode, ROUNDS, RANK_DIGITS))(_pagerank(_mode))
    register(f"pagerank_lines_{_mode}", O.pagerank_lines_sql(_mode, ROUNDS, RANK_DIGITS))(_pagerank_lines(_mode))


def _converged(spark, d) -> PR.PageRankRun:
    run = _pagerank_run(spark, d, "cited_only", iterations=None, tol=CONVERGE_TOL)
    assert run.converged
    return run


@register("pagerank_converge", O.converge_sql(CONVERGE_TOL, f"SELECT page, {O.rounded('rank', RANK_DIGITS)} AS rank FROM stopped"))
def q_pagerank_converge(spark, d):
    """cited_only, no round limit, until the total changes by CONVERGE_TOL at most."""
    return _rounded(_converged(spark, d).ranks)


@register("total_rank", O.converge_sql(CONVERGE_TOL, f"SELECT round(CAST(sum(CAST(rank AS DECIMAL(38,18))) AS DOUBLE), {RANK_DIGITS}) AS total FROM stopped"))
def q_total_rank(spark, d):
    return PR.total_rank(_converged(spark, d).ranks).select(F.round(F.col("total").cast("double"), RANK_DIGITS).alias("total"))


RESIDUAL_ERROR = 1e-7
RESIDUAL_DIGITS = 3


@register("pagerank_residual", O.fixed_point_sql(1e-11, f"SELECT page, round(rank + 1e-7, {RESIDUAL_DIGITS}) AS rank FROM stopped"))
def q_pagerank_residual(spark, d):
    """all_nodes to its fixed point, pushing only pages that still move."""
    run = RR.residual_pagerank(I.graph_edges(spark, d), mode="all_nodes", error=RESIDUAL_ERROR)
    assert run.missing <= RESIDUAL_ERROR
    return run.ranks.select("page", F.round(F.col("rank") + F.lit(1e-7), RESIDUAL_DIGITS).alias("rank"))


@register("pagerank_resume", O.pagerank_sql("all_nodes", ROUNDS, RANK_DIGITS))
def q_pagerank_resume(spark, d):
    """Half of the rounds, the state as text lines and back, then the other half."""
    half = _pagerank_run(spark, d, "all_nodes", iterations=ROUNDS // 2).ranks
    state = half.select(F.concat_ws("", "page", F.lit(X.TAB + X.STATE_SEP), F.col("rank").cast("string")).alias("value"))
    start = state.select(*X.parse_rank_state())
    return _rounded(_pagerank_run(spark, d, "all_nodes", iterations=ROUNDS - ROUNDS // 2, initial_ranks=start).ranks)


@register("rank_report", O.pagerank_sql("all_nodes", ROUNDS, RANK_DIGITS).replace(
    f"SELECT page, {O.rounded('rank', RANK_DIGITS)} AS rank FROM r{ROUNDS}",
    f"SELECT page || ' has rank: ' || CAST({O.rounded('rank', RANK_DIGITS)} AS VARCHAR) || '.' AS report FROM r{ROUNDS}"))
def q_rank_report(spark, d):
    r = PR.pagerank(I.graph_edges(spark, d), mode="all_nodes", iterations=ROUNDS)
    return r.select(X.rank_report("page", _round(F.col("rank"))).alias("report"))


# ---- text formats: each line as written, and read back -----------------------

_TF_TEXT = f"CAST({O.java_float_to_double('tf')} AS VARCHAR)"


@register("count_text", O._with(O.DOC_TOKENS, O.POSTINGS) + "SELECT word || '&#&#&' || doc || chr(9) || chr(9) || n AS line FROM postings")
def q_count_text(spark, d):
    return T.doc_word_count(I.docs(spark, d)).select(X.count_line().alias("line"))


@register("tf_text", O._with(O.DOC_TOKENS, O.POSTINGS, O.TF) + f"SELECT word || '&#&#&' || doc || chr(9) || chr(9) || {_TF_TEXT} AS line FROM tf")
def q_tf_text(spark, d):
    return T.term_frequency(I.docs(spark, d)).select(X.count_line(value="tf").alias("line"))


@register("weight_text", O.text_chain() + f"SELECT word || '&#&#&' || doc || chr(9) || CAST(round(tfidf, {WEIGHT_DIGITS}) AS VARCHAR) AS line FROM tfidf")
def q_weight_text(spark, d):
    w = T.tfidf(I.docs(spark, d)).select("word", "doc", F.round("tfidf", WEIGHT_DIGITS).alias("tfidf"))
    return w.select(X.weight_line().alias("line"))


@register("score_text", O.text_chain(O.score_cte(O.in_list(RANK_WORDS)))
          + f"SELECT doc || chr(9) || CAST({O.java_float_to_double('score')} AS VARCHAR) AS line FROM scores")
def q_score_text(spark, d):
    return T.search(I.docs(spark, d), RANK_WORDS).select(X.score_line().alias("line"))


_KEEP = O.pagerank_ctes("keep_uncited", ROUNDS)
_FLOAT_TEXT = O.java_text(O.java_float_to_double(f"CAST({O.rounded('rank', FLOAT_DIGITS)} AS FLOAT)"))


def _states(spark, d) -> DataFrame:
    """(page, rank, links) after the rounds of keep_uncited; a page's distinct targets in order."""
    ranks = _rounded(_pagerank_run(spark, d, "keep_uncited", iterations=ROUNDS).ranks, FLOAT_DIGITS)
    links = I.graph_edges(spark, d).groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("links"))
    return (ranks.join(links.withColumnRenamed("src", "page"), "page", "left")
            .withColumn("links", F.coalesce("links", F.array().cast("array<string>"))))


_STATES = ("states AS (SELECT r.page, r.rank, l.links FROM r%d r LEFT JOIN (SELECT src, "
           "array_to_string(list_sort(list(DISTINCT dst)), '@!#') AS links FROM edges GROUP BY src) l ON r.page = l.src)" % ROUNDS)


@register("rank_state_text", O._with(*_KEEP, _STATES) + f"""SELECT page || chr(9) || '##' || {_FLOAT_TEXT}
    || CASE WHEN links IS NULL THEN '' ELSE '##' || links END AS line FROM states""")
def q_rank_state_text(spark, d):
    return _states(spark, d).select(X.rank_state_line().alias("line"))


@register("ranked_page_text", O._with(*_KEEP) + f"SELECT page || chr(9) || chr(9) || {_FLOAT_TEXT} AS line FROM r{ROUNDS}")
def q_ranked_page_text(spark, d):
    ranks = _rounded(_pagerank_run(spark, d, "keep_uncited", iterations=ROUNDS).ranks, FLOAT_DIGITS)
    return ranks.select(X.ranked_page_line().alias("line"))


@register("rank_line_text", O._with(*O.pagerank_ctes("all_nodes", ROUNDS))
          + f"SELECT page || '   ' || CAST({O.rounded('rank', RANK_DIGITS)} AS VARCHAR) AS line FROM r{ROUNDS}")
def q_rank_line_text(spark, d):
    return _rounded(_pagerank_run(spark, d, "all_nodes", iterations=ROUNDS).ranks).select(X.rank_line("page", "rank").alias("line"))


@register("term_weights_parsed", O._with(O.DOC_TOKENS, O.POSTINGS, O.TF)
          + f"SELECT word, CAST(doc AS VARCHAR) AS doc, {O.java_float_to_double('tf')} AS value FROM tf")
def q_term_weights_parsed(spark, d):
    return q_tf_text(spark, d).select(*X.parse_term_weight("line"))


@register("scores_parsed", O.text_chain(O.score_cte(O.in_list(RANK_WORDS))) + "SELECT CAST(doc AS VARCHAR) AS doc, score FROM scores")
def q_scores_parsed(spark, d):
    return q_score_text(spark, d).select(*X.parse_score("line"))


@register("rank_state_parsed", O._with(*_KEEP, _STATES)
          + f"SELECT page, {O.java_float_to_double(f'CAST({O.rounded('rank', FLOAT_DIGITS)} AS FLOAT)')} AS rank, "
            "coalesce(links, '') AS links_text FROM states")
def q_rank_state_parsed(spark, d):
    back = q_rank_state_text(spark, d).select(*X.parse_rank_state("line"))
    return back.select("page", "rank", X.encode_links("links").alias("links_text"))


@register("edges_parsed", O._with(O.EDGES) + "SELECT DISTINCT src, dst FROM edges")
def q_edges_parsed(spark, d):
    return q_edge_list_text(spark, d).select(*X.parse_edge("edge_line"))


@register("wiki_edges_stripped", O._with(O.WIKI_LINES, O.parsed_pages("first_section"))
          + "SELECT src, replace(dst, ' ', '') AS dst FROM (SELECT title AS src, unnest(links) AS dst FROM pages)")
def q_wiki_edges_stripped(spark, d):
    pages = L.parse_pages(I.wiki_lines(spark, d), "first_section", strip_target_spaces=True)
    return L.page_edges(pages).select("src", "dst")


@register("adjacency_decoded", O._with(O.WIKI_LINES, O.parsed_pages("whole_line"))
          + "SELECT title, unnest(links) AS dst FROM pages")
def q_adjacency_decoded(spark, d):
    """links encoded as a@!#b and taken apart again."""
    coded = L.adjacency(L.parse_pages(I.wiki_lines(spark, d), "whole_line"))
    return coded.select("title", F.explode(X.decode_links("links_text")).alias("dst"))


@register("search_query_words", O.text_chain(O.score_cte(O.in_list(["the", "la", "und"]))) + "SELECT doc, score FROM scores")
def q_search_query_words(spark, d):
    """repeated words count once, a comma separates two."""
    return T.search(I.docs(spark, d), ["the,la", "the", "und", "", "la"])


@register("counts_in_key_order", O._with(O.DOC_TOKENS, O.POSTINGS)
          + "SELECT row_number() OVER (ORDER BY word, doc) AS pos, word, doc, n FROM postings ORDER BY word, doc")
def q_counts_in_key_order(spark, d):
    """The whole key-ordered output, numbered."""
    return T.in_key_order(T.doc_word_count(I.docs(spark, d)))


# ---- text folders: written, and read back ------------------------------------

@register("text_folder_counts", O._with(O.SOURCE_TOKENS) + "SELECT word, doc, count(*) AS n FROM source_tokens GROUP BY word, doc")
def q_text_folder_counts(spark, d):
    """Word counts of folders of text files, one folder per source, by a label made of the file's path."""
    from ..sources.files import DOC_SUFFIX, read_text_docs

    path = Tables(spark).path("texts")
    lines = T.lines(documents(I.table(spark, d, "documents"), "source"))
    lines.select(F.col("doc").alias("source"), F.col("line").alias("value")).write.partitionBy("source").text(path)
    files = read_text_docs(spark, f"{path}/*", doc_suffix=DOC_SUFFIX)
    label = F.regexp_extract("doc", r"/source=([^/]*)/[^/]*(\.txt)$", 1)
    return T.doc_word_count(files.select(label.alias("doc"), "text"))


@register("text_folder_files", "SELECT count(DISTINCT c_nationkey) AS files, count(DISTINCT c_nationkey) AS docs FROM customer")
def q_text_folder_files(spark, d):
    """N of a folder with one file of customers per nation, counted by the scan and by the file system."""
    from ..sources import count_files, list_docs

    path = Tables(spark).path("files")
    customers = I.table(spark, d, "customer").select("c_nationkey", F.col("c_name").alias("value"))
    customers.repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    docs = list_docs(spark, path).where(F.col("doc").like("%/part-%"))
    files = count_files(spark, path, pattern="part-*")
    return docs.agg(F.count_distinct("doc").alias("docs")).select(F.lit(files).cast("long").alias("files"), "docs")


@register("page_line_files", O._with(O.WIKI_LINES) + "SELECT line, count(*) AS n FROM wiki_lines GROUP BY line")
def q_page_line_files(spark, d):
    """Page lines from text files, blank lines kept, every line with a number of its own."""
    from ..sources import read_lines

    path = Tables(spark).path("lines")
    I.wiki_lines(spark, d).select(F.col("line").alias("value")).write.text(path)
    return read_lines(spark, path).groupBy("line").agg(F.count_distinct("line_id").alias("n"))


@register("single_file_report", O._with(*O.pagerank_ctes("all_nodes", ROUNDS))
          + f"SELECT page || ' has rank: ' || CAST({O.rounded('rank', RANK_DIGITS)} AS VARCHAR) || '.' AS report, 1 AS files FROM r{ROUNDS}")
def q_single_file_report(spark, d):
    """The report as one file, read back with the number of files it came from."""
    from ..sinks import write_rank_report

    path = Tables(spark).path("report")
    write_rank_report(_rounded(_pagerank_run(spark, d, "all_nodes", iterations=ROUNDS).ranks), path, single_file=True)
    lines = spark.read.text(path).select(F.col("value").alias("report"), F.col("_metadata.file_name").alias("file"))
    files = lines.agg(F.count_distinct("file").alias("files"))
    return lines.select("report").crossJoin(F.broadcast(files))  # one row


# ---- integer ids and the persistent index ------------------------------------

_NODES = "nodes AS (SELECT src AS page FROM edges UNION SELECT dst AS page FROM edges)"


@register("page_ids", O._with(O.EDGES, _NODES) + "SELECT row_number() OVER (ORDER BY page) - 1 AS id, page FROM nodes")
def q_page_ids(spark, d):
    """The dictionary that PageRank's rounds work on."""
    e = I.graph_edges(spark, d)
    return Dictionary.of(Tables(spark), e.select("src").union(e.select("dst"))).table.withColumnRenamed("value", "page")


def _index(spark, d) -> SearchIndex:
    """An index of all documents in the shared folder; it goes when the application ends."""
    return SearchIndex.build(I.docs(spark, d), Tables(spark).path("index"))


@register("index_postings", O._with(O.DOC_TOKENS, O.POSTINGS, O.TF, O.DF,
                                    "lexicon AS (SELECT word, df, row_number() OVER (ORDER BY word) - 1 AS word_id FROM dfreq)")
          + "SELECT word_id, word, df, doc, tf FROM tf JOIN lexicon USING (word)")
def q_index_postings(spark, d):
    """The index's tables, joined by their ids."""
    index = _index(spark, d)
    postings = index.table("postings").withColumn("word_id", F.shiftright("slot", SPAN_BITS))
    return postings.join(index.table("lexicon"), "word_id").join(index.table("documents"), "doc_no").select("word_id", "word", "df", "doc", "tf")


@register("index_search", SQL["search"])
def q_index_search(spark, d):
    return _index(spark, d).search(SEARCH_WORDS)


@register("index_search_keywords", SQL["search_keyword_table"])
def q_index_search_keywords(spark, d):
    return _index(spark, d).search(keywords=T.keyword_table(I.benchmark_texts(spark, d)))


@register("index_top_k", SQL["top_k_documents"])
def q_index_top_k(spark, d):
    """O3: blocks that cannot hold one of the first k are not read."""
    queries = spark.createDataFrame([(0, w) for w in RANK_WORDS], "query_id int, word string")
    return _index(spark, d).top_k(queries, TOP_K).rows.select("pos", "doc", "score")


@register("index_batch_top_k", O.text_chain(
    O.BENCH_TOKENS, "asked AS (SELECT DISTINCT doc AS query_id, word FROM bench_tokens)",
    "batch AS (SELECT query_id, tfidf.doc, CAST(sum(CAST(CAST(tfidf AS FLOAT) AS DOUBLE)) AS FLOAT) AS score FROM tfidf JOIN asked USING (word) GROUP BY ALL)",
    "placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS pos FROM batch)")
    + f"SELECT query_id, pos, doc, score FROM placed WHERE pos <= {TOP_K}")
def q_index_batch_top_k(spark, d):
    """Every benchmark item as a query, all at once."""
    queries = T.tokens(I.benchmark_texts(spark, d)).withColumnRenamed("doc", "query_id")
    return _index(spark, d).top_k(queries, TOP_K).rows


# ---- stores that outlive the application --------------------------------------

@register("pagerank_stored", O.pagerank_sql("all_nodes", ROUNDS, RANK_DIGITS))
def q_pagerank_stored(spark, d):
    """Half of the rounds, the store opened anew, then the other half."""
    path = Tables(spark).path("ranks")
    RankStore.create(I.graph_edges(spark, d), path, mode="all_nodes").advance(ROUNDS // 2)
    again = RankStore(spark, path)
    again.advance(ROUNDS)
    return _rounded(again.ranks())


@register("statistics_in_batches", O._with(O.DOC_TOKENS, O.POSTINGS, O.DF, O.NDOCS) + "SELECT word, df, n_docs FROM dfreq, ndocs")
def q_statistics_in_batches(spark, d):
    """Two batches, the second of which brings the first one again."""
    docs = I.docs(spark, d)
    store = CorpusStatistics(spark, Tables(spark).path("statistics"))
    store.add(docs.where(F.xxhash64("doc") % 2 == 0))
    store.add(docs)
    return store.inverse_doc_frequency().select("word", "df", "n_docs")


@register("approx_distinct", O._with(O.WIKI_LINES, O.EDGES) + f"""SELECT 'titles' AS what, count(DISTINCT regexp_extract(line, {O.TITLE}, 1)) AS n, TRUE AS near
    FROM wiki_lines WHERE regexp_matches(line, {O.TITLE})
UNION ALL SELECT 'documents', count(DISTINCT doc_id), TRUE FROM documents
UNION ALL SELECT 'targets', count(DISTINCT dst), TRUE FROM edges""")
def q_approx_distinct(spark, d):
    """Distinct counts from mergeable sketches, one per tenth of the values, beside the exact ones."""
    titles = L.parse_pages(I.wiki_lines(spark, d), "whole_line").select(F.lit("titles").alias("what"), F.col("title").alias("v"))
    values = titles.union(I.docs(spark, d).select(F.lit("documents"), F.col("doc").cast("string"))).union(
        I.graph_edges(spark, d).select(F.lit("targets"), "dst"))
    part = F.pmod(F.xxhash64("v"), F.lit(10)).alias("part")
    estimate = merged_estimate(distinct_sketch(values.select("*", part), "v", "what", "part"), "what").withColumnRenamed("n", "estimate")
    exact = values.groupBy("what").agg(F.count_distinct("v").alias("n"))
    return exact.join(estimate, "what").select("what", "n", (F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * 4 * STANDARD_ERROR).alias("near"))
