"""rankloom: text ranking (TF-IDF search) and link ranking (PageRank) as Spark DataFrame operators.

    from rankloom import documents, tfidf, rank_documents, pagerank_lines
    docs = documents(spark.read.parquet("documents.parquet"))      # (doc, text)
    rank_documents(docs, ["Hadoop", "yellow"]).show()
"""

from .operators.index import SearchIndex
from .operators.links import adjacency, page_edges, parse_pages
from .operators.pagerank import pagerank, pagerank_lines, pagerank_run
from .operators.rank_store import RankStore
from .operators.residual import residual_pagerank
from .operators.statistics import CorpusStatistics
from .operators.text import (corpus_size, doc_frequency, doc_word_count, documents, inverse_doc_frequency,
                             rank_documents, search, term_frequency, tfidf, tokens)
from .session import ensure_checkpoint_dir, local_session
from .tables import Tables

__all__ = [
    "CorpusStatistics", "RankStore", "SearchIndex", "Tables",
    "adjacency", "corpus_size", "doc_frequency", "doc_word_count", "documents", "ensure_checkpoint_dir",
    "inverse_doc_frequency", "local_session", "page_edges", "pagerank", "pagerank_lines", "pagerank_run",
    "parse_pages", "rank_documents", "residual_pagerank", "search", "term_frequency", "tfidf", "tokens",
]
__version__ = "0.1.0"
