"""Corpus statistics that grow with the corpus (A3, A6, P3, J5; mergeable counts for A6, A7, A8, A15).

A store holds, per batch of documents, the document frequencies of the batch's words, the keys of its documents, and
sketches of its distinct words.  Adding a batch reads the batch and the keys only: no old text.  Frequencies and N are sums
over the batches, so weights of any documents follow from the store.

=============  ==================================  =========================================
words/b        word, df                            of the documents that batch b brought
documents/b    doc                                 keys that no earlier batch had
batches/b      batch, n_docs, words_sketch         one row, written when batch b is complete
=============  ==================================  =========================================

A document key that the store knows is passed over, so a batch that is delivered twice counts once, and a batch whose
writing was ended counts not at all and can be added again.  Rows without a key are passed over.

Sketches are HyperLogLog of ``LG_K`` (2 ** 12 registers: a standard error of 1.6 %); they merge without the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.weights import float_text_to_double, idf as idf_col
from ..session import delete_path, path_exists
from ..tables import Tables
from .text import doc_frequency, term_frequency

LG_K = 12
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
_BATCH = "batch int, n_docs long, words_sketch binary"


def distinct_sketch(values: DataFrame, column: str, *by: str) -> DataFrame:
    """``(by..., sketch)``: a mergeable sketch of a column's distinct values."""
    return values.groupBy(*by).agg(F.hll_sketch_agg(column, F.lit(LG_K)).alias("sketch"))


def merged_estimate(sketches: DataFrame, *by: str) -> DataFrame:
    """``(by..., n)``: the estimated number of distinct values of all sketches together."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


class CorpusStatistics:
    def __init__(self, spark: SparkSession, folder: str):
        """Open a store, or begin one in a folder that does not exist yet."""
        self.spark, self.folder = spark, folder.rstrip("/")

    def batches(self) -> DataFrame:
        """``(batch, n_docs, words_sketch)`` of the complete batches."""
        if not path_exists(self.spark, f"{self.folder}/batches"):
            return self.spark.createDataFrame([], _BATCH)
        return self.spark.read.schema(_BATCH).option("recursiveFileLookup", "true").parquet(f"{self.folder}/batches")

    def _complete(self) -> list[int]:
        return sorted(r.batch for r in self.batches().select("batch").collect())  # a row per batch

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{b}" for b in self._complete()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def add(self, docs: DataFrame) -> int:
        """Add a batch ``(doc, text)``; gives the number of documents that were new."""
        number = max(self._complete(), default=-1) + 1
        known = self._read("documents", f"doc {docs.schema['doc'].dataType.simpleString()}")
        place = lambda kind: f"{self.folder}/{kind}/{number}"
        for kind in ("words", "documents"):
            delete_path(self.spark, place(kind))  # what an ended run left
        with Tables(self.spark) as tables:
            docs = docs.where("doc IS NOT NULL")
            docs.select("doc").distinct().join(known, "doc", "left_anti").write.parquet(place("documents"))
            fresh = self.spark.read.schema(known.schema).parquet(place("documents"))
            if number:
                docs = docs.join(fresh, "doc", "left_semi")
            postings = tables(term_frequency(docs, tables=tables).select("word", "doc"))
            doc_frequency(postings).write.parquet(place("words"))
            words = self.spark.read.schema("word string, df long").parquet(place("words"))
            n = fresh.count()
            sketch = distinct_sketch(words, "word").first()["sketch"]
            self.spark.createDataFrame([(number, n, sketch)], _BATCH).coalesce(1).write.parquet(place("batches"))
        return n

    def n_docs(self) -> int:
        """Documents of all batches."""
        return self.batches().agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n")).first()["n"]

    def doc_frequency(self) -> DataFrame:
        """A3: ``(word, df)`` over all batches."""
        return self._read("words", "word string, df long").groupBy("word").agg(F.sum("df").alias("df"))

    def inverse_doc_frequency(self) -> DataFrame:
        """``(word, df, n_docs, idf)`` over all batches."""
        return self.doc_frequency().withColumn("n_docs", F.lit(self.n_docs())).withColumn("idf", idf_col("n_docs", "df"))

    def tfidf(self, docs: DataFrame) -> DataFrame:
        """``(word, doc, tf, tfidf)`` of documents of the store, weighted by the whole store's statistics; only these texts are read."""
        weights = self.inverse_doc_frequency().select("word", "idf")
        return term_frequency(docs).join(weights, "word").select("word", "doc", "tf", (float_text_to_double("tf") * F.col("idf")).alias("tfidf"))

    def estimated_words(self) -> int:
        """Distinct words of all batches, from their sketches alone."""
        found = merged_estimate(self.batches().select(F.col("words_sketch").alias("sketch"))).first()["n"]
        return int(found or 0)
