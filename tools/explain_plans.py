"""Write the final (post-AQE) physical plans of key queries to PLANS.md.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rankloom import local_session  # noqa: E402
from rankloom.operators import pagerank as PR  # noqa: E402
from rankloom.operators.dictionary import Dictionary  # noqa: E402
from rankloom.operators.index import SearchIndex  # noqa: E402
from rankloom.operators.rank_store import RankStore  # noqa: E402
from rankloom.plans import catalog  # noqa: E402
from rankloom.plans import inputs as I  # noqa: E402
from rankloom.tables import Tables  # noqa: E402

NOTES = {
    "doc_word_count": "Plain scan. Two Generate steps and the partial (word, doc) aggregate run in one codegen stage; one "
                      "exchange carries one row per distinct (word, doc) of a map task.",
    "tfidf": "The postings are a written copy (the corpus is tokenized once, before this plan); they are joined with the "
             "measured (word, idf) table by broadcast and not shuffled.",
    "search": "Only matching postings were written; they are joined with their words' weights and summed per document.",
    "search_keyword_table": "The keyword table is written and measured first; being small it is "
                            "broadcast into a semi-join right on the tokens; then as for search.",
    "wiki_parse_all": "Per-row regex projections and a posexplode of the links, over lineitem joined with orders; the "
                      "line is made once, behind a generator.",
    "index_search": "A word list on the index: only the buckets of its slots are read (SelectedBucketsCount), and the one "
                    "shuffle of postings' data is that of sums per document.",
    "pagerank_round": "One PageRank round over checkpointed shares and rank vector, keyed by page ids: the only Exchange carries "
                      "partial sums per target; the edge scan is neither shuffled nor re-sorted.",
    "rank_store_round": "The same round over a store's bucketed tables, as a restarted application plans it.",
}


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text.rstrip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` (local[8]); final plans after AQE.", ""]
    for name in ["doc_word_count", "tfidf", "search", "search_keyword_table", "wiki_parse_all"]:
        out += [f"## {name}", "", NOTES[name], "", "```", final_plan(catalog.QUERIES[name](spark, sf_dir)), "```", ""]
    tables = Tables(spark)
    index = SearchIndex.build(I.docs(spark, sf_dir), tables.path("index"))
    out += ["## index_search", "", NOTES["index_search"], "", "```", final_plan(index.search(catalog.SEARCH_WORDS)), "```", ""]
    # one PageRank round, as pagerank_run executes it
    e = I.graph_edges(spark, sf_dir)
    store = RankStore.create(e, tables.path("ranks"), partitions=8)
    book = Dictionary.of(tables, e.select("src").union(e.select("dst")))
    e = tables(book.encode(e, "src", "dst"))
    parts = 8
    with PR.fixed_partitioning(spark, parts):
        m = e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))
        deg = m.groupBy("src").agg(F.sum("m").alias("deg"))
        cold = (m.repartition(parts, "src").join(deg.repartition(parts, "src"), "src")
                .select("src", "dst", (F.col("m") / F.col("deg")).alias("w")).sortWithinPartitions("src").checkpoint())
        nodes = (e.select(F.col("src").alias("page")).union(e.select(F.col("dst").alias("page"))).distinct()
                 .repartition(parts, "page").checkpoint())
        ranks = PR._round(cold, None, None, nodes.select("page", F.lit(0.001).alias("rank")), "all_nodes").checkpoint()
        plan = final_plan(PR._round(cold, None, None, ranks, "all_nodes"))
    out += ["## pagerank_round", "", NOTES["pagerank_round"], "", "```", plan, "```", ""]
    with PR.fixed_partitioning(spark, store.meta.buckets):
        out += ["## rank_store_round", "", NOTES["rank_store_round"], "", "```", final_plan(store.step(store._ids(1))), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
