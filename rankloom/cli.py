"""Command-line jobs over text folders, writing the reference's text formats.

    python -m rankloom wordcount IN OUT
    python -m rankloom termfrequency IN OUT
    python -m rankloom tfidf IN OUT
    python -m rankloom search IN OUT WORD [WORD ...]
    python -m rankloom rank IN OUT WORD [WORD ...] [--ties one|all]
    python -m rankloom pagerank IN OUT [--mode M] [--iterations 10] [--tol T] [--format F]
                                       [--edges] [--n N]

Every job refuses an output folder that exists, unless ``--overwrite`` is given.

``IN`` is one or more comma-separated folders or files; every file is a
document, labelled by its base name plus ``.txt``, and N counts every file.
For ``pagerank`` the input holds page lines, or ``src#####dst`` edge lines
with ``--edges`` (N then defaults to the mode's count over the edges; give
``--n`` for the line count of the original page file).  ``--iterations 0`` sets no round limit; whether
the total rank settled within ``--tol`` is said on standard error.
Each job is sources -> operators -> sinks on the active (or a new) Spark
session; nothing passes through the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import sinks as K
from . import sources as S
from .operators import pagerank as PR
from .operators import text as T
from .session import ensure_checkpoint_dir

PAGERANK_FORMATS = {
    "state": K.write_ranked_pages,     # page<TAB><TAB>rank
    "lines": K.write_rank_lines,       # page + three spaces + rank
    "report": K.write_rank_report,     # page has rank: r.
}
# Output format each reference program wrote.
FORMAT_OF_MODE = {"keep_uncited": "state", "all_nodes": "lines", "cited_only": "report"}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rankloom", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("wordcount", "termfrequency", "tfidf"):
        s = sub.add_parser(name)
        s.add_argument("--overwrite", action="store_true")
        s.add_argument("input")
        s.add_argument("output")
    for name in ("search", "rank"):
        s = sub.add_parser(name)
        s.add_argument("input")
        s.add_argument("output")
        s.add_argument("words", nargs="*")
        s.add_argument("--overwrite", action="store_true")
        if name == "rank":
            s.add_argument("--ties", choices=("all", "one"), default="all")
    s = sub.add_parser("pagerank")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--mode", choices=PR.MODES, default="keep_uncited")
    s.add_argument("--iterations", type=int, default=10)
    s.add_argument("--tol", type=float, default=None, help="default: 0 for cited_only, none for the others")
    s.add_argument("--overwrite", action="store_true")
    s.add_argument("--format", choices=tuple(PAGERANK_FORMATS), default=None)
    s.add_argument("--strip-target-spaces", action="store_true")
    s.add_argument("--edges", action="store_true", help="input holds src#####dst edge lines")
    s.add_argument("--n", type=int, default=None, help="N for the initial rank 1/N")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"rankloom-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    new = {"overwrite": args.overwrite}
    if args.job == "pagerank":
        settings = {"mode": args.mode, "n": args.n, "iterations": args.iterations or None, "tol": PR.BY_MODE if args.tol is None else args.tol}
        if args.edges:
            done = PR.pagerank_run(S.read_edge_list(spark, args.input), **settings)
        else:
            done = PR.pagerank_lines_run(S.read_lines(spark, args.input), strip_target_spaces=args.strip_target_spaces, **settings)
        print(f"{'converged' if done.converged else 'stopped'} after {done.rounds} rounds", file=sys.stderr)
        ranks = done.ranks.orderBy(F.desc("rank"), F.asc("page"))
        PAGERANK_FORMATS[args.format or FORMAT_OF_MODE[args.mode]](ranks, args.output, **new)
        return
    docs = S.read_text_docs(spark, args.input, doc_suffix=S.files.DOC_SUFFIX, key="name")
    n_files = S.count_files(spark, args.input)
    if args.job == "wordcount":
        K.write_counts(T.doc_word_count(docs), args.output, ordered=True, **new)
    elif args.job == "termfrequency":
        K.write_counts(T.term_frequency(docs), args.output, value="tf", ordered=True, **new)
    elif args.job == "tfidf":
        K.write_weights(T.tfidf(docs, all_docs=n_files), args.output, ordered=True, **new)
    elif args.job == "search":
        K.write_scores(T.search(docs, args.words, all_docs=n_files), args.output, **new)
    else:
        K.write_scores(T.rank_documents(docs, args.words, ties=args.ties, all_docs=n_files), args.output, **new)


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
