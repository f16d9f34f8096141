"""Sources: the reference's text files (``files``) and the driver's Parquet tables (``plans.inputs``)."""

from .files import (count_files, list_docs, read_edge_list, read_lines, read_rank_state, read_scores, read_term_weights,
                    read_text_docs)

__all__ = ["count_files", "list_docs", "read_edge_list", "read_lines", "read_rank_state", "read_scores", "read_term_weights",
           "read_text_docs"]
