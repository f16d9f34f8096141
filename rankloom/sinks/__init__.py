"""Sinks writing the reference's text formats."""

from .text import (write_counts, write_edge_list, write_rank_lines, write_rank_report, write_rank_state,
                   write_ranked_pages, write_scores, write_weights)

__all__ = ["write_counts", "write_edge_list", "write_rank_lines", "write_rank_report", "write_rank_state",
           "write_ranked_pages", "write_scores", "write_weights"]
