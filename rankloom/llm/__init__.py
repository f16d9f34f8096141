"""Training-data operators: each module is one operator, ``catalog`` names their queries.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
