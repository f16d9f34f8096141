"""Column-level building blocks: tokenizer, weights, markup extraction, text encodings."""

from . import markup, text_formats, tokenize, weights

__all__ = ["markup", "text_formats", "tokenize", "weights"]
