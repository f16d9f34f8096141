"""Public tokenizer vocabularies; where they are is a parameter, never a copy."""

from __future__ import annotations

import base64
import functools
import os

import numpy as np


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to ids (uint32) that gives what ``tokenizers`` gives for the file ``path``
    without special tokens added.

    Where the same vocabulary lies beside it as ranks, these encode (four times the speed); texts that
    spell a token which the file has beside its ranks go through the file itself.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    beside = os.path.splitext(path)[0] + ".tiktoken"
    plain = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
    if not os.path.exists(beside):
        return plain
    import public_tokenizers
    import tiktoken

    added = [t.content for t in own.get_added_tokens_decoder().values()]
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(beside), special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return plain(text)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode
