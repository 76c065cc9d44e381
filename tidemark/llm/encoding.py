"""Byte-level BPE ids inside tasks.

The ids are those of ``tokenizers`` with ``byte_bpe_50k.json`` and ``add_special_tokens=False``, so a text that holds the
string of the added token has its id. They are computed by ``tiktoken`` from the same vocabulary kept as ranks, which is
three times as fast; ``tests/llm/test_encoding.py`` holds the two against each other on every Unicode code point and on
whole documents. A text on which ``tiktoken``'s regex engine gives up (runs of a million blanks) goes to ``tokenizers``
itself. Ids come as an array of 4 bytes each, however long the text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np

#: The added token of the vocabulary.
ADDED = {"<|endoftext|>": 50256}
RANKS, JSON = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


@functools.lru_cache(maxsize=4)
def _fast(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


@functools.lru_cache(maxsize=4)
def _plain(path: str | None):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path(JSON))


def encode(text: str | None, ranks_path: str | None = None, json_path: str | None = None) -> np.ndarray:
    """Ids (uint32) of a whole text; a null text has none."""
    if not text:
        return np.zeros(0, np.uint32)
    try:
        return _fast(ranks_path).encode_to_numpy(text, allowed_special="all")
    except BaseException as e:  # the regex engine gives up with an error or a panic, which isn't an Exception nor importable
        if not isinstance(e, ValueError) and type(e).__name__ != "PanicException":
            raise
        return np.asarray(_plain(json_path).encode(text, add_special_tokens=False).ids, np.uint32)
