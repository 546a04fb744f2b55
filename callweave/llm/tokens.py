"""Token ids of whole texts by public vocabularies.

The vocabulary's own ranks are run by a faster engine that gives the same ids;
texts that spell out a special token go through the tokenizer file itself, which
maps that string to its id. Vocabulary files are looked up on each executor by
name and never copied.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

BYTE_BPE = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def _ranks(name: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))


def token_ids(text: str | None, name: str = BYTE_BPE) -> np.ndarray:
    """uint32 ids of the whole text; a null text is empty."""
    if not text:
        return np.zeros(0, np.uint32)
    if name == BYTE_BPE and SPECIAL in text:
        return np.array(_tokenizer(name).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.frombuffer(memoryview(_ranks(name).encode_to_numpy(text, disallowed_special=())), np.uint32)
