"""Public byte-level BPE tokenizer in tasks."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

END = "<|endoftext|>"


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(4)
def encoder(path: str, special: tuple[tuple[str, int], ...] = ((END, 50256),)):
    """The vocabulary of byte_bpe_50k.json, read from its file of ranks; loaded once a worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))


def encode(text: str | None, path: str, allow_special: bool) -> np.ndarray:
    """Ids of a text (null: none) as uint32. allow_special: the end-of-text string becomes its id, as the json file's tokenizer has it."""
    if not text:
        return np.zeros(0, np.uint32)
    allowed = {END} if allow_special and END in text else set()
    return encoder(path).encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
