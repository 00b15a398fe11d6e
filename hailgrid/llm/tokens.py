"""Token ids of a byte-level BPE.

Two libraries read the same vocabulary and give the same ids. The one that
encodes fast matches its pattern by backtracking with a bounded stack, and
gives up on runs of some hundred thousand blanks or line breaks. Such a text
goes to the other one, whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

END_OF_TEXT = ("<|endoftext|>", 50256)


@dataclass(frozen=True)
class Vocabulary:
    """The same vocabulary twice: as ranks with a splitting pattern, and as a tokenizer file."""

    ranks: str
    pattern: str
    tokenizer: str


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(maxsize=2)
def fast(vocabulary: Vocabulary):
    import tiktoken

    with open(vocabulary.ranks, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens=dict([END_OF_TEXT]))


@lru_cache(maxsize=2)
def steady(vocabulary: Vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary.tokenizer)


def encoder(vocabulary: Vocabulary) -> Callable[[str | None], np.ndarray]:
    """Texts to ids; null is the empty text, and the end-of-text string in a text is that token."""

    def ids(text: str | None) -> np.ndarray:
        try:
            return fast(vocabulary).encode_to_numpy(text or "", allowed_special="all").astype("<u4")
        except ValueError:  # the pattern ran out of stack
            return np.array(steady(vocabulary).encode(text, add_special_tokens=False).ids, "<u4")

    return ids
