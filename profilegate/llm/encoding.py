"""Token ids of many texts, inside tasks.

The ids are those of the tokenizer file. Its merge ranks are applied by the library that takes ranks, which is several
times as fast. Where white space never follows white space, the pre-token pattern needs no look-ahead, which makes
matching cheaper and changes no id. Texts that spell out a special token are left to the tokenizer itself.
"""

from __future__ import annotations

import base64
import functools
import re
from typing import NamedTuple

import numpy as np

_RUN = re.compile(r"\s\s")


class Vocabulary(NamedTuple):
    """Files of one byte-level BPE vocabulary, and the pattern of its pre-tokens."""

    tokenizer: str
    ranks: str
    pattern: str
    special: tuple[str, ...] = ("<|endoftext|>",)


def default_vocabulary() -> Vocabulary:
    import public_tokenizers as files

    return Vocabulary(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        import tiktoken

        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        plain = vocabulary.pattern.replace(r"\s+(?!\S)|\s+", r"\s")
        self.vocabulary = vocabulary
        self.plain = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def exact(self):
        import tiktoken

        return tiktoken.Encoding("exact", pat_str=self.vocabulary.pattern, mergeable_ranks=self.plain._mergeable_ranks, special_tokens={})

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary.tokenizer)

    def ids(self, text: str) -> list[int]:
        if any(x in text for x in self.vocabulary.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return (self.exact if _RUN.search(text) else self.plain).encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return np.array(self.ids(text), "<u4").tobytes()
