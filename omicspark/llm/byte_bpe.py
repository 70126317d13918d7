"""Byte-level BPE by the tiktoken library."""

from __future__ import annotations

import base64

import numpy as np


class ByteCodec:
    """Token ids of texts, without special tokens."""

    def __init__(self, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encode = self.library.encode_ordinary

    def array(self, text: str) -> np.ndarray:
        return np.array(self.encode(text), np.uint16)

    def count(self, text: str) -> int:
        return len(self.encode(text))


_codecs: dict[tuple[str, str], ByteCodec] = {}


def codec(ranks_file: str, pattern: str) -> ByteCodec:
    """One codec per Python worker and file."""
    if (ranks_file, pattern) not in _codecs:
        _codecs[ranks_file, pattern] = ByteCodec(ranks_file, pattern)
    return _codecs[ranks_file, pattern]


def default_ranks() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
