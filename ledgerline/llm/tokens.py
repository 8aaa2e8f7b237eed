"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

#: Folder of the public vocabularies, and the one used by default.
FOLDER = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's authors part a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a .tiktoken file; read once per Python process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_path() -> str:
    return os.path.join(FOLDER, VOCABULARY)


def token_count(text: Column | str, path: str | None = None) -> Column:
    """The number of tokens of a whole text; null for null, 0 for an empty one. Special tokens' strings are ordinary text."""
    path = path or default_path()

    @pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(path)
        for texts in batches:
            yield pd.Series([None if t is None else len(own.encode_ordinary(t)) for t in texts], dtype="Int64")

    return count(text)


@lru_cache(maxsize=4)
def _byte_lengths(path: str) -> np.ndarray:
    """The number of bytes of every token of a vocabulary."""
    own = encoding(path)
    return np.array([len(own.decode_single_token_bytes(i)) for i in range(own.n_vocab)], dtype=np.int64)


def token_ends(text: str, path: str | None = None) -> np.ndarray:
    """Offsets in code points at which the tokens of text end, as prefix sums; a token inside a character ends with it."""
    path = path or default_path()
    tokens = np.array(encoding(path).encode_ordinary(text), dtype=np.int64)
    ends = np.cumsum(_byte_lengths(path)[tokens])
    if text.isascii():
        return ends
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    # the characters begun before a byte: of an end inside a character, that one is among them
    begun = np.cumsum((data & 0xC0) != 0x80)
    return begun[ends - 1]
