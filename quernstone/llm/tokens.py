"""Sizes of texts in tokens of a public tokenizer.

The vocabulary file (byte-level BPE ranks) stays where it is; its path is a
parameter and must be readable on every executor.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = os.environ.get("QUERNSTONE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")

# Fixed value: the split pattern that belongs to byte-level BPE vocabularies of this kind.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# No match of the pattern crosses from a run of other characters into white
# space, so a text's tokens are those of these pieces, one after the other.
_PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Counts(dict):
    """Piece → tokens; texts repeat their pieces, so each is encoded once."""

    def __init__(self, path: str):
        self.encode = encoding(path).encode_ordinary

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) < 64:
            if len(self) > 1_000_000:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=2)
def _counts(path: str) -> _Counts:
    return _Counts(path)


def count_tokens(text: str | None, path: str = DEFAULT_VOCABULARY) -> int:
    return sum(map(_counts(path).__getitem__, _PIECES.findall(text))) if text else 0


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), path: str = DEFAULT_VOCABULARY, digest: bool = False) -> DataFrame:
    """``key, *keep, n_tokens[, digest]``; null and empty texts have no tokens."""
    kinds = dict(docs.dtypes)
    cols = [key, *keep]
    src = docs.select(*cols, F.col(text).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = _counts(path).__getitem__
        for pdf in batches:
            out = pdf[cols].copy()
            texts = pdf["__text"].tolist()
            out["n_tokens"] = [sum(map(size, _PIECES.findall(t))) if t else 0 for t in texts]
            if digest:
                out["digest"] = [hashlib.blake2b(t.encode(), digest_size=16).digest() if t else b"" for t in texts]
            yield out

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols) + ", n_tokens int" + (", digest binary" if digest else "")
    return src.mapInPandas(run, schema)
