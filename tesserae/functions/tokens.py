"""Token counts: runs without white space, or the tokens of a public byte-level vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tesserae.functions.text import word_count

#: Fixed value: how such vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_pairs(path: str, pattern: str = PATTERN) -> Callable[[str | Column], Column]:
    """A counter of the tokens of a rank file (a base64 token and its rank a line), read once a task on the executors; of a
    list of texts the tokens of all put together without a separator."""
    encoders: dict[str, object] = {}

    def run(s: pd.Series) -> pd.Series:
        import tiktoken

        if path not in encoders:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            encoders[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return s.map(lambda t: len(encoders[path].encode_ordinary(t)) if t else 0).astype("int32")

    count = F.pandas_udf(run, "int")
    return lambda text: count(text)


def counter(path: str | None = None) -> Callable[[str | Column], Column]:
    """The default counter of words, or one of byte pairs where a vocabulary is named."""
    return byte_pairs(path) if path else word_count


def message_tokens(parts: list[str], path: str | None = None) -> Column:
    """Tokens of the fields put together without a separator; nulls count as empty."""
    return counter(path)(F.concat(*(F.coalesce(F.col(p), F.lit("")) for p in parts)))
