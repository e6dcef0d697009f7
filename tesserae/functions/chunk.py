"""Chunkers with sequential state, as Arrow-batched functions that return arrays."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK_CHARS = 1024
SEPARATORS = ("\n\n", "\n", ". ")
SENTENCE_WORDS = 1024  # words that running text may have before it is cut by sentences
SENTENCE_END = re.compile(r"(?<=[.?!])\s+")


def recursive_chunks(text: str, limit: int = CHUNK_CHARS, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most limit characters, cut at the first separator that helps, neighbours joined while they fit.

    A piece that no separator can cut comes out whole. Pieces put together give the text back.
    """
    if len(text) <= limit or not separators:
        return [text]
    head, rest = separators[0], separators[1:]
    parts = text.split(head)
    parts = [p + head for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    out: list[str] = []
    for part in parts:
        if out and len(out[-1]) + len(part) <= limit:
            out[-1] += part
        elif len(part) > limit:
            out.extend(recursive_chunks(part, limit, rest))
        else:
            out.append(part)
    return out


def sentence_chunks(text: str, max_words: int = SENTENCE_WORDS) -> list[str]:
    """Sentences packed by their number of words; one that is too long stands alone."""
    out: list[str] = []
    held: list[str] = []
    n = 0
    for s in filter(None, SENTENCE_END.split(text.strip())):
        k = max(1, len(s.split()))
        if k > max_words:
            out.append(" ".join(held))
            out.append(s)
            held, n = [], 0
        elif n + k > max_words:
            out.append(" ".join(held))
            held, n = [s], k
        else:
            held.append(s)
            n += k
    out.append(" ".join(held))
    return [x for x in out if x]


def markdown_chunks(markdown: str, max_words: int) -> list[str]:
    """A piece of at most max_words stays whole, trimmed, a blank one as ''. A longer one is read line by line as text, code or table: code
    and tables stay together, blank lines go, and running text is closed before the line that takes it over max_words;
    what is closed as text, and what is left at the end, is then cut by sentences at SENTENCE_WORDS. A table or fence on
    the first line of a run counts as text, so the row that opens a table stands apart, and an opening fence there turns
    code and text around until the next."""
    if len(markdown.split()) <= max_words:
        return [markdown.strip()]
    out: list[str] = []
    held: list[str] = []
    state, words = "text", 0

    def flush(as_block: bool) -> None:
        nonlocal words
        if held:
            block = "\n".join(held)
            out.extend([block] if as_block else sentence_chunks(block))
            held.clear()
        words = 0

    for line in filter(None, map(str.strip, markdown.split("\n"))):
        n = len(line.split())
        now = "code" if line.startswith("```") else "table" if line.startswith("|") else "text"
        if held and state == "text" and (now != "text" or words + n > max_words):
            flush(False)
            state = now
        elif held and state == "table" and now != "table":
            flush(True)
            state = "text"
        held.append(line)
        words += n
        if state == "code" and now == "code" and len(held) > 1:
            flush(True)
            state = "text"
    flush(False)
    return out


def chunks(text: str | Column, how: Callable[..., list[str]], *args: object) -> Column:
    """The column of a text's chunks; null for null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else how(x, *args))

    return F.pandas_udf(run, "array<string>")(text)
