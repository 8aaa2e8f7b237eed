"""Cutting documents into windows, and rebuilding windows from their spans."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def word_tokens(text: str) -> int:
    """A tokenizer for where none is given: words and signs."""
    return len(re.findall(r"\w+|[^\w\s]", text))


_BOUNDARIES = (re.compile(r"\n\s*\n"), re.compile(r"\n"), re.compile(r"(?<=[.!?])\s+"))


def windows(text: str | None, most: int = 400, tokens: Callable[[str], int] = word_tokens) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of contiguous windows of at most `most` tokens.

    Cut between paragraphs, then lines, then sentences, then in halves; neighbours are joined
    while they fit, and windows lose white space at their ends. Every other character is in one.
    """
    if most < 1:
        raise ValueError("needs at least one token")
    if not text or not text.strip():
        return []

    def halves(a: int, b: int) -> Iterator[tuple[int, int]]:
        if b - a <= 1 or tokens(text[a:b]) <= most:
            yield a, b
        else:
            yield from halves(a, (a + b) // 2)
            yield from halves((a + b) // 2, b)

    def leaves(a: int, b: int, depth: int) -> Iterator[tuple[int, int]]:
        if tokens(text[a:b]) <= most:
            yield a, b
        elif depth == len(_BOUNDARIES):
            yield from halves(a, b)
        else:
            cuts = [a, *(m.end() for m in _BOUNDARIES[depth].finditer(text, a, b) if a < m.end() < b), b]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                yield from leaves(x, y, depth + 1)

    groups: list[list[int]] = []
    held = 0
    for a, b in leaves(0, len(text), 0):
        n = tokens(text[a:b])
        if groups and held + n <= most:
            groups[-1][1] = b
            held += n
        else:
            groups.append([a, b])
            held = n
    out = []
    for a, b in groups:
        piece = text[a:b]
        a, b = a + len(piece) - len(piece.lstrip()), b - len(piece) + len(piece.rstrip())
        if a < b:
            out += [(x, y, tokens(text[x:y])) for x, y in halves(a, b)]
    return out


def split_windows(documents: DataFrame, key: str, text: str, most: int = 400, tokens: Callable[[str], int] = word_tokens) -> DataFrame:
    """(key, window, start, end, token_count, source_sha256): windows as spans, without their text."""
    kept = documents.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(i, n, *w) for i, t in enumerate(batch[text].to_pylist()) for n, w in enumerate(windows(t, most, tokens))]
            at = pa.array([o[0] for o in own], pa.int64())
            yield pa.RecordBatch.from_arrays([batch[key].take(at), batch["_sha"].take(at), *(pa.array([o[i] for o in own], pa.int64()) for i in range(1, 5))], [key, "source_sha256", "window", "start", "end", "token_count"])

    rows = documents.select(key, text, F.sha2(text, 256).alias("_sha"))
    return rows.mapInArrow(work, f"`{key}` {kept}, source_sha256 string, window long, start long, end long, token_count long")


def rebuild_windows(spans: DataFrame, documents: DataFrame, key: str, text: str) -> DataFrame:
    """spans with their text, and whether the document is still the one they were cut from; a key with any mismatch is stale as a whole."""
    joined = spans.join(documents.select(key, text), key, "left").withColumn("_same", F.coalesce(F.sha2(text, 256) == F.col("source_sha256"), F.lit(False)))
    stale = joined.groupBy(key).agg(F.min("_same").alias("fresh"))
    return joined.join(stale, key).withColumn("window_text", F.when(F.col("fresh"), F.substring(F.col(text), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")))).drop("_same", text)
