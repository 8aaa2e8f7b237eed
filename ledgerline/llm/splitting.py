"""Problem 4: cutting oversized texts at natural boundaries, with overlap.

Boundaries are found once per text and kept in sorted arrays of offsets, one per strength
(section break, paragraph, line, sentence, word). For every piece the last boundary under the
limit is found by binary search, strongest kind first; where a kind has none in the admissible
range the next is asked. Where none has, all kinds are asked again down to the overlap, and where
the window holds no boundary at all the cut is hard. The next piece starts exactly `overlap` units
before the cut. Sizes are prefix sums over units: the ends of a public tokenizer's tokens, or of the
characters (code points) themselves, whose prefix sums are their offsets.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ledgerline.llm import tokens

#: Kinds of boundary, strongest first; a match's end is where a piece may end.
BOUNDARIES = (
    ("paragraph", re.compile(r"\n[ \t]*\n\s*")),
    ("line", re.compile(r"\n\s*")),
    ("sentence", re.compile(r"[.!?;:][\"')\]]*\s+")),
    ("word", re.compile(r"\s+")),
)
#: A stronger kind of boundary is taken only if the piece stays this full; else a weaker, later one.
#: Where no kind has one so late, a piece may be less full: any boundary goes before a hard cut.
LEAST_FILL = 0.5

PIECE = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("boundary", StringType())])


def boundary_arrays(text: str) -> list[tuple[str, list[int]]]:
    return [(name, [m.end() for m in pattern.finditer(text)]) for name, pattern in BOUNDARIES]


def cut_points(
    text: str, limit: int, overlap: int, token_ends: Sequence[int] | None = None, least_fill: float = LEAST_FILL
) -> list[tuple[int, int, str]]:
    """(start, end, kind of boundary at end) of each piece, offsets in code points.

    Each piece has at most `limit` units; consecutive pieces share exactly `overlap` units, and
    the pieces cover the text without a gap. token_ends, where given, are the offsets at which
    the tokens of the text end, and units are tokens: cuts then fall on token ends only.
    """
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("needs limit >= 1 and 0 <= overlap < limit")
    units = len(text) if token_ends is None else len(token_ends)
    if units <= limit:
        return [(0, len(text), "end")]
    if token_ends is None:
        offset: Callable[[int], int] = lambda unit: unit
        arrays = boundary_arrays(text)
    else:
        ends = [0, *map(int, token_ends)]
        offset = ends.__getitem__
        # a boundary counts as the last token end at or before it
        arrays = [(name, sorted({bisect_right(ends, at) - 1 for at in array})) for name, array in boundary_arrays(text)]
    pieces, start = [], 0
    while units - start > limit:
        last = start + limit
        end, kind = last, "hard"
        # a piece must end beyond the overlap, or the next would not advance
        advance = start + overlap + 1
        found = [(array[at], name) for name, array in arrays if (at := bisect_right(array, last) - 1) >= 0 and array[at] >= advance]
        full = [f for f in found if f[0] >= start + int(limit * least_fill)]
        if found:
            end, kind = (full or found)[0]
        pieces.append((offset(start), offset(end), kind))
        start = end - overlap
    pieces.append((offset(start), len(text), "end"))
    return pieces


def _pieces_of(texts: Column | str, limits: Column | str, overlaps: Column | str, unit: str, vocabulary: str | None) -> Column:
    @pandas_udf(ArrayType(PIECE))
    def pieces(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for text, limit, overlap in zip(*batch, strict=True):
                ends = tokens.token_ends(text, vocabulary) if unit == "tokens" else None
                found.append([{"start": a, "end": b, "boundary": k} for a, b, k in cut_points(text, int(limit), int(overlap), ends)])
            yield pd.Series(found, dtype=object)

    return pieces(texts, limits, overlaps)


def split_pieces(df: DataFrame, text: str, limit: Column | int, overlap: Column | int, unit: str = "chars", vocabulary: str | None = None) -> DataFrame:
    """df with column `pieces`: array of (start, end, boundary) in code points.

    Limit and overlap count code points (unit "chars") or tokens of a public tokenizer (unit
    "tokens", vocabulary names its file), by prefix sums of the tokens' lengths. Texts that can't
    exceed the limit (as many code points in chars, as many bytes in tokens, which have one byte at
    least) are one piece from 0 to their end and don't leave the JVM. A null text has null pieces;
    an empty text has one empty piece; a null limit is none. Limit and overlap may be columns.
    """
    if unit not in ("chars", "tokens"):
        raise ValueError("unit is chars or tokens")
    limit = F.lit(limit) if isinstance(limit, int) else limit
    overlap = F.lit(overlap) if isinstance(overlap, int) else overlap
    most = F.octet_length(F.col(text).cast("binary")) if unit == "tokens" else F.char_length(text)
    sized = df.withColumn("_most", most).withColumn("_length", F.char_length(text)).withColumn("_limit", limit.cast("long")).withColumn("_overlap", F.coalesce(overlap, F.lit(0)).cast("long"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("_length").alias("end"), F.lit("end").alias("boundary")))
    fits = sized.where("_most is null or _limit is null or _most <= _limit").withColumn("pieces", F.when(F.col(text).isNotNull(), whole).cast(ArrayType(PIECE)))
    over = sized.where("_most > _limit").withColumn("pieces", _pieces_of(text, "_limit", "_overlap", unit, vocabulary))
    return fits.unionByName(over).drop("_most", "_length", "_limit", "_overlap")


def explode_pieces(df: DataFrame, text: str) -> DataFrame:
    """One row per piece: df's columns without text and pieces, then piece_no from 0, start, end, boundary, piece."""
    kept = [c for c in df.columns if c not in (text, "pieces")]
    rows = df.select(*kept, text, F.posexplode("pieces").alias("piece_no", "_piece"))
    return rows.select(
        *kept, "piece_no", "_piece.start", "_piece.end", "_piece.boundary", F.substring(F.col(text), F.col("_piece.start") + 1, F.col("_piece.end") - F.col("_piece.start")).alias("piece")
    )
