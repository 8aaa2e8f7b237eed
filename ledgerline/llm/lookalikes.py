"""Problem 9: one consistent form for text that looks the same.

Three layers, all in Catalyst except where a Python function is asked for:

* ``mapped``: look-alike letters, full-width forms, ligatures, odd spaces and hyphens become
  their plain counterparts, invisible characters vanish and accents are composed (NFC, in the JVM),
  so that a text's form depends on the text alone, not on which others are there;
* ``skeleton_key``: a 64-bit hash of the mapped text without accents, used only to find which
  texts can be equal at all, so that whole texts are shuffled for those alone;
* ``canonical_members``: values are grouped by their mapped form under the accent-sensitive
  collation UNICODE, which makes composed and decomposed accents equal, and each class gets its
  smallest mapped member (by code point) as the canonical one.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.pairing import pairs_within
from ledgerline.plans.lineage import cut

# Letters of other scripts whose shape is that of a Latin letter.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝӀӏԌѴѵҮ", "ABESIJKMHOPCTYXaesijopcyxdhqwIlGVvY", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϹϳͿ", "ABEZHIKMNOPTYXovcCjJ", strict=True))
ARMENIAN = dict(zip("օսհոցՍՏՕ", "ouhngUSO", strict=True))
# Presentation ligatures.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
# Characters without width, and spaces and hyphens drawn like the plain ones.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63"

# Letters and digits of the mathematical alphabets and of the letterlike block: one plain character under compatibility.
STYLED = {
    chr(c): plain
    for c in (*range(0x1D400, 0x1D6A4), *range(0x1D7CE, 0x1D800), *range(0x2100, 0x2140))
    if len(plain := unicodedata.normalize("NFKC", chr(c))) == 1 and plain.isascii() and plain.isalnum()
}
# Roman numerals drawn as letters: some become several.
ROMAN = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2160, 0x2180)}
FULL_WIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
SINGLE = {**CYRILLIC, **GREEK, **ARMENIAN, **STYLED, **{c: p for c, p in ROMAN.items() if len(p) == 1}, **FULL_WIDTH, **dict.fromkeys(SPACES, " "), **dict.fromkeys(HYPHENS, "-")}
_BASE = str.maketrans(SINGLE)
# The same letters with accents: a Cyrillic letter with diaeresis looks like the Latin one with it.
SINGLE.update(
    (chr(c), alike)
    for c in (*range(0x370, 0x530), *range(0x1F00, 0x2000))
    if len(alike := unicodedata.normalize("NFC", (parts := unicodedata.normalize("NFD", chr(c))).translate(_BASE))) == 1 and len(parts) > 1 and alike not in (chr(c), unicodedata.normalize("NFC", chr(c)))
)
ACCENTED = {
    chr(c): base[0]
    for c in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000))
    if len(base := unicodedata.normalize("NFD", chr(c))) > 1 and unicodedata.combining(base[1])
}
# A base letter of another script may itself be a look-alike: both spellings must share a skeleton.
SKELETON = {c: SINGLE.get(b, b) for c, b in ACCENTED.items()}
SKELETON.update({c: ACCENTED.get(b, b) for c, b in SINGLE.items()})

#: Characters that stand for several.
SEVERAL = {**LIGATURES, **{c: p for c, p in ROMAN.items() if len(p) > 1 and p.isascii()}}
_SEVERAL = "[" + "".join(SEVERAL) + "]"

_TABLE = str.maketrans({**SINGLE, **SEVERAL, **dict.fromkeys(INVISIBLE, "")})


def mapped_text(text: str | None) -> str | None:
    """The mapped form in Python: what ``mapped`` gives, for use inside other Python stages."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFC", text.translate(_TABLE))


def _translate(column: Column, table: dict[str, str], dropped: str = "") -> Column:
    return F.translate(column, "".join(table) + dropped, "".join(table.values()))


def _is_plain(column: Column) -> Column:
    """True where every character is ASCII (a byte each), where no mapping can apply."""
    return F.octet_length(column) == F.char_length(column)


def _replaced(column: Column, table: dict[str, str]) -> Column:
    done = _translate(column, table, INVISIBLE)
    several = done
    for one, letters in SEVERAL.items():
        several = F.replace(several, F.lit(one), F.lit(letters))
    return F.when(done.rlike(_SEVERAL), several).otherwise(done)


def _composed(column: Column) -> Column:
    """Unicode's composed form (NFC) by the ICU library that Spark's collations stand on; column mustn't be null."""
    return F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), column, F.lit(False))


def mapped(column: Column) -> Column:
    """Look-alikes, widths, ligatures, spaces and hyphens mapped; invisible characters dropped; accents composed. Null stays null."""
    return F.when(_is_plain(column), column).when(column.isNotNull(), _composed(F.coalesce(_replaced(column, SINGLE), F.lit(""))))


def skeleton_key(column: Column) -> Column:
    """A hash on which all texts that look the same agree: mapped, and without combining marks."""
    return F.xxhash64(F.when(_is_plain(column), column).otherwise(F.regexp_replace(_replaced(column, SKELETON), r"\p{Mn}+", "")))


def looks_alike_candidates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of df (key, text) whose skeleton is shared by a different text.

    Only hashes are shuffled to find them; per skeleton just the smallest and largest text hash
    are kept, so that a skeleton shared by a third of all rows costs one partial row per task.
    """
    hashed = df.where(F.col(text).isNotNull()).select(key, text, skeleton_key(F.col(text)).alias("_skeleton"), F.xxhash64(text).alias("_content"))
    shared = (
        hashed.groupBy("_skeleton")
        .agg(F.min("_content").alias("_low"), F.max("_content").alias("_high"))
        .where("_low <> _high")
        .select("_skeleton")
    )
    return hashed.join(shared, "_skeleton", "left_semi")


def canonical_members(candidates: DataFrame, text: str) -> DataFrame:
    """(_skeleton, _content, text, canonical): every distinct text with its class's canonical member.

    Classes are those of the mapped text under the accent-sensitive, case-sensitive collation
    UNICODE; the canonical member is the smallest mapped text by code point. Distinct texts only,
    so copies of one text cost one row.
    """
    values = candidates.groupBy("_skeleton", "_content").agg(F.first(text).alias(text))
    values = values.withColumn("_mapped", mapped(F.col(text)))
    classes = values.groupBy("_skeleton", F.collate("_mapped", "UNICODE").alias("_class")).agg(F.min("_mapped").alias("canonical"))
    return values.alias("v").join(
        classes.alias("c"), (F.col("v._skeleton") == F.col("c._skeleton")) & (F.collate("v._mapped", "UNICODE") == F.col("c._class"))
    ).select("v._skeleton", "v._content", f"v.{text}", "c.canonical")


def canonical_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, canonical): every row's text in its consistent form.

    A text that shares its looks with no other is its own class, and its mapped form is the
    canonical one. Null text gives a null form; an empty text stays empty. Repeated rows keep
    one row each. Columns of df other than key and text are ignored.
    """
    df = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    members = canonical_members(looks_alike_candidates(df, key, "_text"), "_text").select("_skeleton", "_content", "canonical")
    hashed = df.withColumn("_skeleton", skeleton_key(F.col("_text"))).withColumn("_content", F.xxhash64("_text"))
    joined = hashed.join(members, ["_skeleton", "_content"], "left")
    return joined.select(key, F.coalesce("canonical", mapped(F.col("_text"))).alias("canonical"))


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key_a, key_b): rows whose texts look the same but differ in characters, smaller key first.

    Null texts take part in no pair. A row repeated with the same key counts once.
    """
    candidates = looks_alike_candidates(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_key", "_text")
    members = canonical_members(candidates, "_text").select("_skeleton", "_content", F.xxhash64("canonical").alias("_form"), F.xxhash64(F.reverse("canonical")).alias("_form2"))
    keyed = candidates.select("_skeleton", "_content", "_key").distinct().join(members, ["_skeleton", "_content"]).select("_form", "_form2", "_content", "_key")
    # a class of any size is paired block by block
    pairs = pairs_within(cut(keyed), ["_form", "_form2"], "_key", ["_content"])
    return pairs.where("a__content <> b__content").select(F.col("a__key").alias("key_a"), F.col("b__key").alias("key_b")).distinct()
