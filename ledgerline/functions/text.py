"""Column functions on text: coercion, identifiers, names, evidence and markup lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value, compared without case.
PLACEHOLDERS = ("nan", "none", "null", "<na>", "n/a")
# Instrument nouns folded to the singular in name fingerprints.
SINGULAR = {"notes": "note", "bonds": "bond", "debentures": "debenture", "loans": "loan", "facilities": "facility"}
# Words without weight in a name.
STOPWORDS = ("the", "of", "and", "its", "new", "existing", "certain")
# Lemmas of which a document must hold one to be looked at further.
GATE_LEMMAS = ("credit agreement", "indenture", "notes due", "term loan", "revolving credit", "notes offering", "debenture", "syndicated loan", "bond issuance")


def strip(text: Column) -> Column:
    """Trim white space of any script, not only the ASCII blank."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def coerce_text(text: Column) -> Column:
    """Trimmed text; blank and placeholder texts become null."""
    trimmed = strip(text.cast("string"))
    return F.when((trimmed != "") & ~F.lower(trimmed).isin(*PLACEHOLDERS), trimmed)


def collapse(text: Column) -> Column:
    """One blank for every stretch of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_cik(cik: Column) -> Column:
    """Digits padded to ten places (longer ones stay as they are); anything else trimmed; blank is null."""
    trimmed = strip(cik.cast("string"))
    padded = F.when(F.length(trimmed) < 10, F.lpad(trimmed, 10, "0")).otherwise(trimmed)
    return F.when(trimmed == "", None).when(trimmed.rlike(r"^\d+$"), padded).otherwise(trimmed)


def normalize_accession(accession: Column) -> Column:
    return F.replace(accession, F.lit("-"), F.lit(""))


def shard(value: Column, shards: int = 64) -> Column:
    """Four-digit label of crc32 modulo shards: the same file layout from any engine."""
    return F.lpad((F.crc32(value.cast("binary")) % shards).cast("string"), 4, "0")


def canonical_number(value: Column) -> Column:
    """Decimal text without trailing zeros: 5.0000 -> 5."""
    text = value.cast("string")
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)


# A name is read as tokens: rates, currency marks, words, and numbers with what is written onto them.
_RATE_TOKEN = r"\d+(?:[.,]\d+)*\s*(?:%|(?:per\s*cent|percent|pct)\b)"
_NAME_TOKEN = _RATE_TOKEN + r"|[$€£¥]|(?:usd|eur|gbp|cad|aud|chf|jpy|r)(?=\d{1,3}[,\s]\d|\d[\d.]*\s?(?:million|billion|thousand|bn|mm|m)\b)|(?:usd|eur|gbp|cad|aud|chf|jpy)(?=\d)|\d+(?:[.,]\d+)*[a-z0-9]*|[a-z][a-z0-9]*|%"
# Classes of tokens, as letters, and the words or patterns of each; the first that fits counts.
_CLASSES = (
    ("r", _RATE_TOKEN), ("k", "[$€£¥]"), ("c", "usd|eur|gbp|cad|aud|chf|jpy"), ("m", "million|billion|thousand|bn|mm|m"), ("x", "us|a|c"), ("z", "r"), ("u", "u"), ("s", "s"),
    ("i", "in"), ("g", "aggregate"), ("p", "principal"), ("t", "amount"), ("f", "of"), ("b", r"\d{1,3}(?:,\d{3})+(?:\.\d+)?"), ("n", r"\d[\d.,]*(?:million|billion|thousand|bn|mm|m)?"),
)
# An amount at the head of a name, in classes: a mark with or without a country before it, a currency's code, or a rand.
_HEAD = r"^(?:(?:c|x|z|us)?k[nb]m?|c[nb]m?|zbm?|zn+m|zn(?:n|b)+m?)(?:i?gpt)?f?(?=.)"


def name_tokens(name: Column) -> Column:
    """The tokens of a name in lower case: rates, currency marks, words and numbers."""
    return F.regexp_extract_all(F.lower(name), F.lit(_NAME_TOKEN), 0)


def _token_class(token: Column) -> Column:
    found = F.when(F.lit(False), "")
    for letter, pattern in _CLASSES:
        found = found.when(token.rlike(f"^(?:{pattern})$"), letter)
    return found.otherwise("o")


def _plain_token(token: Column) -> Column:
    """A token as a fingerprint has it: a rate without trailing zeros, a noun in the singular, anything else as its letters and digits."""
    folds = F.create_map(*(F.lit(x) for pair in SINGULAR.items() for x in pair))
    digits = F.regexp_extract(token, r"^[\d.,]+", 0)
    rate = F.concat(F.when(digits.rlike(r"^\d+\.\d+$"), F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")).otherwise(digits), F.lit("%"))
    bare = F.when(token.rlike(f"^(?:{_RATE_TOKEN})$"), rate).otherwise(F.coalesce(folds[token], token))
    return F.trim(F.regexp_replace(bare, "[^a-z0-9%]+", " "))


#: Tokens at the head of a name among which an amount ends.
HEAD_TOKENS = 16


def fingerprint_of(tokens: Column) -> Column:
    """name_fingerprint() of a column that holds name_tokens(): for plans in which those are found once."""
    classes = F.array_join(F.transform(F.slice(tokens, 1, HEAD_TOKENS), _token_class), "")
    head = F.length(F.regexp_extract(classes, _HEAD, 0))
    rest = F.slice(tokens, F.when(head < F.size(tokens), head + 1).otherwise(1), F.greatest(F.size(tokens), F.lit(0)))
    joined = F.array_join(F.filter(F.transform(rest, _plain_token), lambda t: t != ""), " ")
    return F.when(joined != "", joined)


def name_fingerprint(name: Column) -> Column:
    """A name for comparison: worded rates as %, no leading amount, no trailing zeros of rates, singular nouns.

    The classes of the first tokens, written as one word, say where an amount at the head ends; a
    name that is nothing but an amount keeps its last word or else all of it. Null where no token
    is left.
    """
    return fingerprint_of(name_tokens(name))


def fingerprint_tokens(fingerprint: Column) -> Column:
    """The distinct words of a fingerprint that carry weight."""
    return F.array_distinct(F.filter(F.split(fingerprint, " "), lambda w: ~w.isin(*STOPWORDS)))


# A rate in a fingerprint, whose decimal point has become a blank; years before it aren't part of it.
_RATE_WORDS = r"(?<!\d)(\d{1,3}(?:[ .]\d{1,4})?)%"
# A word that only says which class or tranche is meant.
_DESIGNATOR = r"^(?:[a-z]?-?\d+[a-z]?|[a-z])$"


def fingerprint_rates(fingerprint: Column) -> Column:
    """Distinct coupons of a fingerprint as canonical numbers ("4 375%" -> 4.375)."""
    found = F.regexp_extract_all(fingerprint, F.lit(_RATE_WORDS), 1)
    return F.array_distinct(F.transform(found, lambda r: canonical_number(F.translate(r, " ", ".").cast("decimal(9,4)"))))


def fingerprint_identifies(fingerprint: Column) -> Column:
    """Whether a fingerprint holds a coupon or a year of the 20th or 21st century."""
    return (F.size(fingerprint_rates(fingerprint)) > 0) | F.exists(F.split(fingerprint, " "), lambda w: w.rlike(r"^(?:19|20)\d{2}$"))


def names_compatible(left: Column, right: Column) -> Column:
    """Whether two fingerprints can name one instrument; false where one is missing.

    The words both have are compared with each side's: if one side has no others, the names agree
    so far, and if neither has, they are one. Else at least two words must be common, the coupons
    must not contradict each other, and what the longer name adds must be more than designators.
    """
    a, b = fingerprint_tokens(left), fingerprint_tokens(right)
    common = F.size(F.array_intersect(a, b))
    fewer, more = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    added = F.when(F.size(a) > F.size(b), F.array_except(a, b)).otherwise(F.array_except(b, a))
    of_a, of_b = fingerprint_rates(left), fingerprint_rates(right)
    contradict = (F.size(of_a) > 0) & (F.size(of_b) > 0) & ~F.arrays_overlap(of_a, of_b)
    tells = F.exists(added, lambda w: ~w.rlike(_DESIGNATOR))
    shortened = (common == fewer) & (common >= 2) & ~contradict & tells
    return F.coalesce((left == right) | ((fewer > 0) & ((common == more) | shortened)), F.lit(False))


def passes_gate(text: Column) -> Column:
    """Whether a document holds one of the gate's lemmas as a word, singular or plural, in any case."""
    return F.coalesce(text.rlike(r"(?i)\b(?:" + "|".join(GATE_LEMMAS) + r")(?:s|es)?\b"), F.lit(False))


#: Where lines end, in any script.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def unescape(text: Column) -> Column:
    """Character references decoded (by the JVM's text library); null stays null."""
    decoded = F.call_function("java_method", F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4"), F.coalesce(text, F.lit("")))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def body_lines(body: Column) -> Column:
    """array of (number, text): the non-blank lines of a marked-up body with their numbers from 1.

    Lines end at breaks and at the ends of blocks and cells; tags go, and only then references are
    decoded, so that an escaped sign isn't read as a tag; white space is collapsed.
    """
    broken = F.regexp_replace(body, r"(?i)<\s*br\s*/?\s*>|</\s*(?:p|div|tr|td|th|li|h[1-6])\s*>", "\n")
    plain = unescape(F.regexp_replace(broken, r"<[^>]+>", " "))
    numbered = F.transform(F.split(plain, LINE_END), lambda line, i: F.struct((i + 1).alias("number"), collapse(line).alias("text")))
    return F.filter(numbered, lambda line: line["text"] != "")
