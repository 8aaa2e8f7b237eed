"""Amounts of money as written in text: figure, scale and currency."""

from __future__ import annotations

import re
from decimal import Decimal, InvalidOperation
from functools import lru_cache

# How currencies are marked beside a figure, longest marks first where one holds another.
MARKS = {
    "US$": "USD", "U.S. $": "USD", "U.S.$": "USD", "USD": "USD", "A$": "AUD", "AU$": "AUD", "AUD": "AUD", "C$": "CAD", "CA$": "CAD", "Cdn$": "CAD", "CAD": "CAD",
    "HK$": "HKD", "HKD": "HKD", "R$": "BRL", "BRL": "BRL", "Mex$": "MXN", "MX$": "MXN", "MXN": "MXN", "S$": "SGD", "SGD": "SGD", "NZ$": "NZD", "NZD": "NZD", "€": "EUR", "EUR": "EUR",
    "£": "GBP", "GBP": "GBP", "¥": "JPY", "JPY": "JPY", "RMB": "CNY", "CNY": "CNY", "CN¥": "CNY", "₹": "INR", "Rs.": "INR", "Rs": "INR", "INR": "INR",
    "CHF": "CHF", "SFr.": "CHF", "SFr": "CHF", "Fr.": "CHF", "SEK": "SEK", "$": "USD",
}
# Currencies in words; of dollars, the word before tells which.
NOUNS = {
    "euro": "EUR", "sterling": "GBP", "pound": "GBP", "yen": "JPY", "yuan": "CNY", "renminbi": "CNY", "rupee": "INR", "reai": "BRL", "real": "BRL",
    "peso": "MXN", "kronor": "SEK", "krona": "SEK", "franc": "CHF",
}
DOLLARS = {"australian": "AUD", "canadian": "CAD", "hong kong": "HKD", "singapore": "SGD", "new zealand": "NZD"}
# Scales in words and letters.
SCALES = {
    "thousand": 3, "thousands": 3, "000s": 3, "k": 3, "million": 6, "millions": 6, "mm": 6, "mn": 6, "mil": 6, "mio": 6, "m": 6, "billion": 9, "billions": 9, "bn": 9, "bln": 9, "b": 9,
    "trillion": 12, "trillions": 12, "tn": 12, "lakh": 5, "lakhs": 5, "lac": 5, "lacs": 5, "crore": 7, "crores": 7, "cr": 7,
}
UNITS = dict(
    zip(
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(),
        range(20),
        strict=True,
    )
) | dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10), strict=True))

_MARK = "|".join(re.escape(m) for m in sorted(MARKS, key=len, reverse=True))
_FIGURE = re.compile(r"\d(?:[\d.,'’   ]*\d)?")
_BEFORE = re.compile(rf"({_MARK})\s*$")
_AFTER = re.compile(rf"^\s*({_MARK})(?![A-Za-z])")
_SCALE = re.compile(r"^\s*\(?\s*(?:in\s+)?(thousands?|millions?|billions?|trillions?|crores?|lakhs?|lacs?|000s|mm|mn|mio|mil|bln|bn|tn|cr|k|m|b)\b\.?", re.I)
_NUMBER_WORD = re.compile(r"[a-z]+(?:-[a-z]+)?")


def figure(text: str) -> Decimal | None:
    """The number written in text: the last separator counts as decimal where it stands alone or differs from the others."""
    digits = re.sub(r"['’\s]", "", text)
    dots, commas = digits.count("."), digits.count(",")
    if dots and commas:
        decimal = "." if digits.rindex(".") > digits.rindex(",") else ","
    elif commas:
        decimal = "," if commas == 1 and not re.search(r",\d{3}$", digits) else ""
    elif dots:
        decimal = "" if dots > 1 else "."
    else:
        decimal = ""
    for separator in ".,":
        digits = digits.replace(separator, "." if separator == decimal else "")
    try:
        return Decimal(digits)
    except InvalidOperation:
        return None


def figure_in_words(text: str) -> tuple[Decimal | None, int]:
    """(number, where it ends) of the number words text begins with, up to a scale word."""
    total = part = 0
    seen, end = False, 0
    for m in _NUMBER_WORD.finditer(text.lower()):
        if text[end : m.start()].strip(" ,"):
            break
        pieces = m[0].split("-")
        if all(p in UNITS for p in pieces):
            part += sum(UNITS[p] for p in pieces)
        elif m[0] == "hundred" and seen:
            part = (part or 1) * 100
        elif m[0] == "and" and seen:
            pass
        else:
            break
        seen, end = True, m.end()
    return (Decimal(total + part), end) if seen else (None, 0)


def currency_in_words(text: str) -> str | None:
    """The currency named by the first currency noun of text."""
    lowered = text.lower()
    if m := re.search(r"\bdollars?\b", lowered):
        before = lowered[max(0, m.start() - 20) : m.start()]
        return next((code for word, code in DOLLARS.items() if word in before), "USD")
    return next((code for noun, code in NOUNS.items() if re.search(rf"\b{noun}s?\b", lowered)), None)


@lru_cache(maxsize=100_000)
def written(text: str) -> tuple[str | None, str | None, str | None]:
    """(figure, scale as written in lower case or None, ISO currency or None) of an amount as written.

    ("45", None, None) for a bare "45"; (None, None, None) where no number is written. Figures are
    decimal text without exponent.
    """
    if m := _FIGURE.search(text):
        number, before, after = figure(m[0]), text[: m.start()], text[m.end() :]
        mark = _BEFORE.search(before)
        currency = MARKS[mark[1]] if mark else None
    else:
        number, end = figure_in_words(text.strip())
        before, after, currency = "", text.strip()[end:], None
    if number is None:
        return None, None, None
    scale = None
    if m := _SCALE.match(after):
        scale = m[1].lower()
        after = after[m.end() :]
    if currency is None and (m := _AFTER.match(after)):
        currency = MARKS[m[1]]
    if currency is None:
        currency = currency_in_words(after)
    return format(number.normalize(), "f"), scale, currency


def stated(text: str) -> tuple[str | None, int | None, str | None]:
    """(figure, power of ten of the scale or None, ISO currency or None): written() with the scale looked up."""
    figure_text, scale, currency = written(text)
    return figure_text, None if scale is None else SCALES[scale], currency


_HEADER = re.compile(r"\b(thousands|millions|billions|crores|lakhs|lacs)\b((?:\s+[^\s]+){1,5})", re.I)


def written_headers(text: str | None) -> list[tuple[int, str, str | None]]:
    """(offset, scale as written in lower case, currency) of every line that says in what an item's bare figures are stated."""
    found = []
    for m in _HEADER.finditer(text or ""):
        if (currency := currency_in_words(m[2])) is not None:
            found.append((m.start(), m[1].lower(), currency))
    return found


def headers(text: str | None) -> list[tuple[int, int, str | None]]:
    """written_headers() with the scales looked up: (offset, power of ten, currency)."""
    return [(at, SCALES[scale], currency) for at, scale, currency in written_headers(text)]
