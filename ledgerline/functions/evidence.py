"""Column functions that read amounts, rates, dates and tenors out of evidence text, and hold recorded values against them.

A recorded value is kept only where the text it cites, or the instrument's name, says the same:
a reading never replaces a record, it confirms it or leaves it null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import iso_date, plus_tenor
from ledgerline.functions.text import canonical_number

# Magnitudes in words and as letters.
MAGNITUDES = {
    "thousand": 3, "thousands": 3, "million": 6, "millions": 6, "mil": 6, "mils": 6, "mm": 6, "mn": 6,
    "billion": 9, "billions": 9, "bil": 9, "bln": 9, "bn": 9, "trillion": 12, "trillions": 12,
}
LETTERS = {"k": 3, "m": 6, "b": 9}
# Dollars of other countries by the letters before the sign, and the currency codes that are known.
DOLLARS = {"A": "AUD", "C": "CAD", "CA": "CAD", "HK": "HKD", "NZ": "NZD", "R": "BRL", "S": "SGD"}
CODES = "AED AUD BRL CAD CHF CNY DKK EUR GBP HKD INR JPY KRW MXN NOK NZD SAR SEK SGD TRY USD ZAR".split()
# Tenors in words.
TENORS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "eighteen": 18}
# Kinds of dated events with the status each gives and how much it says about an obligation's life.
EVENTS = {
    "announcement": ("announced", 1), "closing": ("entered_into", 2), "amendment": ("amended", 3), "termination": ("terminated", 4), "retirement": ("repaid", 4), "exchange": ("exchanged", 5), "default": ("defaulted", 6),
}
RETIRING = ("retirement", "termination", "exchange", "default")
PRINCIPAL_KINDS = ("commitment", "principal")

_WORDS = "|".join(sorted(MAGNITUDES, key=len, reverse=True))
_FIGURE = r"\d(?:[\d.,]*\d)?"
NAMED_AMOUNT = rf"(?i)(?:[A-Z]{{0,2}}\$|€|£|¥)\s?{_FIGURE}(?:\s*(?:{_WORDS})\b\.?|[KkMmBb](?![A-Za-z]))?"
Money = "decimal(38,6)"


def single(values: Column) -> Column:
    """The one distinct value of an array, nulls aside; null where it has none or several."""
    known = F.array_distinct(F.array_compact(values))
    return F.when(F.size(known) == 1, known[0])


def _lookup(table: dict, key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


# -- amounts --------------------------------------------------------------------------------------


def magnitude(text: Column) -> Column:
    """The power of ten an amount is written with: a word, or a letter behind the first figure; null for none.

    The longest word counts. A small letter counts only behind a figure with a currency's sign.
    """
    lowered = F.replace(F.lower(text), F.lit(","), F.lit(""))
    word = F.when(F.lit(False), 0)
    for name in sorted(MAGNITUDES, key=lambda w: (-len(w), w)):
        word = word.when(lowered.rlike(rf"(?<![a-z]){name}\b"), MAGNITUDES[name])
    first = rf"^[^\d]*{_FIGURE}"
    letter = F.regexp_extract(text, first + r"([KMBkmb])(?![A-Za-z])", 1)
    marked = F.regexp_extract(text, rf"^([^\d]*){_FIGURE}", 1).rlike(r"[$€£¥]\s?$")
    return F.coalesce(word, F.when((letter != "") & ((letter == F.upper(letter)) | marked), _lookup(LETTERS, F.lower(letter))))


def figure(text: Column) -> Column:
    """The first figure of a text as a decimal number.

    Two shapes decide what their separators mean: points before three digits more than once part
    thousands, and of points and commas the last is the decimal sign. Any other figure is read with
    commas for thousands.
    """
    first = F.regexp_extract(text, _FIGURE, 0)
    points = first.rlike(r"^\d{1,3}(?:\.\d{3}){2,}$")
    last = F.regexp_extract(first, r"([.,])\d*$", 1)
    whole = F.regexp_extract(first, r"^(.*)[.,]\d*$", 1)
    both = F.contains(first, F.lit(".")) & F.contains(first, F.lit(",")) & ~F.contains(F.regexp_replace(whole, r"[.,](?=.*[.,])", ""), last)
    parted = F.concat(F.regexp_replace(whole, r"[.,]", ""), F.lit("."), F.regexp_extract(first, r"[.,](\d*)$", 1))
    plain = F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"\d+(?:\.\d+)?", 0)
    chosen = F.when(points, F.replace(first, F.lit("."), F.lit(""))).when(both, parted).otherwise(plain)
    return F.when(chosen != "", chosen.try_cast(Money))


def _scaled(number: Column, power: Column) -> Column:
    return (number * F.pow(F.lit(10.0), F.coalesce(power, F.lit(0))).cast("decimal(18,0)")).cast(Money)


def amount(text: Column) -> Column:
    """An amount as written, in whole units; null where no figure is."""
    return _scaled(figure(text), magnitude(text))


def numeric_text(value: Column) -> Column:
    """A number as text without trailing zeros."""
    return canonical_number(value)


def number_of(text: Column) -> Column:
    """A recorded amount (text, commas allowed) as a number; null for anything else."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast(Money)


def amounts_agree(recorded: Column, read: Column) -> Column:
    return F.coalesce(number_of(recorded) == read, F.lit(False))


def currencies(text: Column) -> Column:
    """array of the currencies a text may mean: signs, words and known codes, each once."""
    letters = "|".join(sorted(DOLLARS, key=len, reverse=True))
    qualified = F.regexp_extract_all(text, F.lit(rf"(?i)\b({letters})\$"), 1)
    lowered = F.lower(text)
    bare = (F.regexp_count(text, F.lit(r"\$")) > F.size(qualified)) | lowered.rlike(r"u\.s\. dollar|us dollar")
    signs = F.array(
        F.when(bare, "USD"), F.when(F.contains(text, F.lit("€")) | F.contains(lowered, F.lit(" euro")), "EUR"),
        F.when(F.contains(text, F.lit("£")) | lowered.rlike(" pound sterling| british pound"), "GBP"), F.when(F.contains(text, F.lit("¥")) | F.contains(lowered, F.lit(" yen")), "JPY"),
    )
    codes = F.filter(F.regexp_extract_all(text, F.lit(r"\b([A-Z]{3})\b"), 1), lambda c: c.isin(CODES))
    return F.array_distinct(F.array_compact(F.concat(F.transform(qualified, lambda q: _lookup(DOLLARS, F.upper(q))), signs, codes)))


def is_rate_like(text: Column) -> Column:
    """Whether every number of a text is a rate, and no currency or magnitude makes it an amount."""
    numbers = F.regexp_count(text, F.lit(r"\d[\d,]*(?:\.\d+)?"))
    rates = F.regexp_count(text, F.lit(r"(?i)\d[\d,]*(?:\.\d+)?\s*(?:%|percent\b|basis\s+points?\b|bps?\b)"))
    words = F.lower(text).rlike(rf"\b(?:{_WORDS})\b")
    return F.coalesce((F.size(currencies(text)) == 0) & ~words & (numbers > 0) & (numbers == rates), F.lit(False))


def amount_in_name(name: Column) -> Column:
    """The one amount with a currency's sign that a name states; null for none and for several."""
    return single(F.transform(F.regexp_extract_all(name, F.lit(NAMED_AMOUNT), 0), amount))


def currency_in_name(name: Column) -> Column:
    """The currency of the only amount a name states."""
    stated = F.regexp_extract_all(name, F.lit(NAMED_AMOUNT), 0)
    return F.when(F.size(stated) == 1, single(currencies(stated[0])))


def read_spans(spans: Column) -> Column:
    """array of (text, amount, power, currencies, rate): every cited text read once; an empty array for null."""
    known = F.filter(F.coalesce(spans, F.array().cast("array<string>")), lambda t: t.isNotNull())
    first = F.transform(known, lambda t: F.struct(t.alias("text"), figure(t).alias("figure"), magnitude(t).alias("power"), currencies(t).alias("currencies"), is_rate_like(t).alias("rate")))
    return F.transform(first, lambda s: F.struct(s["text"].alias("text"), _scaled(s["figure"], s["power"]).alias("amount"), s["power"].alias("power"), s["currencies"].alias("currencies"), s["rate"].alias("rate")))


def _canonical_span(read: Column) -> Column:
    """Of read_spans() the longest text with an amount, else the longest; the first of equal ones."""
    best = lambda spans: F.array_max(F.transform(spans, lambda s, i: F.struct(F.length(s["text"]).alias("n"), (-i).alias("i"), s.alias("s"))))["s"]
    return F.coalesce(best(F.filter(read, lambda s: s["amount"].isNotNull())), best(read))


def computed_sum(recorded: Column, read: Column) -> Column:
    """The recorded number where it is the sum of two or more amounts of read_spans(); null otherwise.

    Any cited rate, and any cited amount equal to the record, speak against a sum.
    """
    amounts = F.array_compact(F.transform(read, lambda s: s["amount"]))
    total = F.aggregate(amounts, F.lit(0).cast(Money), lambda s, x: (s + x).cast(Money))
    sums = (F.size(amounts) >= 2) & ~F.exists(read, lambda s: s["rate"]) & ~F.array_contains(amounts, recorded) & (total == recorded)
    return F.when(F.coalesce(sums, F.lit(False)), recorded)


def scale_by_siblings(df: DataFrame, recorded: str, spans: str, sibling_spans: str) -> DataFrame:
    """df with scaled: the recorded amount where a sibling fact's one magnitude makes it of the cited figure; null otherwise.

    "from $400.0 to $500.0 million" gives the first figure its magnitude on the second.
    """
    rows = df.withColumn("_own", read_spans(F.col(spans))).withColumn("_other", read_spans(F.col(sibling_spans))).withColumn("_value", number_of(F.col(recorded)))
    rows = rows.withColumn("_power", single(F.transform("_other", lambda s: s["power"]))).withColumn("_base", _canonical_span(F.col("_own"))["amount"])
    bare = ~F.exists("_own", lambda s: s["power"].isNotNull()) & ~F.exists(F.concat("_own", "_other"), lambda s: s["rate"])
    fits = bare & F.col("_power").isNotNull() & (_scaled(F.col("_base"), F.col("_power")) == F.col("_value"))
    return rows.withColumn("scaled", F.when(F.coalesce(fits, F.lit(False)), F.col("_value"))).drop("_own", "_other", "_value", "_power", "_base")


def verify_amounts(df: DataFrame, recorded: str, currency: str, spans: str, name: str, document_currencies: str | None = None) -> DataFrame:
    """df with verified: struct(amount, currency, derived_from), what the evidence confirms of a recorded amount.

    The amount is kept where the cited text says it ("stated"), or, if no cited text holds an amount,
    the name ("name"), or where it is the sum of the cited ones ("computed"). The currency is kept
    where it is a known one the same evidence shows; where that shows none, the only one of the
    whole document counts. Every text is read once, in columns of its own.
    """
    none = F.array().cast("array<string>")
    rows = df.withColumn("_read", read_spans(F.col(spans))).withColumn("_value", number_of(F.col(recorded))).withColumn("_name", amount_in_name(F.col(name))).withColumn("_name_currency", currency_in_name(F.col(name)))
    rows = rows.withColumn("_cited", _canonical_span(F.col("_read"))).withColumn("_sum", computed_sum(F.col("_value"), F.col("_read")))
    rate = F.coalesce(F.col("_cited.rate"), F.lit(False))
    rows = rows.withColumn("_named", F.when(F.col("_cited.amount").isNull(), F.col("_name"))).withColumn("_rate", rate)
    agrees = lambda c: F.coalesce(F.col("_value") == c, F.lit(False))
    stated = agrees(F.col("_cited.amount")) & ~F.col("_rate")
    rows = rows.withColumn("_how", F.when(stated, "stated").when(agrees(F.col("_named")) & ~F.col("_rate"), "name").when(F.col("_sum").isNotNull(), "computed"))
    of_name = F.when(F.col("_name_currency").isNotNull(), F.array("_name_currency"))
    shown = F.coalesce("_cited.currencies", none)
    seen = F.when(F.col("_how") == "computed", F.array_distinct(F.flatten(F.transform("_read", lambda s: s["currencies"])))).when(F.col("_rate"), none).when(F.col("_named").isNotNull(), F.coalesce(of_name, shown)).otherwise(shown)
    rows = rows.withColumn("_seen", seen)
    if document_currencies is not None:
        only = (F.size("_seen") == 0) & (F.size(document_currencies) == 1) & ~F.col("_rate")
        rows = rows.withColumn("_seen", F.when(only, F.col(document_currencies)).otherwise(F.col("_seen")))
    kept = F.when(F.col(currency).isin(CODES) & F.array_contains("_seen", F.col(currency)), F.col(currency))
    value = F.when(F.col("_how").isNotNull(), numeric_text(F.col("_value")))
    verified = F.struct(value.alias("amount"), kept.alias("currency"), F.col("_how").alias("derived_from"))
    return rows.withColumn("verified", verified).drop("_read", "_value", "_name", "_name_currency", "_cited", "_sum", "_named", "_rate", "_how", "_seen")


def principal_of(facts: Column) -> Column:
    """The first fact (kind, prior, normalized_amount) that is a current commitment or principal with a value."""
    return F.get(F.filter(facts, lambda f: f["kind"].isin(*PRINCIPAL_KINDS) & ~F.coalesce(f["prior"], F.lit(False)) & f["normalized_amount"].isNotNull()), F.lit(0))


# -- rates ----------------------------------------------------------------------------------------


def rates(text: Column) -> Column:
    """array of the rates a text states, as numbers: fractions ("6 1/2%") first, then figures with a rate's sign or word."""
    fraction = r"(?i)(\d+)\s+(\d+)\s*/\s*(\d+)\s*(?:%|percent\b)"
    part = lambda whole, i: F.regexp_extract(whole, fraction, i).cast("decimal(18,6)")
    fractions = F.transform(F.regexp_extract_all(text, F.lit(fraction), 0), lambda f: F.when(part(f, 3) != 0, (part(f, 1) + part(f, 2) / part(f, 3)).cast("decimal(18,6)")))
    figures = F.transform(F.regexp_extract_all(F.regexp_replace(text, fraction, " "), F.lit(r"(?i)(\d+(?:\.\d+)?)\s*(?:%|percent\b)"), 1), lambda r: r.cast("decimal(18,6)"))
    return F.concat(F.array_compact(fractions), figures)


def rates_in_rate_text(text: Column) -> Column:
    """rates() of a text known to be a rate: a bare number is one."""
    bare = F.trim(text)
    return F.when(F.size(rates(text)) > 0, rates(text)).when(bare.rlike(r"^\d+(?:\.\d+)?$"), F.array(bare.try_cast("decimal(18,6)"))).otherwise(F.array().cast("array<decimal(18,6)>"))


def verify_rates(df: DataFrame, recorded: str, rate_texts: str, name: str) -> DataFrame:
    """df with verified: struct(rate, derived_from), the recorded rate where a cited rate says it, or, without any, the name does."""
    number = F.when(F.col(recorded).rlike(r"^\d+(?:\.\d+)?$"), F.col(recorded).try_cast("decimal(18,6)"))
    rows = df.withColumn("_cited", F.flatten(F.transform(rate_texts, rates_in_rate_text))).withColumn("_named", rates(F.col(name))).withColumn("_own", number)
    stated = F.coalesce((F.size("_cited") > 0) & F.array_contains("_cited", F.col("_own")), F.lit(False))
    by_name = F.coalesce((F.coalesce(F.size("_cited"), F.lit(0)) <= 0) & F.array_contains("_named", F.col("_own")), F.lit(False))
    verified = F.struct(F.when(stated | by_name, numeric_text(F.col("_own"))).alias("rate"), F.when(stated, "stated").when(by_name, "name").alias("derived_from"))
    return rows.withColumn("verified", verified).drop("_cited", "_named", "_own")


# -- dates ----------------------------------------------------------------------------------------

_MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"


def _month_end(year: Column, month: Column) -> Column:
    return F.date_format(F.last_day(F.try_to_date(F.concat_ws("-", year, F.initcap(month), F.lit("1")), "y-MMMM-d")), "yyyy-MM-dd")


def month_year(text: Column) -> Column:
    """The end of the only month a text names with its year; null for none and for several."""
    pattern = rf"(?i)(?<![A-Za-z\d])({_MONTH}),?\s+(\d{{4}})(?!\d)"
    return single(F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: _month_end(F.regexp_extract(m, pattern, 2), F.regexp_extract(m, pattern, 1))))


def maturity(text: Column) -> Column:
    """The end date a phrase states after "due": a day, else the end of a month, else the end of a year.

    Phrases that state several ("due 2028 and 2030", "due June 1, 2027 and 2028") name no one
    instrument and give null.
    """
    more = r"(?:\s*(?:,|/|&|and(?:/or)?|or)\s*(?:[A-Za-z]+\s+(?:\d{1,2},?\s+)?)?\d{4})*"
    full = rf"(?i)\bdue\s+(?:on\s+)?([A-Za-z]+)\s+(\d{{1,2}}),?\s+(\d{{4}})({more})"
    month = rf"(?i)\bdue\s+(?:in\s+)?([A-Za-z]+),?\s+(\d{{4}})({more})"
    year = r"(?i)\bdue\s+(?:in\s+)?(\d{4}(?:\s*(?:,|/|&|and(?:/or)?|or)\s*(?:[A-Za-z]+\s+\d{1,2},?\s+)?\d{4})*)\b"
    each = lambda pattern, read: F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), read)
    years_in = lambda t: F.regexp_extract_all(t, F.lit(r"\d{4}"), 0)
    day = lambda m: F.date_format(F.try_to_date(F.concat_ws("-", F.regexp_extract(m, full, 3), F.initcap(F.regexp_extract(m, full, 1)), F.regexp_extract(m, full, 2)), "y-MMMM-d"), "yyyy-MM-dd")
    ends = lambda m: _month_end(F.regexp_extract(m, month, 2), F.regexp_extract(m, month, 1))
    days = F.array_distinct(F.array_compact(each(full, day)))
    months = F.array_distinct(F.array_compact(each(month, ends)))
    further = F.flatten(each(full, lambda m: years_in(F.regexp_extract(m, full, 4))))
    of_months = F.flatten(F.transform(F.filter(F.regexp_extract_all(text, F.lit(month), 0), lambda m: ends(m).isNotNull()), lambda m: years_in(F.regexp_extract(m, month, 3))))
    years = F.array_distinct(F.concat(further, of_months, F.flatten(each(year, lambda m: years_in(F.regexp_extract(m, year, 1))))))
    others = lambda dates: F.size(F.array_except(years, F.transform(dates, lambda d: F.substring(d, 1, 4))))
    by_day = F.when((F.size(days) == 1) & (others(days) == 0) & ~F.exists(months, lambda m: F.substring(m, 1, 7) != F.substring(days[0], 1, 7)), days[0])
    by_month = F.when((F.size(months) == 1) & (others(months) == 0), months[0])
    by_year = F.when(F.size(years) == 1, F.concat(years[0], F.lit("-12-31")))
    return F.when(F.size(days) > 0, by_day).when(F.size(months) > 0, by_month).otherwise(by_year)


def tenor(text: Column) -> Column:
    """struct(count, unit) of the only tenor a text states ("five-year", "18 months"); null for none and for several."""
    pattern = rf"(?i)\b(\d{{1,3}}|{'|'.join(TENORS)})[-\s](year|month|day)s?\b"
    count = lambda m: F.coalesce(_lookup(TENORS, F.lower(F.regexp_extract(m, pattern, 1))), F.regexp_extract(m, pattern, 1).try_cast("int"))
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), lambda m: F.struct(count(m).alias("count"), F.lower(F.regexp_extract(m, pattern, 2)).alias("unit")))
    return single(found)


def computed_maturity(recorded: Column, date_texts: Column, tenor_texts: Column) -> Column:
    """The recorded date where it is a cited date plus or minus a cited tenor; null otherwise."""
    starts = F.array_distinct(F.array_compact(F.transform(date_texts, iso_date)))
    tenors = F.array_distinct(F.array_compact(F.transform(tenor_texts, tenor)))
    moved = lambda s, t, sign: F.date_format(plus_tenor(F.to_date(s), t["count"] * sign, t["unit"]), "yyyy-MM-dd")
    lands = F.exists(starts, lambda s: F.exists(tenors, lambda t: (moved(s, t, 1) == recorded) | (moved(s, t, -1) == recorded)))
    return F.when(F.coalesce(lands & recorded.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)), recorded)


def dates_agree(recorded: Column, read: Column) -> Column:
    return F.coalesce(iso_date(recorded) == read, F.lit(False))


def verified_date(recorded: Column, spans: Column) -> Column:
    """The recorded date where the one date the cited texts state says it."""
    read = single(F.transform(spans, iso_date))
    return F.when(dates_agree(recorded, read), read)


def verify_end_dates(df: DataFrame, recorded: str, spans: str, name: str, date_texts: str, tenor_texts: str) -> DataFrame:
    """df with verified: struct(date, derived_from) of a recorded maturity: stated by the cited texts as a day or a month,
    read from a phrase in them, computed from a date and a tenor, or taken from the name."""
    rows = df
    for column, read in (("_day", iso_date), ("_month", month_year), ("_phrase", maturity)):
        rows = rows.withColumn(column, single(F.transform(spans, read)))
    rows = rows.withColumn("_named", maturity(F.col(name))).withColumn("_computed", computed_maturity(F.col(recorded), F.col(date_texts), F.col(tenor_texts))).withColumn("_own", iso_date(F.col(recorded)))
    rows = rows.withColumn("_read", F.coalesce("_day", "_month", "_phrase"))
    said = F.coalesce(F.col("_own") == F.col("_read"), F.lit(False))
    value = F.when(said, F.col("_read")).otherwise(F.coalesce("_computed", "_named"))
    how = F.when(said, F.when(F.coalesce("_day", "_month").isNotNull(), "stated").otherwise("name")).when(F.col("_computed").isNotNull(), "computed").when(F.col("_named").isNotNull(), "name")
    return rows.withColumn("verified", F.struct(value.alias("date"), how.alias("derived_from"))).drop("_day", "_month", "_phrase", "_named", "_computed", "_own", "_read")


def date_precision(date: Column, texts: Column, derived_from: Column) -> Column:
    """How exactly the cited texts state a date: day, month or year; null for no date."""
    by_day = derived_from.eqNullSafe("computed") | F.coalesce(F.exists(texts, lambda t: iso_date(t) == date), F.lit(False))
    by_month = F.coalesce(F.exists(texts, lambda t: (month_year(t) == date) | t.rlike(rf"(?i)\bdue\s+(?:in\s+)?(?:{_MONTH}),?\s+\d{{4}}")), F.lit(False))
    return F.when(date.isNull(), None).when(by_day, "day").when(by_month, "month").when(date.endswith("-12-31"), "year").otherwise("day")


# -- dated facts ----------------------------------------------------------------------------------

DATED = "array<struct<kind: string, normalized_date: string, prior: boolean, expected: boolean>>"


def _flag(fact: Column, name: str) -> Column:
    return F.coalesce(fact[name], F.lit(False))


def current_date(facts: Column, kind: str) -> Column:
    """The date of the first fact of a kind that is neither prior nor merely expected."""
    return F.get(F.filter(facts, lambda f: (f["kind"] == kind) & ~_flag(f, "prior") & ~_flag(f, "expected")), F.lit(0))["normalized_date"]


def mark_expected(facts: Column, filed: Column) -> Column:
    """facts in which every event but an announcement that is dated after the filing is expected."""
    kinds = [*(k for k in EVENTS if k != "announcement"), "repayment"]
    later = lambda f: F.coalesce(f["kind"].isin(kinds) & (f["normalized_date"] > filed) & (filed != ""), F.lit(False))
    return F.transform(facts, lambda f: f.withField("expected", _flag(f, "expected") | later(f)))


def derived_status(facts: Column) -> Column:
    """struct(status, date, from_kind): what a mention says happened, from its dated facts.

    The newest completed event wins; one without a date counts as new as the newest with one, and of
    equally new ones the one that says most about the obligation's life, then the first. Without any,
    an expected closing announces and an agreement enters into it.
    """
    completed = F.filter(facts, lambda f: f["kind"].isin(*EVENTS) & ~_flag(f, "prior") & ~_flag(f, "expected"))
    newest = F.array_max(F.transform(completed, lambda f: f["normalized_date"]))
    ranks = {kind: rank for kind, (_, rank) in EVENTS.items()}
    ranked = F.transform(completed, lambda f, i: F.struct(F.coalesce(f["normalized_date"], newest, F.lit("")).alias("day"), _lookup(ranks, f["kind"]).alias("rank"), (-i).alias("place"), f["kind"].alias("kind"), f["normalized_date"].alias("date")))
    best = F.array_max(ranked)
    closing = F.exists(facts, lambda f: (f["kind"] == "closing") & _flag(f, "expected"))
    agreed = F.get(F.filter(facts, lambda f: (f["kind"] == "agreement") & ~_flag(f, "prior")), F.lit(0))
    statuses = {kind: status for kind, (status, _) in EVENTS.items()}
    some = F.coalesce(F.size(completed), F.lit(0)) > 0
    status = F.when(some, _lookup(statuses, best["kind"])).when(closing, "announced").when(agreed.isNotNull(), "entered_into")
    date = F.when(some, best["date"]).when(closing, None).when(agreed.isNotNull(), agreed["normalized_date"])
    kind = F.when(some, best["kind"]).when(closing, "closing:expected").when(agreed.isNotNull(), "agreement")
    return F.struct(status.alias("status"), date.alias("date"), kind.alias("from_kind"))


def retirement_expected(facts: Column) -> Column:
    """Whether the facts hold a planned end of the obligation."""
    return F.coalesce(F.exists(facts, lambda f: f["kind"].isin(*RETIRING) & _flag(f, "expected")), F.lit(False))
