"""Filings cut into their items, inside the JVM: a document is an array of lines, a heading a place in it.

No line leaves its document's row: headings, tables of contents and section ends are found by array
functions, so that there is neither a shuffle nor a Python process, and one row comes out for every
item the filing's header declares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import body_lines

# What filings call their items, in lower case, and the items' numbers.
CAPTIONS = {
    "entry into a material definitive agreement": "1.01",
    "termination of a material definitive agreement": "1.02",
    "bankruptcy or receivership": "1.03",
    "mine safety - reporting of shutdowns and patterns of violations": "1.04",
    "material cybersecurity incidents": "1.05",
    "completion of acquisition or disposition of assets": "2.01",
    "results of operations and financial condition": "2.02",
    "creation of a direct financial obligation or an obligation under an off-balance sheet arrangement of a registrant": "2.03",
    "triggering events that accelerate or increase a direct financial obligation or an obligation under an off-balance sheet arrangement": "2.04",
    "costs associated with exit or disposal activities": "2.05",
    "cost associated with exit or disposal activities": "2.05",
    "material impairments": "2.06",
    "notice of delisting or failure to satisfy a continued listing rule or standard; transfer of listing": "3.01",
    "unregistered sales of equity securities": "3.02",
    "material modifications to rights of security holders": "3.03",
    "changes in registrant's certifying accountant": "4.01",
    "non-reliance on previously issued financial statements or a related audit report or completed interim review": "4.02",
    "changes in control of registrant": "5.01",
    "departure of directors or certain officers; election of directors; appointment of certain officers: compensatory arrangements of certain officers": "5.02",
    "amendments to articles of incorporation or bylaws; change in fiscal year": "5.03",
    "temporary suspension of trading under registrant's employee benefit plans": "5.04",
    "amendments to the registrant's code of ethics, or waiver of a provision of the code of ethics": "5.05",
    "change in shell company status": "5.06",
    "submission of matters to a vote of security holders": "5.07",
    "shareholder director nominations": "5.08",
    "shareholder nominations pursuant to exchange act rule 14a-11": "5.08",
    "abs informational and computational material": "6.01",
    "change of servicer or trustee": "6.02",
    "change in credit enhancement or other external support": "6.03",
    "failure to make a required distribution": "6.04",
    "securities act updating disclosure": "6.05",
    "regulation fd disclosure": "7.01",
    "other events": "8.01",
    "financial statements and exhibits": "9.01",
}
NUMBERS = sorted(set(CAPTIONS.values()))
# Phrases by which a line mentions an item without heading it.
MENTIONS = (
    "incorporated by reference", "shall not be deemed", "is not deemed", "is being furnished", "is being filed", "of this current report", "of this report", "of this form 8-k",
)
#: Share of words two sections have in common from which they count as one text.
ENOUGH_ALIKE = 0.95
_END_OF_ITEMS = r"(?i)^\s*(?:signatures?|exhibit\s+index)\s*$"
_BARE = r"^\s*(\d\.0\d)(?!\s*%)\s*(?:[.:;\-)]|\b)"


def _words(text: Column, most: int) -> Column:
    return F.slice(F.regexp_extract_all(F.lower(text), F.lit(r"\w+"), 0), 1, most)


#: The first two words of each item's captions, behind its number.
_OPENINGS = sorted({number + " " + " ".join("".join(c if c.isalnum() or c == "_" else " " for c in caption).split()[:2]) for caption, number in CAPTIONS.items()})


def one_number(text: Column) -> Column:
    """A text whose item numbers are written in one piece: "1 . 0 1" is 1.01."""
    return F.regexp_replace(text, r"\b(\d)\s*\.\s*(\d)\s*(\d)\b", "$1.$2$3")


def primary_body(text: Column) -> Column:
    """The body of the first 8-K document of a submission, else what follows its header, else all of it."""
    blocks = F.regexp_extract_all(text, F.lit("(?is)<DOCUMENT>(.*?)</DOCUMENT>"), 1)
    own = F.get(F.filter(blocks, lambda b: F.lower(F.trim(F.regexp_extract(b, r"(?i)<TYPE>\s*([^\n\r<]+)", 1))) == "8-k"), 0)
    inner = F.when(own.rlike("(?is)<TEXT>.*?</TEXT>"), F.regexp_extract(own, "(?is)<TEXT>(.*?)</TEXT>", 1)).otherwise(own)
    header = F.instr(F.upper(text), "</SEC-HEADER>")
    return F.when(own.isNotNull(), inner).when(header > 0, F.substr(text, header + len("</SEC-HEADER>"))).otherwise(text)


def declared_items(text: Column) -> Column:
    """array of (caption, number): what the header declares, in order; of captions with one number the first counts. Unknown captions have no number."""
    numbers = F.create_map(*(F.lit(x) for pair in CAPTIONS.items() for x in pair))
    heads = F.filter(F.transform(F.split(text, r"\r\n|\n|\r"), F.trim), lambda line: F.lower(line).startswith("item information:"))
    captions = F.transform(heads, lambda line: F.trim(F.lower(F.substr(line, F.lit(len("item information:") + 1)))))
    keys = F.transform(captions, lambda c: F.coalesce(numbers[c], c))
    return F.filter(F.transform(captions, lambda c: F.struct(c.alias("caption"), numbers[c].alias("number"))), lambda e, i: F.array_position(keys, F.coalesce(e["number"], e["caption"])) == i + 1)


def heading_numbers(line: Column, declared: Column) -> Column:
    """The item numbers a line heads: those behind "Item", or a bare number that is declared or followed by its caption.

    Numbers that read as money or a rate head nothing, nor does a line that speaks of an item.
    """
    written = one_number(line)
    behind = F.filter(F.regexp_extract_all(written, F.lit(r"(?<![$€£])\b\d\.0\d\b(?!\s*%)"), 0), lambda n: n.isin(NUMBERS))
    bare = F.regexp_extract(written, _BARE, 1)
    opening = F.concat_ws(" ", bare, F.array_join(_words(F.regexp_replace(written, _BARE, ""), 2), " "))
    alone = F.when((bare != "") & (F.array_contains(declared, bare) | opening.isin(_OPENINGS)), F.array(bare))
    none = F.array().cast("array<string>")
    speaks = F.lower(written).rlike("|".join(m.replace("-", r"\-") for m in MENTIONS))
    return F.when(speaks, none).when(written.rlike(r"(?i)^\s*item\b"), behind).otherwise(F.coalesce(alone, none))


def _outside_contents(heads: Column, contents: Column) -> Column:
    """heads without the first heading of a number after a table of contents, where the number comes again later."""

    def listed(head: Column, at: Column) -> Column:
        before, after = F.slice(heads, F.lit(1), at), F.slice(heads, at + 2, F.size(heads))
        first = lambda toc, n: ~F.exists(before, lambda b: (b["at"] > toc) & F.array_contains(b["numbers"], n))
        again = lambda n: F.exists(after, lambda b: F.array_contains(b["numbers"], n))
        return F.exists(contents, lambda toc: (head["at"] > toc) & F.exists(head["numbers"], lambda n: first(toc, n) & again(n)))

    return F.when(F.size(contents) > 0, F.filter(heads, lambda head, at: ~listed(head, at))).otherwise(heads)


def section_plain(section: Column, number: Column) -> Column:
    """A section's text for comparison: words and points only, without its own heading's number and lines of digits."""
    folded = F.transform(F.split(section, "\n"), lambda line: F.trim(F.regexp_replace(F.lower(one_number(line)), r"[^\w.]+", " ")))
    own = F.concat(F.lit(r"^(?:item\s+)?"), F.replace(number, F.lit("."), F.lit(r"\.")), F.lit(r"\.?$"))
    return F.array_join(F.filter(folded, lambda line: (line != "") & ~line.rlike(r"^\d+$") & ~F.rlike(line, own)), " ")


def alike(a: Column, b: Column) -> Column:
    """Whether two plain texts are one: one holds the other, or nearly all their words are the same."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    overlap = F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a) | (overlap >= ENOUGH_ALIKE))


def itemize(documents: DataFrame, key: str, text: str, undeclared: bool = False) -> DataFrame:
    """One row per item a document declares: key, item_information, item, extraction_status, duplicate_resolution, section_heading, start_line, end_line, section_char_count, section_text.

    Status is ok, duplicate_heading (several headings whose sections differ; the first is taken),
    missing_heading, or unmapped_item_information for a caption without a number; the last two have
    no section. With undeclared, items that are headed but not declared have rows as well, without
    item_information. Documents without any item, and null texts, have no row.
    """
    rows = documents.where(F.col(text).isNotNull()).select(key, F.col(text).alias("_text"), declared_items(F.col(text)).alias("_declared"))
    rows = rows if undeclared else rows.where("size(_declared) > 0")
    rows = rows.withColumn("_lines", body_lines(primary_body(F.col("_text")))).drop("_text")
    rows = rows.withColumn("_numbers", F.transform("_declared", lambda e: e["number"]))
    heads = F.filter(F.transform("_lines", lambda line, i: F.struct(i.alias("at"), line["text"].alias("text"), heading_numbers(line["text"], F.col("_numbers")).alias("numbers"))), lambda h: F.size(h["numbers"]) > 0)
    places = lambda test: F.filter(F.transform("_lines", lambda line, i: F.when(test(line["text"]), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_all", heads).withColumn("_contents", places(lambda t: F.contains(F.lower(t), F.lit("table of contents")))).withColumn("_ends", places(lambda t: t.rlike(_END_OF_ITEMS)))
    rows = rows.withColumn("_heads", _outside_contents(F.col("_all"), F.col("_contents"))).drop("_all", "_contents")
    if undeclared:
        headed = F.array_except(F.array_distinct(F.flatten(F.transform("_heads", lambda h: h["numbers"]))), "_numbers")
        none = F.lit(None).cast("string")
        rows = rows.withColumn("_declared", F.concat("_declared", F.transform(headed, lambda n: F.struct(none.alias("caption"), n.alias("number")))))
    one = rows.withColumn("_item", F.explode("_declared")).withColumn("_number", F.col("_item.number")).drop("_declared", "_numbers")
    own = F.filter("_heads", lambda h: F.array_contains(h["numbers"], F.col("_number")))
    below = F.concat(F.lit(r"(?i)^\s*(?:Item\s+)?"), F.replace("_number", F.lit("."), F.lit(r"\.")), F.lit(r"\s*\([a-z]\)"))
    one = one.withColumn("_own", F.when(F.col("_number").isNotNull(), own).otherwise(F.slice("_heads", 1, 0)))
    one = one.withColumn("_top", F.filter("_own", lambda h: ~F.rlike(one_number(h["text"]), below)))
    one = one.withColumn("_starts", F.when(F.size("_top") > 0, F.col("_top")).otherwise(F.slice("_own", 1, 1)))

    def candidate(head: Column) -> Column:
        after = lambda places: F.array_min(F.filter(places, lambda i: i > head["at"]))
        others = F.transform(F.filter("_heads", lambda h: F.exists(h["numbers"], lambda n: n != F.col("_number"))), lambda h: h["at"])
        stop = F.least(after(others), after(F.col("_ends")), F.size("_lines"))
        return F.struct(head["at"].alias("at"), head["text"].alias("heading"), stop.alias("stop"))

    one = one.withColumn("_spans", F.transform("_starts", candidate))
    section = lambda s: F.array_join(F.transform(F.slice("_lines", s["at"] + 1, s["stop"] - s["at"]), lambda line: line["text"]), "\n")
    one = one.withColumn("_texts", F.transform("_spans", lambda s: F.struct(s["at"].alias("at"), s["stop"].alias("stop"), s["heading"].alias("heading"), section(s).alias("text"))))
    one = one.withColumn("_sections", F.transform("_texts", lambda s: F.struct(s["at"].alias("at"), s["stop"].alias("stop"), s["heading"].alias("heading"), s["text"].alias("text"), section_plain(s["text"], F.col("_number")).alias("plain"))))
    every = lambda test: F.get(F.filter("_sections", lambda c: F.forall("_sections", lambda o: (o["at"] == c["at"]) | test(c, o))), 0)
    several = F.size("_sections") > 1
    one = one.withColumn("_same", F.when(several, every(lambda c, o: alike(c["plain"], o["plain"])))).withColumn("_whole", F.when(several & F.col("_same").isNull(), every(lambda c, o: F.contains(c["plain"], o["plain"]))))
    one = one.withColumn("_taken", F.coalesce("_same", "_whole", F.get("_sections", F.lit(0))))
    how = (
        F.when(F.size("_sections") == 0, None).when(F.size("_sections") == 1, "single_heading").when(F.col("_same").isNotNull(), "benign_equivalent").when(F.col("_whole").isNotNull(), "benign_contained").otherwise("unresolved_duplicate")
    )
    status = F.when(F.col("_number").isNull(), "unmapped_item_information").when(F.size("_sections") == 0, "missing_heading").when(how == "unresolved_duplicate", "duplicate_heading").otherwise("ok")
    line_no = lambda at: F.get("_lines", at)["number"].cast("long")
    return one.select(
        key, F.col("_item.caption").alias("item_information"), F.col("_number").alias("item"), status.alias("extraction_status"), how.alias("duplicate_resolution"), F.col("_taken.heading").alias("section_heading"),
        line_no(F.col("_taken.at")).alias("start_line"), line_no(F.col("_taken.stop") - 1).alias("end_line"), F.char_length("_taken.text").cast("long").alias("section_char_count"), F.col("_taken.text").alias("section_text"),
    )
