import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.operators import itemizing


def items(spark, *bodies):
    df = spark.createDataFrame([(i, b, "clash") for i, b in enumerate(bodies)], "key long, body string, item string")
    return {(r.key, r.item or r.item_information): r for r in itemizing.itemize(df, "key", "body").collect()}


def filing(captions, body):
    return "\n".join(f"ITEM INFORMATION: {c}" for c in captions) + f"\n<DOCUMENT><TYPE>EX-1\n<TEXT>Item 8.01 no</TEXT></DOCUMENT><DOCUMENT><TYPE>8-K\n<TEXT>{body}</TEXT></DOCUMENT>"


def test_sections_end_at_other_items_and_signatures(spark):
    body = "Table of Contents\nItem 8.01 Other Events\nItem 8.01 Other Events\nFirst line.\nItem 9 . 01 Exhibits\nlist\nSIGNATURES\nend"
    found = items(spark, filing(["Other Events", "OTHER EVENTS", "Financial Statements and Exhibits", "Regulation FD Disclosure", "Something new"], body), None, "", "Item 8.01 undeclared")
    assert len(found) == 4
    events, exhibits = found[0, "8.01"], found[0, "9.01"]
    assert (events.extraction_status, events.duplicate_resolution, events.section_text) == ("ok", "single_heading", "Item 8.01 Other Events\nFirst line.")
    assert (events.start_line, events.end_line, events.section_char_count) == (3, 4, len(events.section_text))
    assert exhibits.section_text == "Item 9 . 01 Exhibits\nlist"
    assert found[0, "7.01"].extraction_status == "missing_heading" and found[0, "7.01"].section_text is None
    assert found[0, "something new"].extraction_status == "unmapped_item_information" and found[0, "something new"].item is None


def test_duplicate_headings(spark):
    long = "The same words stand here in both places, many of them, one after the other, to the end of it."
    same = items(spark, filing(["Other Events"], f"Item 8.01\n{long}\nItem 8.01.\n{long}"))[0, "8.01"]
    assert (same.extraction_status, same.duplicate_resolution) == ("ok", "benign_equivalent")
    differ = items(spark, filing(["Other Events"], "Item 8.01\nOne text.\nItem 1.01 x\ny\nItem 8.01\nAnother thing altogether."))[0, "8.01"]
    assert (differ.extraction_status, differ.duplicate_resolution, differ.section_text) == ("duplicate_heading", "unresolved_duplicate", "Item 8.01\nOne text.")
    below = items(spark, filing(["Other Events"], "Item 8.01(a) First\nx\nItem 8.01(b) Second\ny"))[0, "8.01"]
    assert below.section_text.endswith("y") and below.duplicate_resolution == "single_heading"


@pytest.mark.parametrize(
    ("line", "declared", "expected"),
    [
        ("Item 1.01 and 2.03 Entry", [], ["1.01", "2.03"]), ("ITEM 1 . 0 1", [], ["1.01"]), ("Item 1.05% Notes", [], []), ("Item $1.05 billion", [], []), ("Item 6.00 x", [], []), ("see Item 1.01", [], []),
        ("Item 1.01 is incorporated by reference", [], []), ("Item 2.03 of this Current Report", [], []), ("Item 9.01 shall not be deemed filed", [], []), ("8.01 Other Events", [], ["8.01"]), ("8.01 a table cell", [], []),
        ("8.01 a table cell", ["8.01"], ["8.01"]), ("5.06% Senior Notes", ["5.06"], []), ("5.07. Submission of Matters", [], ["5.07"]), ("", [], []),
    ],
)
def test_heading_numbers(spark, line, declared, expected):
    df = spark.createDataFrame([(line, declared)], "line string, declared array<string>")
    assert df.select(itemizing.heading_numbers(F.col("line"), F.col("declared")).alias("n")).first().n == expected


def test_bodies(spark):
    df = spark.createDataFrame([("<SEC-HEADER>h</SEC-HEADER>body",), ("plain",), (None,), ("<DOCUMENT><TYPE>8-K\nno text tag</DOCUMENT>",)], "t string")
    assert [r.b and r.b.strip() for r in df.select(itemizing.primary_body(F.col("t")).alias("b")).collect()] == ["body", "plain", None, "<TYPE>8-K\nno text tag"]
    lines = spark.createDataFrame([("a<br>b &lt;p&gt; c</td> d  e\n\n<p>&#8212;x</p>",)], "t string").select(text.body_lines(F.col("t")).alias("l")).first().l
    assert [(x.number, x.text) for x in lines] == [(1, "a"), (2, "b <p> c"), (3, "d e"), (5, "—x")]


def test_undeclared_items(spark):
    df = spark.createDataFrame([(1, filing(["Other Events"], "Item 1.01 Entry\na\nItem 8.01\nb")), (2, "Item 2.03 x\ny"), (3, "none")], "key long, body string")
    found = {(r.key, r.item): (r.item_information, r.section_text) for r in itemizing.itemize(df, "key", "body", undeclared=True).collect()}
    assert found == {(1, "8.01"): ("other events", "Item 8.01\nb"), (1, "1.01"): (None, "Item 1.01 Entry\na"), (2, "2.03"): (None, "Item 2.03 x\ny")}
