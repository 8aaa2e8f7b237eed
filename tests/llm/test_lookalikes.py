import itertools

import pytest

from ledgerline.llm import lookalikes

ALIKE = [
    "Café filings office", "Cafe\u0301 filings office", "Ｃafé filings office", "Café \ufb01lings o\ufb03ce", "Caf\u00e9\u00a0filings office", "C\u0430f\u00e9 filings office", "Ca\u200bfé filings office", "Café filings o\u00adffice", "Café filings \u03bfffice",
]
DIFFERENT = ["Cafe filings office", "Café filings  office", "café filings office", "Café filings office.", "", "Данный флот", "Ёлка", "-", "\u2013"]


@pytest.fixture
def documents(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*ALIKE, *DIFFERENT, None, "", "\u2010", "\u2011", "Е\u0308лка"])]
    return spark.createDataFrame([*rows, rows[0]], "key long, body string, canonical string")


def test_pairs_against_brute_force(documents):
    rows = sorted({(r.key, r.body) for r in documents.collect() if r.body is not None})
    expected = {(a, b) for (a, s), (b, t) in itertools.combinations(rows, 2) if s != t and lookalikes.mapped_text(s) == lookalikes.mapped_text(t)}
    assert len([p for p in expected if p[1] < len(ALIKE)]) == len(ALIKE) * (len(ALIKE) - 1) // 2
    assert {tuple(r) for r in lookalikes.lookalike_pairs(documents, "key", "body").collect()} == expected


def test_canonical_form(documents):
    found = {r.key: r.canonical for r in lookalikes.canonical_texts(documents, "key", "body").collect()}
    assert len({found[i] for i in range(len(ALIKE))}) == 1 and len({found[i] for i in range(len(ALIKE), len(ALIKE) + 6)}) == 6
    assert found[len(ALIKE) + len(DIFFERENT)] is None and found[len(ALIKE) + len(DIFFERENT) + 1] == ""


def test_long_and_empty(spark):
    long = "word " * 200_000
    df = spark.createDataFrame([(1, long + "\u00e9"), (2, long + "e\u0301"), (3, long)], "key long, body string")
    assert [tuple(r) for r in lookalikes.lookalike_pairs(df, "key", "body").collect()] == [(1, 2)]
    assert lookalikes.lookalike_pairs(df.limit(0), "key", "body").count() == 0


def test_the_form_depends_on_the_text_alone(spark, documents):
    """A text without a twin comes out as it does among its twins, and the JVM's form is Python's."""
    together = {r.key: r.canonical for r in lookalikes.canonical_texts(documents, "key", "body").collect()}
    for row in documents.distinct().collect():
        assert together[row.key] == lookalikes.mapped_text(row.body)
    alone = spark.createDataFrame([(1, "café")], "key long, body string")
    assert lookalikes.canonical_texts(alone, "key", "body").first().canonical == "café"


def test_letters_of_styled_alphabets_and_numerals(spark):
    rows = [(1, "\U0001d400ct Ⅳ Ⅿ ℌx \U0001d7d8"), (2, "Act IV M Hx 0"), (3, "x² – “q”"), (4, 'x2 - "q"')]
    df = spark.createDataFrame(rows, "key long, body string")
    assert [tuple(r) for r in lookalikes.lookalike_pairs(df, "key", "body").collect()] == [(1, 2)]
