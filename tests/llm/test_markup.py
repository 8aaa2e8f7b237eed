import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import markup, pages

MARKED = {
    "<p>Net <b>income</b></p>": "Net income", "R&amp;D grew&nbsp;fast": "R&D grew fast", "<!-- note -->text": "text", "# Head\n\nbody": "# Head\n\nbody", "a **bold** word": "a bold word",
    "see [here](https://x.example/a)": "see here", "== Head ==\nbody": "# Head\nbody", "x [[Page|shown]] y": "x shown y", "x[[Category:Files]] y": "x y", "\\section{Head}\nA \\textbf{b} \\& 5\\%": "# Head\n\nA b & 5%",
    "\\[ x_1 \\le 2 \\]": "$x_1 \\le 2$", "<ul><li>one<li>two</ul>": "- one\n- two", "<table><tr><td>a<td>b<tr><td>1</td><td>2</td></tr></table>": "a | b\n1 | 2",
    "{|\n|-\n| a || b\n|-\n| 1 || 2\n|}": "a | b\n1 | 2", "| a | b |\n|---|---|\n| 1 | 2 |": "a | b\n1 | 2", "```\nx = 1\n```": "```\nx = 1\n```", "<pre><code>x &lt; 1</code></pre>": "```\nx < 1\n```", "> *end of note*": "end of note",
    "half is \\frac{a}{b} of it": "half is $\\frac{a}{b}$ of it", "\\textbf{see} C:\\temp\\file now": "see C:\\temp\\file now", "x {{a {{b}} c}} y": "x  y", "an __important__ and _small_ **word**": "an important and small word",
    "**T**\nTitle\n=====\nsee [this](notes.md)": "T\n# Title\nsee this",
}
PLAIN = ["(R&D unit 5)", "ratio < 7.50:1.00", "$5 and $6", "note *12 and *13", "file ex99_17.htm [27]", "Item #33", "x_9 <= 33 * y", "a - b\n- c", "<DOCUMENT>\n<TYPE>8-K\n<TEXT>\nbody", "P = 47 / (1 + r)^5", "AT&T; S&P", "", "in C:\\temp\\file", "\\\\host\\share", "Form 20-F __X__", "total 5\n=====", "see [27](a)", "a_b_c"]


@pytest.mark.parametrize("text", MARKED)
def test_clean(text):
    assert markup.clean(text) == MARKED[text]


def test_found_and_left_alone(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*MARKED, *PLAIN, None])]
    df = spark.createDataFrame([*rows, rows[0]], "key long, body string, kinds string")
    assert {r.key for r in markup.marked_keys(df, "key", "body").collect()} == set(range(len(MARKED)))
    clean = {r.key: r for r in markup.strip_markup(df, "key", "body").collect()}
    # the envelope goes from unmarked texts as from marked ones, all else stays
    assert all(clean[len(MARKED) + i].clean_text == t.replace("<DOCUMENT>\n<TYPE>8-K\n<TEXT>\n", "") for i, t in enumerate(PLAIN))
    assert clean[len(MARKED) + len(PLAIN)].clean_text is None and clean[len(MARKED) + len(PLAIN)].kinds == []
    assert markup.strip_markup(df.limit(0), "key", "body").count() == 0


def test_long_text(spark):
    df = spark.range(1).select("id", F.concat(F.repeat(F.lit("plain words "), 100_000), F.lit("<br>")).alias("body"))
    assert len(markup.strip_markup(df, "id", "body").first().clean_text) > 1_000_000


PAGES = [
    (1, "https://a.example/x/1.htm", "<html>\n<div>\nSame statement.\nOwn words of one.\n</div>\n</html>"),
    (2, "https://a.example/x/2.htm", "<html>\n<div>\nSame statement.\nOther words.\n</div>\n</html>"),
    (3, "https://a.example/y/1.htm", "Plain page.\nSame statement."),
    (4, "https://b.example/x/1.htm", "<html>\nThe only page of its host."),
    (5, None, "<html>\nNo address."),
    (6, "https://a.example/y/1.html", None),
]


def test_nearest_pages_and_their_frames(spark):
    df = spark.createDataFrame([(*p, "clash") for p in [*PAGES, PAGES[0]]], "key long, url string, body string, mate string")
    near = {r.key: r.mate for r in pages.nearest_pages(df, "key", "url").collect()}
    assert near == {1: 2, 2: 1, 3: 6, 6: 3}
    shared = {r.key: r.shared for r in pages.page_differences(df, "key", "url", "body").collect()}
    assert shared == {1: [0, 1, 2, 4, 5], 2: [0, 1, 2, 4, 5]}
    clean = {r.key: r for r in markup.strip_markup(df, "key", "body", "url").collect()}
    # the frame goes, a statement that two pages share stays
    assert clean[1].frame_lines == 4 and clean[1].clean_text == "Same statement.\nOwn words of one." and clean[4].frame_lines == 0
    assert {r.key for r in markup.marked_keys(df, "key", "body", "url").collect()} == {1, 2, 4, 5}
    assert pages.page_differences(df.limit(0), "key", "url", "body").count() == 0


def test_pages_in_many_partitions(spark):
    """The order doesn't depend on where partitions end."""
    rows = [(i, f"https://a.example/{'x' * (i % 5)}{i:03}", "t") for i in range(200)] + [(i, None, "t") for i in range(200, 210)]
    df = spark.createDataFrame(rows, "key long, url string, body string")
    ordered = sorted(rows[:200], key=lambda r: r[1])
    share = lambda a, b: len(os.path.commonprefix([a[1], b[1]]))
    expected = {}
    for i, row in enumerate(ordered):
        before, after = ordered[i - 1] if i else None, ordered[i + 1] if i < 199 else None
        expected[row[0]] = before[0] if before and (not after or share(before, row) >= share(after, row)) else after[0]
    assert {r.key: r.mate for r in pages.nearest_pages(df, "key", "url").collect()} == expected


def test_common_lines_against_brute_force():
    def longest(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y and x else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        found = pages.common_lines(a, b)
        assert len(found) == longest(a, b) and found == sorted(set(found))
        rest = iter(b)
        assert all(a[i] in rest for i in found)
