"""Problem 6: HTML, Markdown, wiki and LaTeX markup to clean text that keeps its structure.

Three stages. Nearest-URL page differencing (pages.py) finds the lines a page shares with the page
whose URL is nearest; those that hold nothing but markup are its frame and are deleted. Shared lines
with words in them stay: filings share statements, and what is common to two filings isn't residue
(README has the figures of deleting them all). Then Catalyst finds the kinds of markup (one regular
expression per kind, each guarded by a plain search for a character it needs), so that unmarked
texts, the bulk of a corpus, never leave the JVM, and a Python function over Arrow batches converts
marked texts alone. A text counts as marked if that changed anything besides the filing's envelope.

Clean text keeps headings as ``# ...`` lines, list items as ``- ...`` lines, table rows with
`` | `` between cells, code between lines of three back quotes, formulas between ``$`` signs as
written; everything else is plain text. Signs that are ordinary in filings (``$5``, ``R&D``,
``*12``, ``[27]``, ``< 7.50:1.00``, ``Item #33``, ``ex99_17.htm``) stay.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ledgerline.llm.pages import lines, page_differences

# Element names of HTML, and the extension elements wikis allow.
ELEMENTS = (
    "a abbr address area article aside b base big blockquote body br button caption center cite code col colgroup dd del details dfn dir "
    "div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input "
    "ins kbd label legend li link main map mark math menu meta nav nobr noscript nowiki object ol optgroup option p param pre q ref references s "
    "samp script section select small source span strike strong style sub summary sup syntaxhighlight table tbody td textarea tfoot "
    "th thead title tr tt u ul var wbr"
)
_NAMES = "|".join(ELEMENTS.split())
HTML = rf"(?i)<!--|<!doctype|</?(?:{_NAMES})(?:\s[^<>]*)?/?>"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8}[0-9]{0,2});"
MARKDOWN = (
    r"(?m)^\#{1,6}[ \t]+\S|\*\*[^\s*]|!?\[[^\]\n]+\]\((?:https?:|mailto:|/|\#|\.)[^)\s]*\)|```|`[^`\n]+`|^>[ \t]+\S|^\|[^\n]*\|[ \t]*$"
    r"|(?:(?<=\s)|^)\*[A-Za-z][^*\n]*[A-Za-z.]\*(?=\W|$)|~~[^~\n]+~~"
)
# bold by underscores, of more than a letter: a ticked box (__X__) is an ordinary sign
MARKDOWN += r"|(?<![\w_])__[A-Za-z][^_\n]+[^_\s]__(?![\w_])"
WIKI = r"(?m)\[\[[^\]\n]+\]\]|'''?[^'\n]+'''?|\{\{[^}\n]+\}\}|^={2,6}[^=\n]+={2,6}[ \t]*$|^\{\||^\|\}|^\|-(?!-)"
LATEX = r"\\(?:[A-Za-z]+|[\[\]()$%&_#{}\\])|\$\$[^$]+\$\$"

KINDS = {
    "html": (HTML, ("<",)),
    "entity": (ENTITY, ("&",)),
    "markdown": (MARKDOWN, ("#", "*", "](", "`", "> ", "|", "~~", "__")),
    "wiki": (WIKI, ("[[", "''", "{{", "==", "{|", "|")),
    "latex": (LATEX, ("\\", "$$")),
}
#: Paths of files, whose backslashes begin no command.
FILE_PATH = r"(?<![\w\\])(?:[A-Za-z]:\\|\\\\[\w.-]+\\)[^\s\"<>|{}$]*"


def markup_kinds(text: Column) -> Column:
    """array<string> of the kinds of markup in text; empty for none and for null or empty text."""
    found = []
    for kind, (pattern, needs) in KINDS.items():
        guard = F.lit(False)
        for needed in needs:
            guard = guard | F.contains(text, F.lit(needed))
        read = F.when(text.rlike(FILE_PATH), F.regexp_replace(text, FILE_PATH, "")).otherwise(text) if kind == "latex" else text
        found.append(F.when(guard & read.rlike(pattern), F.lit(kind)))
    return F.array_compact(F.array(*found))


_ENVELOPE = re.compile(r"</?(?:DOCUMENT|TEXT|SEQUENCE|FILENAME|DESCRIPTION)>[ \t]*\n?|<TYPE>[^\n<]*\n?|</TYPE>[ \t]*\n?")
_BLOCK = re.compile(r"(?i)</?(?:p|div|section|article|header|footer|body|html|head|center|blockquote|ul|ol|dl|table|tbody|thead|tfoot|form|hr|address)(?:\s[^<>]*)?/?>")
_TAG = re.compile(rf"(?i)</?(?:{_NAMES})(?:\s[^<>]*)?/?>")
_COMMENT = re.compile(r"<!--.*?-->|(?i:<!doctype[^>]*>)", re.S)
_DROPPED = re.compile(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<title\b[^>]*>.*?</title\s*>")
_ENTITY = re.compile(ENTITY)
_PATH = re.compile(FILE_PATH)
# Commands of formulas with arguments, as they stand outside of formula signs.
_FORMULA = re.compile(r"\\(?:[dt]?frac|sqrt|binom|sum|prod|int)(?![A-Za-z])(?:\s*\[[^\]\n]*\])?(?:[_^](?:\{(?:[^{}]|\{[^{}]*\})*\}|\w)|\s*\{(?:[^{}]|\{[^{}]*\})*\})*")
_KEEP = re.compile("\x00(\\d+)\x00")


class _Held:
    """Code and formulas set aside while the rest is converted."""

    def __init__(self) -> None:
        self.parts: list[str] = []

    def put(self, part: str) -> str:
        self.parts.append(part)
        return f"\x00{len(self.parts) - 1}\x00"

    def back(self, text: str) -> str:
        while _KEEP.search(text):
            text = _KEEP.sub(lambda m: self.parts[int(m[1])], text)
        return text


def _code(body: str) -> str:
    return "\n```\n" + body.strip("\n") + "\n```\n"


def _formula(body: str) -> str:
    return "$" + body.strip() + "$"


def _html(text: str, held: _Held) -> str:
    text = _DROPPED.sub("", _COMMENT.sub("", text))
    text = re.sub(r"(?is)<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>)?\s*</pre\s*>|<syntaxhighlight\b[^>]*>(.*?)</syntaxhighlight\s*>", lambda m: held.put(_code(html.unescape(_TAG.sub("", m[1] or m[2] or "")))), text)
    text = re.sub(r"(?is)<math\b[^>]*>(.*?)</math\s*>", lambda m: held.put(_formula(m[1])), text)
    text = re.sub(r"(?is)<ref\b[^>]*?/>|<ref\b[^>]*>.*?</ref\s*>", "", text)
    text = re.sub(r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1\s*>", lambda m: "\n\n" + "#" * int(m[1]) + " " + " ".join(_TAG.sub("", m[2]).split()) + "\n\n", text)
    text = re.sub(r"(?i)<br\s*/?>", "\n", text)
    text = re.sub(r"(?i)\s*<li\b[^>]*>\s*", "\n- ", text)
    text = re.sub(r"(?i)</li\s*>\s*", "\n", text)
    text = re.sub(r"(?i)\s*<tr\b[^>]*>\s*(?:<t[dh]\b[^>]*>[ \t]*)?", "\n", text)
    text = re.sub(r"(?i)[ \t]*</t[dhr]\s*>", "", text)
    text = re.sub(r"(?i)\s*<t[dh]\b[^>]*>\s*", " | ", text)
    text = _BLOCK.sub("\n\n", text)
    return _TAG.sub("", text)


def _latex(text: str, held: _Held) -> str:
    if "\\begin{document}" in text:
        text = text[text.index("\\begin{document}") + len("\\begin{document}"):]
    text = text.replace("\\end{document}", "")
    text = re.sub(r"(?m)(?<!\\)%[^\n]*$", "", text) if "\\begin" in text or "\\section" in text else text
    text = re.sub(r"\\begin\{(?:verbatim|lstlisting)\}(?:\[[^\]\n]*\])?(.*?)\\end\{(?:verbatim|lstlisting)\}", lambda m: held.put(_code(m[1])), text, flags=re.S)
    text = re.sub(r"\\begin\{(?:equation|align|displaymath|math)\*?\}(.*?)\\end\{(?:equation|align|displaymath|math)\*?\}", lambda m: held.put(_formula(m[1])), text, flags=re.S)
    text = re.sub(r"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)", lambda m: held.put(_formula(m[1] or m[2] or m[3])), text, flags=re.S)
    text = re.sub(r"(?<!\\)\$([^$\n]*\\[A-Za-z][^$\n]*)\$", lambda m: held.put(_formula(m[1])), text)
    text = _PATH.sub(lambda m: held.put(m[0]), text)
    text = _FORMULA.sub(lambda m: held.put(_formula(m[0])), text)
    text = re.sub(r"\\begin\{tabular\}(?:\{[^}]*\})?(.*?)\\end\{tabular\}", lambda m: "\n" + re.sub(r"\s*(?<!\\)&\s*", " | ", re.sub(r"\\hline", "", m[1])).replace("\\\\", "\n") + "\n", text, flags=re.S)
    text = re.sub(r"\\(?:label|ref|cite|documentclass|usepackage|vspace|hspace|pagestyle|bibliography)\*?(?:\[[^\]\n]*\])?\{[^{}]*\}", "", text)
    for level, name in enumerate(("chapter", "section", "subsection", "subsubsection"), 0):
        text = re.sub(rf"\\{name}\*?\{{([^{{}}]*)\}}", lambda m, level=level: "\n\n" + "#" * max(1, level) + " " + m[1] + "\n\n", text)
    text = re.sub(r"[ \t]*\\item(?:\[[^\]\n]*\])?[ \t]*", "\n- ", text)
    text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]\n]*\])?", "\n", text)
    previous = None
    while previous != text:
        previous = text
        text = re.sub(r"\\(?:text(?:bf|it|tt|sc|rm|sf)|emph|underline|mbox|footnote|href\{[^{}]*\}|url)\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\(?:noindent|newline|newpage|clearpage|maketitle|hline|par|centering|bigskip|medskip|smallskip|quad|qquad)\b[ \t]*", "", text)
    text = re.sub(r"\\\\(?:\[[^\]\n]*\])?", "\n", text)
    text = re.sub(r"\\([$%&_#{}])", r"\1", text)
    return re.sub(r"\\[A-Za-z]+\*?(?:\{([^{}]*)\})?", lambda m: m[1] or "", text)


def _wiki(text: str, held: _Held) -> str:
    text = re.sub(r"\[\[(?:Category|File|Image|Media)\s*:[^\]\n]*\]\]", "", text, flags=re.I)
    before = None
    while before != text:
        # templates within templates go from the inside out
        before, text = text, re.sub(r"\{\{[^{}]*\}\}", "", text)

    def rows(m: re.Match[str]) -> str:
        lines = []
        for row in re.split(r"(?m)^\|-.*$", m[1]):
            cells = [c.strip() for line in row.split("\n")[0 if row.startswith("\n") else 1:] for c in re.split(r"\|\||!!", re.sub(r"^[|!]\+?", "", line.strip())) if line.strip()]
            lines.append(" | ".join(cells))
        return "\n" + "\n".join(x for x in lines if x) + "\n"

    text = re.sub(r"(?ms)^\{\|(.*?)^\|\}", rows, text)
    text = re.sub(r"\[\[(?:[^|\]\n]*\|)?([^\]\n]*)\]\]", r"\1", text)
    text = re.sub(r"\[https?://\S+ ([^\]\n]+)\]", r"\1", text)
    text = re.sub(r"(?m)^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "#" * (len(m[1]) - 1) + " " + m[2], text)
    text = re.sub(r"'''?((?:[^'\n]|'(?!'))+)'''?", r"\1", text)
    return re.sub(r"(?m)^\*+[ \t]+", "- ", text)


def _markdown(text: str, held: _Held) -> str:
    text = re.sub(r"```[^\n`]*\n(.*?)```", lambda m: held.put(_code(m[1])), text, flags=re.S)
    text = re.sub(r"`([^`\n]+)`", r"\1", text)
    text = re.sub(r"!?\[([^\]\n]+)\]\((?:https?:|mailto:|/|#|\.)[^)\s]*\)", r"\1", text)
    text = re.sub(r"\*\*([^*\n]+)\*\*", r"\1", text)
    text = re.sub(r"\*\*(?=\S)|(?<=\S)\*\*", "", text)
    text = re.sub(r"(?<![\w*])\*([A-Za-z][^*\n]*[A-Za-z.])\*(?![\w*])", r"\1", text)
    text = re.sub(r"(?<![\w_])__([A-Za-z][^_\n]+[^_\s])__(?![\w_])", r"\1", text)
    text = re.sub(r"(?<![\w_])_([A-Za-z][^_\n]*[A-Za-z.])_(?![\w_])", r"\1", text)
    text = re.sub(r"!?\[([^\]\n]+)\]\([\w./-]+\.[A-Za-z]{2,5}(?:#[\w-]*)?\)", r"\1", text)
    if "====" in text:
        text = re.sub(r"(?m)^(?=[^\n]*[A-Za-z])([^\n]+)\n={4,}[ \t]*$", r"# \1", text)
    text = re.sub(r"~~([^~\n]+)~~", r"\1", text)
    text = re.sub(r"(?m)^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*\n?", "", text)
    text = re.sub(r"(?m)^\|[ \t]*([^\n]*?)[ \t]*\|[ \t]*$", lambda m: re.sub(r"[ \t]*\|[ \t]*", " | ", m[1]), text)
    text = re.sub(r"(?m)^>[ \t]?", "", text)
    return re.sub(r"(?m)^[*+][ \t]+(?=\S)", "- ", text)


def clean(text: str | None, kinds: list[str] | None = None) -> str | None:
    """The clean text. kinds limits the work to those kinds of markup; by default all are tried."""
    if text is None:
        return None
    wanted = set(KINDS) if kinds is None else set(kinds)
    held = _Held()
    text = _ENVELOPE.sub("", text.replace("\x00", ""))
    if "markdown" in wanted:
        text = re.sub(r"```[^\n`]*\n(.*?)```", lambda m: held.put(_code(m[1])), text, flags=re.S)
    if "html" in wanted:
        text = _html(text, held)
    if "latex" in wanted:
        text = _latex(text, held)
    if "wiki" in wanted:
        text = _wiki(text, held)
    if "markdown" in wanted:
        text = _markdown(text, held)
    if "entity" in wanted:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text).replace("\xa0", " ")
    return _finished(held.back(text)) if wanted else text


def _finished(text: str) -> str:
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


#: The markup clean text keeps: headings, code and formulas as they are written in it.
_STRUCTURE = re.compile(r"(?m)^#{1,6}[ \t]+\S|^```|\$[^$\n]*\\[^$\n]*\$")
_CLEANED = StructType([StructField("clean_text", StringType()), StructField("changed", BooleanType())])


@pandas_udf(_CLEANED)
def _clean_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, kinds in batches:
        cleaned = [None if t is None else clean(t, list(k)) for t, k in zip(texts, kinds, strict=True)]
        changed = [c is not None and (_STRUCTURE.search(c) is not None or c != _finished(_ENVELOPE.sub("", t))) for c, t in zip(cleaned, texts, strict=True)]
        yield pd.DataFrame({"clean_text": pd.Series(cleaned, dtype=object), "changed": pd.Series(changed, dtype=bool)})


def without_envelope(text: Column) -> Column:
    """A text without the tags of a filing's envelope."""
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, _ENVELOPE.pattern, "")).otherwise(text)


#: A line that holds nothing but tags, comments and commands.
_FRAME = rf"(?i)^\s*(?:(?:<!--.*?-->|<!doctype[^>]*>|</?(?:{_NAMES})(?:\s[^<>]*)?/?>|\\(?:begin|end|documentclass|usepackage|maketitle)\b(?:\[[^\]]*\])?(?:\{{[^{{}}]*\}})?)\s*)+$"


def page_frames(df: DataFrame, key: str, url: str, text: str) -> DataFrame:
    """(key, frame): the numbers of the lines of nothing but markup that a page shares with its nearest page; pages without any have no row."""
    bare = F.filter(F.transform(lines(F.col(text)), lambda line, i: F.when(line.rlike(_FRAME), i)), lambda i: i.isNotNull())
    marked = df.where(F.contains(text, F.lit("<")) | F.contains(text, F.lit("\\"))).select(F.col(key), bare.alias("_bare")).where("size(_bare) > 0")
    shared = page_differences(df, key, url, text).where("size(shared) > 0").select(key, "shared")
    return marked.join(shared, key).select(key, F.array_sort(F.array_intersect("shared", "_bare")).alias("frame")).where("size(frame) > 0").dropDuplicates([key])


def strip_markup(df: DataFrame, key: str, text: str, url: str | None = None) -> DataFrame:
    """(key, kinds, frame_lines, changed, clean_text): one row per row of df.

    With url, the frame a page shares with its nearest page is deleted first (frame_lines counts
    its lines). changed says whether the text held markup: frame lines, or what its conversion took
    out or kept as structure. Unmarked texts lose a filing's envelope and are otherwise as they were; null stays null
    with no kinds; an empty text stays empty. Columns of df other than key, text and url are ignored.
    """
    base = df.select(F.col(key).alias(key), F.col(text).alias("_text"))
    seen = base.withColumn("kinds", F.coalesce(markup_kinds(F.col("_text")), F.array().cast("array<string>")))
    if url is None:
        framed = seen.withColumn("frame", F.array().cast("array<int>"))
    else:
        framed = seen.join(page_frames(df.select(key, text, url), key, url, text), key, "left").withColumn("frame", F.coalesce("frame", F.array().cast("array<int>")))
    rest = F.array_join(F.filter(lines(F.col("_text")), lambda line, i: ~F.array_contains("frame", i)), "\n")
    framed = framed.withColumn("frame_lines", F.size("frame")).withColumn("_text", F.when(F.size("frame") > 0, rest).otherwise(F.col("_text"))).drop("frame")
    # unmarked texts go by as nulls: kinds are found once, and only marked texts reach Python
    marked = F.size("kinds") > 0
    cleaned = framed.withColumn("c", _clean_batches(F.when(marked, F.col("_text")), F.when(marked, F.col("kinds"))))
    changed = F.coalesce("c.changed", F.lit(False)) | (F.col("frame_lines") > 0)
    return cleaned.select(key, "kinds", "frame_lines", changed.alias("changed"), F.when(marked, F.col("c.clean_text")).otherwise(without_envelope(F.col("_text"))).alias("clean_text"))


def marked_keys(df: DataFrame, key: str, text: str, url: str | None = None) -> DataFrame:
    """(key): rows whose text strip_markup() finds to hold markup: a shared frame, or something its conversion took out or kept as structure."""
    return strip_markup(df, key, text, url).where("changed").select(key).distinct()
