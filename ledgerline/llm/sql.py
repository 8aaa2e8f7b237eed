"""DuckDB SQL for the queries of this subpackage that SQL can express.

Regular expressions there know no look-around, so patterns take in the characters beside a match.
"""

from __future__ import annotations

from ledgerline.llm import lookalikes, markup

_quoted = lambda text: "'" + text.replace("'", "''") + "'"

_RECORDS = """select 'document' record_kind, cast(doc_id as varchar) record_key, text from documents
    union all select 'snippet', item_id, text from sixk_snippets"""


def _looks(column: str) -> str:
    """The form of a text in which look-alikes are equal."""
    done = f"translate({column}, {_quoted(''.join(lookalikes.SINGLE) + lookalikes.INVISIBLE)}, {_quoted(''.join(lookalikes.SINGLE.values()))})"
    for one, letters in lookalikes.SEVERAL.items():
        done = f"replace({done}, '{one}', '{letters}')"
    return f"nfc_normalize({done})"


# White space as it parts words: that of any script.
_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

_MARKDOWN = (
    r"(?m)^#{1,6}[ \t]+\S|\*\*[^\s*]|!?\[[^\]\n]+\]\((?:https?:|mailto:|/|#|\.)[^)\s]*\)|```|`[^`\n]+`|^>[ \t]+\S|^\|[^\n]*\|[ \t]*$"
    r"|(?:\s|^)\*[A-Za-z][^*\n]*[A-Za-z.]\*(?:\W|$)|~~[^~\n]+~~|(?:^|[^\w])__[A-Za-z][^_\n]+[^_\s]__(?:[^\w]|$)"
)
_WIKI = r"(?m)\[\[[^\]\n]+\]\]|'''?[^'\n]+'''?|\{\{[^}\n]+\}\}|^={2,6}[^=\n]+={2,6}[ \t]*$|^\{\||^\|\}|^\|-(?:[^-]|$)"
_PATH = r"""(^|[^\w\\])(?:[A-Za-z]:\\|\\\\[\w.-]+\\)[^\s"<>|{}$]*"""

SQL = {
    "p3_found": f"""
        with r as (select distinct record_kind, record_key, case record_kind when 'document' then {_looks('text')} else text end as t from ({_RECORDS}) where text is not null),
        w as (select record_kind, record_key, list_filter(string_split_regex(lower(t), '{_SPACE}'), lambda x: x <> '') w from r),
        s as (select distinct record_kind, record_key, array_to_string(w[i:i + 2], ' ') run from (select record_kind, record_key, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) i from w)),
        n as (select record_kind, record_key, count(*) n from s group by 1, 2),
        c as (select a.record_kind, a.record_key key_a, b.record_key key_b, count(*) common from s a join s b on a.record_kind = b.record_kind and a.run = b.run and a.record_key < b.record_key group by 1, 2, 3)
        select c.record_kind, key_a, key_b from c join n x on x.record_kind = c.record_kind and x.record_key = key_a join n y on y.record_kind = c.record_kind and y.record_key = key_b
        where common / (x.n + y.n - common) >= 0.7""",
    "p4_found": f"""
        with r as ({_RECORDS})
        select distinct r.record_kind, r.record_key from r join size_limits s on s.record_kind = r.record_kind and s.purpose = 'split'
        where length(r.text) > s.max_size""",
    "p6_found": f"""
        select distinct doc_id from documents where regexp_matches(text, {_quoted(markup.HTML)}) or regexp_matches(text, {_quoted(markup.ENTITY)}) or regexp_matches(text, {_quoted(_MARKDOWN)})
        or regexp_matches(text, {_quoted(_WIKI)}) or regexp_matches(regexp_replace(text, {_quoted(_PATH)}, '\\1', 'g'), {_quoted(markup.LATEX)})""",
    "p9_found": f"""
        with f as (select distinct doc_id, text, {_looks('text')} form from documents where text is not null)
        select distinct a.doc_id doc_id_a, b.doc_id doc_id_b from f a join f b on a.form = b.form and a.text <> b.text and a.doc_id < b.doc_id""",
    "p9_canonical": f"select doc_id, {_looks('text')} canonical from documents",
}
