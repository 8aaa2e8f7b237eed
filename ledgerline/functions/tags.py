"""Text with inline evidence tags: plain text with offsets, realignment, and spans of values."""

from __future__ import annotations

import re
from html import unescape

_TAG = re.compile(r"<(/?)([A-Za-z_][\w.-]*)((?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(/?)>")
_ID = re.compile(r"\bid\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def parse_tagged(tagged: str) -> tuple[str, dict[str, dict]]:
    """(plain text, tag id -> {type, text, char_start, char_end}); offsets are half-open code points of the plain text.

    Raises ValueError where tags aren't nested or an id comes twice.
    """
    parts: list[str] = []
    size, at = 0, 0
    open_tags: list[tuple[str, str | None, int]] = []
    found: dict[str, dict] = {}
    plain = ""
    for m in _TAG.finditer(tagged):
        piece = unescape(tagged[at : m.start()])
        parts.append(piece)
        size += len(piece)
        at = m.end()
        if m[1]:
            if not open_tags or open_tags[-1][0] != m[2]:
                raise ValueError(f"</{m[2]}> closes nothing")
            kind, own, start = open_tags.pop()
            if own is not None:
                if own in found:
                    raise ValueError(f"{own} comes twice")
                found[own] = {"type": kind, "char_start": start, "char_end": size}
        elif not m[4]:
            own = _ID.search(m[3])
            open_tags.append((m[2], (own[1] or own[2]) if own else None, size))
    if open_tags:
        raise ValueError(f"<{open_tags[-1][0]}> isn't closed")
    parts.append(unescape(tagged[at:]))
    plain = "".join(parts)
    for tag in found.values():
        tag["text"] = plain[tag["char_start"] : tag["char_end"]]
    return plain, found


def realign(tags: dict[str, dict], plain: str, original: str) -> dict[str, dict]:
    """tags with offsets into original, which differs from plain in white space only; ValueError if it differs otherwise."""
    ours, theirs = ([i for i, c in enumerate(t) if not c.isspace()] for t in (plain, original))
    if [plain[i] for i in ours] != [original[i] for i in theirs]:
        raise ValueError("the texts differ in more than white space")
    place = dict(zip(ours, theirs, strict=True))
    moved = {}
    for own, tag in tags.items():
        inside = [place[i] for i in range(tag["char_start"], tag["char_end"]) if i in place]
        start, end = (inside[0], inside[-1] + 1) if inside else (0, 0)
        moved[own] = {**tag, "char_start": start, "char_end": end, "text": original[start:end]}
    return moved


def verdict_problems(verdict: object, snippets: int) -> list[str]:
    """What keeps a verdict on numbered snippets from being a partition of them; empty for a sound one.

    Sound: {"kept": [...], "duplicates": [{"index": i, "covered_by": k}], "no_details": [...]} in
    which every number from 0 comes once and covered_by names a kept one.
    """
    if not isinstance(verdict, dict):
        return ["not an object"]
    problems = [f"{key} isn't a list" for key in ("kept", "duplicates", "no_details") if not isinstance(verdict.get(key, []), list)]
    if problems:
        return problems
    kept, rest, pairs = verdict.get("kept", []), verdict.get("no_details", []), verdict.get("duplicates", [])
    if not all(isinstance(p, dict) and {"index", "covered_by"} <= p.keys() for p in pairs):
        return ["a duplicate lacks index or covered_by"]
    named = [*kept, *rest, *(p["index"] for p in pairs)]
    if not all(isinstance(n, int) and not isinstance(n, bool) and 0 <= n < snippets for n in [*named, *(p["covered_by"] for p in pairs)]):
        return ["a number is none of the snippets"]
    problems += [f"{n} comes twice" for n in sorted({n for n in named if named.count(n) > 1})]
    problems += [f"{n} is missing" for n in range(snippets) if n not in named]
    problems += [f"{p['index']} is covered by {p['covered_by']}, which isn't kept" for p in pairs if p["covered_by"] not in kept]
    return problems


def merge_spans(spans: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Overlapping or touching spans merged in order, while a merged span stays within `most` characters."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1] and max(end, merged[-1][1]) - merged[-1][0] <= most:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged
