"""Clustering the mentions of one block in order: refusals, ways to belong, and what becomes of a tie.

The rules are data. A cluster is a table of what its members have shown (field -> set of values);
REFUSALS lists the reasons a mention can't belong to a cluster, WAYS the reasons it can, each a
small function of a mention and a cluster. They run in the order they stand in.
"""

from __future__ import annotations

import difflib
import hashlib
import json
from collections import defaultdict
from collections.abc import Callable

#: Scores: what counts as certain, what is worth an edge, how near rivals come, what lenders must have in common.
STRONG, LOOSE, MARGIN, LENDER_SUPPORT = 0.90, 0.75, 0.05, 0.5
#: Mentions of an issuer that may share a name before it says nothing by itself.
CLASS_GATE = 2

Mention = dict
Names = frozenset | set


class Cluster:
    """What the members of a cluster have shown."""

    def __init__(self, name: str, seed: tuple) -> None:
        self.name, self.seed = name, seed
        self.shown: dict[str, set] = defaultdict(set)

    def has(self, field: str, value: object) -> bool:
        return value is not None and value in self.shown[field]

    def contradicts(self, field: str, value: object) -> bool:
        """Whether the cluster has shown other values than this one only; a missing value contradicts nothing."""
        return value is not None and bool(self.shown[field]) and value not in self.shown[field]

    def admit(self, m: Mention) -> None:
        shown = self.shown
        for field in ("amount", "start", "end"):
            if m[field] is not None:
                shown[field].add(m[field])
        shown["member"].add(m["mention_id"])
        shown["item"].add(m["item_id"])
        shown["target"].update(pointers(m))
        if m["lenders"]:
            shown["lenders"].add(m["lenders"])
        if m["terminal"] or m["retired_by"]:
            shown["retired"].add(True)
        # a synthesized state has another mention's name and rate
        if m["synthesized_by"] is None:
            shown["coupon"].update(m["coupons"])
            if m["fingerprint"]:
                shown["name"].add(m["fingerprint"])
                shown["said"].add((m["item_id"], m["fingerprint"], m["amount"], m["start"]))
                if m["identifies"]:
                    shown["identified"].add(True)


def pointers(m: Mention) -> set[str]:
    """The mentions this one names as others than itself."""
    return {x for x in (m["amendment_of"], m["split_of"], *m["retired_by"]) if x}


def sort_key(m: Mention) -> tuple:
    return (m["date"] or "", m["accession_number"] or "", m["item_id"] or "", 0 if m["synthesized_by"] else 1, m["mention_id"])


def mint_id(cik: str, seed: tuple) -> str:
    """An id made of the issuer and the seed alone: the same cluster, the same id, in any run."""
    return "di::" + hashlib.sha256(json.dumps([cik, list(seed)]).encode()).hexdigest()[:24]


# -- refusals -----------------------------------------------------------------------------------


def _said_again(m: Mention, c: Cluster) -> bool:
    """Whether m repeats a member: the same item gave the same telling name, with no other amount or start."""
    if m["synthesized_by"] is not None or not m["identifies"]:
        return False
    free = lambda own, other: own is None or other is None or own == other
    return any(item == m["item_id"] and name == m["fingerprint"] and free(m["amount"], amount) and free(m["start"], start) for item, name, amount, start in c.shown["said"])


def _same_item(m: Mention, c: Cluster) -> bool:
    return m["item_id"] in c.shown["item"] and not _said_again(m, c)


def _points_in(m: Mention, c: Cluster) -> bool:
    return not c.shown["member"].isdisjoint(pointers(m))


def _pointed_at(m: Mention, c: Cluster) -> bool:
    return m["mention_id"] in c.shown["target"]


def _other_end(m: Mention, c: Cluster) -> bool:
    """Ends of year, month or day precision agree if one begins with the other."""
    ends, own = c.shown["end"], m["end"]
    return bool(ends) and own is not None and not any(own.startswith(e) or e.startswith(own) for e in ends)


def _other_coupon(m: Mention, c: Cluster) -> bool:
    return bool(m["coupons"]) and bool(c.shown["coupon"]) and c.shown["coupon"].isdisjoint(m["coupons"])


REFUSALS: tuple[Callable[[Mention, Cluster], bool], ...] = (_same_item, _points_in, _pointed_at, _other_end, _other_coupon)


# -- ways to belong -----------------------------------------------------------------------------


def _by_keys(m: Mention, c: Cluster, named: bool) -> tuple[float, str] | None:
    """Amount and start date agree; lenders in common or a compatible name make it certain."""
    if not (c.has("amount", m["amount"]) and c.has("start", m["start"])):
        return None
    support = {"": 0.0}
    lenders = m.get("borrowed") or m["lenders"]
    if lenders and (named or not m["fingerprint"] or not c.shown["name"]):
        alike = max((round(difflib.SequenceMatcher(None, lenders, own).ratio(), 4) for own in c.shown["lenders"]), default=0.0)
        if alike >= LENDER_SUPPORT:
            support["+lenders"] = alike
    if named:
        support["+name"] = 1.0
    # of equal supports the first found counts
    way = max(support, key=lambda w: (support[w], w == "+lenders"))
    return round(min(1.0, LOOSE + (1 - LOOSE) * support[way]), 4), f"amount_start{way}"


def _by_name(m: Mention, c: Cluster, named: bool) -> tuple[float, str] | None:
    """The name is compatible and tells the instrument, or is rare enough with a key that agrees and none that doesn't."""
    if not named:
        return None
    if m["identifies"]:
        return None if c.shown["name"] and not c.shown["identified"] else (STRONG, "name_fingerprint")
    agrees = any(c.has(f, m[f]) for f in ("amount", "start", "end"))
    if m["class_size"] > CLASS_GATE or not agrees or any(c.contradicts(f, m[f]) for f in ("amount", "start")):
        return None
    return STRONG, "name_fingerprint"


def score(m: Mention, c: Cluster, names: Names) -> tuple[float, str] | None:
    """(score, way) of a mention for a cluster; None where something refuses it or nothing speaks for it."""
    if any(refuses(m, c) for refuses in REFUSALS):
        return None
    named = not c.shown["name"].isdisjoint(names)
    return _by_keys(m, c, named) or _by_name(m, c, named)


# -- resolution ---------------------------------------------------------------------------------

Candidate = tuple[float, str, Cluster]


def resolve(m: Mention, found: list[Candidate]) -> tuple[Candidate | None, str, list[Candidate]]:
    """(home, kind of the other edges, their candidates) of a mention's candidates, best first.

    A strong candidate without a rival within the margin is the home. Rivals that are all matched by
    name alone are told apart by exact name, being alive, size and age; any other tie stays open.
    """
    strong = [f for f in found if f[0] >= STRONG]
    if not strong:
        return None, "related", [f for f in found if f[0] >= LOOSE]
    near = [f for f in strong if strong[0][0] - f[0] <= MARGIN]
    if len(near) == 1:
        return near[0], "related", [f for f in found[1:] if f[0] >= LOOSE]
    if any(f[1] != "name_fingerprint" for f in near):
        return None, "ambiguous_candidate", strong
    home, *others = sorted(near, key=lambda f: (m["fingerprint"] not in f[2].shown["name"], bool(f[2].shown["retired"]), -len(f[2].shown["member"]), f[2].seed))
    return home, "ambiguous_candidate", others


def cluster_block(rows: list[Mention], compatible: Callable[[str], Names]) -> list[tuple[str, str, str, float, int, str]]:
    """(mention, cluster, edge type, score, rank, way) of one block's mentions; clusters are named by their seeds' mentions.

    compatible gives the fingerprints that can name the same instrument as one, itself included.
    """
    edges = []
    # only clusters that share amount and start date, or hold a compatible name, can be candidates
    by_key: dict[tuple, dict[str, Cluster]] = defaultdict(dict)
    by_name: dict[str, dict[str, Cluster]] = defaultdict(dict)
    for m in sorted(rows, key=sort_key):
        names = compatible(m["fingerprint"]) if m["fingerprint"] else frozenset()
        keyed = m["amount"] is not None and m["start"] is not None
        within: dict[str, Cluster] = {}
        if keyed or m["identifies"] or m["class_size"] <= CLASS_GATE:
            within |= by_key.get((m["amount"], m["start"]), {})
            for name in names:
                within |= by_name.get(name, {})
        found = sorted(((*got, c) for c in within.values() if (got := score(m, c, names))), key=lambda f: (-f[0], f[2].seed))
        home, kind, others = resolve(m, found)
        if home:
            cluster = home[2]
            edges.append((m["mention_id"], cluster.name, "member", home[0], 1, f"member:{home[1]}"))
        else:
            cluster = Cluster(m["mention_id"], sort_key(m))
            edges.append((m["mention_id"], cluster.name, "member", 1.0, 1, "member:seed"))
        label = kind.removesuffix("_candidate")
        edges += [(m["mention_id"], c.name, kind, value, rank, f"{label}:{way}") for rank, (value, way, c) in enumerate(others, 2 if home else 1)]
        cluster.admit(m)
        for amount in cluster.shown["amount"]:
            for start in cluster.shown["start"]:
                by_key[amount, start][cluster.name] = cluster
        if m["fingerprint"] in cluster.shown["name"]:
            by_name[m["fingerprint"]][cluster.name] = cluster
    return edges
