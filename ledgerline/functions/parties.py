"""Column functions on named parties: folded names, role-only texts, lender signatures, disclosure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTIES = "array<struct<role: string, canonical_name: string, kind: string, spans: array<struct<text: string>>>>"

# Legal suffixes that a party's folded name leaves out.
PARTY_SUFFIXES = ("national association", "n a", "na", "inc", "llc", "ltd", "plc", "corp", "corporation", "company", "co")
# Words by which filings refer to a party without naming it: roles, modifiers, pronouns and fillers.
ROLE_WORDS = (
    "administrator affiliate agent bank borrower buyer company dealer debtor entity guarantor holder investor issuer lender noteholder obligor partnership party person purchaser "
    "representative trustee underwriter administrative co collateral credit facility increasing initial issuing lead loan notes original other parent required revolving securities "
    "specified subsidiary successor and as its of our the thereto us we"
).split()
# Legal forms and filler words that don't tell borrowers apart.
BORROWER_FILLERS = "corporation corp incorporated inc company co llc lp llp plc ltd limited na the a an that certain".split()
# How completely lenders are disclosed, from the least telling to the most decisive.
DISCLOSURES = ("none_named", "complete", "collective_present")


def party_text(name: Column) -> Column:
    """A party's name folded for comparison: lower case, letters and digits only, without legal suffixes."""
    words = F.regexp_replace(F.lower(name), r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(words, r"\b(?:" + "|".join(PARTY_SUFFIXES) + r")\b", " "), r"\s+", " "))


def is_role_only(text: Column) -> Column:
    """Whether every word of a text, or its singular, is a role, modifier or pronoun; false for a text without words."""
    folded = F.regexp_replace(F.lower(F.translate(text, "’‘", "''")), r"'s\b|\(s\)", "")
    words = F.regexp_extract_all(folded, F.lit("[a-z]+"), 0)

    def known(word: Column) -> Column:
        singular = F.when(word.endswith("ies"), F.concat(F.regexp_replace(word, "ies$", ""), F.lit("y"))).otherwise(F.regexp_replace(word, "s$", ""))
        return word.isin(ROLE_WORDS) | singular.isin(ROLE_WORDS)

    return (F.size(words) > 0) & F.forall(words, known)


def longest_specific(texts: Column) -> Column:
    """Of an array of texts the longest that names someone, else the longest; the first of equal ones, null for an empty array."""
    ranked = F.transform(texts, lambda t, i: F.struct((~is_role_only(t)).alias("specific"), F.length(t).alias("n"), (-i).alias("i"), t.alias("t")))
    return F.array_max(ranked)["t"]


def lender_keys(parties: Column) -> Column:
    """The folded names of the lenders of parties (PARTIES), sorted; of a lender's spans the longest that names someone counts."""

    def key(party: Column) -> Column:
        folded = F.filter(F.transform(F.filter(party["spans"], lambda s: s["text"].isNotNull()), lambda s: party_text(s["text"])), lambda t: t != "")
        return longest_specific(folded)

    keys = F.transform(F.filter(parties, lambda p: p["role"] == "lender"), key)
    return F.array_sort(F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != ""))))


def signature_of(keys: Column) -> Column:
    """The lenders of lender_keys() that are named, as one text; empty where none is."""
    return F.coalesce(F.array_join(F.filter(keys, lambda k: ~is_role_only(k)), " | "), F.lit(""))


def lender_signature(parties: Column) -> Column:
    """The lenders that are named, as one text; empty where none is."""
    return signature_of(lender_keys(parties))


def canonical_name(texts: Column) -> Column:
    """The longest text that names the party, else the longest; null for an empty array."""
    return longest_specific(texts)


def borrower_keys(parties: Column) -> Column:
    """The borrowers of parties as folded word lists without legal forms; those named by their role only are left out."""

    def key(party: Column) -> Column:
        words = F.filter(F.split(F.regexp_replace(F.lower(party["canonical_name"]), "[^0-9a-z]+", " "), " "), lambda w: (w != "") & ~w.isin(BORROWER_FILLERS))
        return F.array_join(words, " ")

    keys = F.transform(F.filter(parties, lambda p: p["role"] == "borrower"), key)
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "") & ~is_role_only(k)))


def borrowers_disagree(left: Column, right: Column) -> Column:
    """Whether both sides name borrowers, but none in common."""
    return F.coalesce((F.size(left) > 0) & (F.size(right) > 0) & ~F.arrays_overlap(left, right), F.lit(False))


def disclosure_of(lender_kinds: Column) -> Column:
    """How completely an array of lender kinds names who holds the debt."""
    return F.when(F.coalesce(F.size(lender_kinds), F.lit(0)) <= 0, DISCLOSURES[0]).when(F.array_contains(lender_kinds, "collective"), DISCLOSURES[2]).otherwise(DISCLOSURES[1])


def disclosure_rank(value: Column) -> Column:
    """The place of a disclosure in DISCLOSURES; unknown and missing ones count as the first."""
    return F.coalesce(F.array_position(F.array(*(F.lit(d) for d in DISCLOSURES)), F.trim(value)), F.lit(0)).cast("int")


def worst_disclosure(rank: Column) -> Column:
    """An aggregate of disclosure_rank(): the most decisive disclosure of the group."""
    return F.element_at(F.array(*(F.lit(d) for d in DISCLOSURES)), F.greatest(F.lit(1), F.max(rank)).cast("int"))
