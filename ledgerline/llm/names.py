"""Problem 1: variant spellings of names.

Every distinct string is read into a form: what must agree exactly (line of business, or rate,
year and series) and what may be spelled differently (the words of the name). Forms are blocked by
the suffixes of their words. Suffixes are counted over all forms: one that more than COMMON_FORMS
forms have is refined by the other fields (the other words' first letters), and only then discarded
by itself; what is still a large block is paired piece by piece. Pairs of a block are compared word
by word by the ratio of their longest common subsequence. Forms that leave something out (an initial, no middle name) join
the one fuller entity they fit, and none if they fit several. Entities are the components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

from ledgerline.operators.graph import connected_components
from ledgerline.operators.pairing import pairs_within
from ledgerline.plans.lineage import cut

SHORTEST_SUFFIX = 3
#: Letters in which two spellings of an organisation's own words may differ, all words together;
#: and where both spellings are recorded for one owner.
MOST_SLIPS, MOST_SLIPS_OWNED = 2, 3
#: Forms that may share a suffix before it counts as common and is refined by the other fields.
COMMON_FORMS = 64

# Legal forms as they stand at the end of a name, without dots.
LEGAL = set("company co corporation corp inc incorporated llc plc limited ltd lp gmbh ag aktiengesellschaft sa nv partnership".split())
# Words of lines of business, in full.
BUSINESS = set(
    "and bank capital chemical commercial communications credit devices education energy estate finance financial foods fund funding gas group "
    "holdings hospitality industries insurance international investment loan logistics manufacturing markets medical metals mezzanine "
    "mining oil operating partners pharmaceuticals properties real resources savings securities semiconductor services shipping "
    "technologies transportation treasury trust utilities water".split()
)
# Their customary abbreviations, without dots and apostrophes.
SHORT = {
    "&": "and", "bk": "bank", "cap": "capital", "chem": "chemical", "comml": "commercial", "comm": "communications", "comms": "communications",
    "cr": "credit", "dev": "devices", "devs": "devices", "ed": "education", "edu": "education", "educ": "education", "en": "energy", "est": "estate",
    "fdg": "funding", "opg": "operating", "fin": "finance", "finl": "financial", "fd": "fund", "grp": "group", "gp": "group", "hldg": "holdings", "hldgs": "holdings", "holding": "holdings",
    "hosp": "hospitality", "ind": "industries", "inds": "industries", "ins": "insurance", "intl": "international", "int": "international",
    "inv": "investment", "invt": "investment", "ln": "loan", "log": "logistics", "mfg": "manufacturing", "mkt": "markets", "mkts": "markets",
    "med": "medical", "mezz": "mezzanine", "min": "mining", "op": "operating", "oper": "operating", "ptnrs": "partners", "ptrs": "partners", "pharm": "pharmaceuticals",
    "pharma": "pharmaceuticals", "pharms": "pharmaceuticals", "prop": "properties", "props": "properties", "re": "real", "res": "resources", "svgs": "savings", "sav": "savings",
    "sec": "securities", "secs": "securities", "semi": "semiconductor", "semicond": "semiconductor", "svc": "services", "svcs": "services", "serv": "services",
    "ship": "shipping", "shpg": "shipping", "tech": "technologies", "techs": "technologies", "transp": "transportation", "trans": "transportation",
    "treas": "treasury", "tr": "trust", "util": "utilities", "utils": "utilities", "wtr": "water",
}
# First names in full, and what they are shortened to.
FIRST = {
    "alexander": "alex al sandy xander", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben", "catherine": "cathy cate", "charles": "charlie chuck",
    "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave", "deborah": "debbie deb debra", "donald": "don", "dorothy": "dot dottie", "edward": "ed eddie ted ned",
    "elizabeth": "liz beth betty eliza lizzie betsy", "eugene": "gene", "francisco": "paco pancho frank cisco", "frederick": "fred", "gregory": "greg", "henry": "hank harry", "james": "jim jimmy jamie",
    "jennifer": "jen jenny", "john": "jack johnny", "joseph": "joe joey pepe", "katherine": "kathy kate katie kat", "kenneth": "ken", "lawrence": "larry", "margaret": "maggie peggy meg marge",
    "matthew": "matt", "michael": "mike mick mickey", "nicholas": "nick", "patricia": "pat trish patty tricia", "peter": "pete", "rebecca": "becky", "richard": "rick dick rich", "robert": "bob rob bobby bert", "ronald": "ron",
    "samuel": "sam", "stephen": "steve", "susan": "sue susie", "theodore": "theo teddy", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky tori vicki", "walter": "walt", "william": "bill will billy liam",
}
NICK = {short: full for full, shorts in FIRST.items() for short in shorts.split()} | {full: full for full in FIRST}
# Words of instrument names in full, and their abbreviations.
CLASS = set(
    "senior junior secured unsecured subordinated guaranteed convertible first second lien notes bonds debentures term loan bridge delayed draw "
    "revolving credit facility letter line uncommitted agreement due maturing series tranche percent million floating fixed rate exchangeable discount zero coupon perpetual commercial paper".split()
)
CLASS_SHORT = {
    "sr": "senior", "jr": "junior", "sec": "secured", "secd": "secured", "unsec": "unsecured", "sub": "subordinated", "subord": "subordinated", "gtd": "guaranteed", "guar": "guaranteed",
    "conv": "convertible", "cv": "convertible", "st": "first", "nts": "notes", "nt": "notes", "note": "notes", "bds": "bonds", "bd": "bonds", "bond": "bonds", "debs": "debentures", "deb": "debentures", "debenture": "debentures",
    "ln": "loan", "loans": "loan", "bridging": "bridge", "cr": "credit", "fac": "facility", "unc": "uncommitted", "agmt": "agreement", "agreemt": "agreement", "agrmt": "agreement", "ser": "series", "pct": "percent", "mm": "million", "mat": "maturing", "tr": "tranche",
    "per": "", "cent": "", "of": "", "the": "", "in": "", "and": "",
    "rcf": "revolving credit facility", "revolver": "revolving credit facility", "tla": "term loan a", "tlb": "term loan b", "tlc": "term loan c", "ddtl": "delayed draw term loan",
    "lc": "letter credit facility", "l/c": "letter credit facility", "loc": "line credit",
}
#: Words that say nothing about which instrument is meant.
EMPTY = {"agreement", "due", "maturing", "series", "tranche", "percent", "million", "facility"}


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full = state = (1 << len(a)) - 1
    for c in b:
        u = state & at.get(c, 0)
        state = ((state + u) | (state - u)) & full
    return len(a) - state.bit_count()


def lcs_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths; 1 for two empty strings."""
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def slips_between(a: str, b: str) -> int:
    """Letters by which the longer word exceeds the longest common subsequence."""
    return max(len(a), len(b)) - lcs_length(a, b)


def same_word(a: str, b: str, slips: int = 1) -> bool:
    """Whether two words differ by at most `slips` letters dropped, doubled, exchanged or replaced."""
    if a == b:
        return True
    longest = max(len(a), len(b))
    if longest < 3 or abs(len(a) - len(b)) > slips:
        return False
    # a slip takes one letter from the common subsequence
    return lcs_ratio(a, b) >= 2 * (longest - slips) / (len(a) + len(b)) - 1e-9


@lru_cache(maxsize=200_000)
def _nearest(word: str, known: frozenset[str], shortest: int = 4) -> str | None:
    """The one known word that `word` is a slip of; a word of fewer letters than `shortest` is of none."""
    if len(word) < shortest:
        return None
    found = [w for w in known if len(w) >= 4 and same_word(word, w, 1 if len(w) < 9 else 2)]
    return max(found, key=lambda w: (lcs_ratio(word, w), w)) if found else None


_BUSINESS, _FIRST, _CLASS = frozenset(BUSINESS), frozenset(NICK), frozenset(CLASS)
_LEGAL = frozenset(w for w in LEGAL if len(w) > 6)


def _tokens(name: str) -> list[str]:
    """Lower-cased words; dots and apostrophes fall, joined words of mixed case are parted, spelled letters joined."""
    name = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", name) if not name.isupper() and not re.search(r"\b(?:Mc|Mac|De|La|Le)[A-Z]", name) else name
    words = [w for w in re.split(r"[\s,;()/-]+", re.sub(r"[.'’`\"]", lambda m: "." if m[0] == "." else "", name.lower())) if w]
    out: list[str] = []
    for word in words:
        bare = word.replace(".", "")
        if not bare:
            continue
        if word.endswith(".") and len(bare) == 1 and out and out[-1].endswith("\x01") and len(out[-1]) <= 3:
            out[-1] = out[-1][:-1] + bare + "\x01"
        else:
            out.append(bare + ("\x01" if word.endswith(".") and len(bare) == 1 else ""))
    return [w.replace("\x01", "") for w in out]


def _business(word: str) -> str | None:
    if word in BUSINESS:
        return word
    return SHORT.get(word)


def _legal(word: str) -> bool:
    return word in LEGAL or (len(word) > 5 and _nearest(word, _LEGAL) is not None)


def _organisation(name: str) -> tuple[str, list[str]] | None:
    """(line of business, words of the name), or None where no word tells an organisation."""
    text = re.sub(r"(?i)^the\s+", "", name.strip())
    if "," in text:
        head, _, tail = text.rpartition(",")
        tail_words = _tokens(tail)
        if tail_words and not all(_legal(w) for w in tail_words):
            # "Line of Business Form, Own Name"
            text = f"{tail.strip()} {head}"
    words = _tokens(re.sub(r"(?i)^the\s+", "", text))
    legal = False
    while len(words) > 1 and (_legal(words[-1]) or (words[-1] == "v" and words[-2] == "n") or (words[-1] == "a" and words[-2] == "s")):
        legal = True
        if words[-1] in ("v", "a"):
            words.pop()
        words.pop()
    cut_at = len(words)
    while cut_at > 1 and (_business(words[cut_at - 1]) or (cut_at > 2 and _nearest(words[cut_at - 1], _BUSINESS))):
        cut_at -= 1
    line = [_business(w) or _nearest(w, _BUSINESS) or w for w in words[cut_at:]]
    line = ["financial" if w == "finance" and line[i + 1 : i + 2] == ["services"] else w for i, w in enumerate(line)]
    own = words[:cut_at]
    if not own or not (legal or line):
        return None
    return " ".join(line), own


def _person(name: str) -> tuple[str, str, str]:
    """(first, middle, last); "-" where not given."""
    text = re.sub(r"(?i)^\s*(?:mrs?|ms|dr|prof|hon|messrs)\b\.?\s+", "", name)
    text = re.sub(r"(?i)[\s,]+(?:jr|sr|ii|iii|iv|esq)\.?\s*$", "", text)
    head, comma, tail = text.partition(",")
    words = [w.replace(".", "") for w in re.split(r"[\s]+", (f"{tail} {head}" if comma else text).lower().replace("’", "").replace("'", "")) if w.strip(".")]
    letters = [w for w in words if len(w) == 1]
    full = [w for w in words if len(w) > 1]
    if len(full) >= 2:
        known = [i for i, w in enumerate(full) if w in NICK]
        at = known[0] if known else next((i for i, w in enumerate(full) if _nearest(w, _FIRST)), 0)
        if not comma and len(known) > 1:
            at = known[0]
        first = full.pop(at)
        first = NICK.get(first) or NICK.get(_nearest(first, _FIRST) or "", first)
        return first, letters[0] if letters else "-", " ".join(full)
    last = full[0] if full else "-"
    return letters[0] if letters else "-", letters[1] if len(letters) > 1 else "-", last


_FRACTION = re.compile(r"(?<![\d/])(\d{1,2})[ -](\d{1,2})/(\d{1,2})\s*(?:%|per\s?cent\.?|pct\.?)", re.I)
_RATE = re.compile(r"(?<![\d.,])(\d{1,2}(?:\.\d+)?)\s*(?:%|per\s?cent\.?|pct\.?)", re.I)
_SERIES = re.compile(r"\b[A-Za-z]{2,8}\.?\s*(?:no\.?\s*)?#?(\d+[a-z]?)\s*$", re.I)
_AMOUNT = re.compile(r"^\s*(?:[A-Z]{0,4}[^\w\s]{0,2}|[A-Za-z]{1,4}\.?)\s?[\d.,']+\s*(?:thousand|million|billion|crores?|lakhs?|mm|mn|bn)\b", re.I)


def _instrument(name: str) -> tuple[str, list[str]]:
    """("rate|year|series", words of the class, sorted)."""
    text = _AMOUNT.sub(" ", name.strip())
    rate = ""
    if m := _FRACTION.search(text):
        rate = f"{int(m[1]) + int(m[2]) / int(m[3]):.4f}" if int(m[3]) else ""
        text = text.replace(m[0], " ")
    elif m := _RATE.search(text):
        rate = f"{float(m[1]):.4f}"
        text = text.replace(m[0], " ")
    series = ""
    if (m := re.search(r"[,\s]\s*([A-Za-z]{2,8})\.?\s*(?:no\.?\s*)?#?(\d{1,6}[a-z]?)\s*$", text, re.I)) and (CLASS_SHORT.get(m[1].lower()) == "series" or m[1].lower() == "series" or _nearest(m[1].lower(), _CLASS) == "series"):
        series = m[2].lower()
        text = text[: m.start()]
    numbers = sorted(re.findall(r"(?<![\d.])\d+(?:\.\d+)?(?![\d.])", re.sub(r"\b1st\b", "first", text, flags=re.I)))
    text = re.sub(r"\b1st\b", "first", text, flags=re.I).lower().replace("l/c", " lc ")
    words: list[str] = []
    for word in re.findall(r"[a-z]+", re.sub(r"[.'’]", "", text.replace("-", " "))):
        whole = word if word in CLASS or len(word) == 1 else CLASS_SHORT.get(word)
        if whole is None:
            whole = _nearest(word, _CLASS, 3) or next((CLASS_SHORT[s] for s in CLASS_SHORT if len(s) > 3 and len(word) > 2 and same_word(word, s)), word)
        words += whole.split()
    kept = sorted(w for w in words if w not in EMPTY)
    return f"{rate}|{' '.join(numbers)}|{series}", kept


def form(scope: str, name: str) -> tuple[str, str, str]:
    """(kind, what must agree, what may be spelled differently) of a name."""
    if scope != "party":
        sig, words = _instrument(name)
        return "instrument", sig, " ".join(words)
    if own := _organisation(name):
        return "organisation", own[0], " ".join(own[1])
    return "person", "", " ".join(w.replace(" ", "_") for w in _person(name))


def fit(kind: str, a: str, b: str, most_slips: int = MOST_SLIPS) -> int:
    """2: the same name spelled differently; 1: one of the two leaves out what the other has; 0: different."""
    if a == b:
        return 2
    x, y = a.split(" "), b.split(" ")
    if kind == "instrument":
        return 2 if len(x) == len(y) and all(v == w or (v not in CLASS and w not in CLASS and len(v) > 1 and same_word(v, w)) for v, w in zip(x, y, strict=True)) else 0
    if kind == "person":
        weak = 0
        for v, w in zip(x[:2], y[:2], strict=True):
            if v == w:
                continue
            if v == "-" or w == "-" or (1 in (len(v), len(w)) and v[0] == w[0]):
                weak = 1
            elif len(v) == 1 or len(w) == 1 or not same_word(v, w):
                return 0
        return (1 if weak else 2) if same_word(x[2], y[2]) else 0
    best = 0
    for order in (y, y[::-1]) if len(y) == 2 else (y,):
        if len(x) == len(order):
            weak, slips = False, 0
            for v, w in zip(x, order, strict=True):
                if 1 in (len(v), len(w)):
                    if v[0] != w[0]:
                        break
                    weak |= v != w
                else:
                    slips += (own := slips_between(v, w))
                    if own * 2 > max(len(v), len(w)):
                        break
            else:
                if slips <= most_slips - weak:
                    best = max(best, 1 if weak else 2)
        elif {len(x), len(order)} == {1, 2} and min(len(w) for w in (*x, *order)) > 1 and slips_between("".join(x), "".join(order)) <= most_slips:
            best = 2
    return best


def fullness(kind: str, body: str) -> int:
    """How much of its name a form gives; only ever compared between forms of one kind."""
    words = body.split(" ")
    if kind == "person":
        return (2 if len(words[0]) > 1 else int(words[0] != "-")) + (words[1] != "-")
    return sum(len(w) > 1 for w in words) if kind == "organisation" else 0


def block_keys(kind: str, sig: str, body: str) -> list[tuple[str, list[str]]]:
    """(key, refinements): the suffixes of the words of a form, each with the other fields that refine it.

    A slip in a word's last letters spoils all its suffixes, so its first letters and the set of
    its letters (which exchanged letters leave as it is) are keys as well. Rate, year and series,
    or line of business, are part of every key, since they must agree exactly.
    """
    words, keys = body.split(" "), {}

    def add(word: str, others: set[str]) -> None:
        parts = [word[at:] for at in range(len(word) - SHORTEST_SUFFIX + 1)] + [f"^{word[:SHORTEST_SUFFIX]}", f"={''.join(sorted(word))}"]
        for part in parts:
            keys.setdefault(f"{kind[0]}|{sig}|{part}", set()).update(others)

    if kind == "instrument":
        # rate, year and series refine enough; of the words, the last letters do
        found = {f"i|{sig}|{w[-SHORTEST_SUFFIX:]}" for w in words} | {f"i|{sig}|^{w[:2]}" for w in words}
        return [(key, sorted({w[:1] for w in words})) for key in sorted(found)]
    if kind == "person":
        add(words[2], {words[0][0]})
    else:
        for i, word in enumerate(words):
            if len(word) >= SHORTEST_SUFFIX:
                add(word, {o[0] for j, o in enumerate(words) if j != i} or {word[0]})
    return sorted((key, sorted(others)) for key, others in (keys or {f"{kind[0]}|{sig}|{body}": {body[:1]}}).items())


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scopes, names = batch["scope"].to_pylist(), batch["name"].to_pylist()
        read = [form(s, n) for s, n in zip(scopes, names, strict=True)]
        columns = [pa.array([r[i] for r in read], pa.string()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([batch["scope"], batch["name"], *columns], ["scope", "name", "kind", "sig", "body"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("kind", "sig", "body")), strict=True)
        keys = [block_keys(*row) for row in rows]
        at = [i for i, own in enumerate(keys) for _ in own]
        taken = batch.select(["id", "scope", "kind", "body"]).take(pa.array(at, pa.int64()))
        columns = [pa.array([k for own in keys for k, _ in own], pa.string()), pa.array([r for own in keys for _, r in own], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*taken.columns, *columns], ["id", "scope", "kind", "body", "key", "refined"])


def refine_common(keyed: DataFrame, most: int = COMMON_FORMS) -> DataFrame:
    """keyed (id, scope, kind, body, key, refined) without refined: keys that more than `most` forms have give way to their refinements."""
    common = keyed.groupBy("scope", "key").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("scope", "key", F.lit(True).alias("_common"))
    marked = keyed.join(common, ["scope", "key"], "left")
    keys = F.when(F.col("_common"), F.transform("refined", lambda r: F.concat("key", F.lit("|"), r))).otherwise(F.array("key"))
    return marked.select("id", "scope", "kind", "body", F.explode(keys).alias("key"))


@pandas_udf(IntegerType())
def _fit(kind: pd.Series, a: pd.Series, b: pd.Series, owned: pd.Series) -> pd.Series:
    return pd.Series([fit(k, x, y, MOST_SLIPS_OWNED if o else MOST_SLIPS) for k, x, y, o in zip(kind, a, b, owned, strict=True)], dtype="int32")


@pandas_udf(IntegerType())
def _fullness(kind: pd.Series, body: pd.Series) -> pd.Series:
    return pd.Series([fullness(*row) for row in zip(kind, body, strict=True)], dtype="int32")


def link_variants(names: DataFrame) -> DataFrame:
    """(scope, name, entity): every distinct (scope, name) of names with the entity it names.

    scope "party" holds organisations and persons, any other scope the instruments of one issuer.
    Names may carry a column `owner` (an issuer's number or null): two strings that both have
    owners, but none in common, never name one entity. Null or blank names have no entity.
    """
    owned = names.where("name is not null and trim(name) <> '' and scope is not null")
    distinct = owned.select("scope", "name").distinct()
    read = distinct.mapInArrow(_forms, "scope string, name string, kind string, sig string, body string")
    read = cut(read.withColumn("id", F.xxhash64("scope", "kind", "sig", "body")))
    forms = read.groupBy("id", "scope", "kind", "sig", "body").count().drop("count")
    owner = owned.where("owner is not null").select("scope", "name", "owner").distinct().join(read.select("scope", "name", "id"), ["scope", "name"]).select("id", "owner").distinct()
    owners = owner.groupBy("id").agg(F.collect_set("owner").alias("owners"))
    keyed = cut(forms.mapInArrow(_keyed, "id long, scope string, kind string, body string, key string, refined array<string>"))
    # spellings recorded for one owner are compared whatever their suffixes: the owner is the key
    of_owner = forms.join(owner, "id").select("id", "scope", "kind", "body", F.concat(F.lit("owner|"), F.col("owner"), F.lit("|"), F.col("kind"), F.lit("|"), F.col("sig")).alias("key"))
    met = pairs_within(refine_common(keyed).unionByName(of_owner), ["scope", "key"], "id", ["kind", "body"])
    pairs = met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.col("a_kind").alias("kind"), "a_body", "b_body")
    known = (
        pairs.distinct()
        .join(owners.select(F.col("id").alias("a"), F.col("owners").alias("a_owners")), "a", "left")
        .join(owners.select(F.col("id").alias("b"), F.col("owners").alias("b_owners")), "b", "left")
        .withColumn("shared", F.arrays_overlap("a_owners", "b_owners"))
        .where("shared is null or shared")
    )
    vetted = (
        known.withColumn("fit", _fit("kind", "a_body", "b_body", F.coalesce("shared", F.lit(False))))
        .where("fit > 0")
        .withColumn("a_full", _fullness("kind", "a_body"))
        .withColumn("b_full", _fullness("kind", "b_body"))
        .select("a", "b", "fit", "a_full", "b_full")
    )
    vetted = cut(vetted)
    strong = vetted.where("fit = 2").select("a", "b")
    single = forms.select(F.col("id").alias("a"), F.col("id").alias("b"))
    whole = cut(connected_components(strong.unionByName(single), "a", "b"))
    # a form that leaves something out joins the one fuller entity it fits
    turned = vetted.where("fit = 1 and a_full <> b_full").select(
        *(F.when(F.col("a_full") < F.col("b_full"), F.col(x)).otherwise(F.col(y)).alias(n) for x, y, n in (("a", "b", "less"), ("b", "a", "more"))), F.greatest("a_full", "b_full").alias("full")
    )
    of = lambda side: whole.select(F.col("node").alias(side), F.col("component").alias(f"{side}_component"))
    fits = turned.join(of("less"), "less").join(of("more"), "more").where("less_component <> more_component").select("less_component", "more_component", "full").distinct()
    fullest = fits.groupBy("less_component").agg(F.max("full").alias("full"))
    fits = fits.join(fullest, ["less_component", "full"])
    only = fits.groupBy("less_component").agg(F.min("more_component").alias("low"), F.max("more_component").alias("high")).where("low = high")
    joined = whole.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(only.select(F.col("less_component").alias("a"), F.col("low").alias("b")))
    entity = connected_components(joined, "a", "b").select(F.col("node").alias("id"), F.col("component").alias("entity"))
    return read.select("scope", "name", "id").join(entity, "id").select("scope", "name", "entity")


def variant_pairs(linked: DataFrame) -> DataFrame:
    """(scope, name_a, name_b): the different strings of each entity, smaller first."""
    pairs = pairs_within(cut(linked), ["scope", "entity"], "name")
    return pairs.select("scope", F.col("a_name").alias("name_a"), F.col("b_name").alias("name_b"))
