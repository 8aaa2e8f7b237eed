import pytest

from ledgerline.llm import names

SAME = [
    ("party", "Femuger Favan Communications plc", ["FEMUGER FAVAN COMMUNICATIONS PLC", "Femuger F. Communications", "Femuger-Favan Communications P.L.C.", "The Femuger Favna Comm's plc", "Communications plc, Femuger Favan", "FemugerFavan Communications", "Favan Femuger Communications plc"]),
    ("party", "Francisco S. Binonta", ["Binonta, Francisco S.", "F. S. Binonta", "Paco Binonta", "Binonta Francisco S.", "Mr. Francisco Binonta", "FRANCISCO S BINONTA", "Franciuco S. Binonta"]),
    ("0000000001", "4.625% Senior Unsecured Debentures due 2039, Series 32", ["Sr. Unsec. Debs. 4 5/8% due 2039 Ser. 32", "2039 4.625 percent Senior Unsecured Deebs., Series 32", "$45 million 4.625% Senior Unsecured Debentures due 2039, Series 32"]),
    ("0000000001", "2019 Term Loan A Agreement", ["TLA Agmt. (2019)", "Term A Loan Agreement of 2019", "Tranche A Term Loan Agreemt (2019)"]),
]
OTHERS = [
    ("party", "Femuger Favan Capital plc"), ("party", "Femuger Bodusan Communications plc"), ("party", "Margaret S. Binonta"), ("party", "Francisco H. Nadame"),
    ("0000000001", "4.625% Senior Secured Debentures due 2039, Series 32"), ("0000000001", "4.625% Senior Unsecured Debentures due 2039, Series 33"), ("0000000001", "2019 Term Loan B Agreement"), ("0000000002", "2019 Term Loan A Agreement"),
]


def test_variants_are_linked_and_others_are_not(spark):
    rows = [(s, n, None) for s, first, more in SAME for n in (first, *more)] + [(s, n, None) for s, n in OTHERS] + [("party", None, None), ("party", " ", None), (None, "x", None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows + rows[:2]], "scope string, name string, owner string, entity string")
    found = {(r.scope, r.name): r.entity for r in names.link_variants(df).collect()}
    for scope, first, more in SAME:
        assert {found[scope, n] for n in more} == {found[scope, first]}
    lone = [found[o] for o in OTHERS]
    assert len(set(lone)) == len(lone) and not set(lone) & {found[s, f] for s, f, _ in SAME}
    pairs = names.variant_pairs(names.link_variants(df)).collect()
    assert len(pairs) == sum(len(m) * (len(m) + 1) // 2 for _, _, m in SAME) and all(r.name_a < r.name_b for r in pairs)


def test_a_form_that_fits_several_entities_joins_none(spark):
    df = spark.createDataFrame([("party", n, None) for n in ("Francisco S. Binonta", "Francisco H. Binonta", "Paco Binonta", "F. S. Binonta")], "scope string, name string, owner string")
    found = {r.name: r.entity for r in names.link_variants(df).collect()}
    assert found["F. S. Binonta"] == found["Francisco S. Binonta"]
    assert len({found["Paco Binonta"], found["Francisco S. Binonta"], found["Francisco H. Binonta"]}) == 3


def test_owners_decide(spark):
    df = spark.createDataFrame([("party", "Rubufi Bota Foods Group", "1"), ("party", "Rubrfi Boua Foods Group", "1"), ("party", "Rubufi Bote Foods Group", "2")], "scope string, name string, owner string")
    found = {r.name: r.entity for r in names.link_variants(df).collect()}
    assert found["Rubufi Bota Foods Group"] == found["Rubrfi Boua Foods Group"] != found["Rubufi Bote Foods Group"]
    assert names.link_variants(df.limit(0)).count() == 0


@pytest.mark.parametrize(("a", "b", "length"), [("abcbdab", "bdcaba", 4), ("", "x", 0), ("same", "same", 4)])
def test_longest_common_subsequence(a, b, length):
    assert names.lcs_length(a, b) == length == names.lcs_length(b, a)
