import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import splitting, tokens


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n!é😀", max_size=400), st.integers(1, 60), st.integers(0, 59))
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap):
    overlap = min(overlap, limit - 1)
    pieces = splitting.cut_points(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert all(after[0] == before[1] - overlap for before, after in zip(pieces, pieces[1:], strict=False))
    rebuilt = text[: pieces[0][1]] + "".join(text[a + overlap : b] for a, b, _ in pieces[1:])
    assert rebuilt == text and (len(pieces) == 1) == (len(text) <= limit)


def test_boundaries_are_natural():
    text = "One sentence here. Another one there.\n\nA second paragraph of words. " * 20
    pieces = splitting.cut_points(text, 200, 20)
    assert {k for _, _, k in pieces[:-1]} <= {"paragraph", "sentence"}
    assert [k for _, _, k in splitting.cut_points("x" * 500, 200, 20)] == ["hard", "hard", "end"]


def test_a_hard_cut_only_where_no_boundary_is():
    text = "A short paragraph.\n\nSome prose before " + "x" * 500
    pieces = splitting.cut_points(text, 200, 10)
    assert [(b, k) for _, b, k in pieces[:2]] == [(20, "paragraph"), (38, "word")]
    assert [k for _, _, k in pieces[2:]] == ["hard", "hard", "end"]
    # a boundary within the overlap doesn't let the next piece advance
    assert [k for _, _, k in splitting.cut_points("word " + "x" * 300, 200, 10)] == ["hard", "end"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefg .\n", max_size=400), st.integers(1, 60), st.integers(0, 59))
def test_hard_cuts_have_no_boundary_in_their_window(text, limit, overlap):
    overlap = min(overlap, limit - 1)
    ends = {at for _, array in splitting.boundary_arrays(text) for at in array}
    for start, end, kind in splitting.cut_points(text, limit, overlap):
        assert kind != "hard" or not ends & set(range(start + overlap + 1, end + 1))


def test_limits_in_tokens():
    text = "Some words of a filing, é 😀 and more. " * 40
    ends = tokens.token_ends(text)
    pieces = splitting.cut_points(text, 50, 5, ends)
    assert pieces[-1][1] == len(text) and all(a in {0, *ends} and b in ends for a, b, _ in pieces)
    assert all(sum(a < e <= b for e in ends) <= 50 for a, b, _ in pieces)


def test_bad_sizes():
    with pytest.raises(ValueError):
        splitting.cut_points("x", 5, 5)


def test_rows(spark):
    rows = [("a", "w " * 100, "clash"), ("b", "short", "clash"), ("c", None, None), ("d", "", None), ("a", "w " * 100, "clash")]
    df = spark.createDataFrame(rows, "key string, text string, start string")
    found = {r.key: r.pieces for r in splitting.split_pieces(df, "text", 50, 10).collect()}
    assert len(found["a"]) > 1 and [tuple(p) for p in found["b"]] == [(0, 5, "end")] and found["c"] is None and [tuple(p) for p in found["d"]] == [(0, 0, "end")]
    pieces = splitting.explode_pieces(splitting.split_pieces(df.drop("start").distinct(), "text", 50, 10), "text").where("key = 'a'").orderBy("piece_no").collect()
    assert pieces[0].piece == ("w " * 100)[pieces[0].start : pieces[0].end]
    assert splitting.split_pieces(df.limit(0), "text", 50, 10).count() == 0


def test_rows_in_tokens(spark):
    long = "Some words of a filing, é and more.\n\n" * 60
    df = spark.createDataFrame([("a", long, "c"), ("b", "short", "c"), ("c", None, None), ("d", "", None)], "key string, text string, start string")
    rows = splitting.explode_pieces(splitting.split_pieces(df.drop("start"), "text", 50, 5, unit="tokens"), "text").collect()
    own = sorted((r for r in rows if r.key == "a"), key=lambda r: r.piece_no)
    ends = [0, *tokens.token_ends(long).tolist()]
    assert own[-1].end == len(long) and all(r.piece == long[r.start : r.end] for r in own)
    assert all(ends.index(r.end) - ends.index(r.start) <= 50 for r in own) and all(ends.index(a.end) - ends.index(b.start) == 5 for a, b in zip(own, own[1:], strict=False))
    assert {r.key: (r.start, r.end) for r in rows if r.key in "bd"} == {"b": (0, 5), "d": (0, 0)}
    with pytest.raises(ValueError):
        splitting.split_pieces(df, "text", 50, 5, unit="pages")
