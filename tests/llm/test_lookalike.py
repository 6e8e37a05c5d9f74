from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillspark.llm import lookalike as k

SAME = [
    ("la page", "lа pаge"), ("la page", "la page"), ("la page", "la​ pa\xadge"), ("déjà", "déjà"), ("Bold 12", "Ｂｏｌｄ　１２"), ("office", "oﬀice"), ("fi", "ﬁ"), ("a b", "a b"), ("a b", "a b"),
    ("Он не", "Oн нe"), ("το", "τo"), ("ёлка", "ёлка"), ("й", "й"), ("", "​"), ("µ", "μ"), ("ï", "ї"), ("a\tb", "a b"),
]
DIFFERENT = [("La", "la"), ("m2", "m²"), ("decia", "decía"), ("ab", "a b"), ("a  b", "a b"), ("Nº", "No"), ("½", "1/2"), ("e", "é"), ("text,", "text")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    assert k.visible_form(a) == k.visible_form(b)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(a, b):
    assert k.visible_form(a) != k.visible_form(b)


def test_forms_are_stable():
    for a, b in SAME + DIFFERENT:
        for x in (a, b):
            assert k.visible_form(k.visible_form(x)) == k.visible_form(x)
            assert k.search_form(k.search_form(x)) == k.search_form(x)
    assert k.search_form("Straße ＡＢ") == k.search_form("STRASSE ab")


def pairs_of(df):
    rows = k.lookalike_rows(df, k.lookalike_texts(df))
    return rows, {tuple(r) for r in k.lookalike_pairs(rows).collect()}


def test_pairs(spark):
    rows = [(1, "la page"), (2, "lа pаge"), (3, "la\u00a0page"), (3, "la\u00a0page"), (4, "La page"), (5, None), (6, ""), (7, "\u200b"), (None, "la page"), (8, "x" * 100_000), (9, "x" * 100_000 + "\u200b"), (2, "lа pаge"), (10, "la page")]
    df = spark.createDataFrame([(i, t, "form", "id") for i, t in rows], "idx bigint, text string, form string, id string")
    linked, got = pairs_of(df)
    known = {i: t for i, t in rows if i is not None and t is not None}
    want = {(a, b) for a, b in combinations(sorted(known), 2) if known[a] != known[b] and k.visible_form(known[a]) == k.visible_form(known[b])}
    assert got == want == {(1, 2), (1, 3), (2, 3), (2, 10), (3, 10), (6, 7), (8, 9)}
    links = {r["id"]: r["n_links"] for r in k.lookalike_classes(linked).collect()}
    assert links == {i: sum(i in p for p in want) for i in {x for p in want for x in p}}
    assert pairs_of(df.limit(0))[1] == set()


def test_line_ends_at_the_end(spark):
    """In Java's patterns $ fits before a last line terminator; such texts are no plain ASCII."""
    rows = [(1, "abc def"), (2, "abc\u00a0def"), (3, "abc def\u200b"), (4, "abc\u2009def"), (5, "abc def\n"), (6, "abc def\u2028"), (7, "abc def\u0085"), (8, "abc def "), (9, "abc def\r\n")]
    df = spark.createDataFrame(rows, "idx bigint, text string")
    _, got = pairs_of(df)
    want = {(a, b) for (a, x), (b, y) in combinations(rows, 2) if k.visible_form(x) == k.visible_form(y)}
    assert got == want and want >= set(combinations((1, 2, 3, 4), 2)) | set(combinations((5, 6, 7, 8), 2))
    assert all(r["visible_form"] == k.visible_form(r["text"]) for r in k.normalised(df).collect())


def test_a_hot_text_is_compared_once(spark):
    """One text with nearly all rows and a single look-alike; both ways of writing the ids out."""
    df = spark.range(30_000).select(F.col("id").alias("idx"), F.when(F.col("id") == 77, "the p\u0430ge").otherwise("the page").alias("text"))
    linked, got = pairs_of(df)
    assert len(got) == 29_999 and all(77 in p for p in got)
    links = k.lookalike_classes(linked)
    assert {r["n_links"]: r["count"] for r in links.groupBy("n_links").count().collect()} == {1: 29_999, 29_999: 1}


def test_columns(spark):
    df = spark.createDataFrame([(1, "Ｂ"), (2, None), (3, "abc")], "idx bigint, text string")
    assert [(r["visible_form"], r["search_form"]) for r in k.normalised(df).orderBy("idx").collect()] == [("B", "b"), (None, None), ("abc", "abc")]
