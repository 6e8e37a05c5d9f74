from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import terms

FIELDS = {"text": "blank", "font_path": "whole"}
SCHEMA = "idx bigint, text string, font_path string, term string, block int"


def brute(rows):
    docs, occ = defaultdict(set), defaultdict(dict)
    for idx, text, font in rows:
        if idx is None:
            continue
        found = [("text", w) for w in (text or "").split(" ") if w] + ([("font_path", font)] if font is not None else [])
        for k, n in Counter(found).items():
            docs[k].add(idx)
            occ[k][idx] = max(n, occ[k].get(idx, 0))
    return {k: (len(d), sum(occ[k].values())) for k, d in docs.items()}


def counted(spark, rows, n=3):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(n)
    return {(r["field_name"], r["term"]): (r["n_docs"], r["n_occurrences"]) for r in terms.term_counts(df, "idx", FIELDS).collect()}


def test_against_brute_force(spark):
    rows = [(k * 40_000, " ".join(f"w{(k * j) % 7}" for j in range(k % 9)) + "  é", None if k % 5 == 0 else f"/f{k % 3}") for k in range(120)]
    rows += rows[:30] + [(None, "lost", "lost"), (7, None, None), (8, "", ""), (-5, "minus minus", "/f0")]
    assert counted(spark, rows) == brute(rows)


def test_dense_bitmaps(spark):
    rows = [(k, "all " + ("even even" if k % 2 == 0 else "odd"), None) for k in range(20_000)]
    got = counted(spark, rows + rows[:100], 4)
    assert got == {("text", "all"): (20_000, 20_000), ("text", "even"): (10_000, 20_000), ("text", "odd"): (10_000, 10_000)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10, 200_000), st.text("ab é ", max_size=12), st.sampled_from([None, "x", "y"])), max_size=40))
def test_any_rows(spark, rows):
    assert counted(spark, rows, 2) == brute(rows)


def test_marks(spark):
    rows = [(k, "often" if k < 60 else f"t{k // 2}", None) for k in range(100)]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    marks = {r["term"]: r["mark"] for r in terms.marked_terms(df, "idx", FIELDS).collect()}
    assert marks["often"] == "common" and marks["t30"] == "useful"
    assert terms.marked_terms(df.limit(0), "idx", FIELDS).count() == 0


def test_small_flushes(spark, monkeypatch):
    monkeypatch.setattr(terms, "FLUSH", 3)
    rows = [(k, "a b a c", "/f") for k in range(10)]
    assert counted(spark, rows, 1) == brute(rows)
