import random

from quillspark.llm import leakage as l
from quillspark.operators import skew

R = random.Random(5)
ITEM = [f"item{k}" for k in range(40)]


def brute(doc, item):
    a, b = l.words_of(doc), l.words_of(item)
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] != b[j]:
                continue
            bad = n = 0
            while i + n < len(a) and j + n < len(b):
                same = a[i + n] == b[j + n]
                bad += not same
                n += 1
                if same and n >= 12 and bad <= n // 10:
                    return True
    return False


def test_words():
    assert l.words_of("A *bold* <b>Word</b>, di-\n> vided \n  (2) printer’s — [x] ÉTÉ") == ["a", "bold", "word", "divided", "printer", "x", "été"]
    assert l.words_of("printer's") == l.words_of("printer’s") == l.words_of("printer s") == ["printer"]
    assert l.words_of("a\r\nb") == ["a", "b"]
    assert l.words_of("") == []


def cases():
    fill = lambda n: [f"other{R.randrange(1000)}" for _ in range(n)]
    out = []
    for n in (8, 11, 12, 13, 20, 30, 40):
        for changes in (0, 1, 2, 3):
            run = ITEM[3 : 3 + n]
            for at in R.sample(range(1, max(2, len(run) - 1)), min(changes, max(1, len(run) - 2))):
                run = [*run[:at], "changed", *run[at + 1 :]]
            out.append(" ".join([*fill(R.randrange(20)), *run, *fill(R.randrange(20))]))
    return out


def test_against_brute_force(spark):
    texts = cases()
    items = [(1, " ".join(ITEM)), (2, "too short an item"), (3, None), (None, " ".join(ITEM)), (4, " ".join(f"second{k}" for k in range(15)))]
    long_text = " ".join(f"w{k}" for k in range(60_000)) + " " + " ".join(ITEM[:14])
    rows = [*enumerate(texts), (500, None), (None, texts[0]), (501, ""), (502, long_text), (503, "X, ".join(f"SECOND{k}" for k in range(15)))]
    docs = spark.createDataFrame([(i, t, "item_id") for i, t in rows], "doc_id bigint, text string, item_id string")
    held = spark.createDataFrame([(i, t, "doc_id") for i, t in items], "item_id bigint, text string, doc_id string")
    want = {(i, j) for i, t in rows for j, x in items if None not in (i, t, j, x) and i != 502 and brute(t, x)} | {(502, 1)}
    assert (20, 1) in want and (0, 1) not in want
    assert {tuple(r) for r in l.leaked(docs, held).collect()} == want
    assert l.leaked(docs.limit(0), held).count() == l.leaked(docs, held.limit(0)).count() == 0


def test_two_close_unknown_words(spark):
    patterns = {20: [(8, 9), (8, 10), (8, 11), (9, 10), (9, 11), (10, 11)], 21: [(9, 10), (9, 11), (10, 11)], 22: [(10, 11)]}
    texts = [" ".join(f"unknown{k}" if k in pair else w for k, w in enumerate(ITEM[3 : 3 + n])) for n, pairs in patterns.items() for pair in pairs]
    assert all(brute(t, " ".join(ITEM)) for t in texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM))], "item_id bigint, text string")
    assert {r["doc_id"] for r in l.leaked(docs, items).collect()} == set(range(len(texts)))


def test_repetition_and_hot_passages(spark, monkeypatch):
    """Texts that repeat themselves, many items with one text, and a passage in most documents, with every hash treated as hot."""
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (5,))
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", 5))
    line = " ".join(ITEM[:13])
    docs = [(k, f"{'x ' * (k % 5)}{line} {k}") for k in range(60)] + [(100, f"{line}\n" * 3000), (101, "la " * 5000), (102, "la " * 11), (103, f"{' '.join(ITEM[20:34])} and {line}")]
    items = [(k, " ".join(ITEM)) for k in range(8)] + [(50, "la " * 400), (51, line)]
    got = {tuple(r) for r in l.leaked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    with_line = [*range(60), 100, 103]
    assert got == {(d, i) for d in with_line for i in (*range(8), 51)} | {(101, 50)}


def test_windows_of_a_repeated_line_count_once():
    one, many = (l.Batch([(ITEM[:13] * n)], l._WordHashes()) for n in (9, 900))
    assert len(one.windows()[2]) == len(many.windows()[2])
    assert len(l.Batch([["a"] * 11, []], l._WordHashes()).windows()[2]) == 0


def test_a_small_filter_only_lets_more_pass(spark, monkeypatch):
    monkeypatch.setattr(l, "MAX_BITS", 8)
    monkeypatch.setattr(l, "BITS_PER_WINDOW", 1)
    docs = spark.createDataFrame(list(enumerate(cases())), "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM))] + [(k, " ".join(f"w{k}_{j}" for j in range(60))) for k in range(2, 400)], "item_id bigint, text string")
    assert {tuple(r) for r in l.leaked(docs, items).collect()} == {(r["doc_id"], 1) for r in docs.collect() if brute(r["text"], " ".join(ITEM))}
