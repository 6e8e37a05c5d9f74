import random

import pytest
from pyspark.sql import functions as F

from quillspark.llm import splits
from quillspark.llm.encoding import CharacterModel, Restorer
from quillspark.operators import skew

PLAIN = Restorer(CharacterModel({"aa": 1}), [])


def spelt(spark, p):
    return spark.range(1).select(splits.one_spelling(F.lit(p)).alias("p")).collect()[0]["p"]


def test_spellings(spark):
    want = "/data/fonts/a/a-bold.ttf"
    for p in ("/data/fonts/a/A-Bold.ttf", "\\data\\fonts\\a\\A-Bold.ttf", "//data/fonts//a/A-Bold.ttf", "/DATA/fonts/a/./A-Bold.TTF", "/data/fonts/a/old/../A-Bold.ttf", "/data/fonts/x/../a/y/../A-Bold.ttf"):
        assert spelt(spark, p) == want
    assert spelt(spark, "./ltr/a.txt") == "ltr/a.txt"


def test_lost_names(spark):
    known = spark.createDataFrame([("ltr/página_1.txt",), ("ltr/pagina_2.txt",), ("ltr/père_3.txt",), ("ltr/père_3.txt".replace("è", "é"),)], "corpus_file string")
    names = spark.createDataFrame([("ltr/p\ufffdgina_1.txt",), ("LTR//página_1.txt",), ("ltr/p\ufffdre_3.txt",), ("ltr/other.txt",), (None,)], "corpus_file string")
    got = {r["corpus_file"]: r["node"] for r in splits.right_names(names, "corpus_file", known, "corpus_file", PLAIN).collect()}
    assert got == {"ltr/p\ufffdgina_1.txt": "ltr/página_1.txt", "LTR//página_1.txt": "ltr/página_1.txt", "ltr/p\ufffdre_3.txt": "ltr/p\ufffdre_3.txt", "ltr/other.txt": "ltr/other.txt"}


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(("a", a))] = find(("b", b))
    groups = {}
    for a, _ in edges:
        groups.setdefault(find(("a", a)), set()).add(a)
    return {x: min(g) for g in groups.values() for x in g}


@pytest.mark.parametrize(("seed", "hot"), [(1, 10), (2, 10**9)])
def test_components(spark, seed, hot, monkeypatch):
    """Against union-find; also with every key treated as hot."""
    monkeypatch.setattr(splits, "HOT_ROWS", min(hot, 1000))
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (hot,))
    monkeypatch.setattr(skew.salted_join, "__defaults__", ("inner", hot))
    r = random.Random(seed)
    edges = [(f"r{r.randrange(60):03d}", f"f{r.randrange(70):03d}") for _ in range(70)]
    edges += [(f"q{k:03d}", f"g{k:03d}") for k in range(40)] + [(f"q{k + 1:03d}", f"g{k:03d}") for k in range(39)]  # a long chain
    edges += [(f"h{k:03d}", "hub") for k in range(30)] + [("h000", f"e{k}") for k in range(30)]
    df = spark.createDataFrame([*edges, *edges[:5], (None, "f001"), ("r001", None)], "record string, entity string")
    got = {r["entity"]: r["label"] for r in splits.propagate(df).collect()}
    want = brute([(e, r) for r, e in edges])
    assert {x: got.get(x, x) for x in want} == want
    assert splits.propagate(df.limit(0)).count() == 0


def tables(spark):
    tasks = [(0, "s1", "/f/A.ttf"), (1, "s2", "/f/./a.TTF"), (2, "s3", None), (3, "s4", None), (4, "s5", "/f/b.ttf"), (4, "s5", "/f/b.ttf"), (5, "s6", "\\f\\b.ttf"), (6, "s1", "/f/c.ttf")]
    specs = [("s1", "x/one.txt", "l"), ("s2", "x/two.txt", "l"), ("s3", "X//three.txt", "r"), ("s4", "x/three.txt", "r"), ("s5", "x/four.txt", "l"), ("s6", "x/old/../five.txt", "l"), ("s6", "x/old/../five.txt", "l"), ("s7", None, "l")]
    corpus = [(f"x/{n}.txt",) for n in ("one", "two", "three", "four", "five", "unused")]
    return spark.createDataFrame(tasks, "idx bigint, spec_name string, font_path string"), spark.createDataFrame(specs, "spec_name string, corpus_file string, text_direction string"), spark.createDataFrame(corpus, "corpus_file string"), spark.createDataFrame([("/f/a.ttf",), ("/f/b.ttf",)], "font_path string")


def test_groups(spark):
    got = {tuple(r) for r in splits.held_together(splits.corpus_groups(splits.record_ties(*tables(spark), PLAIN))).collect()}
    assert got == {("x/one.txt", "x/two.txt"), ("x/five.txt", "x/four.txt")}


def test_a_specification_without_a_corpus_file_ties_its_fonts(spark):
    tasks = spark.createDataFrame([(1, "a", "/f/1.ttf"), (2, "x", "/f/1.ttf"), (3, "x", "/f/2.ttf"), (4, "b", "/f/2.ttf"), (5, "c", None)], "idx bigint, spec_name string, font_path string")
    specs = spark.createDataFrame([("a", "a.txt", "l"), ("x", None, "l"), ("b", "b.txt", None), ("c", "c.txt", "l")], "spec_name string, corpus_file string, text_direction string")
    corpus = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",)], "corpus_file string")
    fonts = spark.createDataFrame([("/f/1.ttf",)], "font_path string")
    assert {tuple(r) for r in splits.held_together(splits.corpus_groups(splits.record_ties(tasks, specs, corpus, fonts, PLAIN))).collect()} == {("a.txt", "b.txt")}


TARGETS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))


def targets_(spark):
    return spark.createDataFrame(TARGETS, "split_name string, share double")


def test_assignment(spark):
    """Components stay whole; shares hold in all and for each label, with a huge component and very many small ones."""
    r = random.Random(3)
    rows = [(f"r{k}", f"c{int(r.random() ** 3 * 2000)}", "ab"[k % 5 == 0], 1 + k % 3) for k in range(6000)] + [("huge", "huge", "a", 1500)] + [(f"one{k}", f"one{k}", "abc"[k % 3], 1) for k in range(5000)]
    df = spark.createDataFrame(rows, "record string, component string, label string, n bigint")
    got = {g["record"]: g for g in splits.assign(df, targets_(spark)).collect()}
    assert len(got) == len(rows)
    of = {}
    for g in got.values():
        assert of.setdefault(g["component"], g["split_name"]) == g["split_name"]
    for label in (None, "a", "b", "c"):
        own = [(rec, n) for rec, _, x, n in rows if label in (None, x)]
        for name, share in TARGETS:
            assert abs(sum(n for rec, n in own if got[rec]["split_name"] == name) / sum(n for _, n in own) - share) < 0.01
    with pytest.raises(ValueError):
        splits.assign(df, targets_(spark).limit(0))
    assert splits.assign(df.limit(0), targets_(spark)).count() == 0


def test_many_labels_and_rare_classes(spark, monkeypatch):
    monkeypatch.setattr(splits, "CLASSES", 3)
    rows = [(f"r{k}", f"c{k // 3}", f"label{k % 40}", 1 + k % 50) for k in range(3000)]
    df = spark.createDataFrame(rows, "record string, component string, label string, n bigint")
    got = splits.assign(df, targets_(spark)).collect()
    assert len(got) == len({g["record"] for g in got}) == 3000
    size = {r: n for r, _, _, n in rows}
    for name, share in TARGETS:
        assert abs(sum(size[g["record"]] for g in got if g["split_name"] == name) / sum(size.values()) - share) < 0.01


def test_tasks_by_their_components(spark):
    tasks, specs, corpus, fonts = tables(spark)
    more = spark.createDataFrame([(7, None, "/f/A.ttf"), (8, None, None), (9, "unknown", None), (10, "unknown", "/f/b.ttf"), (6, "s1", "/f/zz.ttf"), (None, "s1", None)], tasks.schema)
    got = {r["idx"]: r for r in splits.task_splits(tasks.unionAll(more), specs, corpus, fonts, PLAIN, targets_(spark)).collect()}
    assert sorted(got) == list(range(11))
    c = {k: r["component"] for k, r in got.items()}
    assert c[0] == c[1] == c[6] == c[7] and c[2] == c[3] and c[4] == c[5] == c[9] == c[10] and len({c[0], c[2], c[4], c[8]}) == 4
    assert all(got[a]["split_name"] == got[b]["split_name"] for a in got for b in got if c[a] == c[b])
