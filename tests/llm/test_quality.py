import pytest

from quillspark.llm import quality as q

COMMON = [("en", w) for w in "the of and to in is that it was for on are as with by this be from or had not but they were which so".split()] + [("de", w) for w in "der die und in den von zu das mit ist im".split()]
TABLE = q.CommonWords(COMMON)
SENTENCE = "The printer of the narrow street had seen the lamp in the window, and they were not sure that it was for sale."
PROSE = [
    SENTENCE + " We were told that the road to the hill was closed for the day. They went by the river with the lamp, not for the first time.",
    (SENTENCE + " We were told that the road to the hill was closed for the day.").upper(),
    "\n".join(["The printer of the narrow street had seen", "the lamp in the window, and they were not", "sure that it was for sale to anyone from", "the town on the hill. The colour of the", "paper was dull and the edges were frayed."]),
    SENTENCE.rstrip(".") + " We were told that the road to the hill was closed for the day They went by the river with the lamp",
    f"“{SENTENCE}” said the man, and so they were on the way to the town with the lamp.\n\n{SENTENCE}",
    "<b>The printer</b> of *the* narrow street had _seen_ the lamp in the [window], and they were not sure that it was for sale.",
    "(3) " + SENTENCE[:-1] + " (12 px, 0.60). (4) " + SENTENCE,
]
OTHER = [
    "| a | b | 12 |\n| the | of | 13 |\n| c | d | 14 |",
    "name\tprinter\t12\nlamp\tstreet\t13\nroad\twindow\t14",
    "2025-04-18 13:38 INFO worker-4 chunk=22 took=6.0s\n" * 5,
    "see all of the items in this list\n" * 10,
    "lamp\nstreet\nroad\nwindow\npaper\ntown",
    "- on the road and the hill\n- for the lamp in town\n- how to set the lamp\n- the edge of the paper",
    "Chapter one ............ 12\nThe road to the town ....... 14\nOf the lamp ......... 20",
    "a_max: 12\nb_min: 3\nc_mode: 8",
    "lamp road window paper town street hill printer edge colour man sale lamp road window paper",
    "the of and to in is that it was for on are as with by this be from",
    "Th_ pr#nter >f th= n{rr^w str%et ha= se~n t<e l*mp in t§e wi|dow, a}d t_ey w^re n>t su#e.",
    "QmFzZTY0IGRhdGEgb2YgdGhlIHdvcmxk/09+QmFzZTY0IGRhdGEgb2YgdGhlIHdvcmxk\nYW5kIHNvIG9uIGFuZCBzbyBvbg9+8QmFzZTY0IGRhdGEgb2YgdGhl",
]


@pytest.mark.parametrize("text", PROSE)
def test_prose(text):
    assert q.measure(text, TABLE)[-1]


@pytest.mark.parametrize("text", OTHER)
def test_not_prose(text):
    assert not q.measure(text, TABLE)[-1]


def test_repetition_is_boilerplate():
    other = "We were told that the road to the hill was closed for the day, so they went by the river with the lamp."
    assert not q.measure("\n\n".join([SENTENCE, other] * 6), TABLE)[-1]


def test_share_decides():
    table = OTHER[1]
    assert q.measure(PROSE[0] + "\n\n" + table, TABLE)[-1]
    assert not q.measure(SENTENCE + "\n\n" + "\n".join([table] * 6), TABLE)[-1]


def test_statistics():
    got = dict(zip([c.split()[0] for c in q.SCHEMA.split(", ")][1:], q.measure("one two. one two\n\nthe same\n\nthe same", TABLE), strict=True))
    assert got["n_words"] == 8 and got["n_lines"] == 3
    assert got["duplicate_paragraph_share"] == 0.25 and got["duplicate_line_share"] > 0.2 and got["top_bigram_share"] > 0.4
    assert q.measure("", TABLE)[0] == 0 and q.measure("", TABLE)[-1]


def test_documents(spark):
    rows = [(1, PROSE[0]), (2, OTHER[0]), (2, OTHER[0]), (3, None), (4, ""), (5, "lamp " * 40_000), (None, OTHER[0])]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, is_prose string, n_words int")
    words = spark.createDataFrame([*COMMON, (None, "x"), ("en", None)], "lang string, word string")
    assert {r[0] for r in q.not_prose(docs, words).collect()} == {2, 5}
    got = {r["doc_id"]: r for r in q.text_statistics(docs, words).collect()}
    assert got[3]["n_words"] is None and got[3]["is_prose"] is None and got[4]["is_prose"]
    assert q.not_prose(docs.limit(0), words).count() == 0
    with pytest.raises(ValueError):
        q.common_table(words, 3)
