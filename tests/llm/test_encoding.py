import pytest

from quillspark.llm import encoding as e

CLEAN = [
    "la cañón está allí y el corazón de la montaña gira cerca del jardín, decía Mañúel, y la página ya era más pálida.",
    "die Küche neben der Brücke ist schön und die Größe der Straße, sagte Müller, wird über Prägung geändert.",
    "la théâtre du château était déjà près de la forêt, disait Hélène, et la pâte calme à côté de la règle.",
    "после семи дней он не знал, но всегда помнил очень хороший город и ещё один дом под горой, сказал другой человек.",
    "η μικρη κορη του κηπου δεν ξερει την μεγαλη πορτα απο το σπιτι και ειναι καλη για την χωρα.",
]
TEXTS = CLEAN * 20


def garble(text, written, read):
    return e.redo(text, written, read)


@pytest.fixture(scope="module")
def by(spark):
    pairs = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("cp1252", "cp1251"), ("cp1251", "cp1252"), ("koi8_r", "cp1251")]
    damaged = [g for t in CLEAN for w, r in pairs if (g := garble(t, w, r)) and g != t]
    examined = spark.createDataFrame([(t, "clash") for t in [*damaged, *TEXTS, None]], "text string, word string")
    reference = spark.createDataFrame([(t, 1) for t in TEXTS], "text string, skeleton int")
    return e.learn([(examined, "text")], [(reference, "text")], (reference, "text"))


def test_learnt_decodings(by):
    assert {("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("cp1252", "cp1251")} <= set(by.decodings)


@pytest.mark.parametrize("text", CLEAN[:4])
def test_round_trip(by, text):
    for written, read in (("utf-8", "cp1252"), ("utf-8", "mac_roman")):
        assert by.restore(garble(text, written, read)) == (True, text)


def test_part_of_a_value(by):
    assert by.restore("decía " + garble("Mañúel", "utf-8", "cp1252") + ", y la página") == (True, "decía Mañúel, y la página")


def test_twice(by):
    assert by.restore(garble(garble("la página está allí", "utf-8", "cp1252"), "utf-8", "cp1252")) == (True, "la página está allí")


def test_sound_values_are_left(by):
    for t in [*CLEAN, "plain ascii text", "", None, "NÃO ABRA A GAVETA", "Štítek č. 9 – žlutý", "20 °C ± 2 °C", "¿QUÉ AÑO?"]:
        assert by.restore(t) == (False, t)


def test_lost_text_is_a_case(by):
    assert by.restore("la p�gina")[0]
    assert by.restore("pl\x81us")[0]


def test_cases_of_a_table(spark, by):
    rows = [(1, garble(CLEAN[0], "utf-8", "cp1252")), (1, garble(CLEAN[0], "utf-8", "cp1252")), (2, CLEAN[0]), (3, None), (None, garble(CLEAN[0], "utf-8", "cp1252")), (4, "x" * 200_000 + "é"), (5, "")]
    df = spark.createDataFrame([(i, t, "damaged", "restored") for i, t in rows], "idx bigint, text string, damaged string, restored string")
    got = e.restored(df, "idx", "text", by).collect()
    assert [(r["record_key"], r["restored"]) for r in got] == [("1", CLEAN[0])]
    assert e.restored(df.limit(0), "idx", "text", by).count() == 0


def test_empty_reference(spark):
    none = spark.createDataFrame([], "text string")
    some = spark.createDataFrame([("dÃ©jÃ ",)], "text string")
    by = e.learn([(some, "text")], [(none, "text")], (none, "text"))
    assert by.restore("plain") == (False, "plain")
    assert by.restore("\x85")[0]


def test_alignment():
    assert e.aligned_runs("dÃ©jÃ\xa0", "déjà") == [("Ã©", "é"), ("Ã\xa0", "à")]
    assert e.aligned_pieces("dÃ©jÃ\xa0", "déjà") == [("Ã©", "é"), ("Ã\xa0", "à")]
    assert e.aligned_pieces("x_ñåíðî.txt", "x_сенро.txt") == list(zip("ñåíðî", "сенро", strict=True))
    assert ("utf-8", "cp1252") in [e.ALL_DECODINGS[k] for k in e.explained_by("Ã©", "é")]


def test_undo_all_is_undo():
    for text in ("Ã©tÃ©", "ñåíðî", "сенро", "Ð¶ÐµÐ¼", "╔══", "‚©‚¿", "abc", "é\x81"):
        want: dict = {}
        for k, (w, r) in enumerate(e.ALL_DECODINGS):
            made = e.undo(text, w, r)
            if made is not None and made != text:
                want.setdefault(made, []).append(k)
        assert {u: sorted(ks) for u, ks in e.undo_all(text).items()} == want


def test_a_decoding_without_words_of_its_own_is_not_learned(spark):
    """Whatever else would explain the same words, only the strongest explanation of enough of them is learned."""
    rows = [[k] * 2 for k in range(40)] + [[0, 5]] * 30 + [[0, 7]] * 8 + [[7]] * 2
    evidence = spark.createDataFrame([(r,) for r in rows], "ks array<int>")
    got = e._chosen(evidence, 3)
    assert e.ALL_DECODINGS[0] in got and e.ALL_DECODINGS[5] not in got and e.ALL_DECODINGS[7] in got


def test_the_mapping_alone_restores(by):
    mapped = e.Restorer(by.model, [], {"¤": "é"})
    assert mapped.restore("la r¤gle était d¤jà ¤tait") == (True, "la régle était déjà était") or mapped.restore("d¤jà ¤tait") == (True, "déjà était")
