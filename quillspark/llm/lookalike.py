"""One consistent form for texts that look the same but differ in their characters.

Every distinct value is brought to compatibility-normalised, composed form: width forms, joined forms, non-breaking and
other blanks and differently encoded accents become one spelling, default-ignorable characters go, and letters of Latin,
Cyrillic and Greek that have the same shape become one letter. Full case folding of that form gives the blocking key
(``search_form``); the ``visible_form`` keeps what a reader sees: letter case, accents, raised and lowered digits, fractions
and other signs whose compatibility form looks different, and every single blank.

The work is done once for each distinct value of a batch, and ASCII values without control characters never leave the JVM.
Look-alike texts are found among distinct texts: digests of form and text are combined where they lie, and only forms with two
digests of texts go on. The operator's result has one row per record with its class and number of links, and the pairs of
different texts; all pairs of records are written out from blocks of their ids only where they are asked for, so a text with a
third of all rows is compared once and never gathered.

Defined results: null stays null; an empty text and one of invisible characters only look the same; a tab or line end is a
blank; other control characters stay; rows with a null id are left out of pairs; an id with several texts counts once for
each distinct text, never with itself; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.skew import pairs_between, salted_join

# Letters of the same shape, each line the Latin letter and its doubles (after the Unicode confusables data).
SAME_SHAPE = {
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜϺ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ",
    "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", "a": "аα", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "іι", "j": "јϳ", "l": "ӏ", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ",
    "u": "υ", "v": "ν", "w": "ԝ", "x": "х", "y": "уγ", "Æ": "Ӕ", "æ": "ӕ", "Γ": "Г", "Π": "П", "Φ": "Ф", "к": "κ", "ε": "є", "へ": "ヘ", "べ": "ベ", "ぺ": "ペ",
}
#: Compatibility decompositions that don't change what is seen.
UNSEEN_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")


def _ignorable(c: int) -> bool:
    """Default-ignorable code points."""
    return c in (0xAD, 0x34F, 0x61C, 0x3164, 0xFFA0) or any(a <= c <= b for a, b in ((0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF)))


def _one(ch: str) -> str:
    """The visible form of one character."""
    c = ord(ch)
    if _ignorable(c):
        return ""
    if ch in "\t\n\v\f\r\x85  " or unicodedata.category(ch) == "Zs":
        return " "
    tag, _, rest = unicodedata.decomposition(ch).partition(" ")
    letters = unicodedata.normalize("NFKC", ch)
    if tag in UNSEEN_TAGS or tag == "<compat>" and (len(letters) > 1 and letters.isalpha() or c == 0xB5):
        return "".join(map(_one, letters)) if letters != ch else ch
    return ch


class _Map(dict):
    """A character map for str.translate that fills itself; a missing key would be an exception for each character."""

    def __init__(self, shape: dict[int, str]) -> None:
        self.shape = shape

    def __missing__(self, c: int) -> str:
        # Letters are compared without their marks, so a composed double (й, ї, ό) needs the decomposed form.
        bare = unicodedata.normalize("NFD", _one(chr(c))).translate(self.shape)
        self[c] = got = unicodedata.normalize("NFC", bare)
        return got


@lru_cache
def _visible() -> _Map:
    return _Map({ord(d): latin for latin, doubles in SAME_SHAPE.items() for d in doubles})


@lru_cache
def _scripts() -> list[_Map]:
    """For Latin, Cyrillic and Greek: letters of the same shape brought into that script."""
    groups = [[latin, *doubles] for latin, doubles in SAME_SHAPE.items()]
    return [_Map({ord(x): own[0] for g in groups if (own := [x for x in g if unicodedata.name(x).startswith(script)]) for x in g if x != own[0]}) for script in ("LATIN", "CYRILLIC", "GREEK")]


def visible_form(text: str) -> str:
    """Equal for texts that look the same when set in type."""
    return unicodedata.normalize("NFC", text.translate(_visible()))


def readings(text: str) -> list[str]:
    """What a reader may take text for: its visible form with the letters of the same shape in one script."""
    return [unicodedata.normalize("NFC", text.translate(m)) for m in _scripts()]


def search_form(text: str) -> str:
    """The visible form in full compatibility form, case folded, for comparisons that ignore case."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", visible_form(text)).casefold())


def _per_distinct(of) -> object:  # noqa: ANN001
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        distinct = texts.dropna().unique()
        forms = dict(zip(distinct, map(of, distinct), strict=True))
        return pd.Series([forms.get(t) for t in texts], dtype=object)

    return run


def _plain_ascii(text: F.Column) -> F.Column:
    return text.rlike(r"\A[\x20-\x7E]*\z")  # not ^ and $: these fit before a last line end, too


def normalised(df: DataFrame, text_col: str = "text", visible: str = "visible_form", search: str = "search_form") -> DataFrame:
    """df with both forms of a text column."""
    text = F.col(text_col)
    return df.withColumn(visible, F.when(_plain_ascii(text), text).otherwise(_per_distinct(visible_form)(text))).withColumn(search, F.when(_plain_ascii(text), F.lower(text)).otherwise(_per_distinct(search_form)(text)))


def lookalike_texts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``form, text_key``: the different texts whose visible form belongs to at least two of them, as digests."""
    text = F.col(text_col)
    ascii_texts = df.where(_plain_ascii(text)).select(F.unhex(F.md5(text)).alias("form"), F.xxhash64(text).alias("text_key"))
    others = df.where(text.isNotNull() & ~_plain_ascii(text)).select(F.unhex(F.md5(_per_distinct(visible_form)(text))).alias("form"), F.xxhash64(text).alias("text_key"))
    texts = ascii_texts.unionByName(others)
    seen = texts.groupBy("form").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).where("lo <> hi").select("form")
    found = texts.distinct()
    return found.join(seen, "form", "left_semi")


def lookalike_rows(df: DataFrame, texts: DataFrame, id_col: str = "idx", text_col: str = "text") -> DataFrame:
    """``id, text, text_key, form`` (distinct) of the rows with one of the texts of ``lookalike_texts``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")).where("id IS NOT NULL AND text IS NOT NULL")
    return salted_join(rows, texts, "text_key", ["id"]).distinct()


def lookalike_classes(rows: DataFrame) -> DataFrame:
    """``id, form, n_links``: each row with its class and the number of other rows that look the same and differ.

    An id with several texts has a row for each class, and links from any of its texts in it.
    """
    own = rows.groupBy("form", "text_key").agg(F.count_distinct("id").alias("n"))
    total = own.groupBy("form").agg(F.sum("n").alias("all"), F.count("*").alias("texts")).where("texts > 1").select("form", "all")
    linked = salted_join(rows.select("id", "text_key"), own.join(total, "form"), "text_key", ["id"])
    return linked.groupBy("id", "form").agg(F.max(F.col("all") - F.col("n")).alias("n_links"))


def lookalike_pairs(rows: DataFrame) -> DataFrame:
    """``idx_a, idx_b`` (a < b): different tasks whose texts look alike and are not the same string.

    Different texts are joined first; then the ids of each pair of texts are written out from blocks.
    """
    texts = rows.select("form", "text_key").distinct()
    a, b = texts.select("form", F.col("text_key").alias("key_a")), texts.select("form", F.col("text_key").alias("key_b"))
    linked = a.join(b, "form").where("key_a < key_b").select("key_a", "key_b")
    return pairs_between(linked, "key_a", "key_b", rows.select("text_key", "id").distinct(), "text_key", "id", "idx_a", "idx_b").distinct()
