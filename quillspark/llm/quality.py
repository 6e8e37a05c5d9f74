"""Statistics of each document's text, and from them whether it is natural prose.

Beside the usual figures (words, mean word length, symbols, lines ending in punctuation, common words) there are figures of
repetition: the share of characters in duplicate lines and paragraphs and that of the most frequent run of two and three
words. Prose is told from lists, tables, logs, dumps and boilerplate line by line, by rules combined:

* a line with the marks of a table, a log, a dump, a form or a separator is not prose; nor is one that the document repeats;
* the other lines are put together into units: lines that go on (the next begins in lower case, or all lines of the block are
  filled up to one width) are one unit, so sentences remain whole however they are broken into lines;
* a unit is prose if it is long enough for a sentence, mixes common words and others as sentences do, and isn't full of
  repeated words, of signs within words, or of pieces that are too short to be sentences.

A document is prose if at least half of its characters (white space aside) lie in such units and it isn't mostly repetition. Common words come from a table by
language; the language with the most of them counts, whatever the document's own label says. In an alphabet for which the
table has no words, short words stand for them.

Each document is handled whole and by itself, so nothing is shuffled; the table of common words is small and fixed (checked).

Defined results: a null text has null statistics and is no case; an empty text has zeros and is no case either; repeated
documents each have a row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most words that the table of common words may have to be sent to the executors.
MAX_COMMON = 100_000
#: From so many words on, a text is boilerplate if this share of it is one run of words, or copies of its lines or paragraphs.
LONG_ENOUGH, REPEATED = 30, 0.5
#: Words that lines up to a stop may have to be taken for one sentence.
SENTENCE = 45
SCHEMA = (
    "doc_id long, n_words long, mean_word_length double, symbol_ratio double, digit_ratio double, n_lines long, punctuated_line_share double, common_word_share double, "
    "duplicate_line_share double, duplicate_paragraph_share double, top_bigram_share double, top_trigram_share double, prose_share double, is_prose boolean"
)

_TAG = re.compile(r"</?(?:b|i|u|em|strong|a|p|br|span|sup|sub|code|h\d)(?:\s[^<>]*)?/?>")
_PAIRED = re.compile(r"(?<![\w*_])([*_]{1,2})(?=[^\W_])([^*_\n]{1,60}?)\1(?![\w*_])|\[([^\W\d_][^\[\]\n]{0,60})\](?!\()")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_BULLET = re.compile(r"^\s*(?:[•*–·▪+-]|\(?\d{1,4}[.)]|\(\d{1,4}\))\s+")
_SIGNS = tuple(".!?…。:;,\"”»’)")
_QUOTED = re.compile(r"^(?:> ?)+")
_STOPS = tuple(".!?…。:;")
_STOP = re.compile(r"[.!?…。]+[\"”»’)]*(?:\s|$)")
_ODD = re.compile(r"[#§<>=~{}|*^%¦_$&@\\+�]|[\x00-\x08\x0e-\x1f\x7f-\x9f]")
_LEADERS = ("....", "____", "----", "====", "****", "~~~~", "####", "||||")
_MENU = (" > ", " » ", " › ", " :: ", " / ", " | ")
_TABS = re.compile(r"\t.*\t|\t\S*\s*$|^\S+\t")
_ROW = re.compile(r"</?t[rdh]\b")
_FORM = re.compile(r"^\s*[\[{].*[\]}],?\s*$|^\s*\[[ xX✓]\]")
_FIELD = re.compile(r"^\s*[\"'][^\"']+[\"']\s*:|^\s*[\w.-]+\s*[:=]\s*[-+]?\d[\d.,]*\s*$")
_LOG = re.compile(r"^\s*\d{4}-\d\d-\d\d[ T]\d\d:\d\d|\b(?:INFO|DEBUG|WARN|WARNING|ERROR|CRITICAL|TRACE)\b.*=")
_CELLS = re.compile(r"^(?:[^,\n]*,){2,}[^, \n][^,\n]*$|^(?:[^;\n]*;){2,}[^; \n][^;\n]*$|^[^,;\n]+(?:[,;][^,; \n][^,;\n]*|[,;](?=[,;]|$)){2,}$")
_FILE = re.compile(r"^\S+\.[a-zA-Z]\w{1,4}$|^\S*[/\\]\S*[/\\]\S*$")
_LETTER = re.compile(r"\w")


def _structured(line: str) -> bool:
    """Marks of lines that aren't running text: tables, logs, dumps, forms, leaders, paths, menus, settings."""
    x = line.strip()
    if not _LETTER.search(x) or any(m in x for m in _LEADERS) or "   " in x:
        return True
    if "|" in x and (x[0] == "|" or x.count("|") >= 3) or "\t" in x and _TABS.search(line):
        return True
    if x[0] in "[{" and _FORM.search(x) or "<" in x and _ROW.search(x):
        return True
    if (":" in x or "=" in x) and (_FIELD.search(x) or _LOG.search(x)):
        return True
    if (x.count(",") >= 2 or x.count(";") >= 2) and _CELLS.search(x):
        return True
    if " " not in x:
        return len(x) > 40 and x.isascii() or ("." in x or "/" in x or "\\" in x) and bool(_FILE.search(x))
    return any(x.count(m) >= 3 for m in _MENU)


class CommonWords:
    """Common words by language, and the alphabets that have some."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        by: dict[str, set[str]] = {}
        for lang, word in rows:
            if lang and word:
                by.setdefault(lang, set()).add(word.casefold())
        self.sets = [frozenset(s) for _, s in sorted(by.items())]
        self.alphabets = {self._alphabet(w) for s in self.sets for w in s}

    @staticmethod
    def _alphabet(word: str) -> int:
        c = ord(word[0])
        return 0 if c < 0x370 else c >> 8

    def best(self, n: Counter) -> frozenset[str] | None:
        """The words of the language that fits best; None where short words stand for common ones."""
        known = sum(k for w, k in n.items() if self._alphabet(w) in self.alphabets)
        if known * 2 < n.total() or not known:
            return None
        return max(self.sets, key=lambda s: sum(n[w] for w in s if w in n), default=None)


def _is_common(word: str, common: frozenset[str] | None) -> bool:
    return len(word) <= 3 if common is None else word in common


def _sentence_like(unit: str, words: list[str], common: frozenset[str] | None, listed: bool) -> bool:
    """Whether a unit of lines is running text."""
    n = len(words)
    if n < (10 if listed else 8):
        return False
    solid = len(unit) - unit.count(" ")
    if len(_ODD.findall(unit)) > 0.04 * solid:
        return False
    letters = sum(map(len, words))
    if letters < 0.72 * solid or letters > 16 * n:
        return False
    share = (sum(len(w) <= 3 for w in words) if common is None else sum(map(common.__contains__, words))) / n
    if not 0.12 <= share <= (0.62 if common is None else 0.75):
        return False
    if n >= 12 and max(Counter(words).values()) > 0.34 * n:
        return False
    # Pieces between stops: sentences, not entries.
    stops = _STOP.findall(unit)
    pieces = len(stops) + (not stops or not _closed(unit))
    return n / pieces >= (7 if listed or pieces > 2 else 5)


def _closed(line: str) -> bool:
    """Whether a line ends in a stop or colon, quotes aside."""
    return line.rstrip().rstrip("\"”»’) ")[-1:] in _STOPS


def _ended(line: str) -> bool:
    return line.rstrip()[-1:] in _SIGNS


def _goes_on(line: str, following: str) -> bool:
    """The next line begins in lower case, or with a figure or an opening sign within a sentence."""
    start = following.lstrip(" \t«“„\"'(—–-¿¡")
    return bool(start) and (start[0].islower() or (start[0].isdigit() and not _STOP.search(line[-3:])))


def _units(block: list[tuple[str, list[str]]]) -> list[tuple[str, list[str], int, bool]]:
    """(text, words, characters, whether it stands in a list) of the units of a block of lines with their words."""
    lines = [x for x, _ in block]
    if len(block) == 1:
        return [(lines[0], block[0][1], len("".join(lines[0].split())), bool(_BULLET.match(lines[0])))]
    bullets = [bool(_BULLET.match(x)) for x in lines]
    closed = list(map(_closed, lines))
    ended = list(map(_ended, lines))
    lengths = [len(x.rstrip()) for x in lines]
    width = max(lengths)
    # Lines without a stop are filled up to one width, where text is broken into lines; entries of a list end anywhere.
    going_on = [(a, b) for c, a, b in zip(closed, lengths, lines[1:], strict=False) if not c]
    full = sum(a + 1 + len(b.split(None, 1)[0]) > width - 2 for a, b in going_on)
    # Where every line begins in lower case and none has a stop, or nearly all end in a sign, lines tell nothing of sentences.
    telling = any(not _goes_on("", x) for x in lines) or any(map(_STOP.search, lines))
    flowing = telling and sum(bullets) <= 1 and bool(going_on) and sum(ended) < 0.8 * len(block) and full >= 0.75 * len(going_on)
    groups: list[list[int]] = [[0]]  # lines up to one that ends in a stop, or to a bullet
    for k in range(1, len(block)):
        if bullets[k] or closed[k - 1]:
            groups.append([k])
        else:
            groups[-1].append(k)
    out: list[list[int]] = []
    for g in groups:
        if len(g) == 1 or closed[g[-1]] and sum(len(block[k][1]) for k in g) <= SENTENCE and (len(g) < 3 or sum(ended[k] for k in g) < 0.8 * len(g)):
            out.append(g)  # a sentence broken into lines
            continue
        out.append(g[:1])
        for k in g[1:]:
            if flowing or telling and _goes_on(lines[k - 1], lines[k]):
                out[-1].append(k)
            else:
                out.append([k])
    short = sum(len(u) == 1 and len(block[u[0]][1]) < 11 for u in out)
    listed = len(out) > 2 and short >= 0.6 * len(out)
    units = []
    for u in out:
        text = _BULLET.sub("", " ".join(lines[k].strip() for k in u))
        units.append((text, [w for k in u for w in block[k][1]], sum(len("".join(lines[k].split())) for k in u), listed or bullets[u[0]]))
    return units


def measure(text: str, table: CommonWords) -> tuple:
    """The statistics of one text, in the order of SCHEMA without doc_id."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    plain = _TAG.sub("", text) if "<" in text else text
    if "*" in plain or "_" in plain or "[" in plain:
        plain = _PAIRED.sub(lambda m: m[2] or m[3], plain)
    all_lines = plain.split("\n")
    words_by_line = list(map(_WORD.findall, plain.casefold().split("\n")))
    words = list(chain.from_iterable(words_by_line))
    n = len(words)
    counts = Counter(words)
    common = table.best(counts)
    lines = [x for x in all_lines if x and not x.isspace()]
    solid = sum(len(x) - x.count(" ") - x.count("\t") for x in lines)
    if not solid:
        return (0, 0.0, 0.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, True)
    letters = sum(map(len, words))
    digits = sum(map(plain.count, "0123456789"))
    seen = Counter(map(str.strip, lines))
    repeated = {x for x, k in seen.items() if k >= 3}
    duplicate = sum(len(x) * (k - 1) for x, k in seen.items()) / max(1, sum(map(len, map(str.strip, lines))))
    paragraphs = Counter(p.strip() for p in plain.split("\n\n") if p and not p.isspace())
    duplicate_p = sum(len(p) * (k - 1) for p, k in paragraphs.items()) / max(1, sum(len(p) * k for p, k in paragraphs.items()))
    tops = []
    for size in (2, 3):
        grams = Counter(zip(*(words[k:] for k in range(size)), strict=False))
        top = max(grams.items(), key=itemgetter(1), default=((), 0))  # of several, the first in the text
        tops.append(min(1.0, top[1] * sum(map(len, top[0])) / max(1, letters)) if top[1] > 1 else 0.0)
    good, block = 0, []

    def close() -> int:
        g = sum(size for unit, ws, size, listed in _units(block) if _sentence_like(unit, ws, common, listed)) if block else 0
        block.clear()
        return g

    for x, ws in zip(all_lines, words_by_line, strict=True):
        if x.startswith(">"):
            x = _QUOTED.sub("", x)
        s = x.strip()
        if not s:
            good += close()
        elif s in repeated or _structured(x):
            good += close()
        else:
            block.append((x, ws))
    good += close()
    share = good / max(1, sum(len("".join(x.split())) for x in lines))
    return (
        n, letters / n if n else 0.0, max(0.0, 1 - (letters + digits) / solid), digits / solid, len(lines), sum(map(_ended, lines)) / len(lines),
        sum(k for w, k in counts.items() if _is_common(w, common)) / n if n else 0.0, duplicate, duplicate_p, *tops, share, share >= 0.5 and not (n >= LONG_ENOUGH and max(duplicate, duplicate_p, *tops) > REPEATED),
    )


def common_table(common_words: DataFrame, limit: int = MAX_COMMON) -> CommonWords:
    rows = common_words.select("lang", "word").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} common words")
    return CommonWords(sorted((r["lang"] or "", r["word"] or "") for r in rows))


def text_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """One row per document with the columns of SCHEMA."""
    table = common_table(common_words)
    width = SCHEMA.count(",")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for pdf in batches:
            rows = [(i, *(measure(t, table) if t is not None else (None,) * width)) for i, t in zip(pdf["doc_id"], pdf["text"], strict=True)]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"n_words": "Int64", "n_lines": "Int64", "is_prose": "boolean"})

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, SCHEMA)


def not_prose(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id`` of the documents that aren't natural prose."""
    return text_statistics(documents.where("text IS NOT NULL"), common_words).where("NOT is_prose AND doc_id IS NOT NULL").select("doc_id").distinct()
