"""Text that was decoded with the wrong character encoding: finding the values and restoring the original.

1. Twins. Implausible words of the examined fields are joined with words of clean reference text on what is left of both when
   the characters beyond ASCII are taken out; whole paths are joined with the right paths in the same way. Words in which hardly
   anything is left have no such twin; theirs is the word of the reference that one of the known wrong decodings turns into them.
2. Alignment. Two twins agree in every ASCII character, so their other characters align run by run, and within a run, where its
   lengths are multiples, character by character: Ã© with é. Aligned pieces that several words show are the learned mapping; its
   size is bounded by the alphabets. Wrong decodings (written in one encoding, read in another) extend it to characters that no
   twin showed. Each piece, and each word of the second kind, is evidence for all decodings that explain it, but votes for the
   one that explains most evidence in all: a decoding that only explains what others explain better is not learned, however
   much text there is.
3. Application. The learned decodings, and where none fits the mapping itself, are undone in all values, twins or not. A value
   is a case if a piece of it holds byte patterns that only a wrong decoding makes, or undoing what was learned turns implausible
   words into plausible ones. Plausibility is a character model of the clean text; a word that merely looks alike (letters of
   another script with the same shape) is compared in its visible form, and unusual but sound words stay, as nothing turns them
   into plausible ones.

What goes to the driver: votes per wrong decoding, learned pieces and counts per pair of characters, bounded by the encodings
and the alphabets, however long the text is. The examined texts are neither moved nor cut; each value is looked at where it
lies, so no key, however frequent, gathers rows; twins with a frequent remainder are salted.

Defined results: null and ASCII values are never cases; a value with U+FFFD or a C1 control is always one, restorable or not;
what can't be restored keeps its characters; an empty reference gives byte patterns only; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.lookalike import readings
from quillspark.operators.skew import salted_join
from quillspark.session import cut_lineage

#: Encodings that text may have been written in, and those it may have been read in.
WRITTEN = ("utf-8", "cp1252", "cp1251", "koi8_r", "cp866", "cp1253", "cp1255", "cp1250", "mac_roman", "cp437", "cp850", "shift_jis", "euc_jp", "gbk", "mac_cyrillic", "mac_greek")
READ = ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp866", "cp1253", "cp1250", "mac_cyrillic", "cp1255", "cp1254")
#: Encodings in which the bytes of UTF-8 are letters of other alphabets, so that sound words may hold the same sequences.
FOREIGN = ("cp1251", "koi8_r", "cp866", "cp1253", "cp1255", "mac_cyrillic")
#: Votes (aligned pieces or words that no stronger decoding explains) that a wrong decoding needs, and the share of all evidence.
VOTES, SHARE = 3, 0.0002
#: Words that must show an aligned piece, and the share that its clean side has of all clean sides of the garbled one.
SHOWN, CERTAIN = 3, 0.8
#: Characters that must be left of a word beside those beyond ASCII to tell of a twin.
TELLING = 3
#: Nats by which undoing a single-byte or East Asian decoding must make a value's words likelier, in all and for each pair of
#: characters: a small gain must be concentrated, a large one may be spread over a long word.
GAINS = ((6.0, 2.0), (7.0, 0.85))
#: Nats by which the mean log probability of a plausible word's pairs may lie below that of clean text in its script.
BELOW_MEAN = 2.4
#: Log probability of a pair with an unknown letter of the same script, and of one that no language has.
RARE, ALIEN = -6.0, -12.0
CONTROL = re.compile("[\x80-\x9f�]")


def to_bytes(text: str, read: str) -> bytes | None:
    """The bytes that were read as text; bytes without a character in the encoding were kept as controls."""
    try:
        return text.encode(read)
    except UnicodeEncodeError:
        pass
    out = bytearray()
    for ch in text:
        try:
            out += ch.encode(read)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) <= 0x9F and ch != "\xa0":
                return None
            out.append(ord(ch))
    return bytes(out)


def undo(text: str, written: str, read: str) -> str | None:
    """The text as it was written, or None if that decoding can't have made it."""
    b = to_bytes(text, read)
    if b is None:
        return None
    try:
        return b.decode(written)
    except UnicodeDecodeError:
        return None


def redo(text: str, written: str, read: str) -> str | None:
    """What a wrong decoding makes of text."""
    try:
        b = text.encode(written)
    except UnicodeEncodeError:
        return None
    return "".join(_decoded(read)[x] for x in b)


def undo_all(text: str) -> dict[str, list[int]]:
    """What the text may have been, each with the wrong decodings (positions in ALL_DECODINGS) that say so."""
    beyond = frozenset(text) - _ASCII
    by_bytes: dict[bytes, list[str]] = {}
    for read in READ:
        if beyond <= _readable_in(read) and (b := to_bytes(text, read)) is not None:
            by_bytes.setdefault(b, []).append(read)
    out: dict[str, list[int]] = {}
    for b, reads in by_bytes.items():
        for written in WRITTEN:
            try:
                made = b.decode(written)
            except UnicodeDecodeError:
                continue
            if made != text:
                out.setdefault(made, []).extend(_NUMBER[written, r] for r in reads if r != written)
    return {made: ks for made, ks in out.items() if ks}


_ASCII = frozenset(map(chr, range(128)))


@lru_cache
def _readable_in(read: str) -> frozenset[str]:
    """Characters that bytes beyond ASCII become."""
    return frozenset(_decoded(read)) | frozenset(map(chr, range(0x80, 0xA1)))


_DECODED: dict[str, list[str]] = {}


def _decoded(read: str) -> list[str]:
    if read not in _DECODED:
        _DECODED[read] = [c if (c := bytes([x]).decode(read, "replace")) != "�" else chr(x) for x in range(256)]
    return _DECODED[read]


def _script(ch: str) -> int:
    """A block of the same alphabet; 0 for what belongs to none."""
    c = ord(ch)
    if not ch.isalpha():
        return 0
    return 1 if c < 0x250 else 2 if 0x370 <= c < 0x400 else 3 if 0x400 <= c < 0x530 else 4 if 0x590 <= c < 0x600 else 5 if c >= 0x3040 else 6


class _Scripts(dict):
    def __missing__(self, ch: str) -> int:
        self[ch] = got = _script(ch)
        return got


class _Pairs(dict):
    """Log probabilities of pairs of characters as they stand, made as they are needed. A pair of letters of two scripts counts -ONE more."""

    def __init__(self, model: CharacterModel) -> None:
        self.model = model

    def __missing__(self, pair: tuple[str, str]) -> float:
        a, b = fold(pair[0]), fold(pair[1])
        m, sa, sb = self.model, _script(a), _script(b)
        if sa and sb and sa != sb:
            got = ALIEN - ONE
        elif a not in m._after or b not in m._single:
            # A letter that the clean text lacks, written as its neighbour is: it may belong to another language.
            got = RARE if sa and (pair[0].islower() or pair[1].isupper()) and (pair[1].islower() or pair[0].isupper()) and not (pair[0].islower() and pair[1].isupper()) else ALIEN
        else:
            got = math.log(0.85 * m.pairs.get(a + b, 0) / m._after[a] + 0.15 * m._single[b] * 0.5 + 1e-6)
        self[pair] = got
        return got


ONE = 1e6


@dataclass
class CharacterModel:
    """Counts of neighbouring characters (case folded, digits as 0) in clean text; a blank stands around words."""

    pairs: dict[str, int]

    def __getstate__(self) -> dict:
        return {"pairs": self.pairs}  # the rest is made anew

    @cached_property
    def _after(self) -> Counter:
        c: Counter = Counter()
        for p, n in self.pairs.items():
            c[p[0]] += n
        return c

    @cached_property
    def _single(self) -> dict[str, float]:
        one: Counter = Counter()
        script: Counter = Counter()
        for p, n in self.pairs.items():
            one[p[1]] += n
        for ch, n in one.items():
            script[_script(ch)] += n
        return {ch: n / script[_script(ch)] for ch, n in one.items()}

    @cached_property
    def alphabet(self) -> frozenset[str]:
        low = set("".join(self.pairs)) - {" "}
        return frozenset(low | {ch.upper() for ch in low if len(ch.upper()) == 1} | set("0123456789" if "0" in low else ""))

    @cached_property
    def _of(self) -> _Pairs:
        return _Pairs(self)

    @cached_property
    def _scripts(self) -> _Scripts:
        return _Scripts()

    @cached_property
    def _readable(self) -> dict[str, bool]:
        return {}

    def score(self, word: str) -> tuple[float, int, bool]:
        """Log probability, number of pairs, and whether all characters are known and no two letters of different scripts meet."""
        total = sum(map(self._of.__getitem__, zip(word, word[1:], strict=False)))
        sound = self.alphabet.issuperset(word)
        if total < -ONE:
            total, sound = total + ONE * int(-total // ONE), False
        return total, max(len(word) - 1, 0), sound

    def plausible(self, word: str) -> bool:
        total, n, sound = self.score(word)
        return sound and (n == 0 or total / n >= self._usual[next(filter(None, map(self._scripts.__getitem__, word)), 0)] - BELOW_MEAN)

    def readable(self, word: str) -> bool:
        """Plausible as it stands, or as what it looks like."""
        if (got := self._readable.get(word)) is None:
            if len(self._readable) > 300_000:
                self._readable.clear()
            got = self._readable[word] = self.plausible(word) or any(all(map(self.plausible, r.split(" "))) for r in readings(word))
        return got

    @cached_property
    def _usual(self) -> dict[int, float]:
        """Mean log probability of a pair in clean text, by script."""
        lp, n = defaultdict(float), defaultdict(int)
        for p, k in self.pairs.items():
            if " " not in p:
                lp[_script(p[0])] += k * self.score(p)[0]
                n[_script(p[0])] += k
        return defaultdict(lambda: -3.0, {s: lp[s] / n[s] for s in n})


def fold(word: str) -> str:
    return re.sub(r"\d", "0", word.lower())


def _utf8_pattern(read: str) -> re.Pattern[str]:
    d = _decoded(read)
    cls = lambda lo, hi: "[" + "".join(re.escape(d[x]) for x in range(lo, hi)) + "]"
    cont = cls(0x80, 0xC0)
    return re.compile(f"{cls(0xC2, 0xE0)}{cont}|{cls(0xE0, 0xF0)}{cont}{{2}}|{cls(0xF0, 0xF5)}{cont}{{3}}")


@dataclass
class Restorer:
    """The learned wrong decodings, ready for one value after the other."""

    model: CharacterModel
    decodings: list[tuple[str, str]]
    mapping: dict[str, str] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"model": self.model, "decodings": self.decodings, "mapping": self.mapping}

    @cached_property
    def _pieces_known(self) -> re.Pattern[str] | None:
        return re.compile("|".join(map(re.escape, sorted(self.mapping, key=lambda g: (-len(g), g))))) if self.mapping else None

    def _mapped(self, word: str) -> str:
        """The word with the learned pieces put back."""
        return self._pieces_known.sub(lambda m: self.mapping[m[0]], word)

    @cached_property
    def _wide(self) -> list[tuple[str, re.Pattern[str]]]:
        return [(r, _utf8_pattern(r)) for w, r in self.decodings if w == "utf-8"]

    @cached_property
    def _telling(self) -> re.Pattern[str] | None:
        """Sequences that alone tell of a wrong decoding: those that don't begin with letters of another alphabet."""
        own = [p.pattern for r, p in self._wide if r not in FOREIGN]
        return re.compile("|".join(own)) if own else None

    @cached_property
    def _narrow(self) -> list[tuple[int, str, str]]:
        return [(k, w, r) for k, (w, r) in enumerate(self.decodings) if w != "utf-8"]

    @cached_property
    def _seen(self) -> dict[str, list[tuple[int, float, int]]]:
        return {}

    def _known(self, ch: str) -> bool:
        return ch in self.model.alphabet or 0x2010 <= ord(ch) <= 0x20CF or 0xA0 <= ord(ch) <= 0xFF

    def _unread_utf8(self, word: str) -> str | None:
        """The word with UTF-8 sequences undone, if it holds any, once or twice."""
        best = None
        beyond = sum(c > "\x7f" for c in word)
        for read, pattern in self._wide:
            covered, fits = 0, True
            for m in pattern.finditer(word):
                made = undo(m[0], "utf-8", read)
                if made is None or not (self._known(made) or made in _decoded("cp1252")):
                    fits = False
                    break
                covered += sum(c > "\x7f" for c in m[0])
            if fits and covered and covered >= (beyond if read in FOREIGN else 0.6 * beyond) and (best is None or covered > best[0]):
                best = (covered, pattern.sub(lambda m, read=read: undo(m[0], "utf-8", read) or m[0], word))
        if best is None or best[1] == word:
            return None
        return self._unread_utf8(best[1]) or best[1]

    def _candidates(self, word: str) -> list[tuple[int, float, int]]:
        """(decoding, gain, pairs) for an implausible word."""
        if (got := self._seen.get(word)) is not None:
            return got
        got = []
        score = self.model.score
        old = max(score(w)[0] for w in [word, *(r for r in readings(word) if score(r)[2])])
        for k, written, read in self._narrow:
            new = undo(word, written, read)
            if new is not None and new != word and self.model.plausible(new) and (n := score(new)[1]):
                got.append((k, score(new)[0] - old, n))
        if not got and self._pieces_known is not None and (new := self._mapped(word)) != word and self.model.plausible(new) and (n := score(new)[1]):
            got.append((-1, score(new)[0] - old, n))
        if len(self._seen) > 100_000:
            self._seen.clear()
        self._seen[word] = got
        return got

    def restore(self, text: str | None) -> tuple[bool, str | None]:
        """(is a case, the text as far as it can be restored)."""
        if text is None or text.isascii():
            return False, text
        pieces = _PIECES.split(text)
        readable = self.model.readable
        telling = self._telling.search if self._telling is not None and self._telling.search(text) else lambda w: None
        odd = [k for k, w in enumerate(pieces) if not w.isascii() and (not readable(w) or telling(w))]
        case = CONTROL.search(text) is not None
        if not odd:
            return case, text
        out = list(pieces)
        for k in odd:
            if (made := self._unread_utf8(pieces[k])) is not None:
                out[k] = made
        if out != pieces:
            case = True
            for k, w in enumerate(pieces):  # words that are readable by chance, too
                if out[k] is w and not w.isascii() and (made := self._unread_utf8(w)) is not None and self.model.plausible(made):
                    out[k] = made
        else:
            gains: dict[int, float] = defaultdict(float)
            pairs: dict[int, int] = defaultdict(int)
            for k in odd:
                for c, gain, n in self._candidates(pieces[k]):
                    gains[c] += gain
                    pairs[c] += n
            best = max(gains, key=lambda c: (gains[c], -c), default=None)
            if best is not None and any(gains[best] >= whole and gains[best] >= each * pairs[best] for whole, each in GAINS):
                case = True
                for k, w in enumerate(pieces):
                    new = None if w.isascii() else self._mapped(w) if best < 0 else undo(w, *self.decodings[best])
                    if new is not None and self.model.plausible(new) and self.model.score(new)[0] > self.model.score(w)[0]:
                        out[k] = new
        if case and CONTROL.search("".join(out)):  # encodings of more bytes, whose bytes may lie in ASCII
            for _, written, read in self._narrow:
                new = undo(text, written, read)
                if new is not None and new != text and all(self._known(c) for c in new if c > "\x7f"):
                    return True, new
        return case, "".join(out)


_PIECES = re.compile(r"([ /_\\])")


def _words_of(text: F.Column, at: str = r"[ \n\r\t/_\\]+") -> F.Column:
    return F.explode(F.array_distinct(F.split(text, at)))


def character_model(clean: DataFrame, text_col: str) -> CharacterModel:
    """Counts of neighbouring characters over the whole of a text column; their number is bounded by the alphabet."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        for pdf in batches:
            for t in pdf["text"]:
                words.update(t.split())
        pairs: Counter = Counter()
        for w, n in words.items():
            w = fold(w)
            for a, b in zip(" " + w, w + " ", strict=True):
                pairs[a + b] += n
        yield pd.DataFrame(list(pairs.items()), columns=["pair", "n"])

    rows = clean.select(F.col(text_col).alias("text")).where("text IS NOT NULL").mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    return CharacterModel({r["pair"]: r["n"] for r in rows})


def skeleton(word: F.Column) -> F.Column:
    return F.regexp_replace(word, r"[^\x00-\x7F]+", "")


def aligned_runs(garbled: str, clean: str) -> list[tuple[str, str]]:
    """Runs of other characters between the same ASCII characters of two words with one skeleton."""
    split = lambda w: re.split("[\x00-\x7f]", w)
    return [(g, c) for g, c in zip(split(garbled), split(clean), strict=True) if g != c]


def aligned_pieces(garbled: str, clean: str) -> list[tuple[str, str]]:
    """The runs of two twins character by character: each clean one with its equal part of the garbled run."""
    out = []
    for g, c in aligned_runs(garbled, clean):
        if c and g and len(g) % len(c) == 0:
            k = len(g) // len(c)
            out += [(g[i * k : i * k + k], x) for i, x in enumerate(c)]
    return out


ALL_DECODINGS = [(w, r) for w in WRITTEN for r in READ if w != r]
_NUMBER = {d: k for k, d in enumerate(ALL_DECODINGS)}


def explained_by(garbled: str, clean: str) -> list[int]:
    """The wrong decodings that make the one of the other."""
    return [k for k, (w, r) in enumerate(ALL_DECODINGS) if redo(clean, w, r) == garbled]


def _chosen(evidence: DataFrame, votes: int) -> list[tuple[str, str]]:
    """The wrong decodings that are the strongest explanation of enough evidence. evidence: ``ks`` of each piece or word."""
    in_all = {r["k"]: r["n"] for r in evidence.select(F.explode("ks").alias("k")).groupBy("k").agg(F.count("*").alias("n")).collect()}
    order = sorted(in_all, key=lambda k: (-in_all[k], k))
    if not order:
        return []
    rank = F.array(*map(F.lit, [order.index(k) if k in in_all else len(order) for k in range(len(ALL_DECODINGS))]))
    best = F.array_min(F.transform("ks", lambda k: F.get(rank, k)))
    won = {r["best"]: r["n"] for r in evidence.select(best.alias("best")).groupBy("best").agg(F.count("*").alias("n")).collect()}
    enough = max(votes, SHARE * sum(won.values()))
    return [ALL_DECODINGS[order[b]] for b in sorted(won, key=lambda b: (-won[b], b)) if won[b] >= enough]


def learn(examined: list[tuple[DataFrame, str]], references: list[tuple[DataFrame, str]], model_text: tuple[DataFrame, str], votes: int = VOTES) -> Restorer:
    """examined: (table, column) to look through; references: (table, column) of clean text; model_text: the reference in running text."""
    model = character_model(*model_text)
    beyond = lambda c: c.rlike(r"[^\x00-\x7F]")

    def words(tables: list[tuple[DataFrame, str]]) -> DataFrame:
        parts = []
        for df, col in tables:
            t = df.where(beyond(F.col(col)))
            parts.append(t.select(_words_of(F.col(col)).alias("word")))
            parts.append(t.where(F.col(col).rlike(r"\.\w+$") & ~F.col(col).contains(" ")).select(F.col(col).alias("word")))  # paths
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out.where(beyond(F.col("word"))).distinct()

    def odd(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Words that aren't plausible as they stand, as only these can be cases."""
        for pdf in batches:
            yield pdf[np.array([not model.readable(w) for w in pdf["word"]], bool)]

    suspects = cut_lineage(words(examined).mapInPandas(odd, "word string"))
    clean = words(references)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(w, g, c) for w, t in zip(pdf["word"], pdf["twin"], strict=True) for g, c in set(aligned_pieces(w, t))]
            yield pd.DataFrame(rows, columns=["word", "garbled", "clean"])

    left = skeleton(F.col("word")).alias("skeleton")
    known = clean.select(left, F.col("word").alias("twin")).where(F.length("skeleton") >= TELLING)
    twins = salted_join(suspects.select("word", left).where(F.length("skeleton") >= TELLING), known, "skeleton", ["word"]).where("word <> twin").select("word", "twin")
    shown = twins.mapInPandas(align, "word string, garbled string, clean string").groupBy("garbled", "clean").agg(F.count_distinct("word").alias("n"))
    pieces = cut_lineage(shown.where(F.col("n") >= SHOWN))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"ks": [explained_by(g, c) for g, c in zip(pdf["garbled"], pdf["clean"], strict=True)]})

    def undone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(w, u, ks, len(u) >= 8 and model.plausible(u)) for w in pdf["word"] for u, ks in undo_all(w).items() if len(u) >= 4 and not u.isascii()]
            yield pd.DataFrame(rows, columns=["word", "undone", "ks", "sound"])

    far = cut_lineage(suspects.mapInPandas(undone, "word string, undone string, ks array<int>, sound boolean"))
    hit = far.where("sound").unionAll(far.where("NOT sound").join(clean.select(F.col("word").alias("undone")), "undone", "left_semi").select(far.columns))
    of_words = hit.groupBy("word").agg(F.array_distinct(F.flatten(F.collect_list("ks"))).alias("ks")).select("ks")
    evidence = cut_lineage(pieces.mapInPandas(explain, "ks array<int>").where("size(ks) > 0").unionAll(of_words))
    # The mapping: single characters whose garbled form has one clean side.
    table: dict[str, Counter] = defaultdict(Counter)
    for r in pieces.where("garbled <> clean").collect():
        table[r["garbled"]][r["clean"]] += r["n"]
    mapping = {}
    for g, c in table.items():
        best, n = max(c.items(), key=lambda x: (x[1], x[0]))
        if n >= CERTAIN * c.total() and not all(ch in model.alphabet for ch in g):
            mapping[g] = best
    return Restorer(model, _chosen(evidence, votes), mapping)


def restored(df: DataFrame, key_col: str, text_col: str, by: Restorer) -> DataFrame:
    """``record_key, damaged, restored``: the cases of a column, each value looked at where it lies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(k, t, r) for k, t in zip(pdf["record_key"], pdf["text"], strict=True) for case, r in (by.restore(t),) if case]
            yield pd.DataFrame(got, columns=["record_key", "damaged", "restored"])

    rows = df.select(F.col(key_col).cast("string").alias("record_key"), F.col(text_col).alias("text")).where(F.col("text").rlike(r"[^\x00-\x7F]") & F.col("record_key").isNotNull())
    return rows.mapInPandas(run, "record_key string, damaged string, restored string").distinct()


def is_damaged(text: F.Column, by: Restorer) -> F.Column:
    """A condition for texts that are cases."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([by.restore(t)[0] for t in texts], dtype=bool)

    return F.coalesce(run(text), F.lit(False))


def restore_all(values: Iterable[str | None], by: Restorer) -> list[tuple[bool, str | None]]:
    return [by.restore(v) for v in values]
