"""Passages of held-out texts inside a corpus, exact or with changed words.

Texts become words: letter case, punctuation, markup, line starts and breaks, words divided at a line end and spacing are gone.
An item leaks into a document if they share a run of at least 12 words of which at most one in ten is changed. m changed words
cut a run of at least 10 m words into m + 1 pieces with 9 m words together. If no 12 words in a row have at most one change, two
neighbouring pieces have at most 10 words; pairing the pieces, 9 m is at most 5 (m + 1) for odd m and 5 m + 10 for even m, so m
is 2. Then the outer pieces have 8 words at least and the inner one 2 at most: the changes lie within 4 words in a row.

Spaced seeds find both kinds: three masks over 12 positions ignore positions 1-4, 5-8 and 9-12. Whatever one word is changed, one
mask ignores it; two changes within 4 words are ignored by the second mask at the window that begins 4 words before the first.

The hashes of all masked windows of the items and of the documents are joined. Documents are read once, whatever the number of
items, and most of their windows never leave the task that made them: the items' hashes fill a Bloom filter (built where the
items lie, merged by union; its size is bounded by MAX_BITS, beyond which it only lets more windows pass), and only stretches
around windows that pass it are written to the checkpoint folder, as numbers. Their hashes are joined with the items' hashes,
hot ones (a passage that a third of all documents hold) salted; hits on one diagonal of a document and an item count once; around
them the words themselves are compared, and a hit stands only if the run begins and ends with an equal word. Items are never
gathered anywhere.

Windows of one text that are equal in their hash and in all words that a comparison may look at give the same answer; the first
stands for all, so a text that repeats one line ten thousand times costs no more than one that has it once.

Defined results: null texts and null ids give nothing; items under 12 words never match; repeated documents count each
under their own id; several rows with one id count together; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.skew import salted_join
from quillspark.session import cut_lineage

WINDOW, PART = 12, 4
#: Words per changed word.
PER_CHANGE = 10
#: Words before and behind a hit that are compared.
REACH = 2 * WINDOW
#: Bits of the filter for each window of the items, and in all (128 MB).
BITS_PER_WINDOW, MAX_BITS = 32, 1 << 30
#: Words whose hashes a worker keeps at hand.
CACHE = 500_000
#: Texts that are worked on together.
TEXTS_AT_ONCE = 200

_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_DIVIDED = re.compile(r"(?<=\w)[-­‐][ \t]*\r?\n[ \t>*•–|#]*(?=[^\W\d_])")
_ENUMERATED = re.compile(r"^[ \t>*•–|#-]*\(?\d{1,4}[.):\]][ \t]", re.MULTILINE)
_WORD = re.compile(r"[^\W_]+")
#: Letters that an apostrophe cuts off; they count as part of their word, whether the apostrophe is there or was taken out.
_CUT_OFF = frozenset("sdtlcjnm")


def words_of(text: str) -> list[str]:
    """The words that are compared."""
    if "<" in text:
        text = _TAG.sub("", text)
    if "\n" in text or "\r" in text:
        if "\r" in text:
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        text = _DIVIDED.sub("", text)
        text = _ENUMERATED.sub("", text)
    if "\xad" in text:
        text = text.replace("\xad", "")
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return [w for w in _WORD.findall(text.casefold()) if w not in _CUT_OFF]



_RNG = np.random.default_rng(7)
#: Odd factors: of the words of a part of a window, and of the two parts that a mask leaves.
_IN_PART, _OF_PARTS, _IN_SPAN = (_RNG.integers(1, 2**63, n, dtype=np.int64) | 1 for n in (PART, 2, WINDOW + 2 * REACH))
#: The parts of a window (by their first word) that each mask leaves.
MASKS = ((4, 8), (0, 8), (0, 4))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word) - (1 << 63) or 1  # 0 stands between texts
        return h


class Batch:
    """The words of some texts in a row, as numbers, with a gap of zeros before and after each."""

    def __init__(self, texts: list[list[str]], hashes: _WordHashes) -> None:
        gap = [0] * (WINDOW + REACH)
        flat, of = list(gap), [np.full(len(gap), -1)]
        for k, ws in enumerate(texts):
            flat += map(hashes.__getitem__, ws)
            flat += gap
            of += [np.full(len(ws), k), np.full(len(gap), -1)]
        self.words, self.of = np.array(flat, np.int64), np.concatenate(of)
        self.first = np.concatenate(([len(gap)], len(gap) + np.cumsum([len(ws) + len(gap) for ws in texts])))

    def windows(self, keep: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mask, start, hash) of all windows that lie in one text and whose hash is kept."""
        n = len(self.words) - WINDOW + 1
        if n <= 0:
            return np.empty(0, np.int8), np.empty(0, np.int64), np.empty(0, np.int64)
        inside = (self.of[:n] >= 0) & (self.of[:n] == self.of[WINDOW - 1 :])
        with np.errstate(over="ignore"):
            parts = sum(self.words[k : k + n + 2 * PART] * _IN_PART[k] for k in range(PART))
            parts ^= parts >> 29
        out = []
        for m, (p, q) in enumerate(MASKS):
            with np.errstate(over="ignore"):
                h = (parts[p : p + n] * _OF_PARTS[0] + parts[q : q + n] * _OF_PARTS[1]) * np.int64(-7046029254386353131) + m
                h ^= h >> 31
            good = inside if keep is None else inside & keep(h)
            at = np.flatnonzero(good)
            out.append((np.full(len(at), m, np.int8), at, h[at]))
        mask, start, h = (np.concatenate(x) for x in zip(*out, strict=True))
        return self._first_of_equal(mask, start, h)

    def _first_of_equal(self, mask: np.ndarray, start: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of windows of one text with one hash and the same surroundings, the first."""
        if not len(h):
            return mask, start, h
        span = np.zeros(len(h), np.int64)
        with np.errstate(over="ignore"):
            for k in range(-REACH, WINDOW + REACH):
                span += self.words[start + k] * _IN_SPAN[k + REACH]
        order = np.lexsort((start, span, h, self.of[start]))
        key = np.stack([self.of[start], span, h])[:, order]
        new = np.ones(len(h), bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        first = np.sort(order[new])
        return mask[first], start[first], h[first]


def _bits_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    u = h.view(np.uint64)
    return (u >> np.uint64(8)) & np.uint64(bits - 1), (u * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & np.uint64(bits - 1)


class BloomFilter:
    """Which hashes may be among the items'."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, self.bits = data, 8 * len(data)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        a, b = _bits_of(h, self.bits)
        got = self.data[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8) & 1
        some = np.flatnonzero(got)
        b = b[some]
        got[some] = self.data[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8) & 1
        return got.astype(bool)


def _texts(df: DataFrame, id_col: str) -> DataFrame:
    return df.where(f"{id_col} IS NOT NULL AND text IS NOT NULL").select(F.col(id_col).cast("long").alias("id"), F.col("text").cast("string").alias("text"))


_STRETCH = "id long, key long, words array<long>, starts array<int>, hashes array<long>"


def stretches(df: DataFrame, id_col: str, keep: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None, whole: bool = False) -> DataFrame:
    """``id, key, words, starts, hashes``: pieces of each text with the windows that are kept, and all words round them.

    keep: makes the filter of a worker. whole: texts as they are, one piece each. key tells the pieces of all rows apart, also
    of rows with one id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, kept = _WordHashes(), keep() if keep is not None else None
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                raw = part.column("text").to_pylist()
                texts = Batch([words_of(t) for t in raw], hashes)
                _, start, h = texts.windows(kept)
                if not len(start):
                    continue
                order = np.argsort(start, kind="stable")
                start, h = start[order], h[order]
                of = texts.of[start]
                apart = of[1:] != of[:-1] if whole else (of[1:] != of[:-1]) | (start[1:] - start[:-1] > WINDOW + 2 * REACH)
                cuts = np.concatenate(([0], np.flatnonzero(apart) + 1, [len(start)]))
                rows = []
                for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    k = of[a]
                    first, end = texts.first[k], texts.first[k + 1] - WINDOW - REACH
                    lo, hi = (first, end) if whole else (max(first, start[a] - 2 * REACH), min(end, start[z - 1] + WINDOW + 2 * REACH))
                    rows.append((k, xxhash.xxh64_intdigest(f"{lo - first} {raw[k]}") - (1 << 63), texts.words[lo:hi], start[a:z] - lo, h[a:z]))
                k, key, *lists = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(k)), pa.array(key, pa.int64()), pa.array(lists[0], pa.list_(pa.int64())), pa.array(lists[1], pa.list_(pa.int32())), pa.array(lists[2], pa.list_(pa.int64()))],
                    names=["id", "key", "words", "starts", "hashes"],
                )

    return _texts(df, id_col).mapInArrow(run, _STRETCH)


def item_filter(items: DataFrame) -> np.ndarray:
    """The bits of all hashes of ``stretches``: set part by part where the items lie, joined as short pieces of at most 64 KB."""
    windows = items.agg(F.sum(F.size("hashes")).alias("n")).first()["n"] or 0
    bits = 1 << 16
    while bits < min(MAX_BITS, windows * BITS_PER_WINDOW):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            h = batch.column("hashes").flatten().to_numpy(zero_copy_only=False)
            at = np.unique(np.concatenate(_bits_of(h, bits)))
            if len(at):
                byte, first = np.unique(at >> np.uint64(3), return_index=True)
                data[byte] |= np.bitwise_or.reduceat(np.uint8(1) << (at & np.uint64(7)).astype(np.uint8), first)
        packed = data.reshape(-1, min(bits // 8, 1 << 16))
        some = np.flatnonzero(packed.any(axis=1))
        for k in some.tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed[k].tobytes()], pa.binary())], names=["piece", "bits"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("piece").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                own = np.frombuffer(x, np.uint8)
                found[k] = found[k] | own if k in found else own
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["piece", "bits"])

    pieces = items.select("hashes").mapInArrow(run, "piece int, bits binary").repartition("piece").mapInArrow(union, "piece int, bits binary")
    out = np.zeros((max(1, bits // 8 // (1 << 16)), min(bits // 8, 1 << 16)), np.uint8)
    for r in pieces.toLocalIterator():
        out[r["piece"]] |= np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _runs(d: np.ndarray, i: np.ndarray) -> bool:
    """Whether two sequences of words, laid side by side, hold a run that begins and ends equal with few enough changes."""
    equal = (d == i) & (d != 0)
    changes = np.concatenate(([0], np.cumsum(~equal)))
    for length in range(WINDOW, min(WINDOW + 2 * WINDOW, len(equal)) + 1):
        few = changes[length:] - changes[:-length] <= length // PER_CHANGE
        if (few & equal[: len(equal) - length + 1] & equal[length - 1 :]).any():
            return True
    return False


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits whose words hold such a run."""
    for batch in batches:
        good = []
        columns = [batch.column(c) for c in ("doc_words", "item_words", "diagonal", "lo", "hi")]
        for k in range(len(batch)):
            d, i = (columns[c][k].values.to_numpy(zero_copy_only=False) for c in (0, 1))
            shift, lo, hi = (columns[c][k].as_py() for c in (2, 3, 4))
            a, z = max(lo - REACH, 0, shift), min(hi + WINDOW + REACH, len(d), len(i) + shift)
            good.append(z - a >= WINDOW and _runs(d[a:z], i[a - shift : z - shift]))
        kept = batch.select(["doc_id", "item_id"]).filter(pa.array(good, pa.bool_()))
        if len(kept):
            yield kept


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id``: each document with every item it leaks."""
    of_items = cut_lineage(stretches(items, "item_id", whole=True).dropDuplicates(["id", "key"]))
    sent = documents.sparkSession.sparkContext.broadcast(item_filter(of_items))
    of_docs = cut_lineage(stretches(documents, "doc_id", lambda: BloomFilter(sent.value)))

    def seeds(s: DataFrame, name: str) -> DataFrame:
        each = s.select(F.col("id").alias(f"{name}_id"), F.col("key").alias(f"{name}_key"), F.explode(F.arrays_zip("hashes", "starts")).alias("s"))
        return each.select(f"{name}_id", f"{name}_key", F.col("s.hashes").alias("hash"), F.col("s.starts").alias(f"{name}_at"))

    hits = salted_join(seeds(of_docs, "doc"), seeds(of_items, "item"), "hash", ["doc_id", "doc_key"])
    diagonal = (F.col("doc_at") - F.col("item_at")).alias("diagonal")
    lines = hits.groupBy("doc_id", "doc_key", "item_id", "item_key", diagonal).agg(F.min("doc_at").alias("lo"), F.max("doc_at").alias("hi"))
    words_of_docs = of_docs.select(F.col("id").alias("doc_id"), F.col("key").alias("doc_key"), F.col("words").alias("doc_words")).dropDuplicates(["doc_id", "doc_key"])
    words_of_items = of_items.select(F.col("key").alias("item_key"), F.col("words").alias("item_words")).dropDuplicates(["item_key"])  # items with one text have one key
    with_words = salted_join(cut_lineage(lines.join(words_of_docs, ["doc_id", "doc_key"])), words_of_items, "item_key", ["doc_id", "doc_key"])
    return with_words.mapInArrow(_verified, "doc_id long, item_id long").distinct()
