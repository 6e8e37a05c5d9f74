"""Occurrences and document frequency of every distinct term, from compressed record-identifier bitmaps.

Vertical layout: each partition turns its records into one bitmap per term and block of 65,536 record ids, with a counter
of occurrences for each record that holds a term more than once. A bitmap is a sorted array of 16-bit numbers, or, from
4,096 members on, a bit set of 8 kB. Bitmaps of the same term and block are merged by union; the document frequency is the
sum of their cardinalities, the occurrences are the cardinalities plus the counters.

A term that fills a third of all records is spread over as many merges as there are blocks of ids, so no task holds it whole;
rows are already combined in each partition before they are shuffled. A record that occurs twice counts once: union of
bitmaps keeps one bit for it, and of two counters for the same record the larger is kept.

Defined results: null ids are left out; null values and empty pieces give no term; terms are compared exactly as stored;
a table without rows gives no row; other columns are ignored, whatever their names; ids may be any non-negative or negative BIGINT.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From this cardinality on a block's bitmap is a bit set.
DENSE = 4096
#: Occurrences that a partition holds before it hands on what it has.
FLUSH = 3_000_000
PART = "field_name string, term string, block long, bits binary, again binary"
MERGED = "field_name string, term string, n_docs long, n_occurrences long"


def _pieces(values: pa.Array, how: str) -> tuple[pa.Array, np.ndarray]:
    """Terms and the rows they come from; how: 'blank' cuts at U+0020, 'whole' takes the value."""
    if how == "whole":
        keep = pc.is_valid(values)
        return values.filter(keep), np.flatnonzero(keep.to_numpy(zero_copy_only=False))
    lists = pc.split_pattern(values, " ")
    terms, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    keep = pc.not_equal(terms, "")
    return terms.filter(keep), parents.filter(keep).to_numpy(zero_copy_only=False)


def _binary(flat: np.ndarray, starts: np.ndarray, width: int) -> pa.Array:
    """Cells of a flat array as binaries, without a loop; starts has one more entry than there are cells."""
    offsets = (starts * width).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def _bitmaps(code: np.ndarray, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Bitmap and counters of each (code, block). row: of each occurrence; rows of the same id are repeats of a record."""
    order = np.lexsort((row, ids, code))
    code, ids, row = code[order], ids[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])
    each = new.copy()
    each[1:] |= row[1:] != row[:-1]
    in_row = np.diff(np.append(np.flatnonzero(each), len(code)))
    n = np.maximum.reduceat(in_row, np.cumsum(each)[new] - 1)
    code, ids = code[new], ids[new]
    block, low = ids >> 16, (ids & 0xFFFF).astype("<u2")
    head = np.ones(len(code), bool)
    head[1:] = (code[1:] != code[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(head)
    bounds = np.append(at, len(code))
    bits = _binary(low, bounds, 2)
    size = np.diff(bounds)
    if (size >= DENSE).any():
        cells = bits.to_pylist()
        for k in np.flatnonzero(size >= DENSE):
            b = np.zeros(65536, bool)
            b[low[bounds[k] : bounds[k + 1]]] = True
            cells[k] = np.packbits(b, bitorder="little").tobytes()
        bits = pa.array(cells, pa.binary())
    many = n > 1
    pairs = np.empty(int(many.sum()), [("low", "<u2"), ("more", "<u4")])
    pairs["low"], pairs["more"] = low[many], n[many] - 1
    again = _binary(pairs, np.append(0, np.cumsum(many))[bounds], 6)
    return code[at], block[at], bits, again


def _members(bits: bytes) -> np.ndarray:
    if len(bits) == 8192:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    return np.frombuffer(bits, "<u2").astype(np.int64)


def term_bitmaps(df: DataFrame, id_col: str, fields: dict[str, str]) -> DataFrame:
    """``field_name, term, block, bits, again``: one row per partition, term and block of ids. fields: column to 'blank' or 'whole'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[pa.Array, np.ndarray, np.ndarray]]] = {f: [] for f in fields}
        n = rows = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            for field, parts in held.items():
                if not parts:
                    continue
                words = pa.chunked_array([p for p, _, _ in parts]).dictionary_encode().unify_dictionaries().combine_chunks()
                code, block, bits, again = _bitmaps(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), *(np.concatenate([p[k] for p in parts]) for k in (1, 2)))
                terms = words.dictionary.take(pa.array(code))
                for a in range(0, len(code), 50_000):
                    cut = slice(a, a + 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array([field] * len(code[cut])), terms[cut], pa.array(block[cut]), bits[cut], again[cut]], names=["field_name", "term", "block", "bits", "again"])
                parts.clear()

        for b in batches:
            valid = b.column("id").is_valid()
            b = b.filter(valid)
            ids = b.column("id").to_numpy(zero_copy_only=False)
            for field, how in fields.items():
                values = b.column(field)
                words, at = _pieces(values.cast(pa.string()), how)
                if len(words):
                    held[field].append((words, ids[at], at + rows))
                    n += len(words)
            rows += len(b)
            if n >= FLUSH:
                yield from hand_on()
                n = 0
        yield from hand_on()

    return df.select(F.col(id_col).cast("long").alias("id"), *(F.col(f).cast("string").alias(f) for f in fields)).mapInArrow(run, PART)


def merge_bitmaps(parts: DataFrame) -> DataFrame:
    """``field_name, term, n_docs, n_occurrences``: bitmaps of a term and block united, then added up over the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def unite(t: pa.Table) -> pa.RecordBatch:
            """All rows of t, whole (field, term, block) groups, which follow each other."""
            field, term, block = (t.column(c).combine_chunks() for c in ("field_name", "term", "block"))
            new = np.ones(len(t), bool)
            if len(t) > 1:
                same = pc.and_(pc.and_(pc.equal(field[1:], field[:-1]), pc.equal(term[1:], term[:-1])), pc.equal(block[1:], block[:-1]))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            bits, again = t.column("bits").combine_chunks(), t.column("again").combine_chunks()
            length = pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)
            more = pc.binary_length(again).to_numpy(zero_copy_only=False)
            docs, extra = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            alone = np.bincount(group, minlength=len(at)) == 1
            lone = alone[group]
            sparse = lone & (length != 8192)
            docs[group[sparse]] = length[sparse] // 2
            for k in np.flatnonzero(lone & ~sparse):
                docs[group[k]] = len(_members(bits[int(k)].as_py()))
            rest = np.flatnonzero(~lone)
            if len(rest):
                cells = [_members(bits[int(k)].as_py()) for k in rest]
                keys = np.repeat(group[rest], [len(c) for c in cells]) << 16 | np.concatenate(cells)
                docs += np.bincount(np.unique(keys) >> 16, minlength=len(at))
            counted = np.flatnonzero(more > 0)
            if len(counted):
                pairs = [np.frombuffer(again[int(k)].as_py(), [("low", "<u2"), ("more", "<u4")]) for k in counted]
                key = np.repeat(group[counted], [len(p) for p in pairs]) << 16 | np.concatenate([p["low"] for p in pairs]).astype(np.int64)
                value = np.concatenate([p["more"] for p in pairs]).astype(np.int64)
                order = np.lexsort((value, key))
                key, value = key[order], value[order]
                last = np.append(key[1:] != key[:-1], True)
                extra += np.bincount(key[last] >> 16, weights=value[last], minlength=len(at)).astype(np.int64)
            where = pa.array(at)
            return pa.RecordBatch.from_arrays([field.take(where), term.take(where), pa.array(docs), pa.array(docs + extra)], names=["field_name", "term", "n_docs", "n_occurrences"])

        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) < 20_000:
                continue
            last = held.slice(len(held) - 1)
            same = pc.and_(pc.and_(pc.equal(held["field_name"], last["field_name"][0]), pc.equal(held["term"], last["term"][0])), pc.equal(held["block"], last["block"][0]))
            cut = int(np.argmax(same.to_numpy()))  # the last group may go on in the next batch
            if cut:
                yield unite(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and len(held):
            yield unite(held)

    keys = ["field_name", "term", "block"]
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, MERGED).groupBy("field_name", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_occurrences").alias("n_occurrences"))


def term_counts(df: DataFrame, id_col: str = "idx", fields: dict[str, str] | None = None) -> DataFrame:
    """``field_name, term, n_docs, n_occurrences`` over all records."""
    return merge_bitmaps(term_bitmaps(df, id_col, fields or {"text": "blank", "font_path": "whole"}))


def marked_terms(df: DataFrame, id_col: str = "idx", fields: dict[str, str] | None = None, rare_docs: int = 1, common_share: float = 0.02) -> DataFrame:
    """term_counts with ``mark``: 'rare' (in at most rare_docs records), 'common' (in more than common_share of all), or 'useful'."""
    n = df.agg(F.count_distinct(F.col(id_col)).alias("n_records"))  # one row
    mark = F.when(F.col("n_docs") <= rare_docs, "rare").when(F.col("n_docs") > common_share * F.col("n_records"), "common").otherwise("useful")
    return term_counts(df, id_col, fields).join(F.broadcast(n)).withColumn("mark", mark).drop("n_records")
