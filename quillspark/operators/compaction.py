"""Consolidation of very many small files into few well-sized containers, byte by byte.

Payloads are never parsed or changed on their way into a container. A manifest gives each file its container, place, length and
checksum; reading a container back by it returns every file as it was (``read_back``).

* Newline-delimited files are joined as they are; only where a file doesn't end in a line end, one is put between it and the
  next, outside its bytes. A file that is one record but has line ends inside goes to containers of their own (``blocks``), so
  that the others (``lines``) can be read line by line.
* Complete zstandard frames are joined as they are (``frames``): frames that follow each other are one stream. Between contents
  that would run together stands a frame of one line end. What isn't a row of complete frames is kept, apart, as a block.
* Where files begin with a header, those with the same header share containers, which begin with it; the manifest says how many
  of its bytes belong to each file. Frames with a header inside are opened for that.

Containers are even without a global sort: with T bytes of one kind and a target size there are n = ceil(T / target) of them, a
file goes to number hash(id) mod n, in the order of ids. A file beyond the target has a container of its own. Which files stay is
decided on ids, lengths and checksums; payloads are moved once, to their container, and no group grows beyond about the target.

Records written more than once: files with the same bytes are one from the start, by their checksum; for different bytes a
fingerprint that doesn't change with key order or white space (the sorted pieces between JSON punctuation) finds candidates, and
only these are read as JSON. Files with one record are a class; all pairs are written out only where they are asked for.

Defined results: a null or blank payload holds no record and is left out (it is listed by ``unfilled``); a null id is left
out; payloads that aren't JSON are the same record only if their bytes are equal; a table without rows gives no container;
columns beside those named are ignored, whatever their names; an id that occurs twice counts once, with its shortest payload
(of several, the one with the smallest checksum).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.draws import uniform
from quillspark.operators.skew import pairs_within, salted_join
from quillspark.session import cut_lineage

TARGET_BYTES = 8 << 20
#: Pieces of a label between JSON punctuation; white space counts nowhere.
_PUNCTUATION = r"[\s,{}\[\]]+"
_BREAK = b"\n"
LINES, BLOCKS, FRAMES = "lines", "blocks", "frames"


# Which files hold a record, and which hold the same ------------------------------------------------------------------

def filled(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json") -> DataFrame:
    """``file_id, payload``: one row per file that holds a record."""
    rows = files.select(F.col(id_col).alias("file_id"), F.col(payload_col).alias("payload")).where("file_id IS NOT NULL AND payload IS NOT NULL")
    return rows.where(F.octet_length("payload") > 0) if _is_binary(rows) else rows.where(~_blank(F.col("payload")))


def _is_binary(rows: DataFrame) -> bool:
    return isinstance(rows.schema["payload"].dataType, T.BinaryType)


def _blank(payload: Column) -> Column:
    return payload.rlike(r"\A\s*\z")


def unfilled(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json") -> DataFrame:
    """``file_id`` of the files without a record."""
    return files.where(F.col(payload_col).isNull() | _blank(F.col(payload_col).cast("string"))).select(F.col(id_col).alias("file_id")).distinct()


def fingerprint(payload: Column) -> Column:
    """Equal for payloads that are the same JSON value; without a backslash in the payload, computed without reading the JSON.

    Numbers count by value; pieces with a character beyond ASCII (or its escape) are left out, as they have several spellings.
    Where other characters may be escaped, the payload's one spelling is taken.
    """
    spelt = F.when(payload.contains("\\"), _canonical(payload)).otherwise(payload)
    pieces = F.split(F.regexp_replace(spelt, r'"\s*:\s*', '":,'), _PUNCTUATION)
    plain = F.filter(pieces, lambda p: (p != "") & ~p.rlike(r"\\|[^\x00-\x7F]"))
    by_value = F.transform(plain, lambda p: F.when(p.rlike(r"\A-?\d+([.eE][-+.\deE]*)?\z"), F.coalesce(p.try_cast("double").cast("string"), p)).otherwise(p))
    return F.xxhash64(F.array_sort(by_value))


def canonical_json(text: str) -> str:
    """The JSON value in one spelling; text that isn't JSON stays as it is. 1 and 1.0 are the same value."""

    def plain(x: object) -> object:
        if isinstance(x, float) and x.is_integer() and abs(x) < 2**63:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return x

    try:
        return json.dumps(plain(json.loads(text)), sort_keys=True, separators=(",", ":"))
    except (ValueError, RecursionError):
        return text


@F.pandas_udf(T.StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical_json, na_action="ignore")


def record_groups(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json") -> DataFrame:
    """``file_id, checksum, record`` (distinct): the files whose record some other file seems to hold too; record is equal for the same JSON value."""
    rows = filled(files, id_col, payload_col)
    checked = F.md5(F.col("payload").cast("binary")).alias("checksum")
    if _is_binary(rows):  # bytes of any kind: the same record is the same bytes
        seen = rows.select("file_id", checked).distinct()
        twice = seen.groupBy("checksum").agg(F.count("*").alias("n")).where("n > 1").select("checksum")
        return salted_join(seen, twice, "checksum", ["file_id"], "left_semi").select("file_id", "checksum", F.col("checksum").alias("record"))
    prints = cut_lineage(rows.select("file_id", checked, fingerprint(F.col("payload")).alias("print")))
    # Counts are combined before anything is moved.
    seen = prints.groupBy("print").agg(F.min("file_id").alias("lo"), F.max("file_id").alias("hi")).where("lo <> hi").select("print")
    again = cut_lineage(salted_join(prints, seen, "print", ["file_id"], "left_semi").select("file_id", "checksum").distinct())
    one_of = again.groupBy("checksum").agg(F.min("file_id").alias("file_id"))
    read = rows.join(one_of.select("file_id").distinct(), "file_id", "left_semi").select(checked, "payload").groupBy("checksum").agg(F.min("payload").alias("payload"))
    records = read.select("checksum", F.md5(_canonical("payload")).alias("record"))
    return salted_join(again, records, "checksum", ["file_id"]).select("file_id", "checksum", "record").distinct()


def record_classes(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json", only: DataFrame | None = None) -> DataFrame:
    """``file_id, record, first_file, n_links``: each file whose record others hold too, with the first of them and their number.

    only: ``file_id, checksum`` of the payloads that count.
    """
    g = record_groups(files, id_col, payload_col)
    g = cut_lineage((g if only is None else g.join(only, ["file_id", "checksum"], "left_semi")).select("file_id", "record").distinct())
    sizes = g.groupBy("record").agg(F.min("file_id").alias("first_file"), (F.count("*") - 1).alias("n_links")).where("n_links > 0")
    return salted_join(g, sizes, "record", ["file_id"]).select("file_id", "record", "first_file", "n_links")


def same_record_pairs(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json") -> DataFrame:
    """``file_id_a, file_id_b`` (a < b): files that hold the same record."""
    g = record_classes(files, id_col, payload_col).select("file_id", "record")
    return pairs_within(cut_lineage(g), "record", "file_id", "file_id_a", "file_id_b").distinct()


def copies(files: DataFrame, id_col: str, payload_col: str, only: DataFrame) -> DataFrame:
    """``file_id`` of the files that hold the same record as one with a smaller id."""
    return record_classes(files, id_col, payload_col, only).where("file_id <> first_file").select("file_id").distinct()


# Where each file goes ------------------------------------------------------------------------------------------------

def _described(rows: DataFrame, one_record: bool, header: bool) -> DataFrame:
    """``file_id, payload`` with ``kind, head`` (a header's checksum, or nothing), ``n_head, n_bytes, added, checksum``.

    n_bytes: what of the file's own bytes goes into the body; added: the line end between it and the next.
    """
    data = F.col("payload").cast("binary")
    text = F.col("payload") if not _is_binary(rows) else F.decode("payload", "ISO-8859-1")
    magic = F.hex(F.substring(data, 1, 4)) == "28B52FFD" if _is_binary(rows) else F.lit(False)
    is_frame = F.when(magic, _complete(data)).otherwise(False) if _is_binary(rows) else magic
    n = F.octet_length(data).cast("long")
    inside = text.rlike(r"(?s)[\r\n].") if one_record else F.lit(False)
    first = F.regexp_extract(text, r"\A([^\n]*\n)", 1) if header else F.lit("")
    n_head = F.when(is_frame, 0).otherwise(F.octet_length(F.encode(first, "ISO-8859-1" if _is_binary(rows) else "UTF-8"))).cast("long")
    kind = F.when(is_frame, FRAMES).when(magic | inside, BLOCKS).otherwise(LINES)
    head = F.when(n_head > 0, F.md5(first.cast("binary"))).otherwise("")
    added = F.when(is_frame, 0).when(text.endswith("\n"), 0).otherwise(1).cast("long")
    return rows.select("file_id", "payload", kind.alias("kind"), head.alias("head"), n_head.alias("n_head"), (n - n_head).alias("n_bytes"), added.alias("added"), F.md5(data).alias("checksum"))


def complete_frames(data: bytes) -> bool:
    """Whether bytes are a row of complete zstandard frames, told by the sizes in the headers of frames and blocks alone."""
    at, end = 0, len(data)
    number = lambda a, n: int.from_bytes(data[a : a + n], "little")
    while at < end:
        magic = number(at, 4)
        if magic & ~0xF == 0x184D2A50:  # may be skipped
            at += 8 + number(at + 4, 4)
            continue
        if magic != 0xFD2FB528 or at + 5 > end:
            return False
        d = data[at + 4]
        single = d >> 5 & 1
        at += 5 + (not single) + (0, 1, 2, 4)[d & 3] + (single, 2, 4, 8)[d >> 6]
        last = 0
        while not last:
            if at + 3 > end:
                return False
            block = number(at, 3)
            last, size = block & 1, block >> 3
            at += 3 + (1 if block >> 1 & 3 == 1 else size)
        at += 4 * (d >> 2 & 1)
    return at == end and end > 0


@F.pandas_udf(T.BooleanType())
def _complete(payloads: pd.Series) -> pd.Series:
    return payloads.map(lambda p: p is not None and complete_frames(bytes(p))).astype(bool)


def _container(totals: Column, n: Column, target: int) -> Column:
    """The container of a file; totals: bytes of its kind and header."""
    kind = F.concat_ws("-", "kind", F.when(F.col("head") != "", F.substring("head", 1, 8)))
    number = F.floor(uniform(F.col("file_id"), "container") * F.greatest(F.lit(1.0), F.ceil(totals / target).cast("double"))).cast("bigint")
    return F.when(n > target, F.concat_ws("-", kind, F.lit("large"), F.col("file_id").cast("string"))).otherwise(F.concat_ws("-", kind, F.lpad(number.cast("string"), 7, "0")))


def _placed(files: DataFrame, id_col: str, payload_col: str, target: int, one_record: bool, header: bool) -> tuple[DataFrame, DataFrame]:
    """(all filled files with payload and container, the placed ones without payload): both from one rule."""
    described = _described(filled(files, id_col, payload_col), one_record, header)
    facts = cut_lineage(described.drop("payload").groupBy("file_id").agg(F.min(F.struct("n_bytes", "checksum", "kind", "head", "n_head", "added")).alias("f")).select("file_id", "f.*"))
    kept = facts.join(copies(files, id_col, payload_col, facts.select("file_id", "checksum")), "file_id", "left_anti")
    totals = kept.groupBy("kind", "head").agg(F.sum(F.col("n_bytes") + F.col("added")).alias("total"))
    kept = cut_lineage(kept.join(totals, ["kind", "head"]).select("file_id", "checksum", "kind", "head", "n_head", "n_bytes", "added", _container(F.col("total"), F.col("n_bytes"), target).alias("container"), "total"))
    whole = described.join(totals, ["kind", "head"]).select("file_id", F.col("payload").cast("binary").alias("payload"), "checksum", _container(F.col("total"), F.col("n_bytes"), target).alias("container"))
    return whole, kept


def _with_places(kept: DataFrame) -> DataFrame:
    w = Window.partitionBy("container").orderBy("file_id")
    start = F.max("n_head").over(Window.partitionBy("container"))
    return kept.select(
        "container", "file_id", (F.row_number().over(w) - 1).cast("long").alias("position"),
        (start + F.sum(F.col("n_bytes") + F.col("added")).over(w) - F.col("n_bytes") - F.col("added")).alias("byte_offset"), "n_head", "n_bytes", "checksum",
    )


def manifest(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json", target_bytes: int = TARGET_BYTES, one_record: bool = True, header: bool = False) -> DataFrame:
    """``container, file_id, position, byte_offset, n_head, n_bytes, checksum``: each record exactly once, without moving a payload.

    Offsets of frames hold for frames whose contents end in a line end; ``containers`` has the final ones.
    """
    return _with_places(_placed(files, id_col, payload_col, target_bytes, one_record, header)[1])


# The containers ------------------------------------------------------------------------------------------------------

def frame_contents(data: bytes) -> tuple[bytes, bool]:
    """What a row of zstandard frames holds, and whether all of them are complete."""
    import zstandard

    out, left = [], data
    while left:
        try:
            one = zstandard.ZstdDecompressor().decompressobj()
            out.append(one.decompress(left))
        except zstandard.ZstdError:
            return b"".join(out), False
        if not one.eof:
            return b"".join(out), False
        left = one.unused_data
    return b"".join(out), True


def _joined(kind: str, rows: list[tuple[Any, bytes, int]]) -> tuple[bytes, list[tuple[Any, int, int, int]]]:
    """(bytes of a container, [(id, offset, bytes of the head, bytes)]) of its files in their order."""
    out = bytearray(rows[0][1][: rows[0][2]])
    places = []
    if kind == FRAMES:
        import zstandard

        between = zstandard.ZstdCompressor().compress(_BREAK)
    for k, (i, data, n_head) in enumerate(rows):
        body = data[n_head:]
        places.append((i, len(out), n_head, len(body)))
        out += body
        if kind == FRAMES:
            content, _ = frame_contents(data)
            if content and not content.endswith(_BREAK) and k + 1 < len(rows):
                out += between
        elif not data.endswith(_BREAK):
            out += _BREAK
    return bytes(out), places


def read_file(container: bytes, offset: int, n_head: int, n_bytes: int) -> bytes:
    """A file as it was, from its container."""
    return container[:n_head] + container[offset : offset + n_bytes]


def opened_frames(files: DataFrame, payload_col: str) -> DataFrame:
    """files with the contents of their frames, where these are complete; for files whose header is inside their frames."""

    @F.pandas_udf(T.BinaryType())
    def contents(payloads: pd.Series) -> pd.Series:
        def one(p: bytes | None) -> bytes | None:
            if p is None:
                return None
            got, complete = frame_contents(bytes(p))
            return got if complete else bytes(p)

        return payloads.map(one)

    data = F.col(payload_col)
    return files.withColumn(payload_col, F.when(F.hex(F.substring(data, 1, 4)) == "28B52FFD", contents(data)).otherwise(data))


def containers(files: DataFrame, id_col: str = "file_id", payload_col: str = "label_json", target_bytes: int = TARGET_BYTES, one_record: bool = True, header: bool = False) -> DataFrame:
    """``container, n_records, n_bytes, checksum, valid, places, data``: the containers themselves, checked.

    places: ``file_id, byte_offset, n_head, n_bytes, checksum`` of each file. valid: every file, read back by its place, has the
    length and checksum that were planned, and frames are complete.
    """
    if header and isinstance(files.schema[payload_col].dataType, T.BinaryType):
        files = opened_frames(files, payload_col)
    whole, kept = _placed(files, id_col, payload_col, target_bytes, one_record, header)
    id_type = files.schema[id_col].dataType.simpleString()
    schema = f"container string, n_records long, n_bytes long, checksum string, valid boolean, places array<struct<file_id: {id_type}, byte_offset: long, n_head: long, n_bytes: long, checksum: string>>, data binary"

    def join(payloads: pd.DataFrame, planned: pd.DataFrame) -> pd.DataFrame:
        if planned.empty:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")[:5]} | {"places": [], "data": []})
        planned = planned.sort_values("file_id")
        by_id = {(i, c): p for i, c, p in zip(payloads["file_id"], payloads["checksum"], payloads["payload"], strict=True)}
        kind, name = planned["kind"].iloc[0], planned["to"].iloc[0]
        rows = [(i, bytes(by_id[i, c]), int(h)) for i, c, h in zip(planned["file_id"], planned["checksum"], planned["n_head"], strict=True)]
        data, places = _joined(kind, rows)
        sums = planned["checksum"].tolist()
        ok = len(rows) == len(planned) and all(hashlib.md5(read_file(data, o, h, n)).hexdigest() == c and n == w for (_, o, h, n), c, w in zip(places, sums, planned["n_bytes"], strict=True))  # noqa: S324
        if kind == FRAMES:
            ok = ok and frame_contents(data)[1]
        listed = [{"file_id": i, "byte_offset": o, "n_head": h, "n_bytes": n, "checksum": c} for (i, o, h, n), c in zip(places, sums, strict=True)]
        return pd.DataFrame({"container": [name], "n_records": [len(rows)], "n_bytes": [len(data)], "checksum": [hashlib.md5(data).hexdigest()], "valid": [ok], "places": [listed], "data": [data]})  # noqa: S324

    # The payloads' only way: to their containers.
    return whole.groupBy("container").cogroup(kept.select("container", "file_id", "checksum", "kind", "n_head", "n_bytes").toDF("to", "file_id", "checksum", "kind", "n_head", "n_bytes").groupBy("to")).applyInPandas(join, schema)


_ENDINGS = {LINES: ".txt", BLOCKS: ".bin", FRAMES: ".zst"}


def write_containers(files: DataFrame, folder: str, **options: Any) -> DataFrame:
    """Writes each container as one file of a folder that all executors see, from the executors, and the manifest beside them.

    Returns ``container, file, n_records, n_bytes, checksum, valid``. Files are written beside and renamed, so a task that is
    repeated changes nothing; the manifest (``_manifest``) is written once all containers are there.
    """
    built = containers(files, **options)
    schema = "container string, file string, n_records long, n_bytes long, checksum string, valid boolean, places " + built.schema["places"].dataType.simpleString()

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from quillspark.sources.storage import write_whole

        for pdf in parts:
            names = [name.replace("/", "_") + _ENDINGS[name.split("-")[0]] for name in pdf["container"]]
            for name, data in zip(names, pdf["data"], strict=True):
                write_whole(f"{folder}/{name}", bytes(data))
            yield pdf.assign(file=names).drop(columns="data")[[c.split()[0] for c in schema.split(", ")[:6]] + ["places"]]

    done = cut_lineage(built.mapInPandas(write, schema))
    done.select("container", "file", F.explode("places").alias("p")).select("container", "file", "p.*").write.mode("overwrite").parquet(f"{folder}/_manifest")
    return done.drop("places")


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """``file_id, payload, valid``: every file of a folder of containers as it was, by the manifest beside them."""
    places = spark.read.parquet(f"{folder}/_manifest")
    data = spark.read.format("binaryFile").load(f"{folder}/*.*").select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("file"), "content")
    id_type = places.schema["file_id"].dataType.simpleString()

    def cut(rows: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        content = bytes(whole["content"].iloc[0]) if len(whole) else b""
        out = [read_file(content, o, h, n) for o, h, n in zip(rows["byte_offset"], rows["n_head"], rows["n_bytes"], strict=True)]
        return pd.DataFrame({"file_id": rows["file_id"], "payload": out, "valid": [hashlib.md5(p).hexdigest() == c for p, c in zip(out, rows["checksum"], strict=True)]})  # noqa: S324

    return places.groupBy("file").cogroup(data.groupBy("file")).applyInPandas(cut, f"file_id {id_type}, payload binary, valid boolean")


def small_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``file_id, payload, n_bytes``: the files below a folder by their paths relative to it, with their bytes; names that begin with . or _ aren't read."""
    root = folder.rstrip("/")
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    bare = root.split(":", 1)[-1].lstrip("/")
    return f.select(F.regexp_replace(F.regexp_replace("path", r"\A\w+:/+", ""), rf"\A\Q{bare}\E/*", "").alias("file_id"), F.col("content").alias("payload"), F.col("length").alias("n_bytes"))
