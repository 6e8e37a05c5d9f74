import csv
import io
import json

import pytest
import zstandard

from quillspark.operators import compaction as c

SCHEMA = "file_id bigint, label_json string, n_bytes bigint, payload string, record string"
Z = zstandard.ZstdCompressor().compress


def files(spark, *rows):
    return spark.createDataFrame([(i, t, None, "clash", "clash") for i, t in rows], SCHEMA)


def test_same_records(spark):
    rows = [(1, '{"a":1,"b":[1,2]}'), (2, '{ "b": [1, 2],\n "a": 1.0 }'), (3, '{"a":1,"b":[2,1]}'), (4, None), (5, "  "), (6, "not json"), (7, "not json"), (1, '{"a":1,"b":[1,2]}'), (8, '{"t":"\\u00e9"}'), (9, '{"t":"é"}'), (None, '{"a":1,"b":[1,2]}')]
    rows += [(20, '{"t":"a\\/b"}'), (21, '{"t":"a/b"}'), (22, '{"t": "\\u0041 x"}'), (23, '{"t":"A x"}'), (24, '{"t":"A y"}'), (25, "{broken \\ one"), (26, "{broken \\ one")]
    f = files(spark, *rows)
    assert {tuple(r) for r in c.same_record_pairs(f).collect()} == {(1, 2), (6, 7), (8, 9), (20, 21), (22, 23), (25, 26)}
    assert {r[0] for r in c.unfilled(f).collect()} == {4, 5}
    assert {(r["file_id"], r["first_file"], r["n_links"]) for r in c.record_classes(f).where("file_id < 8").collect()} == {(1, 1, 1), (2, 1, 1), (6, 6, 1), (7, 6, 1)}


def test_hot_group_of_copies(spark):
    f = files(spark, *((k, '{"a": 1}' if k % 2 else '{"a":1}') for k in range(40)), *((100 + k, f'{{"a": {k}}}') for k in range(2, 82)))
    assert c.same_record_pairs(f).count() == 40 * 39 // 2
    assert c.manifest(f).count() == 81


def test_containers_hold_each_record_once(spark):
    rows = [(k, json.dumps({"k": k, "t": "é\n" * (k % 5)}, indent=1 if k % 3 == 0 else None)) for k in range(200)] + [(999, '{"big": "' + "x" * 5000 + '"}'), (1000, '{"k": 7, "t": "' + "\\u00e9\\n" * 2 + '"}')]
    got = c.containers(files(spark, *rows), target_bytes=2000).collect()
    assert all(r["valid"] for r in got)
    assert any(r["container"] == "lines-large-999" for r in got)
    lines = [json.loads(x) for r in got if r["container"].startswith("lines") for x in bytes(r["data"]).decode().splitlines()]
    blocks = [json.loads(c.read_file(bytes(r["data"]), p["byte_offset"], p["n_head"], p["n_bytes"])) for r in got if r["container"].startswith("blocks") for p in r["places"]]
    assert len(lines) + len(blocks) == 201 and {r["k"] for r in lines + blocks if "k" in r} == set(range(200))
    planned = {(r["container"], r["file_id"]): (r["byte_offset"], r["n_bytes"], r["checksum"]) for r in c.manifest(files(spark, *rows), target_bytes=2000).collect()}
    assert planned == {(r["container"], p["file_id"]): (p["byte_offset"], p["n_bytes"], p["checksum"]) for r in got for p in r["places"]}


def test_nothing(spark):
    f = files(spark)
    assert c.same_record_pairs(f).count() == c.manifest(f).count() == c.containers(f).count() == 0


def test_an_id_with_two_payloads(spark):
    """The shorter one counts; what only the other one held is not lost elsewhere."""
    got = c.containers(files(spark, (1, '{"k": 10}'), (1, '{"k":2}'), (2, "{}"), (3, '{"k":10}'))).collect()
    assert [bytes(r["data"]) for r in got] == [b'{"k":2}\n{}\n{"k":10}\n'] and got[0]["valid"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Ten thousand small files: lines with and without a last line end, CR LF, line ends inside, frames, empty and broken ones."""
    root = tmp_path_factory.mktemp("small")
    made = {}
    for k in range(10_000):
        kind = k % 7
        line = f'{{"k": {k}, "t": "é"}}'
        data = [line, line + "\n", line + "\r\n", line.replace(", ", ",\n"), line + "\n" + line + "\n", line + "\n", line][kind].encode()
        if kind >= 5:
            data = Z(data)
        if k % 997 == 3:
            data = Z(data)[:-3] if k % 2 else b""
        name = f"d{k % 13}/sub/{k}.{'zst' if kind >= 5 else 'json'}"
        made[name] = data
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return root, made


@pytest.mark.parametrize("one_record", [True, False])
def test_round_trip_of_real_files(spark, folder, tmp_path, one_record):
    root, made = folder
    f = c.small_files(spark, str(root))
    report = c.write_containers(f, str(tmp_path / "out"), id_col="file_id", payload_col="payload", target_bytes=60_000, one_record=one_record).collect()
    assert len(report) < 40 and all(r["valid"] for r in report)
    back = {r["file_id"]: (bytes(r["payload"]), r["valid"]) for r in c.read_back(spark, str(tmp_path / "out")).collect()}
    assert all(ok for _, ok in back.values())
    assert {k: p for k, (p, _) in back.items()} == {k: d for k, d in made.items() if d}
    for r in report:  # containers of lines are lines; those of frames are one stream
        data = (tmp_path / "out" / r["file"]).read_bytes()
        assert len(data) == r["n_bytes"]
        if one_record and r["container"].startswith("lines"):
            assert all(json.loads(x)["t"] == "é" for x in data.decode().split("\n") if x.strip())
        if r["container"].startswith("frames"):
            content, complete = c.frame_contents(data)
            assert complete and all(json.loads(x) for x in content.decode().splitlines())


def test_headers_once(spark, tmp_path):
    rows = [(k, f"a,b\n{k},x\n".encode()) for k in range(30)] + [(100 + k, f"a,c\r\n{k},y".encode()) for k in range(30)] + [(200, Z(b"a,b\n200,x\n"))]
    f = spark.createDataFrame(rows, "file_id bigint, payload binary")
    got = c.containers(f, payload_col="payload", one_record=False, header=True).collect()
    assert len(got) == 2 and all(r["valid"] for r in got)
    seen = [tuple(x) for r in got for x in csv.reader(io.StringIO(bytes(r["data"]).decode()))]
    assert seen.count(("a", "b")) == seen.count(("a", "c")) == 1 and len(seen) == 63
    opened = dict(rows) | {200: b"a,b\n200,x\n"}
    for r in got:
        for p in r["places"]:
            assert c.read_file(bytes(r["data"]), p["byte_offset"], p["n_head"], p["n_bytes"]) == opened[p["file_id"]]


def test_complete_frames():
    big = zstandard.ZstdCompressor(write_checksum=True).compress(bytes(range(256)) * 3000)
    for good in (Z(b""), Z(b"a"), Z(b"a" * 500_000) + Z(b"b"), big, b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc" + big):
        assert c.complete_frames(good) and c.frame_contents(good)[1]
    for bad in (b"", b"abc", big[:-1], big + b"x", Z(b"a")[:5], Z(b"a") + b"\x28\xb5\x2f\xfd"):
        assert not c.complete_frames(bad)


def test_equal_bytes_count_once(spark):
    f = spark.createDataFrame([("a", b"\x00\xff"), ("b", b"\x00\xff"), ("c", b"\x00\xfe"), ("d", None), ("e", b"")], "file_id string, payload binary")
    assert sorted(r["file_id"] for r in c.manifest(f, payload_col="payload").collect()) == ["a", "c"]
