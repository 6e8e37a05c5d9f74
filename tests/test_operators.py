"""Known values, statistical properties and edge cases of the core operators."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions import distributions, geometry, layout, text
from quillspark.functions.draws import randint
from quillspark.operators import checks, render, resources, schedule
from quillspark.operators.prefix import dense_index, running_total


def specs(spark, *rows):
    return spark.createDataFrame(list(rows), "batch_id bigint, spec_name string, proportion double")


def allocated(spark, n, *shares):
    df = schedule.allocation(specs(spark, *((0, name, p) for name, p in shares)), n)
    return {r["spec_name"]: r["n_alloc"] for r in df.collect()}


def test_allocation(spark):
    assert allocated(spark, 100, ("a", 0.6), ("b", 0.4)) == {"a": 60, "b": 40}
    assert allocated(spark, 10, ("a", 0.333), ("b", 0.333), ("c", 0.333)) == {"a": 4, "b": 3, "c": 3}
    assert allocated(spark, 100_000, ("a", 0.4995), ("b", 0.4995)) == {"a": 50_000, "b": 50_000}
    assert allocated(spark, 7, ("a", 1.0)) == {"a": 7}
    assert schedule.allocation(specs(spark), 10).count() == 0


def test_interleaving(spark):
    a = schedule.allocation(specs(spark, (0, "a", 0.5), (0, "b", 0.3), (0, "c", 0.2)), 10)
    assert "".join(r["spec_name"] for r in schedule.task_list(a, 10).orderBy("idx").collect()) == "abcabcabaa"


def test_tasks_are_not_broadcast(spark):
    """Few rows become many tasks, so no estimate of their size holds; and a batch without an id is a batch."""
    shares = {7: {"a": 4, "b": 1, "c": 4, "d": 0, "e": 2}, 8: {"a": 9, "b": 9, "c": 1}, None: {"a": 1, "b": 3}}
    df = spark.createDataFrame([(b, n, k) for b, of in shares.items() for n, k in of.items()], "batch_id bigint, spec_name string, n_alloc bigint")
    for images in (1, 3, 10, 14, 1000):
        got = schedule.task_list(df, images)
        tasks = {b: [n for _, _, n in sorted((r, n, n) for n, k in of.items() for r in range(k))][:images] for b, of in shares.items()}
        assert sorted((str(r["batch_id"]), r["idx"], r["spec_name"]) for r in got.collect()) == sorted((str(b), i, n) for b, names in tasks.items() for i, n in enumerate(names))
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_repeated_specifications_count_once(spark):
    assert schedule.allocation(specs(spark, (0, "a", 1.0), (0, "a", 1.0)), 10).collect()[0]["n_alloc"] == 10


def outcomes(spark, *rows):
    return spark.createDataFrame([(r, s, ok, None) for r, s, ok in rows], "resource_id string, seq bigint, ok boolean, recorded_at timestamp")


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_health(spark, block):
    steps = [False, False, True, False, False, True]
    df = resources.health_scores(outcomes(spark, *(("f", k, ok) for k, ok in enumerate(steps))), block)
    assert [r["score"] for r in df.orderBy("seq").collect()] == [90, 80, 81, 71, 61, 62]
    good = outcomes(spark, ("g", 0, True), ("g", 1, True), ("g", 2, False), ("g", 3, None), ("g", 2, False))
    assert resources.final_scores(good, block).collect()[0]["score"] == 90
    assert resources.final_scores(outcomes(spark), block).count() == 0


def test_healthy(spark):
    bad = outcomes(spark, *(("f", k, False) for k in range(6)))
    fonts = spark.createDataFrame([("f",), ("g",)], "font_path string")
    assert [tuple(r) for r in resources.healthy(fonts, "font_path", resources.final_scores(bad)).collect()] == [("g", 100)]


def test_weighted_pick(spark):
    rows = spark.range(3000)
    res = spark.createDataFrame([("a", 100), ("b", 50)], "resource_id string, score bigint")
    share = resources.weighted_pick(rows, "id", res, "t", "r").where("r = 'a'").count() / 3000
    assert abs(share - 2 / 3) < 0.05
    zero = spark.createDataFrame([("a", 0), ("b", -5)], "resource_id string, score bigint")
    assert resources.weighted_pick(rows, "id", zero, "t", "r").select("r").distinct().count() == 2
    assert resources.weighted_pick(rows, "id", res.limit(0), "t", "r").where("r IS NOT NULL").count() == 0


def test_globs(spark):
    fonts = spark.createDataFrame([("/fonts/font_a_Bold.ttf",), ("/fonts/font_b_Regular.ttf",), ("/x/a+b.ttf",), (None,)], "font_path string")
    f = spark.createDataFrame([(g,) for g in ("*Bold.ttf", "*Regular.ttf", "*", "/x/a+b.t?f", "*[!d].ttf", "nothing", None)], "font_filter string")
    got = {}
    for r in resources.glob_matches(f, fonts, "font_filter", "font_path").collect():
        got.setdefault(r["filter"], set()).add(r["name"])
    a, b, c = "/fonts/font_a_Bold.ttf", "/fonts/font_b_Regular.ttf", "/x/a+b.ttf"
    assert got == {"*Bold.ttf": {a}, "*Regular.ttf": {b}, "*": {a, b, c}, "/x/a+b.t?f": {c}, "*[!d].ttf": {b, c}}


def lines(spark, t, n, mode):
    return spark.range(1).select(text.lines_of(F.lit(t), F.lit(n), F.lit(mode)).alias("x")).collect()[0]["x"]


def test_line_breaks(spark):
    assert lines(spark, "the quick brown fox jumps over", 3, "word") == ["the quick", "brown fox", "jumps over"]
    assert lines(spark, "Hi", 5, "character") == ["H", "i", "", "", ""]
    assert lines(spark, "", 2, "word") == [""]
    assert lines(spark, "1234567", 3, "character") == ["123", "45", "67"]
    assert lines(spark, "one line", 1, "word") == ["one line"]
    assert lines(spark, "      ", 2, "word") == ["      "]
    assert " ".join(lines(spark, "Hello world", 2, "word")).split() == ["Hello", "world"]


def test_segments(spark):
    df = spark.range(500).select(text.segment(F.lit("abcdefghij" * 20), F.lit(10), F.lit(20), F.col("id")).alias("s"))
    assert df.where("length(s) BETWEEN 10 AND 20").count() == 500
    assert spark.range(1).select(text.segment(F.lit("short"), F.lit(10), F.lit(20), F.col("id")).alias("s")).collect()[0]["s"] is None


@pytest.fixture(scope="module")
def draws(spark):
    return {n: [r[0] for r in spark.range(4000).select(distributions.sample(F.lit(n), F.lit(0.0), F.lit(100.0), F.col("id"), "t")).collect()] for n in distributions.NAMES}


def test_distributions(spark, draws):
    mean = {n: sum(v) / len(v) for n, v in draws.items()}
    assert all(0 <= x <= 100 for v in draws.values() for x in v)
    assert 48 < mean["uniform"] < 52 and 48 < mean["normal"] < 52 and 48 < mean["truncated_normal"] < 52
    assert 2 < mean["exponential"] < 5 and mean["lognormal"] < 40 and 24 < mean["beta"] < 35
    assert 0.65 < sum(abs(x - 50) < 100 / 6 for x in draws["normal"]) / 4000 < 0.72
    same = spark.range(1).select(*(distributions.sample(F.lit(n), F.lit(3.0), F.lit(3.0), F.col("id"), "t") for n in distributions.NAMES), distributions.sample(F.lit("half_normal"), F.lit(0.0), F.lit(1.0), F.col("id"), "t")).collect()[0]
    assert list(same) == [3.0] * 6 + [None]


def test_randint_is_inclusive(spark):
    assert {r[0] for r in spark.range(300).select(randint(F.col("id"), "t", 1, 3)).collect()} == {1, 2, 3}


def test_perspective_box(spark):
    c = [F.lit(float(x)) for x in (50, 30, 80, 70)]
    corners = [(F.lit(float(x)), F.lit(float(y))) for x, y in ((10, 10), (190, 0), (180, 90), (0, 80))]
    got = spark.range(1).select(*geometry.warped(*c, geometry.homography(F.lit(200.0), F.lit(100.0), corners))).collect()[0]
    assert [int(x) for x in got] == [40, 29, 68, 60]


def test_order_of_boxes(spark):
    for direction, backward in (("left_to_right", False), ("right_to_left", True)):
        df = spark.range(1).select("id", F.explode(layout.straight(F.lit("Hello World"), F.lit(48), F.lit(1000), F.lit(backward))).alias("b")).select("id", "b.*", F.lit(direction).alias("d"))
        assert df.count() == 11
        assert geometry.order_valid(df, ["id"], "d", "char_pos").collect()[0]["valid"]
    for direction in ("top_to_bottom", "bottom_to_top"):
        df = spark.range(1).select("id", F.explode(layout.vertical(F.lit("Hello World"), F.lit(48), F.lit(0), F.lit(direction == "bottom_to_top"))).alias("b")).select("id", "b.*", F.lit(direction).alias("d"))
        assert geometry.order_valid(df, ["id"], "d", "char_pos").collect()[0]["valid"]


def test_running_total_and_dense_index(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    got = running_total(df, "id", {"t": F.col("v")}, block=64).orderBy("id").collect()
    s = 0
    for r in got:
        s += r["v"]
        assert r["t"] == s
    names = spark.createDataFrame([(f"n{k:04d}",) for k in range(300)], "name string")
    assert [r["number"] for r in dense_index(names, "name").orderBy("name").collect()] == list(range(300))


def test_checks(spark):
    p = spark.createDataFrame([("a", "blur_radius", 2.0, 1.0, "uniform", False), ("a", "noise_amount", 0.0, 1.0, "half_normal", False)], "spec_name string, param string, min_value double, max_value double, distribution string, is_int boolean")
    assert [r["message"] for r in checks.min_max_violations(p).collect()] == ["blur_radius: min above max"]
    with pytest.raises(checks.ValidationError):
        checks.raise_if_any(checks.min_max_violations(p))
    s = specs(spark, (0, "a", 0.5), (0, "b", 0.4985), (1, "c", 0.999))
    assert [r["batch_id"] for r in checks.proportion_sums(s).collect()] == [0]


def test_configuration(spark, tmp_path):
    from quillspark.sources import config, sinks

    one = {"name": "a", "proportion": 1.0, "text_direction": "left_to_right", "corpus_file": "t.txt"}
    raw = {"total_images": 3, "specifications": [one]}
    config.check_raw(raw)
    s, p = config.tables(spark, raw)
    assert s.count() == 1 and p.count() == 27
    for bad in ({"total_images": 0}, {"specifications": []}, {"specifications": [one | {"curve_type": "wave"}]}, {"specifications": [one | {"unknown": 1}]}, {"specifications": [one | {"arc_radius_max": 5.0}]}, {"specifications": [one | {"rotation_angle_distribution": "half_normal"}]}):
        with pytest.raises(config.ValidationError):
            config.check_raw(raw | bad)
    assert sinks.config_hash({"a": 1, "b": 2}) == sinks.config_hash({"b": 2, "a": 1}) != sinks.config_hash({"a": 2, "b": 2})


def test_command_line(spark, tmp_path):
    import yaml

    from quillspark import cli
    from quillspark.functions import pixels
    from quillspark.sources import files, sinks

    for d in ("fonts", "backgrounds", "texts", "out"):
        (tmp_path / d).mkdir()
    (tmp_path / "fonts/a_Bold.ttf").write_bytes(b"x")
    (tmp_path / "backgrounds/w.png").write_bytes(pixels.png(pixels.solid(20, 10, (255, 0, 0))))
    (tmp_path / "texts/t.txt").write_text("some words to draw on an image " * 5)
    raw = {"total_images": 5, "specifications": [{"name": "a", "proportion": 1.0, "text_direction": "left_to_right", "corpus_file": "t.txt", "font_filter": "*Bold.ttf", "rotation_angle_max": 5.0, "noise_amount_min": 0.1, "noise_amount_max": 0.1}]}
    (tmp_path / "b.yaml").write_text(yaml.safe_dump(raw))
    args = [x for n, d in (("batch-config", "b.yaml"), ("output-dir", "out"), ("font-dir", "fonts"), ("background-dir", "backgrounds"), ("corpus-dir", "texts")) for x in (f"--{n}", str(tmp_path / d))]
    assert cli.main(args) == 0
    made = sorted(p.name for p in (tmp_path / "out").glob("*.png"))
    assert made == [f"image_{k:05d}.png" for k in range(5)]
    label = json.loads((tmp_path / "out/image_00000.json").read_text())
    assert len(label["bboxes"]) == len(label["text"])
    (tmp_path / "out/image_00002.png").unlink()
    assert cli.main([*args, "--resume"]) == 0
    assert (tmp_path / "out/image_00002.png").exists()
    with pytest.warns(files.CheckpointWarning):
        files.load_checkpoint(str(tmp_path / "out/checkpoint.json"), "another")
    assert files.load_checkpoint(str(tmp_path / "none.json"), "x") is None
    assert sinks.config_hash(raw) == json.loads((tmp_path / "out/checkpoint.json").read_text())["config_hash"]
    assert cli.main([*args[:-1], str(tmp_path / "missing")]) == 1
    seen = spark.read.parquet(str(tmp_path / "out/outcomes"))
    assert seen.where("ok").count() == 12 and seen.select("resource_id").distinct().count() == 2
    drawn = pixels.from_png((tmp_path / "out/image_00001.png").read_bytes())
    assert (drawn[..., 0] == 255).mean() > 0.5


def test_drawing_again_from_labels(spark):
    from quillspark.operators import render
    from quillspark.plans import plan
    from quillspark.sources import config

    one = {"name": "a", "proportion": 1.0, "text_direction": "left_to_right", "corpus_file": "t.txt", "rotation_angle_min": -9.0, "rotation_angle_max": 9.0, "drop_shadow_offset_x_min": 2, "drop_shadow_offset_x_max": 4, "blur_radius_max": 1.0, "max_lines": 3, "color_mode": "per_glyph", "text_color_max": [200, 10, 10]}
    s, p = config.tables(spark, {"total_images": 1, "specifications": [one, one | {"name": "b", "curve_type": "arc", "arc_radius_min": 80.0, "arc_radius_max": 90.0}]})
    tasks = spark.createDataFrame([(k, "ab"[k % 2], f"text number {k} of some", None, None) for k in range(6)] + [(9, "a", None, None, None)], "idx bigint, spec_name string, text string, font_path string, background_path string")
    plans = plan.plans(plan.styled(tasks, s, p))
    images = render.rendered(plans, 2)
    first = {r["idx"]: r["image"] for r in images.collect()}
    assert len(first) == 6 and all(first.values())
    again = render.rendered(render.plans_of_labels(render.labels(plans, images), plans), 3)
    assert {r["idx"]: r["image"] for r in again.collect()} == first


def test_font_tables():
    import glob

    from quillspark.sources.fonts import read_metrics

    found = glob.glob("/usr/share/fonts/**/*.ttf", recursive=True)
    if not found:
        pytest.skip("no font here")
    with open(found[0], "rb") as f:
        m = read_metrics(f.read())
    assert m.units > 0 and m.ascent > 0 and m.width("\ue123", 10) == 6


def test_exact_quantiles(spark):
    import random

    import numpy as np

    from quillspark.operators.quantiles import exact_quantiles

    r = random.Random(1)
    rows = [("a", r.gauss(0, 1)) for _ in range(500)] + [("b", 3.0)] * 40 + [("b", float(k)) for k in range(21)] + [("c", 1.5), ("d", None), ("e", float("nan")), ("e", 2.0), ("e", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    points = {"p0": 0.0, "p33": 0.33, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    for bins in (1, 7, 4096):
        got = {x["k"]: x for x in exact_quantiles(df, "k", "v", points, bins).collect()}
        assert set(got) == {"a", "b", "c", "e"}
        for k in got:
            v = [x for g, x in rows if g == k and x is not None and x == x]
            for name, p in points.items():
                assert abs(got[k][name] - np.quantile(v, p)) < 1e-9


def test_lines_by_direction_and_curve(spark):
    from quillspark.operators import render

    schema = "idx int, text string, lines array<string>, font_size bigint, overlap_bp bigint, spacing_percent bigint, curve string, text_alignment string, arc_radius double, arc_concave boolean, sine_amplitude double, sine_frequency double, sine_phase double, text_direction string"
    directions = ("left_to_right", "right_to_left", "top_to_bottom", "bottom_to_top")
    cases = [(d, c, al, x) for d in directions for c in ("none", "arc", "sine") for al in ("top", "center", "bottom", "left", "right") for x in (("abc", "", "d"), ("abc",), ("d",))]
    rows = [(i, "".join(x), list(x), 20, 0, 100, c, al, 200.0, True, 4.0, 0.05, 0.3, d) for i, (d, c, al, x) in enumerate(cases)]
    got = spark.createDataFrame(rows, schema).select("idx", render.boxes_of_plan().alias("b")).collect()
    boxes = {cases[r["idx"]]: [(b["char"], b["x0"], b["y0"], b["x1"], b["y1"]) for b in r["b"]] for r in got}
    several = ("abc", "", "d")

    # A character is 12 wide and 22 high, vertical lines are 24 apart, stacked ones 22; an empty line keeps its place.
    assert boxes["right_to_left", "none", "center", several] == [("a", 34, 10, 46, 32), ("b", 22, 10, 34, 32), ("c", 10, 10, 22, 32), ("d", 22, 54, 34, 76)]
    for alignment, dy in (("top", 0), ("center", 22), ("bottom", 44), ("left", 0), ("right", 0)):
        d = ("d", 58, 10 + dy, 70, 32 + dy)
        assert boxes["top_to_bottom", "none", alignment, several] == [("a", 10, 10, 22, 32), ("b", 10, 32, 22, 54), ("c", 10, 54, 22, 76), d]
        assert boxes["bottom_to_top", "none", alignment, several] == [("a", 10, 54, 22, 76), ("b", 10, 32, 22, 54), ("c", 10, 10, 22, 32), d]
    for direction in directions:
        flat = direction in directions[:2]
        far, end = (3, "right") if flat else (4, "bottom")
        for curve in ("arc", "sine"):
            first, last = boxes[direction, curve, end, ("abc",)], boxes[direction, curve, end, ("d",)]
            free = max(b[far] for b in first) - max(b[far] for b in last)
            dx, dy = (free, 44) if flat else (48, free)
            assert boxes[direction, curve, end, several] == first + [(c, x0 + dx, y0 + dy, x1 + dx, y1 + dy) for c, x0, y0, x1, y1 in last]


GLOBS = ["*.ttf", "a[bc]?", "a[!bc]?", "*[[]1.ttf", "*a[1.ttf", "[*]x", "[]a]b", "[!]a]b", "a[z-a]b", "a[!z-a]b", "[a-c]*", "a.b", "a+b(c)|d^$", "*\\*", "[\\d]", "[^a]", "[&&]x", "", "*", "?", "[", "[]", "[!", "a*b*c", "é?", "*[0-9]-[0-9].ttf"]
NAMES = ["x.ttf", "abx", "adx", "abc", "q[1.ttf", "qa[1.ttf", "*x", ".x", "]b", "ab", "bb", "azb", "a-b", "axb", "b1", "a.b", "aXb", "a+b(c)|d^$", "q\\r", "\\", "d", "5", "^", "&x", "", "x", "[", "[]", "[!", "aXbYc", "ac", "éa", "a\nb\nc", "x.ttf\n", "f1-2.ttf"]


def test_globs_are_those_of_a_shell(spark):
    import fnmatch

    filters = spark.createDataFrame([(g,) for g in [*GLOBS, None, "*.ttf"]], "f string")
    names = spark.createDataFrame([(n,) for n in [*NAMES, None]], "n string")
    got = {tuple(r) for r in resources.glob_matches(filters, names, "f", "n").collect()}
    assert got == {(g, n) for g in GLOBS for n in NAMES if fnmatch.fnmatchcase(n, g)}


def test_open_filters_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(resources, "OPEN_FILTERS", 3)
    filters = spark.createDataFrame([(f"*{c}",) for c in "abcdefgh"], "f string")
    names = spark.createDataFrame([(f"x{c}",) for c in "abcdefghij"], "n string")
    assert {tuple(r) for r in resources.glob_matches(filters, names, "f", "n").collect()} == {(f"*{c}", f"x{c}") for c in "abcdefgh"}


def test_weighted_choice_by_group(spark):
    scores = [("a", f"r{k:03d}", k - 2) for k in range(40)] + [("zero", "z0", 0), ("zero", "z1", -5), ("heavy", "h0", 10_000), ("heavy", "h1", 1), ("heavy", "h2", 0)]
    spans = resources.weighted_spans(spark.createDataFrame(scores, "g string, resource_id string, score int"), "g")
    seen = spans.collect()
    for g, n, total in (("a", 40, sum(range(38))), ("zero", 2, 2), ("heavy", 3, 10_001)):
        own = sorted({(r["lo"], r["hi"], r["resource_id"]) for r in seen if r["g"] == g})
        assert own[0][0] == 0 and own[-1][1] == total and all(x[1] == y[0] for x, y in zip(own, own[1:], strict=False))
        assert sum(r["g"] == g for r in seen) <= 2 * n
    rows = spark.range(6000).select(F.col("id"), F.element_at(F.array(*map(F.lit, ("a", "zero", "heavy", "none"))), (F.col("id") % 4 + 1).cast("int")).alias("g"))
    got = resources.pick_from_spans(rows, "id", spans, "g", "t", "r").collect()
    assert sorted(r["id"] for r in got) == list(range(6000))
    by = {g: [r["r"] for r in got if r["g"] == g] for g in ("a", "zero", "heavy", "none")}
    assert set(by["none"]) == {None} and {"z0", "z1"} == set(by["zero"]) and by["heavy"].count("h0") >= 1490 and "h2" not in by["heavy"]
    assert {"r000", "r001", "r002"}.isdisjoint(by["a"]) and by["a"].count("r039") > by["a"].count("r003")


SECTIONS = [
    ({"canvas": {"min_padding": -1}}, "negative"), ({"canvas": {"max_padding": "x"}}, "number"), ({"canvas": {"min_padding": 5, "max_padding": 2}}, "above"), ({"canvas": 3}, "number"),
    ({"font": {"size_range": 12}}, "list of two"), ({"font": {"size_range": [1, 2, 3]}}, "list of two"), ({"font": {"size_range": ["a", 2]}}, "list of two"), ({"font": {"size_range": [0, 2]}}, "positive"), ({"font": {"size_range": [9, 2]}}, "wrong way"),
    ({"direction": ["left"]}, "map"), ({"direction": {"left_to_right": -0.5}}, "negative"), ({"direction": {"left_to_right": "x"}}, "number"),
    ({"line_spacing_min": 0}, "above 0"), ({"font_size_min": 40, "font_size_max": 20}, "above"), ({"per_glyph_palette_size_min": 9}, "above"), ({"font_size_min": 0}, "positive"),
]


@pytest.mark.parametrize(("extra", "message"), SECTIONS)
def test_sections_of_a_configuration(extra, message):
    from quillspark.sources import config

    spec = {"name": "a", "proportion": 1.0, "text_direction": "left_to_right", "corpus_file": "a.txt"}
    config.check_raw({"total_images": 1, "specifications": [spec | {"canvas": {"min_padding": 1, "max_padding": 2}, "font": {"size_range": [8, 12]}, "direction": {"left_to_right": 1}}]})
    with pytest.raises(checks.ValidationError, match=message):
        config.check_raw({"total_images": 1, "specifications": [spec | extra]})
    with pytest.raises(checks.ValidationError):
        config.check_fonts(0, "fonts")


def test_corpus_patterns(spark):
    specs = spark.createDataFrame([("a", "x/one.txt"), ("b", "x/*.txt"), ("c", "y/*.txt"), ("d", "none.txt"), ("e", None)], "spec_name string, corpus_file string")
    corpus = spark.createDataFrame([("x/one.txt",), ("z/[1].txt",)], "corpus_file string")
    assert {r["spec_name"] for r in checks.missing_corpora(specs, corpus).collect()} == {"c", "d", "e"}


def test_lines_of_every_direction(spark):
    """Right-to-left lines run from the right, vertical ones stand beside each other and are aligned at top, centre or end."""
    rows = [(k, d, a) for k, (d, a) in enumerate([("left_to_right", "right"), ("right_to_left", "center"), ("top_to_bottom", "bottom"), ("bottom_to_top", "center"), ("top_to_bottom", "left")])]
    df = spark.createDataFrame(rows, "idx long, text_direction string, text_alignment string").select("*", F.array(F.lit("abc"), F.lit(""), F.lit("defgh")).alias("lines"), F.lit(20).alias("font_size"), F.lit(0).alias("overlap_bp"), F.lit(100).alias("spacing_percent"), F.lit("none").alias("curve"), *(F.lit(0.0).alias(c) for c in ("arc_radius", "sine_amplitude", "sine_frequency", "sine_phase")), F.lit(True).alias("arc_concave"))
    got = {r["idx"]: r["b"] for r in df.select("idx", render.lined_boxes().alias("b")).collect()}
    for k, d, _ in rows:
        assert [b["line_index"] for b in got[k]] == [0] * 3 + [2] * 5
        for line in (0, 2):
            own = [b for b in got[k] if b["line_index"] == line]
            key = {"left_to_right": lambda b: b["x0"], "right_to_left": lambda b: -b["x1"], "top_to_bottom": lambda b: b["y0"], "bottom_to_top": lambda b: -b["y1"]}[d]
            assert [key(b) for b in own] == sorted(key(b) for b in own)
    end = lambda k, line, c: max(b[c] for b in got[k] if b["line_index"] == line)
    assert end(0, 0, "x1") == end(0, 2, "x1") and end(2, 0, "y1") == end(2, 2, "y1")
    assert min(b["y0"] for b in got[4] if b["line_index"] == 0) == min(b["y0"] for b in got[4] if b["line_index"] == 2) == 10
    assert all(a["x1"] <= b["x0"] for k in (2, 3, 4) for a in got[k][:3] for b in got[k][3:])


def test_a_stage_of_ones_own(spark):
    from quillspark.plans.plan import STAGES

    render.register_stage("white_corner", "canvas_w > 0", lambda im, b, p: (np.where(np.indices(im.shape[:2]).sum(0)[..., None] < 3, 255, im).astype(np.uint8), b))
    try:
        assert list(STAGES)[-1] == "white_corner" and "white_corner" not in render._OWN
    finally:
        STAGES.pop("white_corner"), render.KERNELS.pop("white_corner")


def test_command_line_tools(spark, tmp_path):
    from quillspark import cli

    assert cli.main(["backgrounds", "--output-dir", str(tmp_path / "b"), "--count", "7", "--log-dir", str(tmp_path / "log")]) == 0
    assert len(list((tmp_path / "b").glob("*.png"))) == 7 and (tmp_path / "log" / "quillspark.log").exists()
    assert cli.main(["review", "--output-dir", str(tmp_path / "b"), "--review-file", str(tmp_path / "r"), "--per-folder", "3"]) == 0
    assert len("".join(p.read_text() for p in (tmp_path / "r").glob("*.csv")).splitlines()) == 4
    (tmp_path / "empty").mkdir()
    (tmp_path / "c.yaml").write_text("total_images: 1\nspecifications: [{name: a, proportion: 1.0, text_direction: left_to_right, corpus_file: a.txt}]")
    folders = [x for n in ("font-dir", "background-dir", "corpus-dir") for x in (f"--{n}", str(tmp_path / "empty"))]
    assert cli.main(["--batch-config", str(tmp_path / "c.yaml"), "--output-dir", str(tmp_path / "o"), *folders]) == 1
