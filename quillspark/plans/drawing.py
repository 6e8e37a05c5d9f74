"""Queries on layout, geometry and plans, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import geometry, layout
from quillspark.functions.distributions import sql_sample
from quillspark.functions.draws import randint, sql_randint, sql_uniform, uniform
from quillspark.functions.text import BLANKS, lines_of
from quillspark.operators.render import lined_boxes
from quillspark.plans import plan
from quillspark.plans.relational import P, S, params_, specs_
from quillspark.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def styled_(spark: SparkSession, d: str) -> DataFrame:
    s = plan.styled(table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "spec_params"))
    return s.where("text IS NOT NULL AND text <> ''").withColumns({"overlap_bp": plan.overlap(), "spacing_percent": plan.spacing(), "curve": plan.curve()})


# What all SQL below begins with: tasks with their fields, draws of each parameter, and characters with their widths.
_DEFAULTS = ", ".join(f"coalesce(max(v) FILTER (WHERE param = '{n}'), {x}::DOUBLE) AS {n}" for n, x in plan.DEFAULTS.items())
DRAWN = f"""t0 AS (SELECT DISTINCT idx, spec_name, text, font_path, background_path FROM tasks WHERE idx IS NOT NULL),
    d0 AS (SELECT idx, param, is_int, {sql_sample("distribution", "min_value", "max_value", "idx", "$param")} AS x FROM (SELECT DISTINCT idx, spec_name FROM tasks) JOIN {P} USING (spec_name)),
    d1 AS (SELECT idx, param, CASE WHEN is_int THEN trunc(x) ELSE x END AS v FROM d0),
    d2 AS (SELECT idx, {_DEFAULTS} FROM (SELECT DISTINCT idx FROM tasks) LEFT JOIN d1 USING (idx) GROUP BY idx),
    s0 AS (SELECT DISTINCT * FROM specs),
    s1 AS (SELECT t0.*, s0.* EXCLUDE (spec_name), d2.* EXCLUDE (idx), {sql_randint("t0.idx", "font_size", "font_size_min", "font_size_max")} AS font_size, {sql_randint("t0.idx", "num_lines", "min_lines", "max_lines")} AS num_lines,
      CAST(floor(glyph_overlap_intensity * 10000) AS BIGINT) AS overlap_bp, CASE WHEN floor(line_spacing * 100) > 0 THEN CAST(floor(line_spacing * 100) AS BIGINT) ELSE 100 END AS spacing_percent,
      CASE WHEN curve_type = 'arc' AND arc_radius > 1 THEN 'arc' WHEN curve_type = 'sine' AND sine_amplitude > 0.1::DOUBLE THEN 'sine' ELSE 'none' END AS curve
      FROM t0 JOIN s0 USING (spec_name) JOIN d2 USING (idx)),
    styled AS (SELECT *, CAST(floor(font_size * 93 / 100) + floor(font_size * 24 / 100) AS BIGINT) AS h FROM s1 WHERE text IS NOT NULL AND text <> '')"""
ADVANCE = "CAST(floor(font_size * CASE WHEN contains('iljtfrI.,:;!''|', char) THEN 35 WHEN contains('mwMW@%', char) THEN 85 WHEN char >= '⺀' THEN 100 ELSE 60 END / 100) AS BIGINT)"


def chars_sql(source: str) -> str:
    """Characters of a table's texts with the width before them (b), after them from the end (e), their own (w) and that of all (total)."""
    return f"""c0 AS (SELECT *, unnest(range(length(text))) AS char_pos FROM {source}), c1 AS (SELECT *, substr(text, char_pos + 1, 1) AS char FROM c0), c2 AS (SELECT *, {ADVANCE} AS w FROM c1),
    c3 AS (SELECT *, CAST(sum(w) OVER (PARTITION BY idx ORDER BY char_pos ROWS UNBOUNDED PRECEDING) - w AS BIGINT) AS b, CAST(sum(w) OVER (PARTITION BY idx) AS BIGINT) AS total, max(w) OVER (PARTITION BY idx) AS widest, count(*) OVER (PARTITION BY idx) AS n FROM c2),
    ch AS (SELECT *, (10000 - overlap_bp) / 10000.0::DOUBLE AS keep, total - b - w AS e FROM c3)"""


def _int(x: str) -> str:
    return f"CAST(floor({x}) AS BIGINT)"


KEPT = "({0} * (10000 - overlap_bp) / 10000.0::DOUBLE)"


def boxes_of(df: DataFrame, boxes: Column, *extra: str, exact: bool = False) -> DataFrame:
    """One row per character; whole columns as BIGINT, exact ones rounded."""
    rows = df.select("idx", *extra, F.explode(boxes).alias("b"))
    names = [f.name for f in rows.schema["b"].dataType.fields]
    as_ = lambda n: F.col(f"b.{n}").alias(n) if n == "char" else (F.round(F.col(f"b.{n}"), 6) + 0.0).alias(n) if exact and n != "char_pos" else F.col(f"b.{n}").cast("bigint").alias(n)
    return rows.select("idx", *extra, *map(as_, names))


# Layout --------------------------------------------------------------------------------------------------------------

@query(f"""WITH {DRAWN}, f AS (SELECT * FROM styled WHERE text_direction = 'left_to_right'), {chars_sql("f")}
    SELECT idx, char_pos, char, {_int("10 + " + KEPT.format("b"))} AS x0, 10::BIGINT AS y0, {_int("10 + " + KEPT.format("b") + " + w")} AS x1, h + 10 AS y1 FROM ch""")
def glyph_layout(spark: SparkSession, d: str) -> DataFrame:
    s = styled_(spark, d).where("text_direction = 'left_to_right'")
    return boxes_of(s, layout.straight(F.col("text"), F.col("font_size"), F.col("overlap_bp")))


@query(f"""WITH {DRAWN}, f AS (SELECT * FROM styled WHERE text_direction = 'right_to_left'), {chars_sql("f")}
    SELECT idx, char_pos, char, {_int("10 + " + KEPT.format("e"))} AS x0, 10::BIGINT AS y0, {_int("10 + " + KEPT.format("e") + " + w")} AS x1, h + 10 AS y1 FROM ch""")
def rtl_layout(spark: SparkSession, d: str) -> DataFrame:
    s = styled_(spark, d).where("text_direction = 'right_to_left'")
    return boxes_of(s, layout.straight(F.col("text"), F.col("font_size"), F.col("overlap_bp"), F.lit(True)))


@query(f"""WITH {DRAWN}, f AS (SELECT * FROM styled WHERE text_direction IN ('top_to_bottom', 'bottom_to_top')), {chars_sql("f")},
    v AS (SELECT *, (widest + 20 - w) / 2.0::DOUBLE AS x, CASE WHEN text_direction = 'bottom_to_top' THEN {_int(KEPT.format("(n * h)") + " + 20")} - 10 - {KEPT.format("((char_pos + 1) * h)")} ELSE 10 + {KEPT.format("(char_pos * h)")} END AS y FROM ch)
    SELECT idx, char_pos, char, {_int("x")} AS x0, {_int("y")} AS y0, {_int("x + w")} AS x1, {_int("y + h")} AS y1 FROM v""")
def vertical_layout(spark: SparkSession, d: str) -> DataFrame:
    s = styled_(spark, d).where("text_direction IN ('top_to_bottom', 'bottom_to_top')")
    return boxes_of(s, layout.vertical(F.col("text"), F.col("font_size"), F.col("overlap_bp"), F.col("text_direction") == "bottom_to_top"))


BACK = "CASE WHEN text_direction IN ('right_to_left', 'bottom_to_top') THEN e ELSE b END"
FLAT = "text_direction IN ('left_to_right', 'right_to_left')"
DEG = f"{layout.DEG!r}::DOUBLE"
TURNED = f"""t AS (SELECT *, abs(cos(degrees / {DEG})) AS ac, abs(sin(degrees / {DEG})) AS asn FROM p)
    SELECT idx, char_pos, char, round(cx, 6) + 0.0 AS cx, round(cy, 6) + 0.0 AS cy, round(degrees, 6) + 0.0 AS degrees, round(cx - (w * ac + h * asn) / 2, 6) + 0.0 AS x0, round(cy - (w * asn + h * ac) / 2, 6) + 0.0 AS y0, round(cx + (w * ac + h * asn) / 2, 6) + 0.0 AS x1, round(cy + (w * asn + h * ac) / 2, 6) + 0.0 AS y1 FROM t"""


@query(f"""WITH {DRAWN}, f AS (SELECT * FROM styled WHERE curve = 'arc'), {chars_sql("f")},
    a AS (SELECT *, floor(arc_radius * 2 + h + 100) / 2.0::DOUBLE AS m, {KEPT.format("total")} / arc_radius AS span, ({KEPT.format("(" + BACK + ")")} + w / 2.0::DOUBLE) / arc_radius AS along FROM ch),
    g AS (SELECT *, CASE WHEN {FLAT} THEN CASE WHEN arc_concave THEN 1.5707963267948966::DOUBLE + span / 2 ELSE -1.5707963267948966::DOUBLE - span / 2 END WHEN arc_concave THEN 3.141592653589793::DOUBLE ELSE 0 END - along AS angle FROM a),
    p AS (SELECT *, m + arc_radius * cos(angle) AS cx, m - arc_radius * sin(angle) AS cy, -(angle * {DEG} + 90) + CASE WHEN arc_concave THEN 0 ELSE 180 END AS degrees FROM g), {TURNED}""")
def arc_layout(spark: SparkSession, d: str) -> DataFrame:
    s = plan.with_values(styled_(spark, d)).where("curve = 'arc'")
    return boxes_of(s, layout.arc(F.col("text"), F.col("font_size"), F.col("overlap_bp"), F.col("text_direction"), F.col("arc_radius"), F.col("arc_concave")), exact=True)


@query(f"""WITH {DRAWN}, f AS (SELECT * FROM styled WHERE curve = 'sine'), {chars_sql("f")},
    a AS (SELECT *, {KEPT.format("(" + BACK + ")")} AS along, floor(sine_amplitude * 2) + 20 AS buffer FROM ch),
    g AS (SELECT *, sine_frequency * (along + w / 2.0::DOUBLE) + sine_phase AS t FROM a),
    p AS (SELECT *, -atan(sine_amplitude * sine_frequency * cos(t)) * {DEG} AS degrees,
      CASE WHEN {FLAT} THEN floor(20 + along) ELSE floor((widest + 2 * buffer) / 2.0::DOUBLE - widest / 2.0::DOUBLE + sine_amplitude * sin(t)) END + w / 2.0::DOUBLE AS cx,
      CASE WHEN {FLAT} THEN floor((h + 2 * buffer) / 2.0::DOUBLE - h / 2.0::DOUBLE + sine_amplitude * sin(t)) ELSE floor(20 + along) END + h / 2.0::DOUBLE AS cy FROM g), {TURNED}""")
def sine_layout(spark: SparkSession, d: str) -> DataFrame:
    s = plan.with_values(styled_(spark, d)).where("curve = 'sine'")
    return boxes_of(s, layout.sine(F.col("text"), F.col("font_size"), F.col("overlap_bp"), F.col("text_direction"), F.col("sine_amplitude"), F.col("sine_frequency"), F.col("sine_phase")), exact=True)


# Lines by the specification's mode (needs WITH RECURSIVE), and their characters.
LINES = """lw AS (SELECT idx, num_lines AS n, text, length(text) // num_lines AS target, list_filter(regexp_split_to_array(text, '{1}'), lambda x: x <> '') AS ws FROM styled WHERE line_break_mode = 'word' AND num_lines > 1 AND length(text) > num_lines),
    lf AS (SELECT idx, 0 AS k, CAST([] AS VARCHAR[]) AS done, '' AS line, ws, n, target FROM lw WHERE len(ws) > 0
      UNION ALL SELECT idx, k + 1,
        CASE WHEN line <> '' AND length(line) + 1 + length(ws[k + 1]) > target AND len(done) < n - 1 THEN list_append(done, line) ELSE done END,
        CASE WHEN line = '' OR (length(line) + 1 + length(ws[k + 1]) > target AND len(done) < n - 1) THEN ws[k + 1] ELSE line || ' ' || ws[k + 1] END, ws, n, target FROM lf WHERE k < len(ws)),
    lg AS (SELECT idx, list_concat(list_append(done, line), list_transform(range(greatest(n - len(done) - 1, 0)), lambda i: '')) AS worded FROM lf WHERE k = len(ws) UNION ALL SELECT idx, [text] FROM lw WHERE len(ws) = 0),
    la AS (SELECT styled.*, CASE WHEN num_lines <= 1 THEN [text] WHEN length(text) <= num_lines THEN list_transform(range(num_lines), lambda i: substr(text, i + 1, 1)) WHEN line_break_mode = 'word' THEN worded
      ELSE list_transform(range(num_lines), lambda i: substr(text, 1 + i * (length(text) // num_lines) + least(i, length(text) % num_lines), length(text) // num_lines + CASE WHEN i < length(text) % num_lines THEN 1 ELSE 0 END)) END AS all_lines FROM styled LEFT JOIN lg USING (idx)),
    l1 AS (SELECT * EXCLUDE (text, all_lines), unnest(all_lines) AS line, unnest(range(len(all_lines))) AS line_index FROM la),
    k0 AS (SELECT *, unnest(range(greatest(length(line), 1))) AS char_pos FROM l1), k1 AS (SELECT *, substr(line, char_pos + 1, 1) AS char FROM k0),
    k2 AS (SELECT *, CASE WHEN line = '' THEN 0 ELSE {0} END AS w FROM k1),
    k3 AS (SELECT *, CAST(sum(w) OVER (PARTITION BY idx, line_index ORDER BY char_pos ROWS UNBOUNDED PRECEDING) - w AS BIGINT) AS b, CAST(sum(w) OVER (PARTITION BY idx, line_index) AS BIGINT) AS total, max(w) OVER (PARTITION BY idx, line_index) AS widest, length(line) AS n FROM k2),
    k4 AS (SELECT *, total - b - w AS e, CASE WHEN line = '' THEN 0 WHEN {2} THEN CAST(floor(total * (10000 - overlap_bp) / 10000.0::DOUBLE + 20) AS BIGINT) ELSE CAST(floor((n * h) * (10000 - overlap_bp) / 10000.0::DOUBLE + 20) AS BIGINT) END AS used,
      CAST(floor(h * spacing_percent / 100) AS BIGINT) AS step, CAST(floor(floor(font_size * 60 / 100) * spacing_percent * 2 / 100) AS BIGINT) AS side FROM k3)""".replace("{0}", ADVANCE).replace("{1}", BLANKS).replace("{2}", FLAT)
BLOCK = f"""bk AS (SELECT idx, CAST(CASE WHEN {FLAT} THEN max(CASE WHEN line = '' THEN 0 ELSE floor({KEPT.format("total")}) END) ELSE any_value(side) * count(DISTINCT line_index) END AS BIGINT) AS width,
    CAST(CASE WHEN {FLAT} THEN any_value(step) * count(DISTINCT line_index) ELSE max(length(line) * floor({KEPT.format("h")})) END AS BIGINT) AS height FROM k4 GROUP BY idx, text_direction)"""


def _lines(s: DataFrame) -> DataFrame:
    return s.withColumn("lines", lines_of(F.col("text"), F.col("num_lines"), F.col("line_break_mode")))


# Each line is laid out by its direction; lines are stacked, or stand beside each other where text is vertical.
PLACED = f"""k5 AS (SELECT *, max(used) OVER (PARTITION BY idx) AS room FROM k4 WHERE curve = 'none'),
    k6 AS (SELECT *, CASE WHEN text_alignment = 'center' THEN (room - used) // 2 WHEN text_alignment = CASE WHEN {FLAT} THEN 'right' ELSE 'bottom' END THEN room - used ELSE 0 END AS shift FROM k5 WHERE line <> ''),
    k7 AS (SELECT *, CASE WHEN {FLAT} THEN 10 + {KEPT.format("(CASE WHEN text_direction = 'right_to_left' THEN e ELSE b END)")} ELSE (widest + 20 - w) / 2.0::DOUBLE END AS x,
      CASE text_direction WHEN 'top_to_bottom' THEN 10 + {KEPT.format("(char_pos * h)")} WHEN 'bottom_to_top' THEN used - 10 - {KEPT.format("((char_pos + 1) * h)")} ELSE 10 END AS y, CASE WHEN {FLAT} THEN shift ELSE line_index * side END AS dx, CASE WHEN {FLAT} THEN line_index * step ELSE shift END AS dy FROM k6),
    placed AS (SELECT idx, text_direction, line_index, char_pos, char, {_int("x")} + dx AS x0, {_int("y")} + dy AS y0, {_int("x + w")} + dx AS x1, {_int("y + h")} + dy AS y1 FROM k7)"""


@query(f"WITH RECURSIVE {DRAWN}, {LINES}, {PLACED} SELECT * EXCLUDE (text_direction) FROM placed")
def multiline_layout(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of all straight texts, line by line."""
    s = plan.with_values(_lines(styled_(spark, d))).where("curve = 'none'")
    return boxes_of(s, lined_boxes())


@query()
def multiline_curved(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of all texts along an arc or wave, line by line."""
    s = plan.with_values(_lines(styled_(spark, d))).where("curve <> 'none'")
    return boxes_of(s, lined_boxes())


@query(f"WITH RECURSIVE {DRAWN}, {LINES}, {BLOCK} SELECT * FROM bk")
def multiline_dims(spark: SparkSession, d: str) -> DataFrame:
    s = _lines(styled_(spark, d))
    return s.withColumn("b", layout.block_size(F.col("lines"), F.col("font_size"), F.col("overlap_bp"), F.col("spacing_percent"), F.col("text_direction"))).select("idx", "b.width", "b.height")


@query(f"""WITH RECURSIVE {DRAWN}, {LINES}, q AS (SELECT idx, line_index, any_value(text_direction) AS text_direction, any_value(text_alignment) AS al, any_value(step) AS step, any_value(side) AS side, CASE WHEN any_value({FLAT}) THEN CASE WHEN any_value(line) = '' THEN 0 ELSE any_value(total) END ELSE length(any_value(line)) * any_value(h) END AS long FROM k4 GROUP BY 1, 2),
    r AS (SELECT *, max(long) OVER (PARTITION BY idx) AS room FROM q),
    z AS (SELECT *, CASE WHEN al = 'center' THEN (room - long) // 2 WHEN al = CASE WHEN {FLAT} THEN 'right' ELSE 'bottom' END THEN room - long ELSE 0 END AS off FROM r)
    SELECT idx, line_index, CASE WHEN {FLAT} THEN off ELSE line_index * side END AS x, CASE WHEN {FLAT} THEN line_index * step ELSE off END AS y FROM z""")
def line_positions(spark: SparkSession, d: str) -> DataFrame:
    at = layout.line_positions(F.col("lines"), F.col("font_size"), F.col("spacing_percent"), F.col("text_alignment"), F.col("text_direction"))
    return _lines(styled_(spark, d)).select("idx", F.posexplode(at)).select("idx", F.col("pos").cast("bigint").alias("line_index"), F.col("col.x").cast("bigint").alias("x"), F.col("col.y").cast("bigint").alias("y"))


@query(f"WITH {DRAWN}, {chars_sql('styled')} SELECT idx, any_value({_int(KEPT.format('total') + ' + 20')}) AS width, any_value(h) + 20 AS height FROM ch GROUP BY idx")
def text_extent(spark: SparkSession, d: str) -> DataFrame:
    return styled_(spark, d).select("idx", layout.extent(F.col("text"), F.col("font_size"), F.col("overlap_bp")).alias("width"), (layout.height(F.col("font_size")) + 2 * layout.MARGIN).alias("height"))


@query(f"WITH {DRAWN} SELECT idx, text_direction, curve FROM styled")
def curve_dispatch(spark: SparkSession, d: str) -> DataFrame:
    return styled_(spark, d).select("idx", "text_direction", "curve")


def _colour_sql(tag: str, lo: str, hi: str) -> str:
    return f"list_transform(range(len({lo})), lambda i: {sql_randint('idx', '$' + tag + chr(39) + '.' + chr(39) + ' || i', lo + '[i + 1]', hi + '[i + 1]')})"


PALETTE = f"""pal AS (SELECT *, CASE color_mode WHEN 'per_glyph' THEN list_transform(range(1, {sql_randint("idx", "palette_size", "per_glyph_palette_size_min", "per_glyph_palette_size_max")} + 1), lambda k: {_colour_sql("'palette.' || k || ", "text_color_min", "text_color_max")})
    WHEN 'gradient' THEN [{_colour_sql("'gradient_start' || ", "gradient_start_color_min", "gradient_start_color_max")}, {_colour_sql("'gradient_end' || ", "gradient_end_color_min", "gradient_end_color_max")}]
    ELSE [{_colour_sql("'uniform' || ", "text_color_min", "text_color_max")}] END AS palette FROM styled)"""


def _joined(palette: Column) -> Column:
    return F.array_join(F.transform(palette, lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")), ";")


@query(f"WITH {DRAWN}, {PALETTE} SELECT idx, color_mode, list_aggregate(list_transform(palette, lambda c: list_aggregate(c, 'string_agg', ',')), 'string_agg', ';') AS palette FROM pal")
def color_palette(spark: SparkSession, d: str) -> DataFrame:
    return styled_(spark, d).select("idx", "color_mode", _joined(plan.palette()).alias("palette"))


@query(f"""WITH {DRAWN}, {PALETTE}, g AS (SELECT idx, color_mode, palette, length(text) AS n, unnest(range(length(text))) AS i FROM pal WHERE color_mode <> 'uniform'),
    v AS (SELECT idx, i AS char_pos, CASE WHEN color_mode = 'per_glyph' THEN palette[1 + i % len(palette)] ELSE list_transform(range(3), lambda c: CAST(trunc(palette[1][c + 1] + (CASE WHEN n > 1 THEN i / (n - 1)::DOUBLE ELSE 0 END) * (palette[2][c + 1] - palette[1][c + 1])) AS BIGINT)) END AS c FROM g)
    SELECT idx, char_pos, list_aggregate(c, 'string_agg', ',') AS color FROM v""")
def glyph_colors(spark: SparkSession, d: str) -> DataFrame:
    s = styled_(spark, d).where("color_mode <> 'uniform'").select("idx", "color_mode", plan.palette().alias("palette"), F.length("text").alias("n"))
    g = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return g.select("idx", F.col("i").cast("bigint").alias("char_pos"), F.array_join(F.transform(layout.glyph_color(F.col("color_mode"), F.col("palette"), F.col("i"), F.col("n")), lambda x: x.cast("string")), ",").alias("color"))


# Geometry ------------------------------------------------------------------------------------------------------------
# The boxes of the label files: [character, x0, y0, x1, y1].

LABELS = """lab AS (SELECT DISTINCT file_id, json_extract(label_json, '$.idx')::BIGINT AS idx, json_extract(label_json, '$.canvas[0]')::BIGINT AS w, json_extract(label_json, '$.canvas[1]')::BIGINT AS h, json_extract_string(label_json, '$.direction') AS direction,
      coalesce(json_extract(label_json, '$.placement.x')::BIGINT, 0) AS px, coalesce(json_extract(label_json, '$.placement.y')::BIGINT, 0) AS py, CAST(json_extract(label_json, '$.bboxes') AS JSON[]) AS bs FROM label_files WHERE trim(label_json) <> '' AND json_extract(label_json, '$.bboxes') IS NOT NULL),
    box AS (SELECT * EXCLUDE (bs), i AS char_pos, json_extract_string(bs[i + 1], '$[0]') AS char, json_extract(bs[i + 1], '$[1]')::BIGINT AS x0, json_extract(bs[i + 1], '$[2]')::BIGINT AS y0, json_extract(bs[i + 1], '$[3]')::BIGINT AS x1, json_extract(bs[i + 1], '$[4]')::BIGINT AS y1 FROM (SELECT *, unnest(range(len(bs))) AS i FROM lab))"""
LABEL_SCHEMA = "idx bigint, seed bigint, canvas array<bigint>, direction string, font_size bigint, blur_radius double, curve_type string, placement struct<x: bigint, y: bigint>, bboxes array<array<string>>"


def boxes_(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "label_files").where("trim(label_json) <> ''").select("file_id", F.from_json("label_json", LABEL_SCHEMA).alias("j")).distinct()
    b = j.select("file_id", "j.idx", F.col("j.canvas")[0].alias("w"), F.col("j.canvas")[1].alias("h"), "j.direction", F.coalesce("j.placement.x", F.lit(0)).alias("px"), F.coalesce("j.placement.y", F.lit(0)).alias("py"), F.posexplode("j.bboxes"))
    return b.select("file_id", "idx", "w", "h", "direction", "px", "py", F.col("pos").cast("bigint").alias("char_pos"), F.col("col")[0].alias("char"), *(F.col("col")[k].try_cast("bigint").alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"), 1)))


def _four(names: tuple[str, ...], cols: tuple[Column, ...]) -> list[Column]:
    return [(F.round(c, 6) + 0.0).alias(n) for n, c in zip(names, cols, strict=True)]


XY = ("x0", "y0", "x1", "y1")


@query(f"""WITH {LABELS}, e AS (SELECT *, max(x1) OVER (PARTITION BY file_id) AS tw, max(y1) OVER (PARTITION BY file_id) AS th FROM box),
    o AS (SELECT *, greatest(0, least(px, w - tw)) AS dx, greatest(0, least(py, h - th)) AS dy FROM e) SELECT file_id, char_pos, x0 + dx AS x0, y0 + dy AS y0, x1 + dx AS x1, y1 + dy AS y1 FROM o""")
def place_bboxes(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("file_id")
    b = boxes_(spark, d).withColumns({"tw": F.max("x1").over(w), "th": F.max("y1").over(w)})
    px = lambda n: geometry.placed(F.col(n), F.col("px"), F.col("w"), F.col("tw")).alias(n)
    py = lambda n: geometry.placed(F.col(n), F.col("py"), F.col("h"), F.col("th")).alias(n)
    return b.select("file_id", "char_pos", px("x0"), py("y0"), px("x1"), py("y1"))


ANGLE = f"(-15.0::DOUBLE + 30.0::DOUBLE * {sql_uniform('file_id', 'angle')})"


@query(f"""WITH {LABELS}, a AS (SELECT *, cos({ANGLE} / {DEG}) AS c, sin({ANGLE} / {DEG}) AS s, (x0 + x1) / 2.0::DOUBLE - w / 2.0::DOUBLE AS cx, (y0 + y1) / 2.0::DOUBLE - h / 2.0::DOUBLE AS cy FROM box),
    m AS (SELECT *, cx * c + cy * s + (w * abs(c) + h * abs(s)) / 2 AS mx, -cx * s + cy * c + (w * abs(s) + h * abs(c)) / 2 AS my, ((x1 - x0) * abs(c) + (y1 - y0) * abs(s)) / 2 AS dx, ((x1 - x0) * abs(s) + (y1 - y0) * abs(c)) / 2 AS dy FROM a)
    SELECT file_id, char_pos, round(mx - dx, 6) AS x0, round(my - dy, 6) AS y0, round(mx + dx, 6) AS x1, round(my + dy, 6) AS y1 FROM m""")
def rotate_bboxes(spark: SparkSession, d: str) -> DataFrame:
    angle = F.lit(-15.0) + F.lit(30.0) * uniform(F.col("file_id"), "angle")
    return boxes_(spark, d).select("file_id", "char_pos", *_four(XY, geometry.rotated(*map(F.col, XY), F.col("w"), F.col("h"), angle)))


INSETS = ("ax", "ay", "bx", "by", "cx", "cy", "dx", "dy")
_inset = lambda n: f"({sql_uniform('file_id', 'inset.' + n)} * least(w, h) * 0.1::DOUBLE)"


@query(f"""WITH {LABELS}, q AS (SELECT *, {_inset("ax")} AS xa, {_inset("ay")} AS ya, w - {_inset("bx")} AS xb, {_inset("by")} AS yb, w - {_inset("cx")} AS xc, h - {_inset("cy")} AS yc, {_inset("dx")} AS xd, h - {_inset("dy")} AS yd FROM box),
    r AS (SELECT *, xb - xc AS dx1, xd - xc AS dx2, xa - xb + xc - xd AS sx, yb - yc AS dy1, yd - yc AS dy2, ya - yb + yc - yd AS sy FROM q),
    g AS (SELECT *, (sx * dy2 - dx2 * sy) / (dx1 * dy2 - dx2 * dy1) AS g0, (dx1 * sy - sx * dy1) / (dx1 * dy2 - dx2 * dy1) AS h0 FROM r),
    p AS (SELECT file_id, char_pos, unnest([[x0, y0], [x1, y0], [x1, y1], [x0, y1]]) AS pt, (xb - xa + g0 * xb) / w AS a, (xd - xa + h0 * xd) / h AS b, xa AS c, (yb - ya + g0 * yb) / w AS d, (yd - ya + h0 * yd) / h AS e, ya AS f, g0 / w AS g, h0 / h AS hh FROM g),
    z AS (SELECT file_id, char_pos, (a * pt[1] + b * pt[2] + c) / (g * pt[1] + hh * pt[2] + 1) AS x, (d * pt[1] + e * pt[2] + f) / (g * pt[1] + hh * pt[2] + 1) AS y FROM p)
    SELECT file_id, char_pos, round(min(x), 6) AS x0, round(min(y), 6) AS y0, round(max(x), 6) AS x1, round(max(y), 6) AS y1 FROM z GROUP BY 1, 2""")
def perspective_bboxes(spark: SparkSession, d: str) -> DataFrame:
    w, h = F.col("w").cast("double"), F.col("h").cast("double")
    i = {n: uniform(F.col("file_id"), f"inset.{n}") * F.least("w", "h") * F.lit(0.1) for n in INSETS}
    corners = [(i["ax"], i["ay"]), (w - i["bx"], i["by"]), (w - i["cx"], h - i["cy"]), (i["dx"], h - i["dy"])]
    return boxes_(spark, d).select("file_id", "char_pos", *_four(XY, geometry.warped(*(F.col(n).cast("double") for n in XY), geometry.homography(w, h, corners))))


@query(f"WITH {LABELS} SELECT file_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS n FROM box GROUP BY 1")
def bbox_envelope(spark: SparkSession, d: str) -> DataFrame:
    return boxes_(spark, d).groupBy("file_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n"))


@query(f"""WITH {LABELS}, s AS (SELECT file_id, CASE direction WHEN 'left_to_right' THEN x0 - lag(x0) OVER v WHEN 'right_to_left' THEN lag(x1) OVER v - x1 WHEN 'top_to_bottom' THEN y0 - lag(y0) OVER v ELSE lag(y1) OVER v - y1 END AS step FROM box WINDOW v AS (PARTITION BY file_id ORDER BY char_pos))
    SELECT file_id, coalesce(bool_and(step >= 0), true) AS valid FROM s GROUP BY 1""")
def char_order_valid(spark: SparkSession, d: str) -> DataFrame:
    return geometry.order_valid(boxes_(spark, d), ["file_id"], "direction", "char_pos")


@query(f"""WITH RECURSIVE {DRAWN}, {LINES}, {PLACED}, q AS (SELECT idx, line_index, arg_min(CASE WHEN {FLAT} THEN y0 ELSE x0 END, char_pos) AS place FROM placed WHERE char_pos = 0 GROUP BY 1, 2),
    z AS (SELECT idx, place - lag(place) OVER (PARTITION BY idx ORDER BY line_index) AS step FROM q) SELECT idx, coalesce(bool_and(step >= 0), true) AS valid FROM z GROUP BY 1""")
def line_order_valid(spark: SparkSession, d: str) -> DataFrame:
    """Whether the first boxes of the lines of a straight text go down, or to the right where text is vertical."""
    s = plan.with_values(_lines(styled_(spark, d))).where("curve = 'none'")
    first = boxes_of(s, lined_boxes(), "text_direction").where("char_pos = 0")
    at = F.when(F.col("text_direction").isin(*layout.HORIZONTAL), F.col("y0")).otherwise(F.col("x0"))
    boxes = first.select("idx", "line_index", at.alias("y0"), at.alias("y1"), F.lit(0).alias("x0"), F.lit(0).alias("x1"), F.lit("top_to_bottom").alias("direction"))
    return geometry.order_valid(boxes, ["idx"], "direction", "line_index")


# Plans ---------------------------------------------------------------------------------------------------------------

CANVAS = f"{LINES}, {BLOCK}, cv AS (SELECT idx, width, height, width + 20 + 2 * {sql_randint('idx', 'pad_x', '10', '50')} AS canvas_w, height + 20 + 2 * {sql_randint('idx', 'pad_y', '10', '50')} AS canvas_h FROM bk)"


def planned_(spark: SparkSession, d: str) -> DataFrame:
    return plan.plans(plan.styled(table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "spec_params")).where("text <> ''"))


@query(f"WITH RECURSIVE {DRAWN}, {CANVAS} SELECT idx, canvas_w, canvas_h, {sql_randint('idx', 'place_x', '0', 'canvas_w - width - 20')} AS placement_x, {sql_randint('idx', 'place_y', '0', 'canvas_h - height - 20')} AS placement_y FROM cv")
def canvas_placement(spark: SparkSession, d: str) -> DataFrame:
    return planned_(spark, d).select("idx", "canvas_w", "canvas_h", "placement_x", "placement_y")


@query(f"""WITH {DRAWN} SELECT idx, CAST(drop_shadow_offset_x AS BIGINT) AS x, CAST(drop_shadow_offset_y AS BIGINT) AS y, round(drop_shadow_radius, 6) AS radius, list_aggregate({_colour_sql("'drop_shadow' || ", "drop_shadow_color_min", "drop_shadow_color_max")}, 'string_agg', ',') AS color
    FROM s1 WHERE drop_shadow_offset_x <> 0 OR drop_shadow_offset_y <> 0""")
def shadow_options(spark: SparkSession, d: str) -> DataFrame:
    s = plan.styled(table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "spec_params")).select("idx", plan.shadow("drop_shadow").alias("s")).where("s IS NOT NULL")
    return s.select("idx", "s.x", "s.y", F.round("s.radius", 6).alias("radius"), F.array_join(F.transform("s.color", lambda x: x.cast("string")), ",").alias("color"))


@query(f"""WITH RECURSIVE {DRAWN}, {CANVAS} SELECT cv.idx, CAST(cutout_width AS BIGINT) AS cw, CAST(cutout_height AS BIGINT) AS chh, {sql_randint("cv.idx", "cutout_x", "0", "canvas_w - CAST(cutout_width AS BIGINT)")} AS x, {sql_randint("cv.idx", "cutout_y", "0", "canvas_h - CAST(cutout_height AS BIGINT)")} AS y
    FROM cv JOIN styled USING (idx) WHERE cutout_width > 0 AND cutout_height > 0 AND cutout_width < canvas_w AND cutout_height < canvas_h""")
def cutout_rect(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("idx")
    s = planned_(spark, d).select("idx", F.col("cutout_width").cast("bigint").alias("cw"), F.col("cutout_height").cast("bigint").alias("chh"), "canvas_w", "canvas_h")
    s = s.where("cw > 0 AND chh > 0 AND cw < canvas_w AND chh < canvas_h")
    return s.select("idx", "cw", "chh", randint(key, "cutout_x", F.lit(0), F.col("canvas_w") - F.col("cw")).alias("x"), randint(key, "cutout_y", F.lit(0), F.col("canvas_h") - F.col("chh")).alias("y"))


@query(f"WITH RECURSIVE {DRAWN}, {CANVAS} SELECT cv.idx, CAST(floor(noise_amount * (canvas_w * canvas_h)) AS BIGINT) AS n_pixels FROM cv JOIN styled USING (idx) WHERE noise_amount > 0")
def noise_budget(spark: SparkSession, d: str) -> DataFrame:
    return planned_(spark, d).where("noise_amount > 0").select("idx", F.floor(F.col("noise_amount") * (F.col("canvas_w") * F.col("canvas_h"))).cast("bigint").alias("n_pixels"))


PLAN_COLUMNS = ("rotation_angle", "perspective_warp_magnitude", "blur_radius", "noise_amount", "brightness_factor", "contrast_factor", "ink_bleed_radius", "arc_radius", "sine_amplitude", "sine_frequency", "sine_phase", "elastic_distortion_alpha", "elastic_distortion_sigma", "optical_distortion_limit", "grid_distortion_steps", "grid_distortion_limit", "erosion_dilation_kernel")


@query(f"""WITH {DRAWN} SELECT idx, spec_name, text, text_direction, text_alignment, color_mode, curve, font_size, num_lines, overlap_bp, spacing_percent, CAST(floor({sql_uniform("idx", "seed")} * 4294967296.0::DOUBLE) AS BIGINT) AS seed, background_path, {", ".join(f"round({c}, 6) AS {c}" for c in PLAN_COLUMNS)} FROM s1 WHERE text IS NOT NULL""")
def plan_params(spark: SparkSession, d: str) -> DataFrame:
    p = plan.plans(plan.styled(table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "spec_params")))
    return p.select("idx", "spec_name", "text", "text_direction", "text_alignment", "color_mode", "curve", "font_size", "num_lines", "overlap_bp", "spacing_percent", "seed", "background_path", *(F.round(F.col(c), 6).alias(c) for c in PLAN_COLUMNS))


@query(f"""WITH s AS {S}, n AS (SELECT unnest({list(plan.DEFAULTS)}) AS param, unnest({list(plan.DEFAULTS.values())}) AS value) SELECT s.spec_name, n.param, n.value::DOUBLE AS value FROM s, n WHERE NOT EXISTS (SELECT 1 FROM spec_params p WHERE p.spec_name = s.spec_name AND p.param = n.param)""")
def plan_defaults(spark: SparkSession, d: str) -> DataFrame:
    every = F.explode(F.array(*(F.struct(F.lit(n).alias("param"), F.lit(x).alias("value")) for n, x in plan.DEFAULTS.items()))).alias("p")
    wanted = specs_(spark, d).select("spec_name", every).select("spec_name", "p.param", "p.value")
    return wanted.join(params_(spark, d).select("spec_name", "param"), ["spec_name", "param"], "left_anti")


STAGES_SQL = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in plan.STAGES.items())


@query(f"WITH {DRAWN} SELECT idx, coalesce(list_aggregate(list_filter([{STAGES_SQL}], lambda x: x IS NOT NULL), 'string_agg', ','), '') AS stages FROM s1")
def active_stages(spark: SparkSession, d: str) -> DataFrame:
    s = plan.with_values(plan.styled(table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "spec_params")))
    return s.select("idx", F.array_join(plan.stages(s), ",").alias("stages"))


@query("""SELECT DISTINCT file_id, json_extract(label_json, '$.idx')::BIGINT AS idx, json_extract(label_json, '$.seed')::BIGINT AS seed, json_extract(label_json, '$.canvas[0]')::BIGINT AS canvas_w, json_extract(label_json, '$.canvas[1]')::BIGINT AS canvas_h,
    json_extract_string(label_json, '$.direction') AS direction, json_extract(label_json, '$.font_size')::BIGINT AS font_size, json_extract(label_json, '$.blur_radius')::DOUBLE AS blur_radius, json_extract_string(label_json, '$.curve_type') AS curve_type, coalesce(json_array_length(json_extract(label_json, '$.bboxes')), 0)::BIGINT AS n_boxes FROM label_files WHERE trim(label_json) <> ''""")
def label_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    read = lambda c: F.from_json(c, LABEL_SCHEMA)
    j = table(spark, d, "label_files").where("trim(label_json) <> ''").select("file_id", F.to_json(read(F.col("label_json"))).alias("again")).select("file_id", read(F.col("again")).alias("j"))
    return j.select("file_id", "j.idx", "j.seed", F.col("j.canvas")[0].alias("canvas_w"), F.col("j.canvas")[1].alias("canvas_h"), "j.direction", "j.font_size", "j.blur_radius", "j.curve_type", F.coalesce(F.size("j.bboxes"), F.lit(0)).cast("bigint").alias("n_boxes")).withColumn("n_boxes", F.greatest("n_boxes", F.lit(0).cast("bigint"))).distinct()


CANON = f"(SELECT spec_name, string_agg(param || '=' || CAST(CAST(round(min_value * 1000000) AS BIGINT) AS VARCHAR) || '..' || CAST(CAST(round(max_value * 1000000) AS BIGINT) AS VARCHAR) || ':' || coalesce(distribution, ''), ';' ORDER BY param) AS canon FROM {P} GROUP BY 1)"


@query(f"SELECT spec_name, sha256(canon) AS hash FROM {CANON}")
def config_hash(spark: SparkSession, d: str) -> DataFrame:
    return _hashes(params_(spark, d))


def _hashes(p: DataFrame) -> DataFrame:
    """A fingerprint of each specification's ranges that doesn't depend on the order of rows."""
    one = F.concat("param", F.lit("="), F.round(F.col("min_value") * 1000000).cast("bigint").cast("string"), F.lit(".."), F.round(F.col("max_value") * 1000000).cast("bigint").cast("string"), F.lit(":"), F.coalesce("distribution", F.lit("")))
    return p.groupBy("spec_name").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(one)), ";"), 256).alias("hash"))


@query(f"""WITH now AS (SELECT spec_name, sha256(canon) AS hash FROM {CANON}), then_ AS (SELECT spec_name, sha256(replace(canon, ':uniform', CASE WHEN length(spec_name) % 2 = 0 THEN ':uniform' ELSE ':normal' END)) AS stored FROM {CANON})
    SELECT spec_name, hash <> stored AS changed FROM now JOIN then_ USING (spec_name)""")
def checkpoint_hash_check(spark: SparkSession, d: str) -> DataFrame:
    p = params_(spark, d)
    stored = _hashes(p.withColumn("distribution", F.when((F.length("spec_name") % 2 != 0) & (F.col("distribution") == "uniform"), "normal").otherwise(F.col("distribution")))).withColumnRenamed("hash", "stored")
    return _hashes(p).join(stored, "spec_name").select("spec_name", (F.col("hash") != F.col("stored")).alias("changed"))
