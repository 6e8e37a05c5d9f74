"""The plan of each task: every draw that its image needs, in one projection over tasks, specifications and their ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import layout
from quillspark.functions.distributions import sample
from quillspark.functions.draws import randint, uniform
from quillspark.functions.text import lines_of

#: What a specification draws where it names no range.
DEFAULTS = {
    "line_spacing": 1.0, "glyph_overlap_intensity": 0.0, "ink_bleed_radius": 0.0, "rotation_angle": 0.0, "perspective_warp_magnitude": 0.0, "elastic_distortion_alpha": 0.0, "elastic_distortion_sigma": 0.0,
    "grid_distortion_steps": 2.0, "grid_distortion_limit": 0.0, "optical_distortion_limit": 0.0, "noise_amount": 0.0, "blur_radius": 0.0, "brightness_factor": 1.0, "contrast_factor": 1.0, "erosion_dilation_kernel": 1.0,
    "cutout_width": 0.0, "cutout_height": 0.0, "drop_shadow_offset_x": 0.0, "drop_shadow_offset_y": 0.0, "drop_shadow_radius": 0.0, "block_shadow_offset_x": 0.0, "block_shadow_offset_y": 0.0, "block_shadow_radius": 0.0,
    "arc_radius": 0.0, "sine_amplitude": 0.0, "sine_frequency": 0.0, "sine_phase": 0.0,
}
#: Stages after the text is drawn, in their order, each with its condition.
STAGES = {
    "ink_bleed": "ink_bleed_radius > 0",
    "drop_shadow": "drop_shadow_offset_x <> 0 OR drop_shadow_offset_y <> 0",
    "block_shadow": "block_shadow_offset_x <> 0 OR block_shadow_offset_y <> 0",
    "rotation": "rotation_angle <> 0",
    "perspective": "perspective_warp_magnitude > 0",
    "elastic": "elastic_distortion_alpha > 0 AND elastic_distortion_sigma > 0",
    "grid": "grid_distortion_limit > 0",
    "optical": "optical_distortion_limit > 0",
    "cutout": "cutout_width > 0 AND cutout_height > 0",
    "morphology": "erosion_dilation_kernel > 1",
    "noise": "noise_amount > 0",
    "blur": "blur_radius > 0",
    "brightness_contrast": "brightness_factor <> 1 OR contrast_factor <> 1",
}
SPEC_COLUMNS = ("text_direction", "line_break_mode", "text_alignment", "curve_type", "arc_concave", "color_mode", "min_lines", "max_lines", "font_size_min", "font_size_max", "per_glyph_palette_size_min", "per_glyph_palette_size_max", *(f"{c}_{e}" for c in ("text_color", "gradient_start_color", "gradient_end_color", "drop_shadow_color", "block_shadow_color") for e in ("min", "max")))


def distinct_tasks(tasks: DataFrame, *columns: str) -> DataFrame:
    """Repeated tasks count once."""
    return tasks.select("idx", *columns).where("idx IS NOT NULL").distinct()


def ranges_by_spec(params: DataFrame) -> DataFrame:
    """``spec_name, ranges``: a map from parameter to its range."""
    one = params.where("spec_name IS NOT NULL AND param IS NOT NULL").groupBy("spec_name", "param").agg(F.min(F.struct("min_value", "max_value", "distribution", "is_int")).alias("r"))
    return one.groupBy("spec_name").agg(F.map_from_entries(F.collect_list(F.struct("param", "r"))).alias("ranges"))


def drawn(ranges: Column, key: Column) -> Column:
    """A map from parameter to its value; whole-number parameters are cut towards zero."""

    def draw(name: Column, r: Column) -> Column:
        x = sample(r["distribution"], r["min_value"], r["max_value"], key, name)
        return F.when(r["is_int"], x.cast("bigint").cast("double")).otherwise(x)

    return F.transform_values(F.coalesce(ranges, F.create_map().cast("map<string,struct<min_value:double,max_value:double,distribution:string,is_int:boolean>>")), draw)


def styled(tasks: DataFrame, specs: DataFrame, params: DataFrame) -> DataFrame:
    """Tasks with their specification's fields, font size, number of lines, and the map ``drawn`` of sampled parameters."""
    t = distinct_tasks(tasks, "spec_name", "text", "font_path", "background_path")
    s = specs.select("spec_name", *SPEC_COLUMNS).dropDuplicates(["spec_name"]).join(ranges_by_spec(params), "spec_name", "left")
    j = t.join(s, "spec_name")
    return j.withColumns({"font_size": randint(F.col("idx"), "font_size", F.col("font_size_min"), F.col("font_size_max")), "num_lines": randint(F.col("idx"), "num_lines", F.col("min_lines"), F.col("max_lines")), "drawn": drawn(F.col("ranges"), F.col("idx"))}).drop("ranges")


def value(name: str) -> Column:
    return F.coalesce(F.col("drawn")[name], F.lit(DEFAULTS[name]))


def overlap() -> Column:
    """Overlap of glyphs in basis points."""
    return F.floor(value("glyph_overlap_intensity") * 10000).cast("bigint")


def spacing() -> Column:
    """Line spacing in percent; a spacing of nothing counts as one."""
    x = F.floor(value("line_spacing") * 100).cast("bigint")
    return F.when(x > 0, x).otherwise(100)


def curve() -> Column:
    return F.when((F.col("curve_type") == "arc") & (value("arc_radius") > 1.0), "arc").when((F.col("curve_type") == "sine") & (value("sine_amplitude") > 0.1), "sine").otherwise("none")


def with_values(df: DataFrame) -> DataFrame:
    """df with a column for each sampled parameter."""
    return df.withColumns({n: value(n) for n in DEFAULTS})


def colour(key: Column, tag: str | Column, lo: Column, hi: Column) -> Column:
    """An array of channels, each drawn between its bounds."""
    named = F.lit(tag) if isinstance(tag, str) else tag
    return F.transform(F.sequence(F.lit(0), F.size(lo) - 1), lambda i: randint(key, F.concat(named, F.lit("."), i.cast("string")), F.get(lo, i), F.get(hi, i)))


def palette() -> Column:
    """Colours of a text: one, some to cycle through, or the two ends of a gradient."""
    key = F.col("idx")
    some = F.transform(
        F.sequence(F.lit(1).cast("bigint"), randint(key, "palette_size", F.col("per_glyph_palette_size_min"), F.col("per_glyph_palette_size_max"))),
        lambda k: colour(key, F.concat(F.lit("palette."), k.cast("string")), F.col("text_color_min"), F.col("text_color_max")),
    )
    ends = F.array(colour(key, "gradient_start", F.col("gradient_start_color_min"), F.col("gradient_start_color_max")), colour(key, "gradient_end", F.col("gradient_end_color_min"), F.col("gradient_end_color_max")))
    return F.when(F.col("color_mode") == "per_glyph", some).when(F.col("color_mode") == "gradient", ends).otherwise(F.array(colour(key, "uniform", F.col("text_color_min"), F.col("text_color_max"))))


def shadow(kind: str) -> Column:
    """Offset, radius and colour of a shadow; null if it isn't offset."""
    x, y = value(f"{kind}_offset_x").cast("bigint"), value(f"{kind}_offset_y").cast("bigint")
    return F.when((x != 0) | (y != 0), F.struct(x.alias("x"), y.alias("y"), value(f"{kind}_radius").alias("radius"), colour(F.col("idx"), kind, F.col(f"{kind}_color_min"), F.col(f"{kind}_color_max")).alias("color")))


def plans(df: DataFrame) -> DataFrame:
    """One row per task with text: everything that is needed to draw it."""
    key = F.col("idx")
    d = df.where("text IS NOT NULL").withColumns({"overlap_bp": overlap(), "spacing_percent": spacing(), "curve": curve(), "lines": lines_of(F.col("text"), F.col("num_lines"), F.col("line_break_mode")), "palette": palette(), "drop_shadow": shadow("drop_shadow"), "block_shadow": shadow("block_shadow"), "seed": F.floor(uniform(key, "seed") * 4294967296.0).cast("bigint")})
    d = d.withColumn("block", layout.block_size(F.col("lines"), F.col("font_size"), F.col("overlap_bp"), F.col("spacing_percent"), F.col("text_direction")))
    d = d.withColumns({"canvas_w": F.col("block.width") + 2 * layout.MARGIN + 2 * randint(key, "pad_x", 10, 50), "canvas_h": F.col("block.height") + 2 * layout.MARGIN + 2 * randint(key, "pad_y", 10, 50)})
    d = d.withColumns({"placement_x": randint(key, "place_x", F.lit(0), F.col("canvas_w") - F.col("block.width") - 2 * layout.MARGIN), "placement_y": randint(key, "place_y", F.lit(0), F.col("canvas_h") - F.col("block.height") - 2 * layout.MARGIN)})
    return with_values(d).drop("block", "drawn", "min_lines", "max_lines", "font_size_min", "font_size_max", "per_glyph_palette_size_min", "per_glyph_palette_size_max", *(c for c in SPEC_COLUMNS if "color_m" in c and c != "color_mode"))


def stages(df: DataFrame) -> Column:
    """Names of the stages that a plan runs, in their order."""
    return F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in STAGES.items())))
