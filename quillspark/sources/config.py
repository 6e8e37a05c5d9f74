"""Batch configurations (YAML) as specification tables, and the checks that come before anything is planned."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillspark.functions.distributions import NAMES
from quillspark.operators.checks import COLOURS, VALUES, ValidationError
from quillspark.plans.plan import DEFAULTS

MANDATORY = ("name", "proportion", "text_direction", "corpus_file")
FIELDS: dict[str, Any] = {
    "font_filter": None, "min_text_length": 10, "max_text_length": 50, "min_lines": 1, "max_lines": 1, "line_break_mode": "word", "text_alignment": "left", "curve_type": "none", "arc_concave": True, "color_mode": "uniform",
    "per_glyph_palette_size_min": 2, "per_glyph_palette_size_max": 5, "font_size_min": 32, "font_size_max": 32,
} | {f"{c}_{e}": [0, 0, 0, 128] if "shadow" in c else [0, 0, 0] for c in COLOURS for e in ("min", "max")}
#: The distribution of a parameter where a specification names none.
DISTRIBUTION = dict.fromkeys(DEFAULTS, "exponential") | dict.fromkeys(("rotation_angle", "brightness_factor", "contrast_factor"), "normal") | dict.fromkeys((n for n in DEFAULTS if "offset" in n or n in ("line_spacing", "grid_distortion_steps", "erosion_dilation_kernel", "cutout_width", "cutout_height", "sine_frequency", "sine_phase")), "uniform")
WHOLE = {n for n in DEFAULTS if "offset" in n or "cutout" in n or n in ("grid_distortion_steps", "grid_distortion_limit", "erosion_dilation_kernel")}
_TYPES = {str: T.StringType(), int: T.IntegerType(), bool: T.BooleanType(), list: T.ArrayType(T.IntegerType()), type(None): T.StringType()}
SPECS = T.StructType(
    [T.StructField("batch_id", T.LongType()), T.StructField("spec_name", T.StringType()), T.StructField("proportion", T.DoubleType()), T.StructField("text_direction", T.StringType()), T.StructField("corpus_file", T.StringType())]
    + [T.StructField(n, _TYPES[type(v)]) for n, v in FIELDS.items()]
)
PARAMS = "spec_name string, param string, min_value double, max_value double, distribution string, is_int boolean"


def read(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as f:
        got = yaml.safe_load(f)
    if not isinstance(got, dict):
        raise ValidationError("the configuration must be a map")
    return got


def check_raw(raw: Mapping[str, Any]) -> None:
    """The first thing wrong with a configuration, as an error."""
    for k in ("total_images", "specifications"):
        if k not in raw:
            raise ValidationError(f"missing field: {k}")
    n = raw["total_images"]
    if not isinstance(n, int) or isinstance(n, bool) or n <= 0:
        raise ValidationError("total_images must be a positive whole number")
    specs = raw["specifications"]
    if not isinstance(specs, list) or not specs:
        raise ValidationError("specifications must be a list that isn't empty")
    names = [s.get("name") for s in specs]
    if len(set(names)) < len(names):
        raise ValidationError("specification names must differ")
    for s in specs:
        problems = [f"missing field: {k}" for k in MANDATORY if s.get(k) is None]
        known = {"canvas", "font", "direction"} | set(MANDATORY) | set(FIELDS) | {f"{p}_{e}" for p in DEFAULTS for e in ("min", "max", "distribution")}
        problems += [f"unknown field: {k}" for k in s if k not in known]
        problems += [f"{k}: {s[k]}" for k, v in VALUES.items() if k in s and s[k] not in v]
        problems += [f"{k}: {v}" for k, v in s.items() if k.endswith("_distribution") and v not in NAMES]
        problems += [f"{k}_min above {k}_max" for k in DEFAULTS if f"{k}_min" in s and f"{k}_max" in s and s[f"{k}_min"] > s[f"{k}_max"]]
        problems += [f"min_{k} above max_{k}" for k in ("text_length", "lines") if s.get(f"min_{k}", FIELDS[f"min_{k}"]) > s.get(f"max_{k}", FIELDS[f"max_{k}"])]
        problems += [f"{k}_min above {k}_max" for k in ("font_size", "per_glyph_palette_size") if s.get(f"{k}_min", FIELDS[f"{k}_min"]) > s.get(f"{k}_max", FIELDS[f"{k}_max"])]
        problems += section_problems(s)
        if s.get("font_size_min", 1) <= 0:
            problems.append("font size not positive")
        if s.get("line_spacing_min", 1.0) <= 0:
            problems.append("line_spacing_min must be above 0")
        if s.get("min_lines", 1) < 1:
            problems.append("min_lines below 1")
        if s.get("curve_type", "none") == "none" and any(s.get(f"{p}_{e}") for p in ("arc_radius", "sine_amplitude") for e in ("min", "max")):
            problems.append("a radius or amplitude without a curve")
        if problems:
            raise ValidationError(f"{s.get('name')}: " + "; ".join(problems))
    if abs(sum(s["proportion"] for s in specs) - 1) > 0.001 + 1e-12:
        raise ValidationError("proportions must add up to 1")


def _number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool)


def section_problems(s: Mapping[str, Any]) -> list[str]:
    """What is wrong with the optional sections of a specification: canvas (min_padding, max_padding), font (size_range) and
    direction weights (direction: a map from direction to weight)."""
    problems = []
    canvas, font, weights = s.get("canvas"), s.get("font"), s.get("direction")
    if canvas is not None:
        ends = [canvas.get("min_padding"), canvas.get("max_padding")] if isinstance(canvas, Mapping) else ["?"]
        given = [x for x in ends if x is not None]
        if not all(map(_number, given)):
            problems.append("canvas padding must be a number")
        elif any(x < 0 for x in given):
            problems.append("canvas padding must not be negative")
        elif len(given) == 2 and given[0] > given[1]:
            problems.append("min_padding above max_padding")
    size = font.get("size_range") if isinstance(font, Mapping) else font
    if size is not None:
        if not isinstance(size, list) or len(size) != 2 or not all(map(_number, size)):
            problems.append("font size_range must be a list of two numbers")
        elif min(size) <= 0:
            problems.append("font sizes must be positive")
        elif size[0] > size[1]:
            problems.append("font size_range is the wrong way round")
    if weights is not None:
        if not isinstance(weights, Mapping):
            problems.append("direction must be a map")
        else:
            problems += [f"direction weight of {k} must be a number" for k, w in weights.items() if not _number(w)]
            problems += [f"direction weight of {k} is negative" for k, w in weights.items() if _number(w) and w < 0]
    return problems


def check_fonts(found: int, folder: str) -> None:
    """There must be a font."""
    if not found:
        raise ValidationError(f"no font file (.ttf) in {folder}")


def check_folders(**folders: str) -> None:
    for name, path in folders.items():
        if not os.path.isdir(path):
            raise ValidationError(f"{name} isn't a folder: {path}")


def tables(spark: SparkSession, raw: Mapping[str, Any], batch_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """(specs, spec_params) of a configuration; absent fields have their defaults."""
    specs, params = [], []
    for s in raw["specifications"]:
        specs.append((batch_id, s["name"], float(s["proportion"]), s["text_direction"], s["corpus_file"], *(s.get(k, v) for k, v in FIELDS.items())))
        for p, x in DEFAULTS.items():
            params.append((s["name"], p, float(s.get(f"{p}_min", x)), float(s.get(f"{p}_max", max(x, s.get(f"{p}_min", x)))), s.get(f"{p}_distribution", DISTRIBUTION[p]), p in WHOLE))
    return spark.createDataFrame(specs, SPECS), spark.createDataFrame(params, PARAMS)
