"""Validation of specifications: each rule gives rows of violations ``spec_name, check_no, message``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.distributions import NAMES
from quillspark.operators.resources import glob_matches

TOLERANCE = 0.001
VALUES = {
    "curve_type": ("none", "arc", "sine"),
    "text_direction": ("left_to_right", "right_to_left", "top_to_bottom", "bottom_to_top"),
    "color_mode": ("uniform", "per_glyph", "gradient"),
    "line_break_mode": ("word", "character"),
    "text_alignment": ("left", "center", "right", "top", "bottom"),
}
COLOURS = ("text_color", "gradient_start_color", "gradient_end_color", "drop_shadow_color", "block_shadow_color")
RANGES = ("text_length", "lines", "font_size", "per_glyph_palette_size")


class ValidationError(ValueError):
    """A configuration that breaks a rule."""


def bounds(name: str) -> tuple[str, str]:
    """Columns of the lower and upper end of a range."""
    return (f"min_{name}", f"max_{name}") if name in ("text_length", "lines") else (f"{name}_min", f"{name}_max")


def _violations(df: DataFrame, number: int, broken: Column, message: Column) -> DataFrame:
    return df.where(broken).select("spec_name", F.lit(number).cast("bigint").alias("check_no"), message.alias("message"))


def proportion_sums(specs: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``batch_id, total`` of the batches whose shares don't add up to one; a sum exactly at the tolerance is accepted."""
    return specs.groupBy("batch_id").agg(F.round(F.sum("proportion"), 9).alias("total")).where(F.round(F.abs(F.col("total") - 1.0), 9) > tolerance)


def enum_violations(specs: DataFrame, params: DataFrame) -> DataFrame:
    parts = [_violations(specs, 10 + k, ~F.coalesce(F.col(c).isin(*v), F.lit(False)), F.concat(F.lit(f"{c}: "), F.coalesce(c, F.lit("null")))) for k, (c, v) in enumerate(VALUES.items())]
    parts.append(_violations(params, 1, ~F.coalesce(F.col("distribution").isin(*NAMES), F.lit(False)), F.concat("param", F.lit(": "), F.coalesce("distribution", F.lit("null")))))
    return reduce(DataFrame.unionByName, parts)


def range_violations(specs: DataFrame) -> DataFrame:
    """Counts and sizes that are too small or the wrong way round, and colours whose lower end is above the upper."""
    parts = [_violations(specs, 20, F.col("min_lines") < 1, F.lit("min_lines below 1"))]
    for k, r in enumerate(RANGES):
        lo, hi = bounds(r)
        parts.append(_violations(specs, 21 + k, F.col(lo) > F.col(hi), F.lit(f"{lo} above {hi}")))
    for k, c in enumerate(COLOURS):
        wrong = F.exists(F.arrays_zip(F.col(f"{c}_min").alias("a"), F.col(f"{c}_max").alias("b")), lambda z: z["a"] > z["b"])
        parts.append(_violations(specs, 30 + k, wrong, F.lit(f"{c}_min above {c}_max")))
    return reduce(DataFrame.unionByName, parts)


def min_max_violations(params: DataFrame) -> DataFrame:
    return _violations(params, 40, F.col("min_value") > F.col("max_value"), F.concat("param", F.lit(": min above max")))


def spacing_violations(params: DataFrame) -> DataFrame:
    return _violations(params, 41, (F.col("param") == "line_spacing") & (F.col("min_value") <= 0), F.lit("line_spacing not positive"))


def curve_violations(specs: DataFrame, params: DataFrame) -> DataFrame:
    """Straight text with a radius or amplitude."""
    curved = params.where(F.col("param").isin("arc_radius", "sine_amplitude") & ((F.col("min_value") != 0) | (F.col("max_value") != 0)))
    return _violations(specs.where("curve_type = 'none'").select("spec_name").join(curved, "spec_name"), 50, F.lit(True), F.concat("param", F.lit(" without a curve")))


def missing_corpora(specs: DataFrame, corpus: DataFrame) -> DataFrame:
    """Specifications whose corpus file is neither the name of one nor a pattern that fits one."""
    missing = specs.join(corpus.select("corpus_file"), "corpus_file", "left_anti")
    patterns = missing.where(F.col("corpus_file").rlike(r"[*?\[]")).select("corpus_file")
    fitting = glob_matches(patterns, corpus, "corpus_file", "corpus_file").select(F.col("filter").alias("corpus_file")).distinct()
    missing = missing.join(fitting, "corpus_file", "left_anti")
    return _violations(missing, 60, F.lit(True), F.concat(F.lit("no corpus file: "), F.coalesce("corpus_file", F.lit("null"))))


def raw_violations(specs: DataFrame) -> DataFrame:
    """Missing or impossible values of mandatory fields."""
    parts = [_violations(specs, 70 + k, F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.lit(f"{c} is missing")) for k, c in enumerate(("spec_name", "text_direction", "corpus_file"))]
    parts.append(_violations(specs, 73, F.col("proportion").isNull() | (F.col("proportion") < 0) | (F.col("proportion") > 1), F.lit("proportion out of range")))
    parts.append(_violations(specs, 74, F.col("font_size_min") <= 0, F.lit("font size not positive")))
    return reduce(DataFrame.unionByName, parts)


def all_violations(specs: DataFrame, params: DataFrame, corpus: DataFrame) -> DataFrame:
    parts = [enum_violations(specs, params), range_violations(specs), min_max_violations(params), spacing_violations(params), curve_violations(specs, params), missing_corpora(specs, corpus), raw_violations(specs)]
    return reduce(DataFrame.unionByName, parts).distinct()


def report(violations: DataFrame) -> DataFrame:
    """``spec_name, n, messages``: all violations of a specification in one text, in the order of checks."""
    listed = F.array_sort(F.collect_list(F.struct("check_no", "message")))
    return violations.groupBy("spec_name").agg(F.count("*").alias("n"), F.array_join(F.transform(listed, lambda x: x["message"]), "; ").alias("messages"))


def first_failure(violations: DataFrame) -> DataFrame:
    """``spec_name, check_no, message``: what a check that stops at once would say."""
    w = Window.partitionBy("spec_name").orderBy("check_no", "message")
    return violations.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def raise_if_any(violations: DataFrame) -> None:
    some = violations.limit(20).collect()
    if some:
        raise ValidationError("; ".join(f"{r['spec_name']}: {r['message']}" for r in some))
