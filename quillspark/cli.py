"""Command line: from a configuration and folders to images with labels; generated backgrounds; a table for reviewing images.

    python -m quillspark.cli --batch-config batch.yaml --output-dir out --font-dir fonts --background-dir backgrounds --corpus-dir texts
    python -m quillspark.cli backgrounds --output-dir backgrounds --count 100 [--art]
    python -m quillspark.cli review --output-dir out --review-file review.csv [--per-folder 5]
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions.draws import uniform
from quillspark.functions.text import segment
from quillspark.operators import render, resources, schedule
from quillspark.operators.checks import ValidationError
from quillspark.plans import plan
from quillspark.session import build_session, cut_lineage, ship_package
from quillspark.sources import config, files, sinks
from quillspark.sources.storage import write_whole

log = logging.getLogger("quillspark")


def _common(p: argparse.ArgumentParser) -> argparse.ArgumentParser:
    p.add_argument("--output-dir", required=True, help="a folder that all executors see, or a URI")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--log-dir", help="a folder for quillspark.log, beside what is said on the console")
    p.add_argument("--master", help="Spark's master; without it this machine")
    p.add_argument("--generation-workers", "--workers", type=int, default=0, help="cores of this machine; 0: all")
    return p


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    args = sys.argv[1:] if args is None else args
    if args[:1] == ["backgrounds"]:
        p = _common(argparse.ArgumentParser(description="Makes backgrounds."))
        p.add_argument("--count", type=int, default=100)
        p.add_argument("--art", action="store_true", help="stripes and shapes instead of one colour")
        return p.parse_args(args[1:], argparse.Namespace(command="backgrounds"))
    if args[:1] == ["review"]:
        p = _common(argparse.ArgumentParser(description="Lists some images of each folder to be looked at."))
        p.add_argument("--review-file", required=True)
        p.add_argument("--per-folder", type=int, default=5)
        return p.parse_args(args[1:], argparse.Namespace(command="review"))
    p = _common(argparse.ArgumentParser(description="Makes labelled images of text."))
    for name in ("batch-config", "font-dir", "background-dir", "corpus-dir"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--chunk-size", type=int, default=10_000, help="images that are made, saved and noted in the checkpoint together")
    p.add_argument("--io-batch-size", type=int, default=0, help="images that a worker writes before it reports; 0: as they come")
    p.add_argument("--resume", action="store_true")
    return p.parse_args(args, argparse.Namespace(command="images"))


def task_table(spark: SparkSession, raw: dict, specs: DataFrame, corpus: DataFrame, fonts: DataFrame, backgrounds: DataFrame, scores: DataFrame) -> DataFrame:
    """``idx, spec_name, text, font_path, background_path`` of every image; font_path is null where a filter matches no healthy font.

    scores: ``resource_id, score`` of fonts and backgrounds that were used before. Fonts are drawn by weight from the fonts of
    the specification's filter; no task or specification holds a list of them.
    """
    n = raw["total_images"]
    usable = cut_lineage(resources.healthy(fonts, "font_path", scores))
    of_filter = resources.glob_matches(specs, usable, "font_filter", "resource_id").join(usable, F.col("name") == F.col("resource_id"))
    choices = of_filter.select(F.concat(F.lit("only "), "filter").alias("choice"), "resource_id", "score").unionByName(usable.select(F.lit("all").alias("choice"), "resource_id", "score"))
    spans = cut_lineage(resources.weighted_spans(choices, "choice"))
    s = specs.join(corpus, "corpus_file").select("spec_name", "text", "min_text_length", "max_text_length", F.coalesce(F.concat(F.lit("only "), "font_filter"), F.lit("all")).alias("choice"))
    t = schedule.task_list(schedule.allocation(specs, n), n).hint("merge").join(s, "spec_name")  # taken for few, tasks would be broadcast
    t = t.select("idx", "spec_name", "choice", segment(F.col("text"), F.col("min_text_length"), F.col("max_text_length"), F.col("idx")).alias("text"))
    t = resources.pick_from_spans(t, "idx", spans, "choice", "font", "font_path").drop("choice")
    return resources.weighted_pick(t, "idx", resources.healthy(backgrounds, "background_path", scores), "background", "background_path")


def known_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores from the outcomes of earlier runs into the same folder."""
    if not os.path.isdir(folder):
        return spark.createDataFrame([], "resource_id string, score bigint")
    return resources.final_scores(spark.read.parquet(folder)).select("resource_id", "score")


def _session(a: argparse.Namespace) -> SparkSession:
    spark = build_session(a.master or f"local[{a.generation_workers or '*'}]")
    ship_package(spark)
    return spark


def make_backgrounds(a: argparse.Namespace) -> int:
    made = render.backgrounds(_session(a), a.count, art=a.art)

    def write(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            for name, image in zip(pdf["name"], pdf["image"], strict=True):
                write_whole(f"{a.output_dir}/{name}", bytes(image))
            yield pdf[["name"]]

    log.info("%d backgrounds", made.mapInPandas(write, "name string").count())
    return 0


def make_review(a: argparse.Namespace) -> int:
    images = files.image_files(_session(a), a.output_dir)
    w = Window.partitionBy("folder").orderBy(uniform(F.col("path"), "review"), "path")
    some = images.withColumn("n", F.row_number().over(w)).where(F.col("n") <= a.per_folder).select("path")
    sinks.write_review(some, a.review_file)
    return 0


def make_images(a: argparse.Namespace) -> int:
    try:
        raw = config.read(a.batch_config)
        config.check_raw(raw)
        config.check_folders(font_dir=a.font_dir, background_dir=a.background_dir, corpus_dir=a.corpus_dir)
        spark = _session(a)
        corpus, fonts = files.corpus_files(spark, a.corpus_dir), files.font_files(spark, a.font_dir)
        config.check_fonts(fonts.limit(1).count(), a.font_dir)
        if not corpus.limit(1).count():
            raise ValidationError(f"no corpus file (.txt) in {a.corpus_dir}")
    except (ValidationError, OSError) as e:
        log.error("%s", e)
        return 1
    specs, params = config.tables(spark, raw)
    missing = specs.join(corpus.select("corpus_file"), "corpus_file", "left_anti").limit(5).collect()
    if missing:
        log.error("no such corpus file: %s", ", ".join(r["corpus_file"] for r in missing))
        return 1
    seen = f"{a.output_dir}/outcomes"
    scores = known_scores(spark, seen)
    if not resources.healthy(fonts, "font_path", scores).limit(1).count():
        log.error("no font is left that renders well enough")
        return 1
    backgrounds = files.background_files(spark, [a.background_dir])
    drawable = cut_lineage(files.drawable_backgrounds(spark, backgrounds, f"{a.output_dir}/backgrounds"))
    unread = backgrounds.join(drawable, "background_path", "left_anti").count()
    if unread:
        log.warning("%d backgrounds can't be read", unread)
    if not drawable.limit(1).count():
        log.warning("no background: text is drawn on white")
    tasks = task_table(spark, raw, specs, corpus, fonts, drawable, scores)
    state, hash_ = f"{a.output_dir}/checkpoint.json", sinks.config_hash(raw)
    if a.resume:
        files.load_checkpoint(state, hash_)
        tasks = schedule.not_done(tasks, files.finished_indices(spark, a.output_dir))
    tasks = cut_lineage(tasks.join(drawable, "background_path", "left"))
    without = tasks.where("font_path IS NULL").groupBy("spec_name").count().limit(20).collect()
    for r in without:
        log.warning("%s: no font matches its filter, %d images are left out", r["spec_name"], r["count"])
    tasks = tasks.where("font_path IS NOT NULL")
    steps = sorted(r["step"] for r in tasks.select(schedule.chunk_of(F.col("idx"), a.chunk_size).alias("step")).distinct().collect())
    saved = failed = 0
    for step in steps:
        part = tasks.where((F.col("idx") >= step * a.chunk_size) & (F.col("idx") < (step + 1) * a.chunk_size))
        plans = cut_lineage(plan.plans(plan.styled(part.drop("background_path").withColumnRenamed("drawable_path", "background_path"), specs, params)))
        images = cut_lineage(render.rendered(plans, read_backgrounds=True))
        written = sinks.write_images(images, render.labels(plans, images), a.output_dir, a.io_batch_size).agg(F.count_if(F.col("error").isNull()).alias("saved"), F.count_if(F.col("error").isNotNull()).alias("failed")).first()
        used = part.select("idx", F.explode(F.array_compact(F.array("font_path", "background_path"))).alias("resource_id"))
        used.join(images.select("idx", F.col("error").isNull().alias("ok")), "idx").select("resource_id", F.col("idx").alias("seq"), "ok", F.current_timestamp().alias("recorded_at")).write.mode("append").parquet(seen)
        saved, failed = saved + written["saved"], failed + written["failed"] + images.where("error IS NOT NULL").count()
        sinks.save_checkpoint(state, files.finished_indices(spark, a.output_dir).count(), raw["total_images"], hash_)
        log.info("images %d to %d: %d saved so far, %d failed", step * a.chunk_size, (step + 1) * a.chunk_size - 1, saved, failed)
    if not steps:
        sinks.save_checkpoint(state, files.finished_indices(spark, a.output_dir).count(), raw["total_images"], hash_)
    log.info("%d images saved, %d failed", saved, failed)
    return 0


def main(args: list[str] | None = None) -> int:
    a = arguments(args)
    logging.basicConfig(level=a.log_level)
    if a.log_dir:
        os.makedirs(a.log_dir, exist_ok=True)
        log.addHandler(logging.FileHandler(os.path.join(a.log_dir, "quillspark.log")))
    return {"backgrounds": make_backgrounds, "review": make_review, "images": make_images}[a.command](a)


if __name__ == "__main__":
    sys.exit(main())
