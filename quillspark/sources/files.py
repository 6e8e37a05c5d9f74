"""Corpora, fonts, backgrounds and finished work in folders."""

from __future__ import annotations

import hashlib
import json
import os
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.resources import is_image
from quillspark.operators.schedule import index_in_name
from quillspark.sources.storage import write_whole


class CheckpointWarning(UserWarning):
    """A checkpoint that belongs to another configuration."""


def _relative(folder: str) -> F.Column:
    return F.regexp_replace(F.expr("_metadata.file_path"), rf"^file:/*|^{folder}", "")


def corpus_files(spark: SparkSession, folder: str) -> DataFrame:
    """``corpus_file, text`` of all .txt files below a folder, named relative to it."""
    root = os.path.abspath(folder).rstrip("/")
    t = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root)
    path = F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), r"^file:/+", "/")
    return t.select(F.substring(path, len(root) + 2, 1 << 30).alias("corpus_file"), F.col("value").alias("text"))


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(os.path.abspath(folder))
    return f.select(F.regexp_replace("path", r"^file:/+", "/").alias("path"), "length")


def font_files(spark: SparkSession, folder: str) -> DataFrame:
    """``font_path, file_bytes`` of all .ttf files; their contents aren't read."""
    return _paths(spark, folder).where(F.lower("path").endswith(".ttf")).select(F.col("path").alias("font_path"), F.col("length").alias("file_bytes"))


def background_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``background_path`` of all images; a folder that is missing gives a warning and nothing."""
    out = spark.createDataFrame([], "background_path string")
    for f in folders:
        if not os.path.isdir(f):
            warnings.warn(f"no such folder: {f}", stacklevel=2)
            continue
        out = out.unionAll(_paths(spark, f).where(is_image(F.col("path"))).select(F.col("path").alias("background_path")))
    return out


def drawable_backgrounds(spark: SparkSession, backgrounds: DataFrame, folder: str) -> DataFrame:
    """``background_path, drawable_path``: PNG files as they are; JPEG files decoded by Spark and written once as PNG files to a
    folder that all executors see. A file that can't be read is left out."""
    from quillspark.functions import pixels

    png = F.lower("background_path").endswith(".png")
    own = backgrounds.where(png).select("background_path", F.col("background_path").alias("drawable_path"))
    jpeg = [r["background_path"] for r in backgrounds.where(~png).select("background_path").distinct().toLocalIterator()]
    if not jpeg:
        return own

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for origin, h, w, channels, data in zip(pdf["origin"], pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"], strict=True):
                raw = np.frombuffer(data, np.uint8).reshape(h, w, channels)
                rgb = np.repeat(raw, 3, axis=2) if channels == 1 else raw[:, :, 2::-1]
                to = f"{folder}/{hashlib.sha256(origin.encode()).hexdigest()}.png"
                write_whole(to, pixels.png(np.dstack([rgb, np.full((h, w), 255, np.uint8)])))
                rows.append((origin, to))
            yield pd.DataFrame(rows, columns=["background_path", "drawable_path"])

    images = spark.read.format("image").option("dropInvalid", True).load(jpeg).select("image.*")
    made = images.mapInPandas(convert, "background_path string, drawable_path string").select(F.regexp_replace(F.url_decode("background_path"), r"^file:/+", "/").alias("background_path"), "drawable_path")
    return own.unionByName(made)


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """``folder, path`` of all images below a folder."""
    f = _paths(spark, folder).where(is_image(F.col("path")))
    return f.select(F.regexp_replace("path", r"/[^/]+\z", "").alias("folder"), "path")


def finished_indices(spark: SparkSession, folder: str) -> DataFrame:
    """``idx`` of the images image_<idx>.png that a folder holds."""
    if not os.path.isdir(folder):
        return spark.createDataFrame([], "idx bigint")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return _paths(spark, folder).where(F.lower("path").endswith(".png")).select(index_in_name(name).alias("idx")).where("idx IS NOT NULL").distinct()


def load_checkpoint(path: str, config_hash: str) -> dict | None:
    """The saved state, or None; a warning if it was saved under another configuration."""
    if not os.path.exists(path):
        return None
    with open(path, encoding="utf-8") as f:
        state = json.load(f)
    if state.get("config_hash") != config_hash:
        warnings.warn("the configuration has changed since the checkpoint", CheckpointWarning, stacklevel=2)
    return state
