"""Images, labels and checkpoints on disk."""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from quillspark.operators.schedule import retry_schedule
from quillspark.sources.storage import write_whole

WRITTEN = "idx long, path string, error string"


def config_hash(raw: Mapping[str, Any]) -> str:
    """A fingerprint that doesn't depend on the order of keys."""
    return hashlib.sha256(json.dumps(raw, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def with_retries(work: Callable[[], None], attempts: int = 3) -> None:
    """Tries again after a permission error, waiting longer each time; the last error is raised."""
    for k, wait in retry_schedule(attempts):
        try:
            return work()
        except PermissionError:
            if k == attempts - 1:
                raise
            time.sleep(wait + random.uniform(0, 0.05))  # noqa: S311
    return None


def write_images(images: DataFrame, labels: DataFrame, folder: str, rows_at_once: int = 0) -> DataFrame:
    """Writes image_<idx>.png and image_<idx>.json from the executors; ``idx, path, error``. Writing again overwrites the same names.

    folder: a path that all executors see, or a URI. rows_at_once: images that are written before their results go on (0: a batch).
    """
    both = images.where("error IS NULL").select("idx", "image").join(labels, "idx")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (b.iloc[at : at + (rows_at_once or len(b))] for b in batches for at in range(0, len(b), rows_at_once or len(b) or 1)):
            rows = []
            for idx, image, label in zip(pdf["idx"], pdf["image"], pdf["label"], strict=True):
                path, error = f"{folder}/image_{idx:05d}", None
                try:
                    with_retries(lambda p=path, d=image: write_whole(p + ".png", d))
                    with_retries(lambda p=path, d=label: write_whole(p + ".json", d.encode()))
                except OSError as e:  # the row is reported; the others go on
                    error = str(e)
                rows.append((idx, path + ".png", error))
            yield pd.DataFrame(rows, columns=["idx", "path", "error"])

    return both.mapInPandas(run, WRITTEN)


def save_checkpoint(path: str, completed: int, total: int, hash_: str) -> None:
    state = {"completed_images": completed, "total_images": total, "config_hash": hash_, "timestamp": datetime.now(timezone.utc).isoformat()}
    write_whole(path, json.dumps(state).encode())


def write_review(sample: DataFrame, path: str) -> None:
    """A table to be filled in by hand: file_path, did_render_correctly, reason."""
    sample.selectExpr("path AS file_path", "'' AS did_render_correctly", "'' AS reason").coalesce(1).write.mode("overwrite").option("header", True).csv(path)
