"""Session helpers: settings, the shared checkpoint folder, and materialising small results."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", name: str = "quillspark", **settings: str) -> SparkSession:
    """A session for tests, the command line and benchmarks; a cluster brings its own."""
    b = SparkSession.builder.master(master).appName(name)
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # a row of a plan is small, and work: bytes don't tell how many tasks it needs
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in settings.items()}
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder named in spark.checkpoint.dir.

    Only on one machine (a local master, as in tests) a folder of our own is made where that is unset, and removed when Python
    ends; executors elsewhere couldn't read it, so on a cluster the missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quillspark-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder, so that a lost executor costs no recomputation of what went before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Makes this package known to the executors' Python workers, wherever they run; once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_quillspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("quillspark", os.path.relpath(full, root)))
    sc.addPyFile(to)
    sc._quillspark_shipped = True
