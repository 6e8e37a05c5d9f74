"""Planning and health scores as streams: bounded steps, each committed before the next, restartable from its checkpoint.

A draw depends on the row's index only, and scores are merged from blocks of outcomes, so a stream gives what a batch gives, in
whatever steps the rows arrive.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.operators.resources import GAIN, LOSS, scores_of_blocks
from quillspark.plans import plan
from quillspark.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _source(spark: SparkSession, path: str, files_per_step: int) -> DataFrame:
    """A stream of the parquet files of a folder, or of one file: a pattern that fits only the path itself allows both."""
    path = path.rstrip("/")
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_step).parquet(f"{path[:-1]}[{path[-1]}]")


def streamed_tasks(spark: SparkSession, path: str, specs: DataFrame, params: DataFrame, files_per_step: int = 4) -> DataFrame:
    """The plans of all tasks of a folder, made step by step; the plans of a batch, whatever the steps.

    Each step is written under its number, so one that is repeated after a failure replaces itself. Repeated tasks, which may
    come in different steps, count once.
    """
    source = _source(spark, path, files_per_step)
    to = shared_folder(spark, "stream-tasks")

    def step(rows: DataFrame, number: int) -> None:
        plan.plans(plan.styled(rows, specs, params)).write.mode("overwrite").parquet(f"{to}/out/step={number}")

    source.writeStream.foreachBatch(step).option("checkpointLocation", f"{to}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", f"{to}/out").parquet(f"{to}/out/step=*").drop("step").distinct()


def _block_sums(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Sum and highest running sum of a block's outcomes so far; the state holds them, at most as many as a block has."""
    kept = set(zip(*state.get, strict=True)) if state.exists else set()
    for rows in parts:
        kept.update(zip(rows["seq"].tolist(), rows["at"].tolist(), rows["ok"].tolist(), strict=True))
    ordered = sorted(kept)
    state.update(tuple(map(list, zip(*ordered, strict=True))))
    total = top = 0
    for k, (_, _, ok) in enumerate(ordered):
        total += GAIN if ok else -LOSS
        top = max(top, total) if k else total
    yield pd.DataFrame({"resource_id": [key[0]], "block": [key[1]], "sum": [total], "top": [top], "n": [len(ordered)]})


def block_stream(outcomes: DataFrame, block: int = 4096) -> DataFrame:
    """``resource_id, block, sum, top, n`` after each step of a stream of outcomes, for each block of seq that the step touched.

    Repeated outcomes count once, and late ones where their seq puts them, so the last sums don't depend on the steps. A hot
    resource is as many keys as it has blocks, and a state is no larger than a block.
    """
    known = outcomes.where("resource_id IS NOT NULL AND seq IS NOT NULL AND ok IS NOT NULL").select("resource_id", F.floor(F.col("seq") / block).cast("long").alias("block"), "seq", F.unix_micros(F.coalesce(F.col("recorded_at").cast("timestamp"), F.timestamp_micros(F.lit(0)))).alias("at"), "ok")
    return known.groupBy("resource_id", "block").applyInPandasWithState(_block_sums, "resource_id string, block long, sum long, top long, n long", "seq array<long>, at array<long>, ok array<boolean>", "update", GroupStateTimeout.NoTimeout)


def streamed_scores(spark: SparkSession, path: str, files_per_step: int = 4) -> DataFrame:
    """``resource_id, score, n_outcomes`` after all outcomes of a folder, made as a stream."""
    source = _source(spark, path, files_per_step)
    to = shared_folder(spark, "stream-health")

    def keep(step: DataFrame, number: int) -> None:
        step.write.mode("overwrite").parquet(f"{to}/out/step={number}")

    block_stream(source).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{to}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    steps = spark.read.schema("resource_id string, block long, sum long, top long, n long, step long").parquet(f"{to}/out")
    last = steps.groupBy("resource_id", "block").agg(F.max_by(F.struct("sum", "top", "n"), "step").alias("s")).select("resource_id", "block", "s.*")
    return scores_of_blocks(last)
