"""From shares to a list of tasks: allocation, interleaving, resuming, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.prefix import running_total


def distinct_specs(specs: DataFrame) -> DataFrame:
    """Repeated specifications count once."""
    return specs.dropDuplicates(["spec_name"])


def allocation(specs: DataFrame, images: int) -> DataFrame:
    """``batch_id, spec_name, n_alloc``: how many of a batch's images each specification gets.

    Shares are cut to whole images; what is left is handed out evenly, the rest one each in the order of names. Shares that add
    up to more than one hand nothing out.
    """
    w = Window.partitionBy("batch_id")
    base = distinct_specs(specs).select("batch_id", "spec_name", F.floor(F.col("proportion") * F.lit(float(images))).cast("bigint").alias("base"))
    left = F.greatest(F.lit(images) - F.sum("base").over(w), F.lit(0))
    ranked = base.select("batch_id", "spec_name", "base", left.alias("left"), F.count("*").over(w).alias("k"), F.row_number().over(w.orderBy("spec_name")).alias("rank"))
    return ranked.select("batch_id", "spec_name", (F.col("base") + F.floor(F.col("left") / F.col("k")) + (F.col("rank") <= F.col("left") % F.col("k")).cast("int")).cast("bigint").alias("n_alloc"))


def task_list(allocated: DataFrame, images: int) -> DataFrame:
    """``batch_id, idx, spec_name``: in each round one task of every specification that has some left, in the order of names.

    Between two numbers of tasks that specifications have, all rounds are alike. So the tasks before such a run of rounds, and
    places in its rounds, are found once for each run, and tasks are written out from them last, where they lie: nothing that has
    a row for each task is sorted, joined or sent to the driver. A batch has no more rows than specifications and images before
    that, and they are spread by runs.
    """
    some = allocated.where("n_alloc > 0")
    batch = Window.partitionBy("batch_id")
    up = batch.orderBy("upto")
    counts = some.groupBy("batch_id", F.col("n_alloc").alias("upto")).agg(F.count("*").alias("n"))
    runs = counts.select("batch_id", "upto", F.lag("upto", 1, 0).over(up).alias("done"), (F.sum("n").over(batch) - F.sum("n").over(up) + F.col("n")).alias("k"))
    earlier = F.sum((F.col("upto") - F.col("done")) * F.col("k")).over(up.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col("batch_id").alias("_batch"), "upto", "done", "k", F.coalesce(earlier, F.lit(0)).alias("before")).where(F.col("before") < images)
    of_spec = some.join(runs.hint("merge"), F.col("batch_id").eqNullSafe(F.col("_batch")) & (F.col("n_alloc") >= F.col("upto")))
    # A run is a small row, and its tasks are many: bytes don't tell how many partitions they need.
    spark = allocated.sparkSession
    spread = of_spec.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "batch_id", "upto")
    place = F.row_number().over(Window.partitionBy("batch_id", "upto").orderBy("spec_name")) - 1
    first = spread.select("batch_id", "spec_name", (F.col("upto") - F.col("done")).alias("rounds"), "k", (F.col("before") + place).alias("first")).where(F.col("first") < images)
    fit = F.least(F.col("rounds") - 1, F.floor((F.lit(images - 1) - F.col("first")) / F.col("k")).cast("bigint"))
    each = first.select("batch_id", "spec_name", "first", "k", F.explode(F.sequence(F.lit(0).cast("bigint"), fit)).alias("round"))
    return each.select("batch_id", (F.col("first") + F.col("round") * F.col("k")).cast("bigint").alias("idx"), "spec_name")


def resume_from(tasks: DataFrame, start: int) -> DataFrame:
    return tasks.where(F.col("idx") >= start)


def not_done(tasks: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks whose index isn't among the finished ones."""
    return tasks.join(done.select("idx"), "idx", "left_anti")


def index_in_name(name: Column) -> Column:
    """The index in image_<index>..., null where there is none."""
    return F.regexp_extract(name, r"^image_([^_.]*)", 1).try_cast("bigint")


def unique_name(run: Column, idx: Column) -> Column:
    """A name for each image of a run in the form of a UUID; the same for every retry, and apart from that of any other run."""
    h = F.md5(F.concat(run, F.lit("|"), idx.cast("string")))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def chunk_of(idx: Column, size: int) -> Column:
    return F.floor(idx / size).cast("bigint")


def chunk_accounting(results: DataFrame, size: int) -> DataFrame:
    """``chunk_id, saved, failed, saved_so_far`` of results ``seq, ok``; results without an outcome count as neither."""
    chunks = results.groupBy(chunk_of(F.col("seq"), size).alias("chunk_id")).agg(F.count_if(F.col("ok")).alias("saved"), F.count_if(~F.col("ok")).alias("failed"))
    return running_total(chunks, "chunk_id", {"saved_so_far": F.col("saved")})


def io_batches(tasks: DataFrame, chunk: int, batch: int) -> DataFrame:
    """``chunk_id, batch_no, n, first_idx``: tasks of a chunk in write batches, the last one partial."""
    w = Window.partitionBy("chunk_id").orderBy("idx")
    numbered = tasks.select("idx", chunk_of(F.col("idx"), chunk).alias("chunk_id")).withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / batch).cast("bigint"))
    return numbered.groupBy("chunk_id", "batch_no").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))


def retry_schedule(attempts: int, first: float = 0.1) -> list[tuple[int, float]]:
    """(attempt, seconds to wait after it), doubling."""
    return [(k, first * 2**k) for k in range(attempts)]
