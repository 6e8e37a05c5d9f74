"""Running sums and dense numbering of whole tables without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut_lineage


def running_total(df: DataFrame, order: str, values: dict[str, Column], block: int = 4096, by: list[str] | None = None) -> DataFrame:
    """df with running sums (name: value) in the order of a unique whole-number column, by groups if asked.

    Rows are summed in blocks of the order column first; only block totals, one row per block, are ordered as a whole.
    """
    by = by or []
    df = df.withColumns({f"_{n}": v for n, v in values.items()}).withColumn("_block", F.floor(F.col(order) / block))
    totals = df.groupBy(*by, "_block").agg(*(F.sum(f"_{n}").alias(f"_{n}") for n in values))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_block", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in values))
    within = Window.partitionBy(*by, "_block").orderBy(order)
    out = df.join(offsets, [*by, "_block"]).withColumns({n: F.sum(f"_{n}").over(within) + F.col(f"_{n}_before") for n in values})
    return out.drop("_block", *(x for n in values for x in (f"_{n}", f"_{n}_before")))


def dense_index(df: DataFrame, order: str, name: str = "number") -> DataFrame:
    """df with 0, 1, 2... in the order of a unique column: numbered in ranges, shifted by the sizes of the ranges before."""
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_part").orderBy(order)
    return ranged.join(offsets, "_part").withColumn(name, F.row_number().over(w) - 1 + F.col("_before")).drop("_part", "_before")
