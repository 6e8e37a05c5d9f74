"""Exact quantiles of large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import cut_lineage

BINS = 4096


def exact_quantiles(df: DataFrame, group: str, value: str, points: dict[str, float], bins: int = BINS) -> DataFrame:
    """``group, <name>...``: linearly interpolated quantiles of each group; nulls and NaN don't count.

    Values are counted in bins between a group's least and greatest; only the bins that hold a wanted rank are ordered, so no
    task sees a whole group. Equal values are counted, not ordered.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    # Equal values are one row with a count from the start: a value that a third of all rows share is one row.
    rows = cut_lineage(rows.groupBy("g", "v").agg(F.count("*").alias("n")))  # read several times below
    ends = rows.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("all"))
    binned = rows.join(ends, "g").withColumn("bin", F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins))).otherwise(0).cast("int"))
    counts = binned.groupBy("g", "bin").agg(F.sum("n").alias("n"), F.first("all").alias("all"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("g").orderBy("bin")) - F.col("n"))  # at most BINS rows a group
    wanted = F.array(*(F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in points.items()))
    ranks = before.withColumn("q", F.explode(wanted)).select("g", "bin", "before", "n", F.col("q.name").alias("name"), ((F.col("all") - 1) * F.col("q.p")).alias("at"))
    ranks = ranks.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))).where("rank >= before AND rank < before + n").select("g", "bin", "before", "name", "at", "rank")
    near = binned.select("g", "bin", "v", "n").join(ranks.select("g", "bin", "before").distinct(), ["g", "bin"])
    near = near.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("g", "bin").orderBy("v")))
    hit = near.select("g", "bin", "v", (F.col("upto") - F.col("n")).alias("from"), "upto").join(ranks.select("g", "bin", "name", "at", "rank"), ["g", "bin"]).where("rank >= from AND rank < upto")
    x = hit.groupBy("g", "name").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.first("at").alias("at"))
    got = x.select("g", "name", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at"))).alias("value"))
    return got.groupBy(F.col("g").alias(group)).pivot("name", list(points)).agg(F.first("value"))
