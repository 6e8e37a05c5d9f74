"""Joins and pairs whose keys may be hot: one key may hold a third of all rows.

The hot keys of a table are its most frequent ones, at most HOT_KEYS of them; every other key holds less than 1/HOT_KEYS of
all rows. They are found from counts that are combined before they are moved, and only their list goes to the driver, so its
size is bounded by HOT_KEYS whatever the data. Rows of a hot key are spread over SALTS parts of it, and the rows that they meet
are repeated once for each part. No row is dropped, and the result doesn't depend on which keys are hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000
#: Below so many rows a key is no burden for one task.
HOT_ROWS = 20_000
SALTS = 64
#: Identifiers of one block when all pairs of a group are asked for.
BLOCK = 1000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> list:
    """The most frequent values of a column, at most HOT_KEYS, each with at least so many rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col(key).isNotNull() & (F.col("_n") >= rows))
    return [r[key] for r in counts.orderBy(F.desc("_n"), key).limit(HOT_KEYS).collect()]


def salted_join(big: DataFrame, small: DataFrame, key: str, by: list[str], how: str = "inner", rows: int = HOT_ROWS) -> DataFrame:
    """big.join(small, key, how) (inner, left, left_semi or left_anti), where rows of big with a hot key are spread by a hash of ``by``."""
    hot = hot_keys(big, key, rows)
    if not hot:
        return big.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int")).otherwise(0))
    right = small.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def id_blocks(rows: DataFrame, key: str, id_col: str, size: int | None = None) -> DataFrame:
    """``key, block, ids``: the ids of each key in arrays of about ``size`` (BLOCK), however many a key has. rows: distinct (key, id)."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    counted = salted_join(rows, counts, key, [id_col])
    block = F.pmod(F.xxhash64(id_col), F.ceil(F.col("_n") / (size or BLOCK))).alias("block")
    return counted.select(key, id_col, block).groupBy(key, "block").agg(F.collect_list(id_col).alias("ids"))


def _spread(pairs: DataFrame, *by: str) -> DataFrame:
    """Pairs of blocks evenly over the tasks that write their ids out."""
    return pairs.repartition(F.xxhash64(*by))


def pairs_within(rows: DataFrame, key: str, id_col: str, a: str, b: str) -> DataFrame:
    """``a, b`` (a < b): all pairs of the ids of each key, formed from pairs of blocks. rows: distinct (key, id)."""
    blocks = id_blocks(rows, key, id_col)
    left = blocks.select(key, F.col("block").alias("_p"), F.col("ids").alias("_a"))
    right = blocks.select(key, F.col("block").alias("_q"), F.col("ids").alias("_b"))
    met = _spread(left.join(right, key).where("_p <= _q"), key, "_p", "_q")
    each = met.select("_p", "_q", F.explode("_a").alias("x"), "_b").select("_p", "_q", "x", F.explode("_b").alias("y"))
    return each.where("x < y OR (_p < _q AND x > y)").select(F.least("x", "y").alias(a), F.greatest("x", "y").alias(b))


def pairs_between(linked: DataFrame, of_a: str, of_b: str, rows: DataFrame, key: str, id_col: str, a: str, b: str) -> DataFrame:
    """``a, b`` (a < b): the ids of each pair of linked keys (once in either order), written out from blocks."""
    blocks = id_blocks(rows, key, id_col)
    left = blocks.select(F.col(key).alias(of_a), F.col("block").alias("_p"), F.col("ids").alias("_a"))
    right = blocks.select(F.col(key).alias(of_b), F.col("block").alias("_q"), F.col("ids").alias("_b"))
    met = _spread(linked.join(left, of_a).join(right, of_b), of_a, of_b, "_p", "_q")
    each = met.select(F.explode("_a").alias("x"), "_b").select("x", F.explode("_b").alias("y"))
    return each.where("x <> y").select(F.least("x", "y").alias(a), F.greatest("x", "y").alias(b))


def pick_one(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row for each key: of rows that differ, the smallest in the order of the columns, nulls last."""
    ordered: list[Column] = [x for c in columns for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    return rows.groupBy(key).agg(F.min(F.struct(*ordered)).alias("_r")).select(key, *(F.col(f"_r.{c}").alias(c) for c in columns))
