"""Random draws as functions of a key and a tag: the same row draws the same values on any partitioning, retry or chunk."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_52 = float(1 << 52)


def tagged(tag: str | Column, suffix: str) -> str | Column:
    return tag + suffix if isinstance(tag, str) else F.concat(tag, F.lit(suffix))


def uniform(key: Column, tag: str | Column) -> Column:
    """A double strictly between 0 and 1."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit("|"), F.lit(tag) if isinstance(tag, str) else tag)), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / TWO_52


def randint(key: Column, tag: str | Column, lo: Column | int, hi: Column | int) -> Column:
    """A whole number from lo to hi, both included."""
    lo, hi = (F.lit(x) if isinstance(x, int) else x for x in (lo, hi))
    return lo.cast("bigint") + F.floor(uniform(key, tag) * (hi - lo + 1).cast("double")).cast("bigint")


def pick(key: Column, tag: str | Column, values: Column) -> Column:
    """An element of an array; null for an empty one."""
    return F.get(values, F.floor(uniform(key, tag) * F.size(values).cast("double")).cast("int"))


def normal(key: Column, tag: str | Column) -> Column:
    """A standard normal variate from two uniform ones."""
    return F.sqrt(F.lit(-2.0) * F.ln(uniform(key, tagged(tag, "#1")))) * F.cos(F.lit(2 * math.pi) * uniform(key, tagged(tag, "#2")))


# The same draws as text for DuckDB, which checks the queries. A tag that begins with $ is an SQL expression.
def sql_tag(tag: str, suffix: str = "") -> str:
    return f"({tag[1:]} || '{suffix}')" if tag.startswith("$") else f"'{tag}{suffix}'"


def sql_uniform(key: str, tag: str, suffix: str = "") -> str:
    return f"((('0x' || substr(md5({key} || '|' || {sql_tag(tag, suffix)}), 1, 13))::BIGINT + 0.5) / {TWO_52!r}::DOUBLE)"


def sql_randint(key: str, tag: str, lo: str, hi: str) -> str:
    return f"({lo} + CAST(floor({sql_uniform(key, tag)} * (({hi}) - ({lo}) + 1)) AS BIGINT))"


def sql_normal(key: str, tag: str) -> str:
    return f"(sqrt(-2.0::DOUBLE * ln({sql_uniform(key, tag, '#1')})) * cos({2 * math.pi!r}::DOUBLE * {sql_uniform(key, tag, '#2')}))"
