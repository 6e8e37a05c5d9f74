"""Fonts and backgrounds: glob filters, health scores, weighted choice."""

from __future__ import annotations

from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.draws import uniform
from quillspark.session import cut_lineage

START, BEST, GAIN, LOSS, HEALTHY = 100, 100, 1, 10, 50
#: Filters without a plain part of three characters that each name gets at a time.
OPEN_FILTERS = 1000
#: Blocks in which cumulative weights are summed.
WEIGHT_BLOCKS = 256


def glob_regex(glob: str) -> str:
    """A glob (with * ? and character sets, as a shell has them) as a whole regular expression; * crosses slashes.

    A [ without its ] is a plain character; ] is one as the first of its set; a set that can't fit (z-a) fits nothing.
    """
    out, at = [], 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and (end := _set_end(glob, at)) > 0:
            out.append(_set_regex(glob[at:end]))
            at = end + 1
        else:
            out.append(_quoted(c))
    return r"(?s)\A" + "".join(out) + r"\z"


def _quoted(c: str) -> str:
    return c if c.isalnum() or c in "_/ " or c > "\x7f" else "\\" + c


def _set_end(glob: str, at: int) -> int:
    """Where the set that begins at ``at`` is closed, or -1."""
    first = at + (glob[at : at + 1] == "!")
    return glob.find("]", first + (glob[first : first + 1] == "]"))


def _set_regex(body: str) -> str:
    no = body.startswith("!")
    body = body[no:]
    parts, k = [], 0
    while k < len(body):
        if k + 2 < len(body) and body[k + 1] == "-":
            if body[k] <= body[k + 2]:
                parts.append(f"{_quoted(body[k])}-{_quoted(body[k + 2])}")
            k += 3
        else:
            parts.append(_quoted(body[k]))
            k += 1
    if not parts:
        return "." if no else "(?!)"
    return f"[{'^' * no}{''.join(parts)}]"


@F.pandas_udf(T.StringType())
def glob_pattern(globs: pd.Series) -> pd.Series:
    return globs.map(glob_regex, na_action="ignore")


def _grams(text: Column) -> Column:
    """Distinct runs of three characters; none for shorter text."""
    return F.when(F.length(text) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3))))).otherwise(F.array().cast("array<string>"))


def glob_matches(filters: DataFrame, names: DataFrame, filter_col: str, name_col: str) -> DataFrame:
    """``filter, name`` for distinct filters and names that match.

    A name that matches holds every run of three characters of the filter's longest plain part. Each filter is joined on its
    rarest run and the candidates are checked by the full pattern.
    """
    globs = cut_lineage(filters.select(F.col(filter_col).alias("filter")).where("filter IS NOT NULL").distinct().withColumn("pattern", glob_pattern("filter")))
    plain = F.sort_array(F.transform(F.split(F.regexp_replace("filter", r"\[!?\]?[^\]]*\]", "*"), r"[*?]"), lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))), asc=False)[0]["p"]
    known = names.select(F.col(name_col).alias("name")).where("name IS NOT NULL").distinct()
    of_name = known.select("name", F.explode(_grams(F.col("name"))).alias("gram"))
    often = of_name.groupBy("gram").agg(F.count("*").alias("n"))
    of_filter = globs.select("filter", "pattern", F.explode(_grams(plain)).alias("gram")).join(often, "gram", "left").groupBy("filter", "pattern").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), F.col("gram"))).alias("gram"))
    out = of_filter.join(of_name, "gram").select("filter", "pattern", "name")
    # Filters without such a part are mostly few different ones (*, *.x), and fit most names: each name gets them as an array,
    # so many at a time that the array stays small.
    short = globs.where(F.length(plain) < 3).select("filter", "pattern").orderBy("filter").toLocalIterator()
    while some := list(islice(short, OPEN_FILTERS)):
        each = F.explode(F.array(*(F.struct(F.lit(r["filter"]).alias("filter"), F.lit(r["pattern"]).alias("pattern")) for r in some))).alias("f")
        out = out.unionByName(known.select(each, "name").select("f.filter", "f.pattern", "name"))
    return out.where(F.regexp_like(F.col("name"), F.col("pattern"))).select("filter", "name")


def candidates(specs: DataFrame, fonts: DataFrame) -> DataFrame:
    """``spec_name, n_fonts, first_font, last_font``; no filter means all fonts; specifications without a match are left out."""
    per = glob_matches(specs, fonts, "font_filter", "font_path").groupBy("filter").agg(F.count("*").alias("n_fonts"), F.min("name").alias("first_font"), F.max("name").alias("last_font"))
    every = fonts.agg(F.count_distinct("font_path").alias("n_fonts"), F.min("font_path").alias("first_font"), F.max("font_path").alias("last_font")).where("n_fonts > 0")
    with_filter = specs.where("font_filter IS NOT NULL").join(per, F.col("font_filter") == F.col("filter")).select("spec_name", "n_fonts", "first_font", "last_font")
    return with_filter.unionByName(specs.where("font_filter IS NULL").select("spec_name").join(F.broadcast(every)))


def is_image(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin("png", "jpg", "jpeg")


def _steps(outcomes: DataFrame, block: int) -> DataFrame:
    """Distinct outcomes with their step and block, partitioned by resource and block, so that all that follows needs no other shuffle."""
    known = outcomes.where("resource_id IS NOT NULL AND seq IS NOT NULL AND ok IS NOT NULL").select("resource_id", F.floor(F.col("seq") / block).alias("block"), "seq", "ok", "recorded_at")
    return known.repartition("resource_id", "block").distinct().withColumn("step", F.when(F.col("ok"), GAIN).otherwise(-LOSS))


def health_scores(outcomes: DataFrame, block: int = 4096) -> DataFrame:
    """``resource_id, seq, score``: the score after each outcome, in the order of seq; it starts at 100 and never exceeds it.

    With S the sum of steps so far and M the largest of 0 and all S so far, the score is 100 + S - M. Sum and maximum are
    formed in blocks of seq and carried over from block to block, so a resource with a third of all rows is spread.
    """
    rows = _steps(outcomes, block)
    within = Window.partitionBy("resource_id", "block").orderBy("seq", "recorded_at", "ok")
    rows = rows.withColumn("s", F.sum("step").over(within)).withColumn("m", F.max("s").over(within))
    before = _carried(rows.groupBy("resource_id", "block").agg(F.sum("step").alias("sum"), F.max("s").alias("top")))
    return rows.join(before, ["resource_id", "block"]).select("resource_id", "seq", (BEST + F.col("s") + F.col("s0") - F.greatest(F.col("m0"), F.col("s0") + F.col("m"))).cast("bigint").alias("score"))


def _carried(blocks: DataFrame) -> DataFrame:
    """Sum and maximum before each block."""
    w = Window.partitionBy("resource_id").orderBy("block")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    b = blocks.withColumn("s0", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
    return b.withColumn("m0", F.greatest(F.lit(0), F.coalesce(F.max(F.col("s0") + F.col("top")).over(earlier), F.lit(0)))).select("resource_id", "block", "s0", "m0")


def final_scores(outcomes: DataFrame, block: int = 4096) -> DataFrame:
    """``resource_id, score, n_outcomes`` after all outcomes."""
    rows = _steps(outcomes, block)
    within = Window.partitionBy("resource_id", "block").orderBy("seq", "recorded_at", "ok")
    per = rows.withColumn("s", F.sum("step").over(within)).groupBy("resource_id", "block").agg(F.sum("step").alias("sum"), F.max("s").alias("top"), F.count("*").alias("n"))
    return scores_of_blocks(per)


def scores_of_blocks(blocks: DataFrame) -> DataFrame:
    """``resource_id, score, n_outcomes`` from ``resource_id, block, sum, top, n`` of all blocks."""
    done = blocks.join(_carried(blocks), ["resource_id", "block"])
    return done.groupBy("resource_id").agg((BEST + F.sum("sum") - F.greatest(F.lit(0), F.max(F.col("s0") + F.col("top")))).cast("bigint").alias("score"), F.sum("n").alias("n_outcomes"))


def healthy(resources: DataFrame, col: str, scores: DataFrame) -> DataFrame:
    """``resource_id, score`` of the resources that may be used; one without outcomes has the starting score."""
    r = resources.select(F.col(col).alias("resource_id")).distinct().join(scores.select("resource_id", "score"), "resource_id", "left")
    return r.select("resource_id", F.coalesce("score", F.lit(START)).cast("bigint").alias("score")).where(F.col("score") >= HEALTHY)


def weighted_spans(resources: DataFrame, group: str) -> DataFrame:
    """``group, resource_id, lo, hi, total, n, bucket``: each resource's part of the cumulative weights of its group.

    resources: ``group, resource_id, score`` (a resource may be in many groups). Negative scores weigh nothing; if all do, all
    weigh alike. Weights are summed in blocks of a hash, so no group is ordered in one task. The weights of a group of n are cut
    into n even buckets, and a resource has a row for each bucket that it reaches into: two for each resource on the average.
    """
    block = F.floor(uniform(F.col("resource_id"), "weight_block") * float(WEIGHT_BLOCKS)).cast("int")
    rows = resources.select(group, "resource_id", F.greatest("score", F.lit(0)).cast("bigint").alias("w"), block.alias("block"))
    sums = rows.groupBy(group, "block").agg(F.sum("w").alias("w"), F.count("*").alias("k"))  # at most WEIGHT_BLOCKS rows a group
    whole, before = Window.partitionBy(group), Window.partitionBy(group).orderBy("block")
    sums = sums.select(group, "block", (F.sum("w").over(before) - F.col("w")).alias("w0"), (F.sum("k").over(before) - F.col("k")).alias("k0"), F.sum("w").over(whole).alias("all_w"), F.sum("k").over(whole).alias("n"))
    within = Window.partitionBy(group, "block").orderBy("resource_id")
    j = rows.join(sums, [group, "block"])
    hi = F.when(F.col("all_w") > 0, F.col("w0") + F.sum("w").over(within)).otherwise(F.col("k0") + F.row_number().over(within)).cast("bigint")
    j = j.select(group, "resource_id", "n", F.when(F.col("all_w") > 0, F.col("w")).otherwise(1).alias("w"), hi.alias("hi"), F.when(F.col("all_w") > 0, F.col("all_w")).otherwise(F.col("n")).alias("total"))
    j = j.where("w > 0").select(group, "resource_id", (F.col("hi") - F.col("w")).alias("lo"), "hi", "total", "n")
    reached = F.sequence(F.floor(F.col("lo") * F.col("n") / F.col("total")), F.floor((F.col("hi") - 1) * F.col("n") / F.col("total")))
    return j.withColumn("bucket", F.explode(reached))


def pick_from_spans(rows: DataFrame, key: str, spans: DataFrame, group: str, tag: str, out: str) -> DataFrame:
    """rows with a resource each, chosen by weight from the spans of their group; none where the group has none.

    A draw falls into one bucket, whose few rows are joined; draws are spread over the buckets as the weights are.
    """
    groups = spans.groupBy(group).agg(F.first("total").alias("_total"), F.first("n").alias("_n"))
    drawn = rows.join(groups, group, "left").withColumn("_at", F.floor(uniform(F.col(key), tag) * F.col("_total").cast("double")).cast("bigint"))
    drawn = drawn.withColumn("_bucket", F.floor(F.col("_at") * F.col("_n") / F.col("_total")).cast("bigint"))
    of = spans.select(F.col(group).alias("_group"), F.col("bucket").alias("_b"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("resource_id").alias(out))
    fits = (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_b")) & (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi"))
    return drawn.join(of, fits, "left").drop("_total", "_n", "_at", "_bucket", "_group", "_b", "_lo", "_hi")


def weighted_pick(rows: DataFrame, key: str, resources: DataFrame, tag: str, out: str) -> DataFrame:
    """rows with a resource each, chosen in proportion to its score (all alike if every score is 0); none if there is no resource."""
    one = F.lit(0).alias("_all")
    return pick_from_spans(rows.withColumn("_all", F.lit(0)), key, cut_lineage(weighted_spans(resources.select(one, "resource_id", "score"), "_all")), "_all", tag, out).drop("_all")
