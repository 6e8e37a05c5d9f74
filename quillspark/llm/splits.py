"""Train, validation and test splits that keep related records together.

Records and the entities they share form a bipartite graph: a specification (the record, with all its tasks) is tied to its
corpus file and to every font file that its tasks use. Paths are compared in one spelling, and a damaged corpus name is restored
first. Components come from iterative minimum-label propagation: each record takes the smallest label among its entities, each
entity the smallest among its records; labels are followed to their own labels until they stand, then every entity is replaced
by its label, repeated ties count once, and records with one tie left are settled. So the graph shrinks in each round and long
chains need few rounds. Each round ends in the shared checkpoint folder.

Before anything is moved, tasks are reduced to the distinct pairs of specification and font in each partition. A hub font, the
label of a huge component or a specification with a third of all tasks is spread wherever rows are joined on it (see
``operators.skew``). The split is decided per component, handed to its specifications, and only then to tasks.

Assignment is one greedy rule for all components: those of about the same size and mix of labels are a class; classes are taken
from the largest components down, and one component after the other (in classes of many: so many at a time that a class takes
at most STEPS turns) goes to the split where the shares of the labels and of all records then deviate least from the targets.
Only classes go to the driver: their number is bounded by CLASSES, whatever the number of components. Within a class,
components are told apart by the order of a hash, whose ranks are counted in blocks.

Defined results: null fonts and null corpus names hold nothing together, but a specification without a corpus file still ties
its fonts; a task without a (known) specification is tied by its font alone; a task with neither is a component of its own;
repeated tasks count once, of different tasks with one idx the smallest counts; a share table without rows is an error; shares
count by their proportions; ties between splits go to the first by name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.encoding import Restorer, skeleton
from quillspark.operators.skew import HOT_ROWS, pick_one, salted_join
from quillspark.session import cut_lineage

#: Labels that are kept in balance; rarer ones count as one.
LABELS = 16
#: Classes of components that are told apart; components of rarer classes form one class for each size.
CLASSES = 5000
#: Turns that a class of many components takes at most.
STEPS = 64
#: Components of one block when ranks are counted.
RANK_BLOCK = 2000


def one_spelling(path: F.Column) -> F.Column:
    """A path without . and .. steps, doubled or backward slashes and letter case."""
    p = F.lower(F.regexp_replace(path, r"[\\/]+", "/"))
    p = F.regexp_replace(p, r"(^|/)(?:\./)+", "$1")
    for _ in range(3):
        p = F.regexp_replace(p, r"(^|/)(?!\.\./)[^/]+/\.\.(?:/|$)", "$1")
    return F.regexp_replace(p, r"^\./", "")


def right_names(names: DataFrame, col: str, known: DataFrame, known_col: str, by: Restorer | None = None) -> DataFrame:
    """``col, node``: each distinct value with its name as in known (or its one spelling, where known has none)."""
    values = names.select(col).where(F.col(col).isNotNull()).distinct()
    if by is not None:

        @F.pandas_udf("string")
        def mend(v):  # noqa: ANN001, ANN202
            return pd.Series([by.restore(t)[1] for t in v], dtype=object)

        values = values.withColumn("mended", F.when(F.col(col).rlike(r"[^\x00-\x7F]"), mend(F.col(col))).otherwise(F.col(col)))
    else:
        values = values.withColumn("mended", F.col(col))
    spelt = known.where(F.col(known_col).isNotNull()).groupBy(one_spelling(F.col(known_col)).alias("spelling")).agg(F.min(known_col).alias("name"))
    found = values.withColumn("spelling", one_spelling(F.col("mended"))).join(spelt, "spelling", "left")
    if by is None:
        return found.select(col, F.coalesce("name", "spelling").alias("node"))
    # What can't be restored, or not by what was learned, may still have one twin among the known names.
    twins = spelt.groupBy(skeleton(F.col("spelling")).alias("skeleton")).agg(F.min("name").alias("twin"), F.count("*").alias("n")).where("n = 1").drop("n")
    lost = F.when(F.col("name").isNull() & F.col("spelling").rlike(r"[^\x00-\x7F]"), skeleton(F.col("spelling")))
    return found.withColumn("skeleton", lost).join(twins, "skeleton", "left").select(col, F.coalesce("name", "twin", "spelling").alias("node"))


def propagate(ties: DataFrame) -> DataFrame:
    """``entity, label``: the smallest entity of the component of each entity that shares a record with another one.

    ties: ``record, entity``. Entities that are missing from the result are their own label.
    """
    several, known, n_known = ties.where("record IS NOT NULL AND entity IS NOT NULL").distinct(), None, 0

    def looked_up(big: DataFrame, n: int, small: DataFrame, key: str, by: str, how: str = "left") -> DataFrame:
        """A join whose big side has at most n rows: too few for a hot key, or salted."""
        return big.join(small, key, how) if n < HOT_ROWS else salted_join(big, small, key, [by], how)

    n = HOT_ROWS
    while True:
        # Records with one entity tie nothing.
        of_record = several.groupBy("record").agg(F.min("entity").alias("least"), F.max("entity").alias("most")).where("least <> most").select("record", "least")
        left = cut_lineage(looked_up(several, n, of_record, "record", "entity", "inner"))
        n = left.count()
        if known is not None and not n:
            return known
        # An entity takes the smallest label around it; it is a root if that is its own.
        taken = cut_lineage(left.groupBy("entity").agg(F.min("least").alias("label"), F.lit(True).alias("moved")))
        n_taken = taken.count()
        while taken.where("moved AND entity <> label").limit(1).count():
            further = taken.where("entity <> label").select(F.col("entity").alias("label"), F.col("label").alias("further"))
            followed = looked_up(taken.select("entity", "label"), n_taken, further, "label", "entity")
            taken = cut_lineage(followed.select("entity", F.coalesce("further", "label").alias("label"), F.col("further").isNotNull().alias("moved")))
        step = taken.where("entity <> label").select("entity", "label")
        several = looked_up(left.select("record", "entity"), n, step, "entity", "record").select("record", F.coalesce("label", "entity").alias("entity")).distinct()
        if known is None:
            known, n_known = step, n_taken
        else:
            moved = looked_up(known, n_known, step.select(F.col("entity").alias("label"), F.col("label").alias("further")), "label", "entity")
            known = cut_lineage(moved.select("entity", F.coalesce("further", "label").alias("label")).unionByName(step))  # what is replaced now was its own label so far


def record_ties(tasks: DataFrame, specs: DataFrame, corpus: DataFrame, fonts: DataFrame, by: Restorer) -> DataFrame:
    """``record, entity`` (distinct): specifications with their corpus file (``0`` and its name) and font files (``1`` and their name)."""
    named = right_names(specs, "corpus_file", corpus, "corpus_file", by)
    # Both sides grow with the data, and Spark takes their columns for smaller than they are: no broadcast here.
    given = specs.select("spec_name", "corpus_file").where("spec_name IS NOT NULL AND corpus_file IS NOT NULL").distinct()
    of_corpus = given.join(named.hint("merge"), "corpus_file").select(F.col("spec_name").alias("record"), F.concat(F.lit("0"), "node").alias("entity"))
    used = tasks.select("spec_name", "font_path").where("spec_name IS NOT NULL AND font_path IS NOT NULL").distinct()
    font = right_names(used, "font_path", fonts, "font_path")
    of_font = salted_join(used, font, "font_path", ["spec_name"]).select(F.col("spec_name").alias("record"), F.concat(F.lit("1"), "node").alias("entity"))
    return of_corpus.unionByName(of_font).distinct()


def corpus_groups(ties: DataFrame) -> DataFrame:
    """``corpus_node, label``: each corpus file that a specification names, with the first member of its group.

    Names of corpus files come before those of fonts, so the smallest label of a component with a corpus file is its first one.
    """
    alone = ties.where("entity LIKE '0%'").select("entity").distinct()
    with_label = alone.join(propagate(ties), "entity", "left")
    return with_label.select(F.substr("entity", F.lit(2)).alias("corpus_node"), F.substr(F.coalesce("label", "entity"), F.lit(2)).alias("label"))


def held_together(groups: DataFrame) -> DataFrame:
    """``corpus_file_a, corpus_file_b``: the first member of each group with each other one."""
    return groups.where("label <> corpus_node").select(F.col("label").alias("corpus_file_a"), F.col("corpus_node").alias("corpus_file_b"))


def record_components(placed: DataFrame, ties: DataFrame, specs: DataFrame) -> DataFrame:
    """``record, component, label, n``: each record of ``tasks_of_records`` with its component, its text direction (for even
    shares) and its number of tasks."""
    labels = propagate(ties)
    of_spec = salted_join(ties, labels, "entity", ["record"], "left").groupBy(F.concat(F.lit("s"), "record").alias("record")).agg(F.min(F.coalesce("label", "entity")).alias("component"))
    of_font = labels.where("entity LIKE '1%'").select(F.concat(F.lit("f"), F.substr("entity", F.lit(2))).alias("record"), F.col("label").alias("component"))
    direction = specs.where("spec_name IS NOT NULL").groupBy(F.concat(F.lit("s"), "spec_name").alias("record")).agg(F.min("text_direction").alias("label"))
    sizes = placed.groupBy("record").agg(F.count("*").alias("n"))
    joined = sizes.join(of_spec.unionByName(of_font), "record", "left").join(direction, "record", "left")
    own = F.when(F.col("record").startswith("f"), F.concat(F.lit("1"), F.substr("record", F.lit(2)))).otherwise(F.concat(F.lit("2"), "record"))
    return joined.select("record", F.coalesce("component", own).alias("component"), F.coalesce("label", F.lit("")).alias("label"), "n")


def tasks_of_records(tasks: DataFrame, fonts: DataFrame) -> DataFrame:
    """``idx, record``: each task with the record it belongs to: ``s`` and its specification, else ``f`` and its font, else ``t`` and its idx."""
    one = pick_one(tasks.where("idx IS NOT NULL").select("idx", "spec_name", "font_path"), "idx", "spec_name", "font_path")
    loose = one.where("spec_name IS NULL")
    spelt = loose.join(right_names(loose, "font_path", fonts, "font_path"), "font_path", "left")
    own = spelt.select("idx", F.coalesce(F.concat(F.lit("f"), "node"), F.concat(F.lit("t"), F.col("idx").cast("string"))).alias("record"))
    return one.where("spec_name IS NOT NULL").select("idx", F.concat(F.lit("s"), "spec_name").alias("record")).unionByName(own)


class _Shares:
    """What the splits hold so far, and which one a component should go to."""

    def __init__(self, shares: dict[str, float], per_label: np.ndarray) -> None:
        self.names = sorted(shares)
        part = np.array([shares[s] for s in self.names])
        self.want = np.outer(part / part.sum(), per_label)
        self.total = max(1.0, per_label.sum())
        self.got = np.zeros_like(self.want)

    def best(self, add: np.ndarray) -> int:
        """The split whose deviation (of each label, and twice that of all) grows least by add; the first of equal ones."""
        lack = self.want - self.got
        by_label = np.abs(lack - add).sum(1) - np.abs(lack).sum(1)
        in_all = np.abs(lack.sum(1) - add.sum()) - np.abs(lack.sum(1))
        return int(np.argmin(np.round((by_label + 2 * in_all) / self.total, 12)))

    def take(self, split: int, add: np.ndarray) -> None:
        self.got[split] += add


def plan_classes(classes: list[tuple[int, int, np.ndarray]], shares: dict[str, float], per_label: np.ndarray) -> list[tuple[int, int, int, str]]:
    """(class, first rank, rank after the last, split) for classes (id, components, records by label in all)."""
    state, out = _Shares(shares, per_label), []
    for c, k, total in sorted(classes, key=lambda x: (-x[2].sum() / x[1], x[0])):
        mean, taken, left = total / k, np.zeros(len(state.names), int), k
        while left:
            m = min(left, -(-k // STEPS))
            s = state.best(mean * m)
            state.take(s, mean * m)
            taken[s] += m
            left -= m
        at = 0
        for s, m in enumerate(taken.tolist()):
            if m:
                out.append((c, at, at + m, state.names[s]))
                at += m
    return out


def assign(records: DataFrame, targets: DataFrame) -> DataFrame:
    """``record, component, split_name``: whole components to splits, close to the shares in all and of each label.

    records: ``record, component, label, n``.
    """
    spark = records.sparkSession
    shares = {r["split_name"]: float(r["share"]) for r in targets.where("split_name IS NOT NULL AND share > 0").groupBy("split_name").agg(F.max("share").alias("share")).collect()}
    if not shares:
        raise ValueError("no split is given")
    often = records.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label").limit(LABELS - 1).collect()
    labels = [r["label"] for r in often]
    in_label = [F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)).alias(f"l{k}") for k, x in enumerate(labels)]
    vector = [f"l{k}" for k in range(len(labels))] + ["other"]
    wholes = records.groupBy("component").agg(F.sum("n").alias("size"), *in_label).withColumn("other", F.col("size") - sum((F.col(x) for x in vector[:-1]), F.lit(0)))
    # About the same size: to one part in eight; about the same mix: each label's share to the sixteenth.
    octave = F.floor(F.log2("size"))
    size_class = F.when(F.col("size") < 16, F.col("size")).otherwise(octave * 8 + F.floor(F.col("size") / F.pow(F.lit(2.0), octave - 3))).cast("bigint")
    mix = F.concat_ws(",", *(F.round(F.col(x) / F.col("size") * 16).cast("int").cast("string") for x in vector))
    wholes = cut_lineage(wholes.withColumn("size_class", size_class).withColumn("mix", mix).withColumn("turn", F.xxhash64("component")))
    of_class = wholes.groupBy("size_class", "mix").agg(F.count("*").alias("k"), *(F.sum(x).alias(x) for x in vector))
    told = of_class.orderBy(F.desc(F.col("size_class")), F.desc("k"), "mix").limit(CLASSES).select("size_class", "mix", F.col("mix").alias("told"))
    # The kinds of mixes are many only where labels are; beyond CLASSES a class is a size.
    named = of_class.join(F.broadcast(told), ["size_class", "mix"], "left").groupBy("size_class", F.coalesce("told", F.lit("")).alias("told")).agg(F.sum("k").alias("k"), *(F.sum(x).alias(x) for x in vector)).collect()
    number = {(r["size_class"], r["told"]): c for c, r in enumerate(sorted(named, key=lambda r: (r["size_class"], r["told"])))}
    classes = [(number[r["size_class"], r["told"]], r["k"], np.array([float(r[x]) for x in vector])) for r in named]
    spans = plan_classes(classes, shares, sum((v for _, _, v in classes), np.zeros(len(vector))))
    blocks = {c: -(-k // RANK_BLOCK) for c, k, _ in classes}
    numbers = spark.createDataFrame([(s, t, c, blocks[c]) for (s, t), c in number.items()], "size_class bigint, told string, class int, blocks bigint")
    classed = wholes.select("component", "size_class", "mix", "turn").join(F.broadcast(told), ["size_class", "mix"], "left").withColumn("told", F.coalesce("told", F.lit(""))).join(F.broadcast(numbers), ["size_class", "told"])
    classed = classed.select("component", "class", "turn", F.floor((F.col("turn") / F.pow(F.lit(2.0), F.lit(64.0)) + 0.5) * F.col("blocks")).alias("block"))
    before = classed.groupBy("class", "block").agg(F.count("*").alias("k")).select("class", "block", (F.sum("k").over(Window.partitionBy("class").orderBy("block")) - F.col("k")).alias("before"))
    ranked = classed.join(before, ["class", "block"]).select("component", "class", (F.col("before") + F.row_number().over(Window.partitionBy("class", "block").orderBy("turn", "component")) - 1).alias("rank"))
    cuts = F.broadcast(spark.createDataFrame(spans, "class int, lo bigint, hi bigint, split_name string"))
    chosen = ranked.join(cuts, "class").where("rank >= lo AND rank < hi").select("component", "split_name")
    return salted_join(records.select("record", "component"), chosen, "component", ["record"])


def task_splits(tasks: DataFrame, specs: DataFrame, corpus: DataFrame, fonts: DataFrame, by: Restorer, targets: DataFrame) -> DataFrame:
    """``idx, component, split_name`` of every task."""
    placed = cut_lineage(tasks_of_records(tasks, fonts))
    ties = cut_lineage(record_ties(tasks, specs, corpus, fonts, by))
    assigned = cut_lineage(assign(record_components(placed, ties, specs), targets))
    return salted_join(placed, assigned, "record", ["idx"]).select("idx", "component", "split_name")
