"""The pN_ queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import encoding, leakage, lookalike, packing, quality, splits, terms
from quillspark.operators.skew import pick_one, salted_join
from quillspark.session import cut_lineage
from quillspark.sources.tables import table


def restorer(spark: SparkSession, d: str) -> encoding.Restorer:
    tasks, specs, corpus = (table(spark, d, t) for t in ("tasks", "specs", "corpus"))
    return encoding.learn([(tasks, "text"), (specs, "corpus_file")], [(corpus, "text"), (corpus, "corpus_file")], (corpus, "text"))


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    by = restorer(spark, d)
    a = encoding.restored(table(spark, d, "tasks"), "idx", "text", by).select(F.lit("tasks").alias("table_name"), "*")
    return a.unionByName(encoding.restored(table(spark, d, "specs"), "spec_name", "corpus_file", by).select(F.lit("specs").alias("table_name"), "*"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_restored(spark, d).select("table_name", "record_key").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    marked = terms.marked_terms(table(spark, d, "tasks"))
    return marked.where("mark <> 'useful'").select("field_name", "term")


def p2_terms(spark: SparkSession, d: str) -> DataFrame:
    return terms.marked_terms(table(spark, d, "tasks"))


def _groups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, encoding.Restorer]:
    return table(spark, d, "tasks"), table(spark, d, "specs"), table(spark, d, "corpus"), table(spark, d, "fonts"), restorer(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.held_together(splits.corpus_groups(cut_lineage(splits.record_ties(*_groups(spark, d)))))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.task_splits(*_groups(spark, d), table(spark, d, "split_targets"))


def _lookalikes(spark: SparkSession, d: str) -> DataFrame:
    """Rows of look-alike texts that aren't damaged; damage is judged once for each different text."""
    tasks = table(spark, d, "tasks").select("idx", "text")
    rows = cut_lineage(lookalike.lookalike_rows(tasks, cut_lineage(lookalike.lookalike_texts(tasks))))
    texts = rows.groupBy("text_key").agg(F.min("text").alias("text"))
    sound = texts.where(~encoding.is_damaged(F.col("text"), restorer(spark, d))).select("text_key")
    return cut_lineage(salted_join(rows.select("id", "text_key", "form"), cut_lineage(sound), "text_key", ["id"], "left_semi"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_pairs(_lookalikes(spark, d))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_classes(_lookalikes(spark, d)).select(F.col("id").alias("idx"), F.hex("form").alias("class"), "n_links")


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.normalised(pick_one(table(spark, d, "tasks").select("idx", "text").where("idx IS NOT NULL AND text IS NOT NULL"), "idx", "text"))


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.documents_packed(table(spark, d, "documents"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.container_fill(p6_packed(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(table(spark, d, "documents"), table(spark, d, "common_words"))


def p8_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_terms, p3_found, p3_splits, p4_found, p4_classes, p4_forms, p6_packed, p6_fill, p7_found, p8_found, p8_statistics)}
SQL: dict[str, str] = {
    "p2_found": """
        WITH t AS (SELECT DISTINCT idx, text, font_path FROM tasks), n AS (SELECT count(DISTINCT idx) AS n FROM tasks),
        v AS (SELECT 'text' AS field_name, idx, unnest(string_split(text, ' ')) AS term FROM t UNION ALL SELECT 'font_path', idx, font_path FROM t WHERE font_path IS NOT NULL),
        c AS (SELECT field_name, term, count(DISTINCT idx) AS n_docs FROM v WHERE field_name = 'font_path' OR term <> '' GROUP BY ALL)
        SELECT field_name, term FROM c, n WHERE n_docs = 1 OR n_docs > 0.02 * n""",
    "p2_terms": """
        WITH t AS (SELECT DISTINCT idx, text, font_path FROM tasks), n AS (SELECT count(DISTINCT idx) AS n FROM tasks),
        v AS (SELECT 'text' AS field_name, idx, unnest(string_split(text, ' ')) AS term FROM t UNION ALL SELECT 'font_path', idx, font_path FROM t WHERE font_path IS NOT NULL),
        c AS (SELECT field_name, term, count(DISTINCT idx) AS n_docs, count(*) AS n_occurrences FROM v WHERE field_name = 'font_path' OR term <> '' GROUP BY ALL)
        SELECT field_name, term, n_docs, n_occurrences, CASE WHEN n_docs <= 1 THEN 'rare' WHEN n_docs > 0.02 * n THEN 'common' ELSE 'useful' END AS mark FROM c, n""",
}
