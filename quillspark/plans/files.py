"""Queries on the file store, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.functions.draws import sql_uniform
from quillspark.operators import compaction
from quillspark.sources.tables import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.same_record_pairs(table(spark, d, "label_files"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return compaction.record_classes(table(spark, d, "label_files")).select("file_id", "first_file", "n_links")


def p5_manifest(spark: SparkSession, d: str) -> DataFrame:
    return compaction.manifest(table(spark, d, "label_files"))


def p5_containers(spark: SparkSession, d: str) -> DataFrame:
    return compaction.containers(table(spark, d, "label_files")).drop("data", "places")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p5_found, p5_classes, p5_manifest, p5_containers)}
RECORDS = """f AS (SELECT DISTINCT file_id, CAST(label_json AS JSON) AS j FROM label_files WHERE trim(label_json) <> ''),
        r AS (SELECT file_id, list_sort(list_transform(json_keys(j), lambda k: k || '=' || regexp_replace(CAST(j -> ('$."' || k || '"') AS VARCHAR), '\\s', '', 'g'))) AS rec FROM f),
        g AS (SELECT file_id, array_to_string(rec, ';') AS rec FROM r)"""
PLACED = f"""{RECORDS}, k AS (SELECT min(file_id) AS file_id FROM g GROUP BY rec),
        b AS (SELECT DISTINCT file_id, label_json, strlen(label_json) AS n_bytes, CASE WHEN suffix(label_json, chr(10)) THEN 0 ELSE 1 END AS added, CASE WHEN regexp_matches(label_json, '(?s)[\r\n].') THEN 'blocks' ELSE 'lines' END AS kind FROM label_files JOIN k USING (file_id)),
        t AS (SELECT kind, sum(n_bytes + added) AS total FROM b GROUP BY 1),
        p AS (SELECT b.*, CASE WHEN n_bytes > {compaction.TARGET_BYTES} THEN kind || '-large-' || file_id ELSE kind || '-' || lpad(CAST(CAST(floor({sql_uniform("file_id", "container")} * greatest(1, ceil(total / {compaction.TARGET_BYTES}))) AS BIGINT) AS VARCHAR), 7, '0') END AS container FROM b JOIN t USING (kind))"""
SQL: dict[str, str] = {
    "p5_found": f"WITH {RECORDS} SELECT a.file_id AS file_id_a, b.file_id AS file_id_b FROM g a JOIN g b ON a.rec = b.rec AND a.file_id < b.file_id",
    "p5_classes": f"WITH {RECORDS} SELECT file_id, min(file_id) OVER (PARTITION BY rec) AS first_file, count(*) OVER (PARTITION BY rec) - 1 AS n_links FROM g QUALIFY n_links > 0",
    "p5_manifest": f"""WITH {PLACED} SELECT container, file_id, row_number() OVER w - 1 AS position, CAST(sum(n_bytes + added) OVER w - n_bytes - added AS BIGINT) AS byte_offset, 0::BIGINT AS n_head, n_bytes, md5(label_json) AS checksum FROM p
        WINDOW w AS (PARTITION BY container ORDER BY file_id ROWS UNBOUNDED PRECEDING)""",
    "p5_containers": f"WITH {PLACED} SELECT container, count(*) AS n_records, CAST(sum(n_bytes + added) AS BIGINT) AS n_bytes, md5(string_agg(label_json || repeat(chr(10), added), '' ORDER BY file_id)) AS checksum, true AS valid FROM p GROUP BY 1",
}
