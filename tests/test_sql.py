"""Every query with SQL against DuckDB over whole tables, and results that don't depend on partitioning."""

import glob
import math
import os

import duckdb
import pytest

from quillspark.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(rows, columns):
    return sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, db, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = db.execute(catalogue.SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    want = [dict(zip(names, r, strict=True)) for r in got.fetchall()]
    columns = sorted(names)
    assert rows_of(df.collect(), columns) == rows_of(want, columns)


@pytest.mark.parametrize("name", ["plan_params", "health_score", "task_list", "chunk_accounting", "corpus_round_robin"])
def test_partitioning_doesnt_matter(spark, name):
    seen = []
    for n in ("1", "13"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = catalogue.QUERIES[name](spark, DATA)
        seen.append(rows_of(df.collect(), sorted(df.columns)))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_scores_dont_depend_on_steps(spark, tmp_path):
    from pyspark.sql import functions as F

    from quillspark.operators import resources
    from quillspark.streaming import jobs

    o = spark.createDataFrame([(f"r{k % 3 if k % 4 else 0}", 10 * ((k * 37) % 400), k % 5 != 0, None) for k in range(400)] + [("r0", 7, None, None), (None, 1, True, None)], "resource_id string, seq bigint, ok boolean, recorded_at timestamp")
    o = o.unionAll(o.where("seq % 7 = 0"))  # repeats, in other steps
    o.withColumn("recorded_at", F.timestamp_seconds(F.col("seq"))).repartition(9).write.parquet(str(tmp_path / "o"))
    want = {tuple(r) for r in resources.final_scores(spark.read.parquet(str(tmp_path / "o")), 512).collect()}
    for files in (1, 4, 100):
        assert {tuple(r) for r in jobs.streamed_scores(spark, str(tmp_path / "o"), files).collect()} == want
