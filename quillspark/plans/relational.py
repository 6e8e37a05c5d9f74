"""Queries on schedules, draws, resources and validation, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.functions.distributions import NAMES, sample, sql_sample
from quillspark.functions.draws import randint, sql_randint, sql_uniform, uniform
from quillspark.operators import checks, resources, schedule
from quillspark.operators.prefix import dense_index
from quillspark.operators.quantiles import exact_quantiles
from quillspark.plans import plan
from quillspark.sources.tables import table

IMAGES, START, CHUNK, IO_BATCH = 1003, 100, 100, 10
S, P, TK, O = (f"(SELECT DISTINCT * FROM {t})" for t in ("specs", "spec_params", "tasks", "outcomes"))
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def specs_(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "specs").dropDuplicates(["spec_name"])


def params_(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "spec_params").distinct()


def tasks_(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return plan.distinct_tasks(table(spark, d, "tasks"), *columns)


def outcomes_(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "outcomes").select("resource_id", "seq", "ok", "recorded_at").distinct()


# Schedule ------------------------------------------------------------------------------------------------------------

ALLOC = f"""b AS (SELECT batch_id, spec_name, CAST(floor(proportion * {IMAGES}::DOUBLE) AS BIGINT) AS base FROM {S}),
    r AS (SELECT *, greatest({IMAGES} - sum(base) OVER (PARTITION BY batch_id), 0) AS rest, count(*) OVER (PARTITION BY batch_id) AS k, row_number() OVER (PARTITION BY batch_id ORDER BY spec_name) AS n FROM b),
    a AS (SELECT batch_id, spec_name, CAST(base + floor(rest / k) + CASE WHEN n <= rest % k THEN 1 ELSE 0 END AS BIGINT) AS n_alloc FROM r)"""


@query(f"WITH {ALLOC} SELECT * FROM a")
def allocation(spark: SparkSession, d: str) -> DataFrame:
    return schedule.allocation(table(spark, d, "specs"), IMAGES)


@query(f"""WITH {ALLOC}, e AS (SELECT batch_id, spec_name, unnest(range(1, n_alloc + 1)) AS k FROM a WHERE n_alloc > 0),
    i AS (SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY k, spec_name) - 1 AS idx, spec_name FROM e) SELECT * FROM i WHERE idx < {IMAGES}""")
def task_list(spark: SparkSession, d: str) -> DataFrame:
    return schedule.task_list(schedule.allocation(table(spark, d, "specs"), IMAGES), IMAGES)


@query(f"SELECT t.idx, t.spec_name, s.batch_id, s.text_direction, s.color_mode FROM (SELECT DISTINCT idx, spec_name FROM tasks) t JOIN {S} s USING (spec_name)")
def task_specs_join(spark: SparkSession, d: str) -> DataFrame:
    return tasks_(spark, d, "spec_name").join(specs_(spark, d).select("spec_name", "batch_id", "text_direction", "color_mode"), "spec_name")


@query(f"SELECT DISTINCT idx, spec_name FROM tasks WHERE idx >= {START}")
def resume_offset(spark: SparkSession, d: str) -> DataFrame:
    return schedule.resume_from(tasks_(spark, d, "spec_name"), START)


@query("""SELECT DISTINCT TRY_CAST(regexp_extract(name, '^image_([^_.]*)', 1) AS BIGINT) AS idx FROM
    (SELECT CASE WHEN seq % 3 = 0 THEN 'image_' || lpad(CAST(seq AS VARCHAR), 7, '0') || '.png' WHEN seq % 3 = 1 THEN 'image_x' || seq || '.png' ELSE 'label_' || seq END AS name FROM outcomes) WHERE TRY_CAST(regexp_extract(name, '^image_([^_.]*)', 1) AS BIGINT) IS NOT NULL""")
def completed_indices(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("seq").cast("string")
    name = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("image_"), F.lpad(s, 7, "0"), F.lit(".png"))).when(F.col("seq") % 3 == 1, F.concat(F.lit("image_x"), s, F.lit(".png"))).otherwise(F.concat(F.lit("label_"), s))
    return table(spark, d, "outcomes").select(schedule.index_in_name(name).alias("idx")).where("idx IS NOT NULL").distinct()


@query("""SELECT DISTINCT idx, spec_name FROM tasks WHERE idx NOT IN (SELECT CAST(json_extract(label_json, '$.idx') AS BIGINT) FROM label_files WHERE trim(label_json) <> '' AND json_extract(label_json, '$.idx') IS NOT NULL)""")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "label_files").select(F.get_json_object("label_json", "$.idx").try_cast("bigint").alias("idx")).where("idx IS NOT NULL")
    return schedule.not_done(tasks_(spark, d, "spec_name"), done)


@query(f"""WITH c AS (SELECT CAST(floor(seq / {CHUNK}) AS BIGINT) AS chunk_id, count(*) FILTER (WHERE ok) AS saved, count(*) FILTER (WHERE NOT ok) AS failed FROM (SELECT DISTINCT resource_id, seq, ok, recorded_at FROM outcomes) GROUP BY 1)
    SELECT *, CAST(sum(saved) OVER (ORDER BY chunk_id) AS BIGINT) AS saved_so_far FROM c""")
def chunk_accounting(spark: SparkSession, d: str) -> DataFrame:
    return schedule.chunk_accounting(outcomes_(spark, d), CHUNK)


@query(f"""WITH n AS (SELECT idx, CAST(floor(idx / {CHUNK}) AS BIGINT) AS chunk_id, row_number() OVER (PARTITION BY floor(idx / {CHUNK}) ORDER BY idx) - 1 AS k FROM (SELECT DISTINCT idx FROM tasks))
    SELECT chunk_id, CAST(floor(k / {IO_BATCH}) AS BIGINT) AS batch_no, count(*) AS n, min(idx) AS first_idx FROM n GROUP BY 1, 2""")
def io_batches(spark: SparkSession, d: str) -> DataFrame:
    return schedule.io_batches(tasks_(spark, d), CHUNK, IO_BATCH)


# Corpus and text -----------------------------------------------------------------------------------------------------

@query("""WITH c AS (SELECT corpus_file, row_number() OVER (ORDER BY corpus_file) - 1 AS n, count(*) OVER () AS k FROM corpus)
    SELECT t.idx, c.corpus_file FROM (SELECT DISTINCT idx FROM tasks) t JOIN c ON t.idx % c.k = c.n""")
def corpus_round_robin(spark: SparkSession, d: str) -> DataFrame:
    files = dense_index(table(spark, d, "corpus").select("corpus_file"), "corpus_file")
    n = files.agg(F.count("*").alias("k"))  # one row
    return tasks_(spark, d).join(F.broadcast(n)).withColumn("number", F.col("idx") % F.col("k")).join(files, "number").select("idx", "corpus_file")


@query(f"SELECT s.spec_name, s.corpus_file, c.corpus_file IS NOT NULL AS found, length(c.text) AS n_chars FROM {S} s LEFT JOIN corpus c USING (corpus_file)")
def corpus_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "corpus").select("corpus_file", F.lit(True).alias("found"), F.length("text").cast("bigint").alias("n_chars"))
    return specs_(spark, d).select("spec_name", "corpus_file").join(c, "corpus_file", "left").select("spec_name", "corpus_file", F.coalesce("found", F.lit(False)).alias("found"), "n_chars")


_L = sql_randint("idx", "segment_length", "min_text_length", "least(max_text_length, length(text))")


@query(f"""WITH j AS (SELECT t.idx, c.text, s.min_text_length, s.max_text_length FROM (SELECT DISTINCT idx, spec_name FROM tasks) t JOIN {S} s USING (spec_name) JOIN corpus c USING (corpus_file)),
    l AS (SELECT *, {_L} AS n FROM j WHERE length(text) >= min_text_length)
    SELECT idx, substr(text, {sql_randint("idx", "segment_start", "0", "length(text) - n")} + 1, n) AS segment FROM l UNION ALL SELECT idx, NULL FROM j WHERE length(text) < min_text_length""")
def text_segments(spark: SparkSession, d: str) -> DataFrame:
    s = specs_(spark, d).select("spec_name", "corpus_file", "min_text_length", "max_text_length").join(table(spark, d, "corpus"), "corpus_file")
    cut = tx.segment(F.col("text"), F.col("min_text_length"), F.col("max_text_length"), F.col("idx"))
    return tasks_(spark, d, "spec_name").join(s, "spec_name").select("idx", cut.alias("segment"))


LINED = f"""SELECT t.idx, t.text, {sql_randint("t.idx", "num_lines", "s.min_lines", "s.max_lines")} AS n, s.line_break_mode AS mode FROM (SELECT DISTINCT idx, spec_name, text FROM tasks WHERE text IS NOT NULL) t JOIN {S} s USING (spec_name)"""
CHAR_LINES = """SELECT idx, n, CASE WHEN text = '' THEN [''] WHEN n <= 1 THEN [text]
    WHEN length(text) <= n THEN list_transform(range(n), lambda i: substr(text, i + 1, 1))
    ELSE list_transform(range(n), lambda i: substr(text, 1 + i * (length(text) // n) + least(i, length(text) % n), length(text) // n + CASE WHEN i < length(text) % n THEN 1 ELSE 0 END)) END AS lines FROM l"""


def _lined(spark: SparkSession, d: str) -> DataFrame:
    t = tasks_(spark, d, "spec_name", "text").where("text IS NOT NULL").join(specs_(spark, d).select("spec_name", "min_lines", "max_lines", "line_break_mode"), "spec_name")
    return t.withColumn("n", randint(F.col("idx"), "num_lines", F.col("min_lines"), F.col("max_lines")))


@query(f"WITH l AS ({LINED}), c AS ({CHAR_LINES}) SELECT idx, n, array_to_string(lines, chr(10)) AS lines FROM c")
def line_break_char(spark: SparkSession, d: str) -> DataFrame:
    return _lined(spark, d).select("idx", "n", F.array_join(tx.lines_of(F.col("text"), F.col("n"), F.lit("character")), "\n").alias("lines"))


@query(f"""WITH RECURSIVE l AS ({LINED}),
    w AS (SELECT idx, text, n, list_filter(regexp_split_to_array(text, '[\\s\\x{{001C}}-\\x{{001F}}\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), lambda x: x <> '') AS ws FROM l WHERE n > 1 AND length(text) > n),
    f AS (SELECT idx, 0 AS k, CAST([] AS VARCHAR[]) AS done, '' AS line, ws, n, length(text) // n AS target FROM w WHERE len(ws) > 0
      UNION ALL SELECT idx, k + 1,
        CASE WHEN line <> '' AND length(line) + 1 + length(ws[k + 1]) > target AND len(done) < n - 1 THEN list_append(done, line) ELSE done END,
        CASE WHEN line = '' OR (length(line) + 1 + length(ws[k + 1]) > target AND len(done) < n - 1) THEN ws[k + 1] ELSE line || ' ' || ws[k + 1] END, ws, n, target FROM f WHERE k < len(ws)),
    g AS (SELECT idx, n, list_append(done, line) AS lines FROM f WHERE k = len(ws)),
    a AS (SELECT idx, n, array_to_string(lines, chr(10)) || repeat(chr(10), CAST(greatest(n - len(lines), 0) AS BIGINT)) AS lines FROM g
      UNION ALL SELECT idx, n, text FROM w WHERE len(ws) = 0
      UNION ALL SELECT idx, n, CASE WHEN text = '' OR n <= 1 THEN text ELSE array_to_string(list_transform(range(n), lambda i: substr(text, i + 1, 1)), chr(10)) END FROM l WHERE n <= 1 OR length(text) <= n)
    SELECT * FROM a""")
def line_break_word(spark: SparkSession, d: str) -> DataFrame:
    return _lined(spark, d).select("idx", "n", F.array_join(tx.lines_of(F.col("text"), F.col("n"), F.lit("word")), "\n").alias("lines"))


@query(f"""WITH l AS ({LINED}), c AS ({CHAR_LINES}), e AS (SELECT idx, lines, unnest(range(len(lines))) AS line_index FROM c)
    SELECT idx, line_index, CAST(coalesce(list_sum(list_transform(lines[1:line_index], lambda x: length(x) + 1)), 0) AS BIGINT) AS start FROM e""")
def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    l = _lined(spark, d).select("idx", tx.lines_of(F.col("text"), F.col("n"), F.lit("character")).alias("lines"))
    return l.select("idx", F.posexplode(tx.line_starts(F.col("lines")))).select("idx", F.col("pos").cast("bigint").alias("line_index"), F.col("col").cast("bigint").alias("start"))


# Draws ---------------------------------------------------------------------------------------------------------------

def _sampler(name: str) -> None:
    where = f"distribution = '{name}'"

    def f(spark: SparkSession, d: str) -> DataFrame:
        return params_(spark, d).where(where).select("spec_name", "param", F.round(sample(F.col("distribution"), F.col("min_value"), F.col("max_value"), F.col("spec_name"), F.col("param")), 6).alias("value"))

    f.__name__ = f"sample_{name}"
    query(f"SELECT spec_name, param, round({sql_sample('distribution', 'min_value', 'max_value', 'spec_name', '$param')}, 6) AS value FROM {P} WHERE {where}")(f)


for _n in NAMES:
    _sampler(_n)

SIX = f"(SELECT unnest({list(NAMES)}) AS distribution)"


def _all_draws(spark: SparkSession, d: str) -> DataFrame:
    six = F.explode(F.array(*(F.lit(n) for n in NAMES))).alias("distribution")
    return tasks_(spark, d).select("idx", six).withColumn("value", sample(F.col("distribution"), F.lit(0.0), F.lit(100.0), F.col("idx"), F.col("distribution")))


DRAWS = f"v AS (SELECT idx, distribution, {sql_sample('distribution', '0.0::DOUBLE', '100.0::DOUBLE', 'idx', '$distribution')} AS value FROM (SELECT DISTINCT idx FROM tasks), {SIX})"


@query(f"SELECT spec_name, param, distribution, round({sql_sample('distribution', 'min_value', 'max_value', 'spec_name', '$param')}, 6) AS value FROM {P}")
def sample_all_distributions(spark: SparkSession, d: str) -> DataFrame:
    return params_(spark, d).select("spec_name", "param", "distribution", F.round(sample(F.col("distribution"), F.col("min_value"), F.col("max_value"), F.col("spec_name"), F.col("param")), 6).alias("value"))


@query(f"WITH {DRAWS} SELECT distribution, CAST(least(9, floor(value / 10)) AS BIGINT) AS bin, count(*) AS n FROM v GROUP BY 1, 2")
def dist_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _all_draws(spark, d).groupBy("distribution", F.least(F.lit(9), F.floor(F.col("value") / 10)).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


@query(f"""WITH {DRAWS} SELECT distribution, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.95), 6) AS p95 FROM v GROUP BY 1""")
def dist_percentiles(spark: SparkSession, d: str) -> DataFrame:
    v, draws = F.col("value"), _all_draws(spark, d)
    points = {"p50": 0.5, "p90": 0.9, "p95": 0.95}
    q = exact_quantiles(draws, "distribution", "value", points)
    means = draws.groupBy("distribution").agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("sd"))
    return means.join(q, "distribution").select("distribution", "mean", "sd", *(F.round(p, 6).alias(p) for p in points))


@query(f"WITH {DRAWS} SELECT distribution, count(*) FILTER (WHERE value < 10) AS below_10, count(*) FILTER (WHERE value BETWEEN 40 AND 60) AS middle, count(*) FILTER (WHERE value > 90) AS above_90, count(*) AS n FROM v GROUP BY 1")
def dist_buckets(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return _all_draws(spark, d).groupBy("distribution").agg(F.count_if(v < 10).alias("below_10"), F.count_if(v.between(40, 60)).alias("middle"), F.count_if(v > 90).alias("above_90"), F.count("*").alias("n"))


# Resources -----------------------------------------------------------------------------------------------------------

@query(f"""SELECT s.spec_name, count(*) AS n_fonts, min(f.font_path) AS first_font, max(f.font_path) AS last_font FROM {S} s JOIN (SELECT DISTINCT font_path FROM fonts) f ON s.font_filter IS NULL OR f.font_path GLOB s.font_filter GROUP BY 1""")
def font_glob_filter(spark: SparkSession, d: str) -> DataFrame:
    return resources.candidates(specs_(spark, d).select("spec_name", "font_filter"), table(spark, d, "fonts"))


@query("SELECT background_path FROM backgrounds WHERE lower(regexp_extract(background_path, '\\.([^./]+)$', 1)) IN ('png', 'jpg', 'jpeg') UNION ALL SELECT font_path FROM fonts WHERE lower(regexp_extract(font_path, '\\.([^./]+)$', 1)) IN ('png', 'jpg', 'jpeg')")
def background_ext_filter(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "backgrounds").select("background_path").unionAll(table(spark, d, "fonts").select("font_path"))
    return paths.where(resources.is_image(F.col("background_path")))


STEPS = f"""o AS (SELECT DISTINCT resource_id, seq, ok, recorded_at FROM outcomes WHERE ok IS NOT NULL),
    s AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE -10 END) OVER (PARTITION BY resource_id ORDER BY seq, recorded_at, ok ROWS UNBOUNDED PRECEDING) AS s FROM o),
    h AS (SELECT *, CAST(100 + s - greatest(0, max(s) OVER (PARTITION BY resource_id ORDER BY seq, recorded_at, ok ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS score, row_number() OVER (PARTITION BY resource_id ORDER BY seq DESC, recorded_at DESC, ok DESC) AS back, count(*) OVER (PARTITION BY resource_id) AS n FROM s),
    fin AS (SELECT resource_id, score, n AS n_outcomes FROM h WHERE back = 1)"""


@query(f"WITH {STEPS} SELECT resource_id, seq, score FROM h")
def health_score(spark: SparkSession, d: str) -> DataFrame:
    return resources.health_scores(table(spark, d, "outcomes"))


@query(f"WITH {STEPS} SELECT * FROM fin")
def health_final(spark: SparkSession, d: str) -> DataFrame:
    return resources.final_scores(table(spark, d, "outcomes"))


HEALTHY = f"{STEPS}, hb AS (SELECT background_path AS resource_id, coalesce(score, 100) AS score FROM (SELECT DISTINCT background_path FROM backgrounds) LEFT JOIN fin ON resource_id = background_path WHERE coalesce(score, 100) >= 50)"


@query(f"WITH {STEPS} SELECT font_path AS resource_id, coalesce(score, 100) AS score FROM (SELECT DISTINCT font_path FROM fonts) LEFT JOIN fin ON resource_id = font_path WHERE coalesce(score, 100) >= 50")
def healthy_resources(spark: SparkSession, d: str) -> DataFrame:
    return resources.healthy(table(spark, d, "fonts"), "font_path", resources.final_scores(table(spark, d, "outcomes")))


@query(f"""WITH {HEALTHY}, g AS (SELECT resource_id, greatest(score, 0) AS w FROM hb), w AS (SELECT resource_id, CASE WHEN sum(w) OVER () = 0 THEN 1 ELSE w END AS w FROM g),
    bl AS (SELECT *, floor({sql_uniform("resource_id", "weight_block")} * {resources.WEIGHT_BLOCKS}) AS block FROM w),
    c AS (SELECT resource_id, sum(w) OVER (ORDER BY block, resource_id) AS hi, sum(w) OVER (ORDER BY block, resource_id) - w AS lo, sum(w) OVER () AS total FROM bl),
    t AS (SELECT DISTINCT idx FROM tasks)
    SELECT t.idx, c.resource_id AS background_path FROM t JOIN c ON floor({sql_uniform("t.idx", "background")} * c.total) >= c.lo AND floor({sql_uniform("t.idx", "background")} * c.total) < c.hi""")
def weighted_pick(spark: SparkSession, d: str) -> DataFrame:
    scores = resources.final_scores(table(spark, d, "outcomes"))
    return resources.weighted_pick(tasks_(spark, d), "idx", resources.healthy(table(spark, d, "backgrounds"), "background_path", scores), "background", "background_path")


# Validation ----------------------------------------------------------------------------------------------------------

ENUMS = " UNION ALL ".join(f"SELECT spec_name, {10 + k} AS check_no, '{c}: ' || coalesce({c}, 'null') AS message FROM {S} WHERE NOT coalesce({c} IN {v}, false)" for k, (c, v) in enumerate(checks.VALUES.items()))
ENUMS += f" UNION ALL SELECT spec_name, 1, param || ': ' || coalesce(distribution, 'null') FROM {P} WHERE NOT coalesce(distribution IN {NAMES}, false)"
RANGES = f"SELECT spec_name, 20 AS check_no, 'min_lines below 1' AS message FROM {S} WHERE min_lines < 1"
for _k, _r in enumerate(checks.RANGES):
    _lo, _hi = checks.bounds(_r)
    RANGES += f" UNION ALL SELECT spec_name, {21 + _k}, '{_lo} above {_hi}' FROM {S} WHERE {_lo} > {_hi}"
for _k, _c in enumerate(checks.COLOURS):
    RANGES += f" UNION ALL SELECT spec_name, {30 + _k}, '{_c}_min above {_c}_max' FROM {S} WHERE len(list_filter(list_zip({_c}_min, {_c}_max), lambda z: z[1] > z[2])) > 0"
MIN_MAX = f"SELECT spec_name, 40 AS check_no, param || ': min above max' AS message FROM {P} WHERE min_value > max_value"
SPACING = f"SELECT spec_name, 41 AS check_no, 'line_spacing not positive' AS message FROM {P} WHERE param = 'line_spacing' AND min_value <= 0"
CURVES = f"SELECT s.spec_name, 50 AS check_no, p.param || ' without a curve' AS message FROM {S} s JOIN {P} p USING (spec_name) WHERE s.curve_type = 'none' AND p.param IN ('arc_radius', 'sine_amplitude') AND (p.min_value <> 0 OR p.max_value <> 0)"
CORPORA = f"SELECT spec_name, 60 AS check_no, 'no corpus file: ' || coalesce(corpus_file, 'null') AS message FROM {S} s WHERE corpus_file IS NULL OR corpus_file NOT IN (SELECT corpus_file FROM corpus) AND NOT (regexp_matches(corpus_file, '[*?\\[]') AND EXISTS (SELECT 1 FROM corpus c WHERE c.corpus_file GLOB s.corpus_file))"
RAW = " UNION ALL ".join(f"SELECT spec_name, {70 + k} AS check_no, '{c} is missing' AS message FROM {S} WHERE {c} IS NULL OR trim({c}) = ''" for k, c in enumerate(("spec_name", "text_direction", "corpus_file")))
RAW += f" UNION ALL SELECT spec_name, 73, 'proportion out of range' FROM {S} WHERE proportion IS NULL OR proportion < 0 OR proportion > 1 UNION ALL SELECT spec_name, 74, 'font size not positive' FROM {S} WHERE font_size_min <= 0"
def _big(sql: str) -> str:
    return f"SELECT spec_name, CAST(check_no AS BIGINT) AS check_no, message FROM ({sql})"


ALL = " UNION ALL ".join((ENUMS, RANGES, MIN_MAX, SPACING, CURVES, CORPORA, RAW))


@query(f"SELECT batch_id, round(sum(proportion), 9) AS total FROM {S} GROUP BY 1 HAVING round(abs(round(sum(proportion), 9) - 1.0), 9) > {checks.TOLERANCE}")
def validate_proportions(spark: SparkSession, d: str) -> DataFrame:
    return checks.proportion_sums(specs_(spark, d))


@query(_big(ENUMS))
def validate_enums(spark: SparkSession, d: str) -> DataFrame:
    return checks.enum_violations(specs_(spark, d), params_(spark, d))


@query(_big(RANGES))
def validate_ranges(spark: SparkSession, d: str) -> DataFrame:
    return checks.range_violations(specs_(spark, d))


@query(_big(MIN_MAX))
def validate_min_max(spark: SparkSession, d: str) -> DataFrame:
    return checks.min_max_violations(params_(spark, d))


@query(_big(SPACING))
def validate_line_spacing(spark: SparkSession, d: str) -> DataFrame:
    return checks.spacing_violations(params_(spark, d))


@query(_big(CURVES))
def validate_curve_consistency(spark: SparkSession, d: str) -> DataFrame:
    return checks.curve_violations(specs_(spark, d), params_(spark, d))


@query(_big(CORPORA))
def validate_corpus_patterns(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_corpora(specs_(spark, d), table(spark, d, "corpus"))


@query(_big(RAW))
def validate_raw(spark: SparkSession, d: str) -> DataFrame:
    return checks.raw_violations(specs_(spark, d))


@query(f"SELECT spec_name, count(*) AS n, string_agg(message, '; ' ORDER BY check_no, message) AS messages FROM (SELECT DISTINCT * FROM ({ALL})) GROUP BY 1")
def validate_report(spark: SparkSession, d: str) -> DataFrame:
    return checks.report(checks.all_violations(specs_(spark, d), params_(spark, d), table(spark, d, "corpus")))


@query(f"SELECT spec_name, CAST(check_no AS BIGINT) AS check_no, message FROM (SELECT DISTINCT * FROM ({ALL})) QUALIFY row_number() OVER (PARTITION BY spec_name ORDER BY check_no, message) = 1")
def validate_first_failure(spark: SparkSession, d: str) -> DataFrame:
    return checks.first_failure(checks.all_violations(specs_(spark, d), params_(spark, d), table(spark, d, "corpus")))


# Utilities -----------------------------------------------------------------------------------------------------------

@query(f"""SELECT dir_path, file_id, output_filename FROM (SELECT DISTINCT file_id, regexp_replace(dir_path, '/[^/]*$', '') AS dir_path, output_filename FROM label_files)
    QUALIFY row_number() OVER (PARTITION BY dir_path ORDER BY {sql_uniform("file_id", "review")}, file_id) <= 5""")
def sample_k_per_group(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "label_files").select("file_id", F.regexp_replace("dir_path", "/[^/]*$", "").alias("dir_path"), "output_filename").distinct()
    w = Window.partitionBy("dir_path").orderBy(uniform(F.col("file_id"), "review"), "file_id")
    return f.withColumn("_n", F.row_number().over(w)).where("_n <= 5").drop("_n")


SECONDS = "epoch_us(received_at) - epoch_us(recorded_at)"


@query(f"""WITH r AS (SELECT DISTINCT * FROM outcomes), g AS (SELECT regexp_extract(resource_id, '^/[^/]*/([^/]*)', 1) AS kind, ({SECONDS}) / 1000000.0::DOUBLE AS s FROM r WHERE resource_id IS NOT NULL),
    a AS (SELECT kind, count(*) AS n, avg(s) AS mean, quantile_cont(s, 0.5) AS median, coalesce(stddev_samp(s), 0) AS sd, min(s) AS least, max(s) AS most FROM g GROUP BY 1)
    SELECT kind, n, round(mean, 6) AS mean, round(median, 6) AS median, round(sd, 4) AS sd, round(least, 6) AS least, round(most, 6) AS most, round((SELECT mean FROM a ORDER BY kind LIMIT 1) / mean, 6) AS speed_up, kind = (SELECT kind FROM a ORDER BY mean, kind LIMIT 1) AS best FROM a""")
def bench_summary(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "outcomes").distinct().where("resource_id IS NOT NULL")
    s = (F.unix_micros(F.col("received_at").cast("timestamp")) - F.unix_micros(F.col("recorded_at").cast("timestamp"))) / F.lit(1000000.0)
    t = r.select(F.regexp_extract("resource_id", "^/[^/]*/([^/]*)", 1).alias("kind"), s.alias("s"))
    a = t.groupBy("kind").agg(F.count("*").alias("n"), F.avg("s").alias("mean"), F.coalesce(F.stddev_samp("s"), F.lit(0.0)).alias("sd"), F.min("s").alias("least"), F.max("s").alias("most")).join(exact_quantiles(t, "kind", "s", {"median": 0.5}), "kind")
    base = a.agg(F.min_by("mean", "kind").alias("base"), F.min_by("kind", F.struct("mean", "kind")).alias("fastest"))  # one row
    return a.join(F.broadcast(base)).select("kind", "n", *(F.round(c, 6).alias(c) for c in ("mean", "median")), F.round("sd", 4).alias("sd"), *(F.round(c, 6).alias(c) for c in ("least", "most")), F.round(F.col("base") / F.col("mean"), 6).alias("speed_up"), (F.col("kind") == F.col("fastest")).alias("best"))


@query(f"SELECT idx, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS name FROM (SELECT DISTINCT idx, md5('run|' || idx) AS h FROM tasks)")
def output_names(spark: SparkSession, d: str) -> DataFrame:
    return tasks_(spark, d).select("idx", schedule.unique_name(F.lit("run"), F.col("idx")).alias("name"))


RATIOS = ((1, 1), (4, 3), (16, 9), (3, 4), (9, 16))


@query(f"SELECT h AS height, (h * r[1]) // r[2] AS width, 'white_' || ((h * r[1]) // r[2]) || 'x' || h || '.png' AS name FROM (SELECT unnest(range(100, 2100, 100)) AS h), (SELECT unnest({[list(r) for r in RATIOS]}) AS r)")
def background_size_grid(spark: SparkSession, d: str) -> DataFrame:
    h = spark.range(100, 2100, 100).select(F.col("id").alias("height"), F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in RATIOS))).alias("r"))
    w = F.expr("height * r.a div r.b").cast("bigint")
    return h.select("height", w.alias("width"), F.concat(F.lit("white_"), w.cast("string"), F.lit("x"), F.col("height").cast("string"), F.lit(".png")).alias("name"))


@query("SELECT k AS attempt, 0.1::DOUBLE * 2 ** k AS seconds FROM (SELECT unnest(range(3)) AS k)")
def retry_backoff_schedule(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(schedule.retry_schedule(3), "attempt bigint, seconds double")
