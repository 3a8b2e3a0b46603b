"""Every registered query of the core with its DuckDB equivalent, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.functions import retry
from loamstack.functions import scalars as S
from loamstack.operators import logs, mutate, rollups, statements
from loamstack.operators import timeseries as ts
from loamstack.plans import pipeline
from loamstack.schemas import UNIQUE_KEYS
from loamstack.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ARGS = {"after": 100, "min_score": 70, "min_chars": 50, "max_chars": 5000}
AS_OF = "TIMESTAMP_NTZ '2024-03-02 00:00:00'"
AS_OF_SQL = "TIMESTAMP '2024-03-02 00:00:00'"


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


REPO_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(lower(trim(repo_name)), '^(?:[a-z][a-z0-9+.-]*://)(?:[^/@]*@)?[^/]+/+|^[^/@:\s]+@[^/:]+:/*', ''), '[?#].*$', ''), '(?:\.git)?/*$', '')"
)
_SERIES_SQL = "coalesce(array_to_string(list_sort(list_transform(map_entries(labels), lambda e: e.key || '=' || coalesce(e.value, ''))), ','), '')"
_SAMPLES_SQL = f"WITH s AS (SELECT DISTINCT ts, kind, name, {_SERIES_SQL} AS series, value FROM metric_samples)"
_FILES = "processed_files"


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return ts.samples(table(spark, d, "metric_samples"))


# --- reading new files -------------------------------------------------------------------------------------------------


@query("SELECT id, content, language, quality_score, file_path FROM processed_files WHERE id > 100 AND quality_score >= 70 AND length(content) BETWEEN 50 AND 5000 ORDER BY quality_score DESC, id LIMIT 20")
def fetch_new_files(spark, d):
    return statements.common(spark).run("fetch_new_files", {_FILES: table(spark, d, _FILES)}, ARGS | {"most": 20})


@query("SELECT count(*) AS n FROM processed_files WHERE id > 100 AND quality_score >= 70 AND length(content) BETWEEN 50 AND 5000")
def count_new_files(spark, d):
    return statements.common(spark).run("count_new_files", {_FILES: table(spark, d, _FILES)}, ARGS)


_CURSOR_SQL = (
    "WITH t AS (SELECT model_name, last_trained_id FROM training_state), r AS (SELECT t.model_name, f.id, f.quality_score FROM t JOIN processed_files f ON f.id > t.last_trained_id WHERE f.quality_score >= 70) "
    "SELECT model_name, count(*) AS new_files, CAST(max(id) AS BIGINT) AS cursor, max(quality_score) AS best FROM r GROUP BY model_name"
)


@query(_CURSOR_SQL)
def cursor_batch(spark, d):
    """New files of each model beyond its cursor: one scan from the least cursor on, one aggregate for all models, no join."""
    return rollups.cursor_batches(table(spark, d, _FILES).where("quality_score >= 70"), table(spark, d, "training_state"))


@query("SELECT id, repo_name, quality_score FROM processed_files ORDER BY quality_score DESC NULLS LAST, id LIMIT 100")
def topk_by_score(spark, d):
    return table(spark, d, _FILES).orderBy(F.desc_nulls_last("quality_score"), "id").limit(100).select("id", "repo_name", "quality_score")


@query(
    "SELECT doc_id, CAST(len(list_filter(string_split_regex(lower(text), '[^\\pL\\pN_]+'), lambda x: x IN ('cache', 'retry'))) AS INTEGER) AS hits FROM documents "
    "WHERE len(list_filter(string_split_regex(lower(text), '[^\\pL\\pN_]+'), lambda x: x IN ('cache', 'retry'))) > 0 ORDER BY hits DESC, doc_id LIMIT 25"
)
def search_documents(spark, d):
    """Documents in which two words occur most often."""
    return logs.search(table(spark, d, "documents").select("doc_id", "text"), "text", ["cache", "retry"], 25, "doc_id").select("doc_id", F.col("hits").cast("int").alias("hits"))


# --- derived columns ---------------------------------------------------------------------------------------------------


@query("SELECT id, CAST(strlen(content) AS BIGINT) AS size, CAST(len(string_split(content, chr(10))) AS INTEGER) AS lines, sha256(content) AS hash, length(content) AS chars FROM processed_files")
def derive_file_columns(spark, d):
    return pipeline.derive(table(spark, d, _FILES)).select("id", "size", "lines", "hash", F.length("content").cast("long").alias("chars"))


@query(
    "SELECT id, CAST(len(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '')) AS INTEGER) AS tokens, CAST(len(string_split(content, chr(10))) AS INTEGER) AS lines FROM processed_files"
)
def token_and_line_counts(spark, d):
    return table(spark, d, _FILES).select("id", S.token_count(F.col("content")).alias("tokens"), S.line_count(F.col("content")).alias("lines"))


@query("SELECT id, CAST(len(string_split(content, chr(10))) * 10 + length(content) * 2 AS BIGINT) AS score, CAST(strlen(content) * 10 AS BIGINT) AS byte_score FROM processed_files")
def bench_quality_score(spark, d):
    return table(spark, d, _FILES).select("id", S.heuristic_score(F.col("content")).cast("long").alias("score"), (S.byte_count(F.col("content")) * 10).cast("long").alias("byte_score"))


@query("SELECT id, regexp_extract(trim(language), '^(.*?)(?:\\s+\\d+(?:\\.\\d+)?%.*)?$', 1) AS language FROM repositories")
def clean_language(spark, d):
    return table(spark, d, "repositories").select("id", S.clean_language(F.col("language")).alias("language"))


@query(f"SELECT id, CAST(coalesce(floor(epoch({AS_OF_SQL} - downloaded_at) / 86400), 0) AS BIGINT) AS age_days, coalesce(nullif(description, ''), 'none') AS description FROM repositories")
def repository_age(spark, d):
    return table(spark, d, "repositories").select("id", S.age_days(F.col("downloaded_at"), F.expr(AS_OF)).alias("age_days"), S.or_default(F.col("description"), "none").alias("description"))


@query("SELECT CAST(range AS INTEGER) AS attempt, least(0.5 * pow(2.0, range), 30.0) AS seconds FROM range(0, 12)")
def backoff_schedule(spark, d):
    return spark.range(12).select(F.col("id").cast("int").alias("attempt"), S.backoff_seconds(F.col("id"), 0.5, 2.0, 30.0).alias("seconds"))


# --- inserts, updates, constraints -------------------------------------------------------------------------------------


@query("SELECT id, hash, repo_name FROM processed_files QUALIFY row_number() OVER (PARTITION BY hash ORDER BY id) = 1")
def insert_dedup_by_hash(spark, d):
    f = table(spark, d, _FILES).select("id", "hash", "repo_name")
    return mutate.first_per_key(f, ["hash"], ["id"])


@query(
    "WITH old AS (SELECT hash FROM processed_files WHERE processed_at < TIMESTAMP '2024-03-01 04:45:00') SELECT id, hash FROM processed_files f WHERE (processed_at >= TIMESTAMP '2024-03-01 04:45:00' OR processed_at IS NULL) AND hash NOT IN (SELECT hash FROM old) "
    "QUALIFY row_number() OVER (PARTITION BY hash ORDER BY id) = 1"
)
def insert_second_batch(spark, d):
    """Files from a point in time on, inserted after all earlier ones."""
    f = table(spark, d, _FILES).select("id", "hash", "processed_at")
    cut = F.expr("TIMESTAMP_NTZ '2024-03-01 04:45:00'")
    old = f.where(F.col("processed_at") < cut).select("id", "hash")
    return mutate.insert_ignore(old, f.where((F.col("processed_at") >= cut) | F.col("processed_at").isNull()).select("id", "hash"), ["hash"], ["id"])


@query("SELECT hash, min(id) AS kept_id, count(*) - 1 AS ignored FROM processed_files GROUP BY hash HAVING count(*) > 1")
def insert_conflict_report(spark, d):
    return mutate.conflicts(table(spark, d, _FILES), "hash", "id")


@query(
    f"SELECT r.id, CASE WHEN j.id IS NULL THEN r.download_status ELSE j.status END AS download_status, CASE WHEN j.id IS NULL THEN r.downloaded_at ELSE j.completed_at END AS downloaded_at, CASE WHEN j.id IS NULL THEN r.updated_at ELSE {AS_OF_SQL} END AS updated_at "
    "FROM repositories r LEFT JOIN processing_jobs j ON r.local_path = j.repo_path"
)
def update_status(spark, d):
    jobs = table(spark, d, "processing_jobs").select(F.col("repo_path").alias("local_path"), F.col("status").alias("download_status"), F.col("completed_at").alias("downloaded_at"))
    out = mutate.update_by_key(table(spark, d, "repositories"), jobs, "local_path", ["download_status", "downloaded_at"], "updated_at", F.expr(AS_OF))
    return out.select("id", "download_status", "downloaded_at", "updated_at")


@query("SELECT id, job_id FROM processed_files f WHERE job_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM processing_jobs j WHERE j.id = f.job_id)")
def fk_orphans(spark, d):
    return mutate.orphans(table(spark, d, _FILES).select("id", "job_id"), table(spark, d, "processing_jobs"), "job_id", "id")


def _unique_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_name, count(*) AS repeated_values, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT {k}, count(*) AS n FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"
        for t, ks in UNIQUE_KEYS.items()
        for k in ks
    )


@query(_unique_sql())
def unique_violations(spark, d):
    parts = [mutate.key_violations(table(spark, d, t), t, ks) for t, ks in UNIQUE_KEYS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "WITH old AS (SELECT hash FROM processed_files WHERE id <= 100) SELECT id, hash, repo_name FROM processed_files f WHERE id > 100 AND NOT EXISTS (SELECT 1 FROM old WHERE old.hash = f.hash) "
    "QUALIFY row_number() OVER (PARTITION BY hash ORDER BY id) = 1"
)
def insert_file(spark, d):
    """The prepared insert: rows that a second delivery adds to the first hundred."""
    f = table(spark, d, _FILES).select("id", "hash", "repo_name")
    return statements.common(spark).run("insert_file", {"incoming": f.where("id > 100"), _FILES: f.where("id <= 100")}, {})


@query(
    "SELECT id, CASE WHEN id = 3 THEN 'downloaded' ELSE download_status END AS download_status, CASE WHEN id = 3 THEN TIMESTAMP '2024-03-02 00:00:00' ELSE downloaded_at END AS downloaded_at, CASE WHEN id = 3 THEN '/data/new' ELSE local_path END AS local_path FROM repositories"
)
def update_repo_status(spark, d):
    """The prepared update of one repository."""
    return statements.common(spark).run("update_repo_status", {"repositories": table(spark, d, "repositories")}, {"id": 3, "status": "downloaded", "at": "2024-03-02 00:00:00", "path": "/data/new"})


@query(
    "SELECT model_name, last_trained_id, total_training_runs FROM training_state UNION ALL SELECT n, 0, 0 FROM (VALUES ('quill-coder-3b'), ('a-new-model')) v(n) WHERE n NOT IN (SELECT model_name FROM training_state)"
)
def seed_models(spark, d):
    """Model rows after seeding two names, one of which is there already."""
    t = table(spark, d, "training_state").select("model_name", "last_trained_id", "total_training_runs")
    seed = spark.createDataFrame([("quill-coder-3b", 0, 0), ("a-new-model", 0, 0)], "model_name string, last_trained_id long, total_training_runs int")
    return t.unionByName(mutate.insert_ignore(t, seed, ["model_name"], ["model_name"]))


def _touched_sql() -> str:
    one = (
        "SELECT '{t}' AS table_name, CAST(count(*) FILTER ({c}) AS BIGINT) AS changed, CAST(count(*) AS BIGINT) AS rows FROM {t}",
        (("processing_jobs", "status = 'pending'"), ("repositories", "forks > 50"), ("training_state", "total_training_runs > 5")),
    )
    return " UNION ALL ".join(one[0].format(t=t, c=c) for t, c in one[1])


@query(_touched_sql())
def updated_at_triggers(spark, d):
    """Rows of the three tables with a trigger whose stamp an update has set."""
    out = []
    for t, change in (("processing_jobs", ("status", F.when(F.col("status") == "pending", "queued").otherwise(F.col("status")))), ("repositories", ("forks", F.when(F.col("forks") > 50, F.col("forks") + 1).otherwise(F.col("forks")))), ("training_state", ("total_training_runs", F.when(F.col("total_training_runs") > 5, 0).otherwise(F.col("total_training_runs"))))):
        before = table(spark, d, t)
        after = mutate.touch(before, before.withColumn(*change), "id", F.expr("TIMESTAMP_NTZ '2030-01-01 00:00:00'"))
        out.append(after.agg(F.lit(t).alias("table_name"), F.count_if(F.col("updated_at") == F.expr("TIMESTAMP_NTZ '2030-01-01 00:00:00'")).alias("changed"), F.count("*").alias("rows")))
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- reports -----------------------------------------------------------------------------------------------------------


@query("SELECT lower(trim(language)) AS language, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, CAST(sum(lines) AS BIGINT) AS lines FROM processed_files GROUP BY 1")
def language_balance(spark, d):
    return rollups.language_balance(table(spark, d, _FILES))


@query("SELECT CAST(floor(quality_score / 10.0) AS INTEGER) AS bucket, count(*) AS files, min(quality_score) AS least, max(quality_score) AS most FROM processed_files GROUP BY 1")
def quality_distribution(spark, d):
    return rollups.quality_distribution(table(spark, d, _FILES))


@query(
    f"SELECT {REPO_SQL} AS repo, count(*) AS file_count, CAST(sum(lines) AS BIGINT) AS code_lines, CAST(sum(size) AS BIGINT) AS bytes, count(*) FILTER (quality_score >= 70) AS good_files, count(DISTINCT hash) AS distinct_files FROM processed_files GROUP BY 1"
)
def repo_rollup(spark, d):
    return rollups.repo_rollup(table(spark, d, _FILES))


@query(
    f"SELECT * FROM (SELECT {REPO_SQL} AS repo, count(*) AS files, count(DISTINCT hash) AS distinct_files, round(CAST(sum(quality_score) AS DOUBLE) / count(quality_score), 6) AS mean_score FROM processed_files GROUP BY 1) WHERE mean_score < 40 OR distinct_files * 2 < files"
)
def repo_exclusion_candidates(spark, d):
    return rollups.repo_exclusion_candidates(table(spark, d, _FILES))


@query(
    "SELECT j.id AS job_id, files_found, files_processed, coalesce(n, 0) AS counted FROM processing_jobs j LEFT JOIN (SELECT job_id, count(*) AS n FROM processed_files WHERE job_id IS NOT NULL GROUP BY 1) f ON f.job_id = j.id"
)
def job_tallies(spark, d):
    return rollups.job_tallies(table(spark, d, _FILES), table(spark, d, "processing_jobs"))


@query(f"SELECT r.id, r.full_name, coalesce(n, 0) AS files FROM repositories r LEFT JOIN (SELECT {REPO_SQL} AS k, count(*) AS n FROM processed_files GROUP BY 1) f ON f.k = lower(r.full_name)")
def files_with_repository(spark, d):
    return rollups.files_with_repository(table(spark, d, _FILES), table(spark, d, "repositories"))


@query("SELECT id, full_name, stars, forks, quality_score FROM repositories WHERE lower(regexp_extract(trim(language), '^(.*?)(?:\\s+\\d+(?:\\.\\d+)?%.*)?$', 1)) = 'rust'")
def repos_by_language(spark, d):
    return rollups.repos_by_language(table(spark, d, "repositories"), "Rust")


@query("SELECT lower(trim(coalesce(download_status, ''))) AS status, count(*) AS repos, CAST(sum(code_lines) AS BIGINT) AS code_lines, max(downloaded_at) AS last_download FROM repositories GROUP BY 1")
def download_stats(spark, d):
    return rollups.download_stats(table(spark, d, "repositories"))


@query("SELECT id, full_name, stars, quality_score FROM repositories ORDER BY stars DESC NULLS LAST, quality_score DESC NULLS LAST, id LIMIT 50")
def topk_repositories(spark, d):
    return rollups.topk_repositories(table(spark, d, "repositories"), 50)


@query("SELECT worker_id, id, last_job_id, last_processed_count, checkpoint_time FROM processing_checkpoints QUALIFY row_number() OVER (PARTITION BY worker_id ORDER BY checkpoint_time DESC NULLS LAST, id DESC) = 1")
def latest_checkpoints(spark, d):
    return rollups.latest_checkpoints(table(spark, d, "processing_checkpoints"))


@query("SELECT CAST(sum(total_samples_trained) AS BIGINT) AS samples, CAST(sum(total_training_runs) AS BIGINT) AS runs, min(best_eval_loss) AS best_loss, arg_min(best_model_path, best_eval_loss) AS best_path FROM training_state")
def training_totals(spark, d):
    return rollups.training_totals(table(spark, d, "training_state"))


@query("SELECT count(*) FILTER (quality_score >= 50) AS passed, count(*) FILTER (quality_score < 50 OR quality_score IS NULL) AS filtered, count(quality_score) AS scores, min(quality_score) AS least, max(quality_score) AS most FROM repositories")
def quality_observations(spark, d):
    return rollups.quality_observations(table(spark, d, "repositories"), 50)


@query(
    "SELECT coalesce(worker_id, 'none') AS worker, count(*) FILTER (lower(trim(status)) = 'completed') AS ok, count(*) FILTER (lower(trim(status)) = 'failed') AS failed, round(sum(epoch(completed_at - started_at)) FILTER (lower(trim(status)) = 'completed'), 3) AS seconds, "
    "count(completed_at - started_at) FILTER (lower(trim(status)) = 'completed') AS timed, CAST(sum(files_processed) FILTER (lower(trim(status)) = 'completed') AS BIGINT) AS files FROM processing_jobs GROUP BY 1"
)
def download_observations(spark, d):
    return rollups.download_observations(table(spark, d, "processing_jobs"))


@query(
    "WITH g AS (SELECT CAST(processed_at AS DATE) AS day, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM processed_files GROUP BY 1) "
    "SELECT day, files, bytes, CAST(sum(files) OVER w AS BIGINT) AS total_files, CAST(sum(bytes) OVER w AS BIGINT) AS total_bytes FROM g WINDOW w AS (ORDER BY day NULLS FIRST ROWS UNBOUNDED PRECEDING)"
)
def dataset_growth(spark, d):
    return rollups.dataset_growth(table(spark, d, _FILES))


_ERROR_SQL = "CASE WHEN regexp_matches(error_msg, '(?i)timeout') THEN 'network' WHEN regexp_matches(error_msg, '(?i)rate') THEN 'rate_limit' WHEN regexp_matches(error_msg, '(?i)clone') THEN 'transient' ELSE 'permanent' END"


@query(f"SELECT {_ERROR_SQL} AS kind, CAST({_ERROR_SQL} IN ('transient', 'network', 'rate_limit') AS BOOLEAN) AS again, count(*) AS jobs FROM processing_jobs WHERE error_msg IS NOT NULL GROUP BY 1, 2")
def retryable_jobs(spark, d):
    """Failed jobs by kind of error and whether another attempt is worth it. The kinds' patterns are ours."""
    kind = logs.classify(F.col("error_msg"), [("timeout", "network"), ("rate", "rate_limit"), ("clone", "transient")], "permanent")
    j = table(spark, d, "processing_jobs").where("error_msg IS NOT NULL").select(kind.alias("kind"))
    return j.groupBy("kind", retry.is_retryable(F.col("kind"), F.lit(True)).alias("again")).agg(F.count("*").alias("jobs"))


@query("SELECT CAST(a.range AS INTEGER) AS attempt, u.range / 4.0 AS u, round(least(1.0 * pow(2.0, a.range), 30.0) * (1 + 0.1 * (0.5 - u.range / 4.0)), 6) AS seconds FROM range(0, 7) a, range(0, 4) u")
def backoff_with_jitter(spark, d):
    r = spark.range(28).select((F.col("id") % 7).cast("int").alias("attempt"), (F.floor(F.col("id") / 7) / 4.0).alias("u"))
    return r.select("attempt", "u", F.round(retry.delay_column(F.col("attempt"), F.col("u")), 6).alias("seconds"))


_EXPORT_SQL = (
    "WITH good AS (SELECT * FROM processed_files WHERE quality_score >= 70 AND length(content) BETWEEN 50 AND 5000), first AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY sha256(content) ORDER BY id) = 1), "
    "e AS (SELECT id, lower(trim(language)) AS language, repo_name, content, quality_score, sha256(content) AS hash FROM first ORDER BY quality_score DESC, id LIMIT 100000) "
)


@query(_EXPORT_SQL + "SELECT * FROM e")
def export_training_set(spark, d):
    return pipeline.select_training(pipeline.derive(table(spark, d, _FILES)))


@query(_EXPORT_SQL + "SELECT count(*) AS files, count(DISTINCT language) AS languages, CAST(sum(length(content)) AS BIGINT) AS chars, min(quality_score) AS least_score, max(quality_score) AS most_score FROM e")
def export_stats(spark, d):
    return pipeline.stats(pipeline.select_training(pipeline.derive(table(spark, d, _FILES))))


# --- metrics -----------------------------------------------------------------------------------------------------------


@query(_SAMPLES_SQL + " SELECT name, round(sum(value), 4) AS total, count(*) AS n FROM s WHERE kind = 'counter' GROUP BY name")
def counter_totals(spark, d):
    return ts.counter_totals(_samples(spark, d))


@query(_SAMPLES_SQL + " SELECT name, series, value, ts AS last_ts FROM s WHERE kind = 'gauge' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name, series ORDER BY ts DESC, value DESC) = 1")
def gauge_latest(spark, d):
    return ts.gauge_latest(_samples(spark, d))


_HIST_SQL = " SELECT * FROM s WHERE kind = 'histogram' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY ts DESC, value DESC, series DESC) <= 1000"


@query(_SAMPLES_SQL + f" SELECT name, count(*) AS n, min(value) AS least, max(value) AS most, round(sum(value), 4) AS total FROM ({_HIST_SQL}) GROUP BY name")
def histogram_last_1000(spark, d):
    return ts.histogram_window(_samples(spark, d))


@query(
    _SAMPLES_SQL + " SELECT name AS metric, round(sum(value), 4) AS value FROM s WHERE kind = 'counter' GROUP BY name UNION ALL "
    "SELECT name, value FROM (SELECT * FROM s WHERE kind = 'gauge' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY ts DESC, value DESC, series DESC) = 1) UNION ALL "
    f"SELECT name || '_count', CAST(count(*) AS DOUBLE) FROM ({_HIST_SQL}) GROUP BY name"
)
def metrics_snapshot(spark, d):
    return ts.snapshot(_samples(spark, d))


_INC_SQL = (
    ", i AS (SELECT *, lag(value) OVER w AS before FROM s WHERE kind = 'counter' AND value IS NOT NULL WINDOW w AS (PARTITION BY name, series ORDER BY ts, value)), "
    "r AS (SELECT ts, name, series, value, round(sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) OVER (PARTITION BY name, series ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW) / 300, 6) AS rate FROM i)"
)


@query(_SAMPLES_SQL + _INC_SQL + " SELECT * FROM r")
def rate_5m(spark, d):
    return ts.rate_simple(_samples(spark, d))


@query(_SAMPLES_SQL + _INC_SQL + " SELECT ts, name, series, rate FROM r WHERE name = 'errors_total' AND rate > 0.1")
def alert_high_rate(spark, d):
    return ts.rate_simple(_samples(spark, d)).where("name = 'errors_total' AND rate > 0.1").select("ts", "name", "series", "rate")


_GRID_SQL = (
    ", g AS (SELECT kind, name, series, date_trunc('hour', ts) + to_seconds(30 * CAST(1 + floor((minute(ts) * 60 + second(ts)) / 30.0) AS BIGINT)) AS step_end, ts, value FROM s WHERE value IS NOT NULL), "
    "p AS (SELECT kind, name, series, step_end, value FROM g QUALIFY row_number() OVER (PARTITION BY kind, name, series, step_end ORDER BY ts DESC, value DESC) = 1)"
)


def _alert_sql(condition: str, hold: int) -> str:
    return (
        _SAMPLES_SQL + _GRID_SQL + f", m AS (SELECT *, coalesce({condition}, false) AS met FROM p), k AS (SELECT *, sum(CASE WHEN met THEN 0 ELSE 1 END) OVER (PARTITION BY name, series ORDER BY step_end) AS island FROM m), "
        f"f AS (SELECT name, series, step_end, min(step_end) OVER (PARTITION BY name, series, island) AS since FROM k WHERE met) SELECT * FROM f WHERE epoch(step_end - since) >= {hold}"
    )


@query(_alert_sql("name = 'queue_depth' AND value > 50", 60))
def alert_for_duration(spark, d):
    p = ts.grid(_samples(spark, d))
    return ts.firing(p, (F.col("name") == "queue_depth") & (F.col("value") > 50), 60, ["name", "series"])


# the six rules, each over the metric of these tables that stands for its own
RULES = (
    ts.Rule("high_error_rate", "errors_total", ">", 10, 300, rate=True),
    ts.Rule("training_stuck", "last_training_timestamp", ">", 3600, 600, age=True),
    ts.Rule("high_connections", "queue_depth", ">", 50, 300),
    ts.Rule("high_gpu_memory", "gpu_memory_used", ">", 0.9, 600, divisor="queue_depth"),
    ts.Rule("low_disk_space", "gpu_memory_used", "<", 0.1, 300, divisor="queue_depth", labels={"mountpoint": "/"}),
    ts.Rule("service_down", "up", "==", 0, 120),
)


def _rule_sql(r: ts.Rule) -> str:
    names = ", ".join(f"'{n}'" for n in (r.metric, r.divisor) if n)
    label = "".join(f" AND labels['{k}'] = '{v}'" for k, v in r.labels.items())
    s = f"WITH s AS (SELECT DISTINCT ts, kind, name, {_SERIES_SQL} AS series, value FROM metric_samples WHERE name IN ({names}){label})"
    if r.rate:
        s += _INC_SQL + ", v0 AS (SELECT ts, name, series, rate AS value FROM r)"
    else:
        s += ", v0 AS (SELECT ts, name, series, value FROM s WHERE value IS NOT NULL)"
    s += ", q AS (SELECT name, series, CAST(floor(epoch(ts) / 30) AS BIGINT) + 1 AS k, value FROM v0 QUALIFY row_number() OVER (PARTITION BY name, series, k ORDER BY ts DESC, value DESC) = 1)"
    s += ", l AS (SELECT *, least(coalesce(lead(k) OVER (PARTITION BY name, series ORDER BY k) - k, 10), 10) AS n FROM q), e AS (SELECT name, series, (k + unnest(range(n))) * 30 AS at_, value FROM l)"
    if r.divisor:
        s += f", v AS (SELECT a.series, a.at_, CASE WHEN b.value <> 0 THEN a.value / b.value END AS value FROM e a JOIN e b ON a.series = b.series AND a.at_ = b.at_ WHERE a.name = '{r.metric}' AND b.name = '{r.divisor}')"
    else:
        s += f", v AS (SELECT series, at_, {'at_ - value' if r.age else 'value'} AS value FROM e)"
    op = "=" if r.op == "==" else r.op
    s += f", m AS (SELECT *, at_ - 30 * row_number() OVER (PARTITION BY series ORDER BY at_) AS island FROM v WHERE value {op} {r.bound}), f AS (SELECT *, min(at_) OVER (PARTITION BY series, island) AS since FROM m)"
    return s + f" SELECT '{r.alert}' AS alert, series, at_ AS at, since, round(value, 6) AS value FROM f WHERE at_ - since >= {r.hold}"


def _add_rule(r: ts.Rule) -> None:
    def run(spark, d):
        return ts.evaluate(table(spark, d, "metric_samples"), r)

    run.__name__ = f"alert_{r.alert}"
    run.__doc__ = f"Steps at which {r.alert} fires."
    query(_rule_sql(r))(run)


for _r in RULES:
    _add_rule(_r)
# the same over these tables' own ranges, where the rule's bounds are rarely met
_add_rule(ts.Rule("some_errors", "errors_total", ">", 0.05, 60, rate=True))
_add_rule(ts.Rule("root_ratio", "gpu_memory_used", "<", 50, 0, divisor="queue_depth", labels={"mountpoint": "/"}))


@query(_SAMPLES_SQL + " SELECT name, series, max(ts) AS last_ts FROM s WHERE name = 'up' GROUP BY ALL HAVING epoch(TIMESTAMP '2024-03-01 12:45:00' - max(ts)) > 3600")
def alert_silent(spark, d):
    """Series of `up` from which nothing has come for an hour."""
    return ts.silent(_samples(spark, d), "up", 3600, F.expr("TIMESTAMP_NTZ '2024-03-01 12:45:00'"))


@query(
    _SAMPLES_SQL + f" SELECT name, series, round(epoch({AS_OF_SQL}) - value, 3) AS seconds FROM s WHERE name = 'last_training_timestamp' AND kind = 'gauge' AND value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name, series ORDER BY ts DESC, value DESC) = 1"
)
def staleness_seconds(spark, d):
    return ts.staleness(_samples(spark, d), "last_training_timestamp", F.expr(AS_OF))


@query(
    _SAMPLES_SQL + _GRID_SQL + " SELECT a.step_end, a.series, CASE WHEN b.value = 0 THEN NULL ELSE round(a.value / b.value, 6) END AS ratio FROM p a JOIN p b ON a.step_end = b.step_end AND a.series = b.series WHERE a.name = 'gpu_memory_used' AND b.name = 'queue_depth'"
)
def ratio_match(spark, d):
    return ts.ratio(ts.grid(_samples(spark, d)), "gpu_memory_used", "queue_depth")


# --- documents of other shapes -----------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total FROM events GROUP BY 1")
def json_field_rollup(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k_total"))


@query("SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def tail_events(spark, d):
    return logs.tail(table(spark, d, "events").select("event_id", "ts", "user_id"), ["ts", "event_id"], 10)


@query(
    "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE doc_type = 'log_excerpt') SELECT CASE WHEN regexp_matches(line, '(?i)error|fatal') THEN 'error' WHEN regexp_matches(line, '(?i)warn') THEN 'warning' ELSE 'ok' END AS level, count(*) AS lines FROM l GROUP BY 1"
)
def classify_log_lines(spark, d):
    lines = table(spark, d, "documents").where("doc_type = 'log_excerpt'").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(logs.classify(F.col("line"), [("error|fatal", "error"), ("warn", "warning")], "ok").alias("level")).agg(F.count("*").alias("lines"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_counts(spark, d):
    """Batch twin of the windowed stream (an extra)."""
    return table(spark, d, "events").groupBy(S.time_bucket(F.col("ts"), 3600).alias("start"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
