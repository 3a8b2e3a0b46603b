"""Reports over files, repositories, jobs, checkpoints and training runs. Each is one partial + final aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamstack.functions.scalars import canonical_repo, clean_language, language_key, seconds_between


def language_balance(files: DataFrame) -> DataFrame:
    return files.groupBy(language_key(F.col("language")).alias("language")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("lines").alias("lines"))


def quality_distribution(files: DataFrame) -> DataFrame:
    """Files by ten-point score bucket; NULL is a bucket of its own."""
    return files.groupBy(F.floor(F.col("quality_score") / 10).cast("int").alias("bucket")).agg(F.count("*").alias("files"), F.min("quality_score").alias("least"), F.max("quality_score").alias("most"))


def repo_rollup(files: DataFrame) -> DataFrame:
    return files.groupBy(canonical_repo(F.col("repo_name")).alias("repo")).agg(
        F.count("*").alias("file_count"), F.sum("lines").alias("code_lines"), F.sum("size").alias("bytes"), F.count_if(F.col("quality_score") >= 70).alias("good_files"), F.countDistinct("hash").alias("distinct_files")
    )


def repo_exclusion_candidates(files: DataFrame, min_mean: float = 40.0) -> DataFrame:
    """Repositories whose mean score is low or of whose files over half are copies. The rule is ours."""
    r = files.groupBy(canonical_repo(F.col("repo_name")).alias("repo")).agg(F.count("*").alias("files"), F.countDistinct("hash").alias("distinct_files"), F.round(F.sum("quality_score") / F.count("quality_score"), 6).alias("mean_score"))
    return r.where((F.col("mean_score") < min_mean) | (F.col("distinct_files") * 2 < F.col("files")))


def job_tallies(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """Files found by counting against what each job says of itself."""
    n = files.where("job_id IS NOT NULL").groupBy("job_id").agg(F.count("*").alias("counted"))
    return jobs.join(n, jobs.id == n.job_id, "left").select(jobs.id.alias("job_id"), "files_found", "files_processed", F.coalesce("counted", F.lit(0)).alias("counted"))


def files_with_repository(files: DataFrame, repos: DataFrame) -> DataFrame:
    """Files per repository found by any spelling of its name; repositories without files have 0."""
    f = files.groupBy(canonical_repo(F.col("repo_name")).alias("_k")).agg(F.count("*").alias("n"))
    r = repos.select("id", "full_name", canonical_repo(F.col("full_name")).alias("_k"))
    return r.join(f, "_k", "left").select("id", "full_name", F.coalesce("n", F.lit(0)).alias("files"))


def repos_by_language(repos: DataFrame, language: str) -> DataFrame:
    return repos.where(F.lower(clean_language(F.col("language"))) == language.lower()).select("id", "full_name", "stars", "forks", "quality_score")


def download_stats(repos: DataFrame) -> DataFrame:
    s = F.lower(F.trim(F.coalesce("download_status", F.lit(""))))
    return repos.groupBy(s.alias("status")).agg(F.count("*").alias("repos"), F.sum("code_lines").alias("code_lines"), F.max("downloaded_at").alias("last_download"))


def latest_checkpoints(cp: DataFrame) -> DataFrame:
    """Last checkpoint of each worker; of equal times the greatest id."""
    return cp.groupBy("worker_id").agg(F.max_by(F.struct("id", "last_job_id", "last_processed_count", "checkpoint_time"), F.struct("checkpoint_time", "id")).alias("c")).select("worker_id", "c.*")


def training_totals(state: DataFrame) -> DataFrame:
    return state.agg(F.sum("total_samples_trained").alias("samples"), F.sum("total_training_runs").cast("long").alias("runs"), F.min("best_eval_loss").alias("best_loss"), F.min_by("best_model_path", "best_eval_loss").alias("best_path"))


def topk_repositories(repos: DataFrame, k: int) -> DataFrame:
    return repos.orderBy(F.desc_nulls_last("stars"), F.desc_nulls_last("quality_score"), "id").limit(k).select("id", "full_name", "stars", "quality_score")


def quality_observations(repos: DataFrame, least: int) -> DataFrame:
    """Repositories that pass a least score and those that do not, with what their scores look like. NULL does not pass."""
    passed = F.coalesce(F.col("quality_score") >= least, F.lit(False))
    return repos.agg(F.count_if(passed).alias("passed"), F.count_if(~passed).alias("filtered"), F.count("quality_score").alias("scores"), F.min("quality_score").alias("least"), F.max("quality_score").alias("most"))


def download_observations(jobs: DataFrame) -> DataFrame:
    """By worker: jobs that ended well or failed, and the seconds and files of those that ended. Times before the start count as they are."""
    status = F.lower(F.trim("status"))
    ended = status == "completed"
    seconds = seconds_between(F.col("started_at"), F.col("completed_at"))
    return jobs.groupBy(F.coalesce("worker_id", F.lit("none")).alias("worker")).agg(
        F.count_if(ended).alias("ok"), F.count_if(status == "failed").alias("failed"), F.round(F.sum(F.when(ended, seconds)), 3).alias("seconds"), F.count(F.when(ended, seconds)).alias("timed"), F.sum(F.when(ended, F.col("files_processed"))).alias("files")
    )


def dataset_growth(files: DataFrame) -> DataFrame:
    """Files and bytes by day of processing and their running totals; rows without a time are day NULL and come first."""
    day = files.groupBy(F.col("processed_at").cast("date").alias("day")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    w = Window.orderBy(F.asc_nulls_first("day")).rowsBetween(Window.unboundedPreceding, 0)  # a row a day
    return day.select("day", "files", "bytes", F.sum("files").over(w).alias("total_files"), F.sum("bytes").over(w).alias("total_bytes"))


MODELS = 10_000


def cursor_batches(files: DataFrame, state: DataFrame) -> DataFrame:
    """(model_name, new_files, cursor, best) of the files beyond each model's `last_trained_id`; models without any have no row.

    The cursors, a row a model, are read first (more than MODELS are refused). The range of ids is taken from the least one on, so the scan
    prunes by it; ids fall between neighbouring cursors, each interval is aggregated once, and a model adds up its intervals.
    """
    cursors = state.where("last_trained_id IS NOT NULL").select("model_name", "last_trained_id").limit(MODELS + 1).collect()
    if len(cursors) > MODELS:
        raise ValueError(f"more than {MODELS} models")
    spark, steps = files.sparkSession, sorted({r.last_trained_id for r in cursors})
    kind = "model_name string, new_files long, cursor long, best int"
    if not steps:
        return spark.createDataFrame([], kind)
    at = F.lit(0)
    for k, c in enumerate(steps):
        at = F.when(F.col("id") > c, k).otherwise(at)
    if len(steps) > 50:  # a long chain of comparisons is a search in an array instead
        at = F.size(F.filter(F.array(*map(F.lit, steps)), lambda c: c < F.col("id"))) - 1
    by = files.where(F.col("id") > steps[0]).groupBy(at.alias("step")).agg(F.count("*").alias("n"), F.max("id").cast("long").alias("last"), F.max("quality_score").alias("best"))
    models = spark.createDataFrame([(r.model_name, steps.index(r.last_trained_id), s) for r in cursors for s in range(steps.index(r.last_trained_id), len(steps))], "model_name string, own int, step int")
    return by.join(models, "step").groupBy("model_name").agg(F.sum("n").alias("new_files"), F.max("last").alias("cursor"), F.max("best").alias("best"))
