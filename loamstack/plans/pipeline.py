"""The corpus pipeline: ingest -> derive -> filter -> deduplicate -> export, one lazy plan; only the export is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions.scalars import byte_count, content_hash, language_key, line_count
from loamstack.operators.mutate import first_per_key
from loamstack.sources.tables import write_jsonl, write_stats


def derive(files: DataFrame) -> DataFrame:
    """size, lines and hash computed from the text itself."""
    return files.withColumns({"size": byte_count(F.col("content")).cast("long"), "lines": line_count(F.col("content")), "hash": content_hash(F.col("content"))})


def select_training(files: DataFrame, min_score: int = 70, min_chars: int = 50, max_chars: int = 5000, cap: int = 100_000) -> DataFrame:
    """Files of at least `min_score` and a length in range, first copy of each text, best first up to `cap`."""
    good = files.where((F.col("quality_score") >= min_score) & F.length("content").between(min_chars, max_chars))
    first = first_per_key(good, ["hash"], ["id"])
    return first.orderBy(F.desc("quality_score"), F.asc("id")).limit(cap).select("id", language_key(F.col("language")).alias("language"), "repo_name", "content", "quality_score", "hash")


def stats(selected: DataFrame) -> DataFrame:
    return selected.agg(
        F.count("*").alias("files"), F.countDistinct("language").alias("languages"), F.sum(F.length("content")).cast("long").alias("chars"), F.min("quality_score").alias("least_score"), F.max("quality_score").alias("most_score")
    )


def export(files: DataFrame, out: str) -> None:
    """Write the training set as JSON lines and its summary beside it; the summary reads what was written."""
    spark = files.sparkSession
    chosen = select_training(derive(files))
    write_jsonl(chosen, f"{out}/training_data")
    write_stats(stats(spark.read.schema(chosen.schema).json(f"{out}/training_data")), f"{out}/stats")
