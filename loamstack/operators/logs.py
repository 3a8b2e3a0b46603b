"""Log lines and status documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def classify(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern is found, without regard to letter case; NULL text gets the default."""
    out = None
    for pattern, label in rules:
        hit = F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def tail(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The last `n` rows in `order` (whose columns must make a total order), in that order."""
    return df.orderBy(*(F.desc(c) for c in order)).limit(n).orderBy(*order)


def status_fields(doc: Column) -> list[Column]:
    """Fields of a trainer's status document; a missing or `null` training time reads `Never`."""
    g = lambda p: F.get_json_object(doc, p)
    return [
        g("$.metrics.model_version").alias("model_version"),
        g("$.metrics.total_files_trained").cast("long").alias("files_trained"),
        F.coalesce(F.nullif(g("$.metrics.last_training_time"), F.lit("null")), F.lit("Never")).alias("last_training"),
        g("$.training_in_progress").cast("boolean").alias("training"),
        F.bround(g("$.gpu_memory_used").cast("double"), 1).alias("gpu_used"),
        F.bround(g("$.gpu_memory_total").cast("double"), 1).alias("gpu_total"),
    ]


def search(df: DataFrame, text: str, terms: list[str], k: int, order: str) -> DataFrame:
    """The `k` rows with most occurrences of all terms (whole words, letter case aside) with their `hits`; ties by `order`.

    Rows without a term are dropped by the scan's own filter; only `k` rows a task are sent on.
    """
    words = "|".join(rf"\Q{t.lower()}\E" for t in terms)
    pattern = rf"(?<![\p{{L}}\p{{N}}_])(?:{words})(?![\p{{L}}\p{{N}}_])"
    low = F.lower(F.col(text))
    return df.where(low.rlike(pattern)).withColumn("hits", F.regexp_count(low, F.lit(pattern))).orderBy(F.desc("hits"), order).limit(k)
