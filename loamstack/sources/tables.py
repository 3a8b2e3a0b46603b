"""Sources and sinks: Parquet tables, JDBC, file trees, CSV, JSON lines, logs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder; the file's own schema holds."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A relational table read in id ranges, one range per task."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn="id", lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions), **options).load()
    )


def jdbc_options(prefix: str = "DB") -> dict[str, str]:
    """url, user and password from the environment: `<prefix>_URL`, or `<prefix>_HOST`, `_PORT` and `_NAME`; a password may stand in the
    file that `<prefix>_PASSWORD_FILE` names. An empty value counts as none."""
    get = lambda k, d="": os.environ.get(f"{prefix}_{k}") or d
    out = {"url": get("URL") or f"jdbc:postgresql://{get('HOST', 'localhost')}:{get('PORT', '5432')}/{get('NAME', 'postgres')}"}
    secret = get("PASSWORD") or (open(get("PASSWORD_FILE")).read().strip() if get("PASSWORD_FILE") else "")
    return out | {k: v for k, v in (("user", get("USER")), ("password", secret)) if v}


def file_tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file under `root` with path, size and text; undecodable bytes become U+FFFD."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return raw.select(F.col("path").alias("file_path"), F.col("length").alias("size"), F.col("modificationTime").alias("processed_at"), F.make_valid_utf8(F.col("content").cast("string")).alias("content"))


def gpu_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less accelerator status rows."""
    return spark.read.schema("name string, util_gpu double, util_mem double, mem_used double, mem_total double, temperature double").csv(path, ignoreLeadingWhiteSpace=True)


def curve_csv(spark: SparkSession, path: str) -> DataFrame:
    """A training curve with the columns step and loss."""
    return spark.read.schema("step long, loss double").csv(path, header=True)


def write_curve(df: DataFrame, path: str) -> None:
    """A training curve (step, loss) as one CSV file with a header, in order of steps."""
    df.select("step", "loss").coalesce(1).sortWithinPartitions("step").write.mode("overwrite").csv(path, header=True)


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with the file they are from; order within a file is that of the scan."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, one file a partition."""
    df.write.mode("overwrite").json(path)


def write_stats(df: DataFrame, path: str) -> None:
    """A one-row summary as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
