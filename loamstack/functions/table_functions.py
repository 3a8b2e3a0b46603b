"""SQL table functions over the corpus tables, for use in spark.sql."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession, repositories: str = "repositories") -> None:
    """`repos_by_language(lang)` and `download_stats()` over the view or table named `repositories`."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION repos_by_language(lang STRING) RETURNS TABLE(id INT, full_name STRING, stars INT) RETURN "
        f"SELECT id, full_name, stars FROM {repositories} WHERE lower(regexp_extract(trim(language), '^(.*?)(?:\\\\s+\\\\d+(?:\\\\.\\\\d+)?%.*)?$', 1)) = lower(lang)"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION download_stats() RETURNS TABLE(status STRING, repos BIGINT, code_lines BIGINT) RETURN "
        f"SELECT lower(trim(coalesce(download_status, ''))), count(*), sum(code_lines) FROM {repositories} GROUP BY 1"
    )
