"""Named, parameterised statements: registered once, run with named arguments."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

FETCH_NEW_FILES = """
SELECT id, content, language, quality_score, file_path FROM {processed_files}
WHERE id > :after AND quality_score >= :min_score AND length(content) BETWEEN :min_chars AND :max_chars
ORDER BY quality_score DESC, id ASC LIMIT :most"""

COUNT_NEW_FILES = """
SELECT count(*) AS n FROM {processed_files}
WHERE id > :after AND quality_score >= :min_score AND length(content) BETWEEN :min_chars AND :max_chars"""

# the rows that the insert adds: the first of each hash that the table does not hold yet
INSERT_FILE = """
SELECT i.* EXCEPT (nth) FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY id) AS nth FROM {incoming}) i
LEFT ANTI JOIN {processed_files} p ON i.hash = p.hash WHERE i.nth = 1 OR i.hash IS NULL"""

# the updated columns of every row after the update
UPDATE_REPO_STATUS = """
SELECT id, CASE WHEN id = :id THEN :status ELSE download_status END AS download_status,
CASE WHEN id = :id THEN CAST(:at AS TIMESTAMP_NTZ) ELSE downloaded_at END AS downloaded_at,
CASE WHEN id = :id THEN :path ELSE local_path END AS local_path FROM {repositories}"""


class Statements:
    """Statements by name. Tables are given as DataFrames in `{braces}`, values as `:name` markers."""

    def __init__(self, spark: SparkSession):
        self.spark, self._text = spark, {}

    def prepare(self, name: str, text: str) -> None:
        """Idempotent for the same text; another text under a taken name is an error."""
        if self._text.setdefault(name, text) != text:
            raise ValueError(f"statement {name} has another text")

    def get(self, name: str) -> str:
        if name not in self._text:
            raise KeyError(f"statement {name} is not prepared")
        return self._text[name]

    def run(self, name: str, tables: dict[str, DataFrame], args: dict[str, Any]) -> DataFrame:
        return self.spark.sql(self.get(name), args=args, **tables)

    def close(self) -> None:
        self._text.clear()


def common(spark: SparkSession) -> Statements:
    s = Statements(spark)
    s.prepare("fetch_new_files", FETCH_NEW_FILES)
    s.prepare("count_new_files", COUNT_NEW_FILES)
    s.prepare("insert_file", INSERT_FILE)
    s.prepare("update_repo_status", UPDATE_REPO_STATUS)
    return s
