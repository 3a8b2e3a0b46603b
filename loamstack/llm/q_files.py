"""Queries over processed_files: problems 2, 3, 4, 5 and 6."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamstack.llm.credentials import find_credentials
from loamstack.llm.licenses import file_licences, repository_licences
from loamstack.llm.near_duplicates import NearDuplicates
from loamstack.config import spread
from loamstack.functions.scalars import canonical_repo
from loamstack.llm.provenance import classify_files, line_copies, marked_files
from loamstack.llm.radix_cap import cap_contributors
from loamstack.llm.syntax import parse_rates, parse_verdicts
from loamstack.plans.catalogue import REPO_SQL
from loamstack.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _files(spark, d, *cols: str):
    df = table(spark, d, "processed_files").select(*cols)
    return spread(df) if "content" in cols else df


P1_KEEP = 15


def _capped(spark, d, left_out: bool):
    return cap_contributors(_files(spark, d, "id", "repo_name", "quality_score"), canonical_repo(F.col("repo_name")), "quality_score", "id", max_count=P1_KEEP, left_out=left_out)


def _capped_sql(op: str) -> str:
    return f"FROM processed_files QUALIFY row_number() OVER (PARTITION BY {REPO_SQL} ORDER BY quality_score DESC NULLS LAST, id) {op} {P1_KEEP}"


@query("SELECT id " + _capped_sql(">"))
def p1_found(spark, d):
    """Files beyond each repository's allowance."""
    return _capped(spark, d, True).select("id")


@query("SELECT id, repo_name, quality_score " + _capped_sql("<="))
def p1_kept(spark, d):
    """Files within it."""
    return _capped(spark, d, False)


@query()
def p2_found(spark, d):
    """Lines on which a literal credential begins."""
    f = find_credentials(_files(spark, d, "id", "content", "file_path", "language"), with_text=False)
    return f.select("id", F.explode("cred_findings.line_no").alias("line_no"))


@query("SELECT count(*) AS files, 0 AS other_length, 0 AS other_lines, 0 AS changed_without_finding FROM processed_files")
def p2_rules(spark, d):
    """Files redacted, and those whose length or lines changed or whose text changed without a finding."""
    f = find_credentials(_files(spark, d, "id", "content", "file_path", "language"))
    lines = lambda c: F.size(F.split(F.col(c), "\n"))
    return f.agg(
        F.count("*").alias("files"), F.count_if(F.length("content") != F.length("cred_text")).alias("other_length"), F.count_if(lines("content") != lines("cred_text")).alias("other_lines"),
        F.count_if((F.size("cred_findings") == 0) & ~F.col("content").eqNullSafe(F.col("cred_text"))).alias("changed_without_finding"),
    )


@query()
def p2_redacted(spark, d):
    """Every file with its credentials replaced by placeholders."""
    f = find_credentials(_files(spark, d, "id", "content", "file_path", "language"))
    return f.select("id", F.col("cred_path").alias("file_path"), F.col("cred_text").alias("content"), F.size("cred_findings").alias("findings"))


def _near(spark, d):
    return NearDuplicates(_files(spark, d, "id", "content"), n=3, threshold=0.7)


def _near_sql(n: int, threshold: float) -> str:
    gram = " || ' ' || ".join(f"t[i + {k}]" for k in range(n))
    return (
        "WITH RECURSIVE f AS (SELECT id, content, regexp_extract_all(content, '[A-Za-z0-9_]+') AS t FROM processed_files WHERE content IS NOT NULL AND id IS NOT NULL), "
        f"s AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(t) - {n - 2}), lambda i: {gram})) AS g FROM f), n AS (SELECT id, count(*) AS n FROM s GROUP BY id), "
        "i AS (SELECT a.id AS x, b.id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL), "
        f"p AS (SELECT x, y FROM i JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE k >= {threshold} * (a.n + b.n - k) - 1e-9 UNION SELECT a.id, b.id FROM f a JOIN f b ON a.content = b.content AND a.id < b.id)"
    )


@query(_near_sql(3, 0.7) + " SELECT x AS id_a, y AS id_b FROM p")
def p5_found(spark, d):
    """Pairs of files that share at least 0.7 of their three-token shingles."""
    return _near(spark, d).pairs()


@query(
    _near_sql(5, 0.8) + ", e AS (SELECT x, y FROM p UNION SELECT y, x FROM p), c AS (SELECT id AS x, id AS y FROM f UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x) SELECT x AS id, min(y) AS group_id FROM c GROUP BY x"
)
def p5_groups(spark, d):
    """Every file with its group, by the usual five tokens and 0.8."""
    return NearDuplicates(_files(spark, d, "id", "content")).groups().select("id", "group_id")


@query()
def p3_found(spark, d):
    """Files that do not parse as their language."""
    return parse_verdicts(_files(spark, d, "id", "content", "language")).select("id")


@query("SELECT id FROM processed_files WHERE lower(trim(language)) = 'json' AND content IS NOT NULL AND NOT json_valid(content)")
def p3_json(spark, d):
    """JSON files that do not parse."""
    return parse_verdicts(_files(spark, d, "id", "content", "language").where("lower(trim(language)) = 'json'")).select("id")


@query()
def p3_report(spark, d):
    """Files that do not parse, with the edits that mend them and what kind of damage it is."""
    return parse_verdicts(_files(spark, d, "id", "content", "language"))


@query()
def p3_rates(spark, d):
    """Share of files that do not parse, by repository and language."""
    return parse_rates(_files(spark, d, "id", "content", "language", "repo_name"), canonical_repo(F.col("repo_name")))


@query()
def p4_found(spark, d):
    """The licence of each file, with conflicts and unknowns."""
    return file_licences(_files(spark, d, "id", "content", "repo_name", "relative_path"), canonical_repo(F.col("repo_name")))


@query()
def p4_repositories(spark, d):
    """The licence of each repository."""
    return repository_licences(_files(spark, d, "id", "content", "repo_name", "relative_path"), canonical_repo(F.col("repo_name")))


def _placed(spark, d):
    return _files(spark, d, "id", "content", "relative_path", "language", "repo_name"), canonical_repo(F.col("repo_name"))


@query()
def p6_found(spark, d):
    """Files that are generated, minified, vendored or data."""
    return marked_files(*_placed(spark, d)).select("id")


@query(
    "WITH l AS (SELECT DISTINCT id, repo, x FROM (SELECT id, {R} AS repo, trim(regexp_replace(unnest(string_split(content, chr(10))), '\\s+', ' ', 'g')) AS x FROM processed_files) WHERE length(x) >= 12), n AS (SELECT id, repo, count(*) AS n FROM l GROUP BY ALL), "
    "i AS (SELECT a.id, b.id AS source_id, count(*) AS k FROM l a JOIN l b ON a.x = b.x AND a.repo <> b.repo GROUP BY ALL) "
    "SELECT i.id, source_id, round(k / n, 4) AS containment FROM i JOIN n ON n.id = i.id WHERE round(k / n, 4) >= 0.8 QUALIFY row_number() OVER (PARTITION BY i.id ORDER BY source_id) = 1".replace("{R}", REPO_SQL)
)
def p6_copies(spark, d):
    """Files that another repository's file contains to 0.8 at least, with the first such file."""
    return line_copies(_files(spark, d, "id", "content", "repo_name"), canonical_repo(F.col("repo_name")))


@query()
def p6_origins(spark, d):
    """Every file's origin, and the other repository's file it repeats, if any."""
    return classify_files(*_placed(spark, d))
