import datetime as dt
import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loamstack.functions import scalars as S
from loamstack.operators import logs, mutate, statements
from loamstack.operators import timeseries as ts
from loamstack.plans import catalogue, pipeline
from loamstack.sources import kvcache
from loamstack.streaming import jobs

DATA = "/root/testdata/sf0.001"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("text,want", [("Rust", "Rust"), ("Rust 80%", "Rust"), ("Rust 80% Python 15% Shell 5%", "Rust"), ("  Go  ", "Go"), (None, None), ("Jupyter Notebook 90%", "Jupyter Notebook")])
def test_clean_language(spark, text, want):
    got = one(spark, text, S.clean_language)
    assert got == want and (got is None or one(spark, got, S.clean_language) == got)


def test_text_counts(spark):
    assert one(spark, "def example():\n    return 42", S.line_count) == 2
    assert one(spark, "This is a test sentence for tokenization.", S.token_count) == 7
    assert one(spark, "  \n", S.token_count) == 0 and one(spark, None, S.token_count) is None
    assert one(spark, "def func():\n    pass", S.heuristic_score) == 2 * 10 + 20 * 2
    assert one(spark, "é", S.byte_count) == 2


@pytest.mark.parametrize("name", ["Owner/Repo", " owner/repo  ", "owner/repo.git", "https://git.host.example/owner/repo", "https://git.host.example/OWNER/repo.git/", "git@host.example:owner/repo.git", "ssh://git@host.example/owner/repo"])
def test_canonical_repo(spark, name):
    assert one(spark, name, S.canonical_repo) == "owner/repo"


def test_age_and_backoff(spark):
    r = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-31 00:00:00' AS a, TIMESTAMP_NTZ '2024-01-01 12:00:00' AS b, CAST(NULL AS TIMESTAMP_NTZ) AS c")
    assert r.select(S.age_days(F.col("b"), F.col("a")), S.age_days(F.col("c"), F.col("a"))).first() == (29, 0)
    got = [x[0] for x in spark.range(8).select(S.backoff_seconds(F.col("id"), 0.5, 2.0, 30.0)).collect()]
    assert got == [min(0.5 * 2**k, 30.0) for k in range(8)]
    assert one(spark, 0.25, lambda x: S.round_half_even(x, 1), "double") == 0.2
    assert one(spark, "", lambda x: S.or_default(x, "d")) == "d"


def test_insert_ignore(spark):
    old = spark.createDataFrame([(1, "a")], "id int, hash string")
    new = spark.createDataFrame([(5, "a"), (4, "b"), (3, "b"), (6, None), (7, None)], "id int, hash string")
    got = mutate.insert_ignore(old, new, ["hash"], ["id"])
    assert sorted(r.id for r in got.collect()) == [3, 6, 7]
    both = old.unionByName(got)
    assert mutate.insert_ignore(both, new.where("hash is not null"), ["hash"], ["id"]).count() == 0


def test_update_by_key(spark):
    t = spark.createDataFrame([(1, "a", "old"), (2, "b", "old")], "id int, v string, at string")
    u = spark.createDataFrame([(2, None)], "id int, v string")
    got = {r.id: (r.v, r.at) for r in mutate.update_by_key(t, u, "id", ["v"], "at", F.lit("new")).collect()}
    assert got == {1: ("a", "old"), 2: (None, "new")}


def test_statements(spark):
    s = statements.common(spark)
    f = spark.createDataFrame([(1, "abc", "x", 80, "p"), (2, "abcd", "x", None, "p"), (3, "ab", "x", 90, "p")], "id int, content string, language string, quality_score int, file_path string")
    args = {"after": 0, "min_score": 70, "min_chars": 2, "max_chars": 3}
    assert [r.id for r in s.run("fetch_new_files", {"processed_files": f}, args | {"most": 9}).collect()] == [3, 1]
    assert s.run("count_new_files", {"processed_files": f}, args).first().n == 2
    with pytest.raises(ValueError):
        s.prepare("count_new_files", "SELECT 1")
    s.close()
    with pytest.raises(KeyError):
        s.get("count_new_files")


def test_cache(spark):
    now = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    empty = spark.createDataFrame([], "key string, value string, expires_at timestamp_ntz")
    e = spark.createDataFrame([("a:1", (1,)), ("b:1", (2,))], "key string, doc struct<n:int>")
    c = kvcache.put(empty, e, now, 60)
    assert kvcache.get(c, "a:1", "n int", now).first().doc.n == 1
    assert not kvcache.exists(c, "a:1", F.expr("TIMESTAMP_NTZ '2024-01-01 00:02:00'"))
    left, gone = kvcache.clear(c, "a:*")
    assert gone.first().removed == 1 and [r.key for r in left.collect()] == ["b:1"]
    assert kvcache.delete(c, "b:1").count() == 1


def samples(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(seconds=30 * k), "counter", "c", None, float(v)) for k, v in enumerate([5, 8, 2, 4])]
    rows += [(t + dt.timedelta(seconds=30 * k), "gauge", "g", {"a": "1"}, float(v)) for k, v in enumerate([1, 9, 9, 9, 0, 9])]
    rows += [(t, "histogram", "h", None, float(v)) for v in range(5)] + [(t, "gauge", "g", {"a": "1"}, None)]
    return ts.samples(spark.createDataFrame(rows + rows[:1], "ts timestamp_ntz, kind string, name string, labels map<string,string>, value double"))


def test_timeseries(spark):
    s = samples(spark)
    assert ts.counter_totals(s).first().total == 19.0
    assert ts.gauge_latest(s).first().value == 9.0
    assert ts.histogram_window(s, 3).first()[:4] == ("h", 3, 2.0, 4.0)
    last = ts.rate_simple(s).orderBy(F.desc("ts")).first()
    assert math.isclose(last.rate, round((0 + 3 + 2 + 2) / 300, 6))
    f = ts.firing(ts.grid(s), (F.col("name") == "g") & (F.col("value") > 5), 60, ["name", "series"]).collect()
    assert len(f) == 1 and (f[0].step_end - f[0].since).seconds == 60
    assert any("h_count" in r.line for r in ts.exposition(s).collect())


def test_logs(spark):
    d = spark.createDataFrame([(1, "ERROR x"), (2, "a warning"), (3, None)], "line_no int, line string")
    got = [r.k for r in d.select(logs.classify(F.col("line"), [("error", "error"), ("warn", "warning")], "ok").alias("k")).collect()]
    assert got == ["error", "warning", "ok"]
    assert [r.line_no for r in logs.tail(d, ["line_no"], 2).collect()] == [2, 3]
    j = spark.createDataFrame([('{"metrics":{"model_version":"v1","total_files_trained":3,"last_training_time":null},"training_in_progress":true,"gpu_memory_used":0.25}',)], "j string")
    assert j.select(*logs.status_fields(F.col("j"))).first()[:5] == ("v1", 3, "Never", True, 0.2)


def test_export(spark, tmp_path):
    f = spark.createDataFrame([(i, "x" * 60 + str(i % 3), "Go", "r", 70 + i, "") for i in range(6)] + [(9, None, "Go", "r", 99, "")], "id int, content string, language string, repo_name string, quality_score int, hash string")
    pipeline.export(f, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/training_data").count() == 3
    assert spark.read.json(f"{tmp_path}/stats").first().files == 3


def test_cursor_gate(spark, tmp_path):
    src, spill = str(tmp_path / "in"), str(tmp_path / "wait")
    got = []
    schema = "id int"
    for batch in ([1, 2], [3, 4, 5]):
        spark.createDataFrame([(x,) for x in batch], schema).coalesce(1).write.mode("append").parquet(src)
        q = jobs.cursor_batches(jobs.file_stream(spark, src, schema), lambda df, _: got.append(sorted(r.id for r in df.collect())), str(tmp_path / "cp"), spill, min_new=4).start()
        q.awaitTermination()
    assert got == [[1, 2, 3, 4, 5]]


def test_streams_equal_batch(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [(t + dt.timedelta(seconds=60 * k), "g", "s", float(v)) for k, v in enumerate([1, 9, 9, 9, 1])]
    src = str(tmp_path / "s")
    spark.createDataFrame(rows, "ts timestamp_ntz, name string, series string, value double").coalesce(1).write.parquet(src)
    st = jobs.file_stream(spark, src, "ts timestamp_ntz, name string, series string, value double")
    q = jobs.alert_states(st, 5.0, 120).writeStream.format("memory").queryName("alerts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.state for r in spark.sql("SELECT state FROM alerts ORDER BY at").collect()] == ["inactive", "pending", "pending", "firing", "inactive"]
    w = jobs.windowed_counts(st, "ts", "name").writeStream.format("memory").queryName("wins").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    w.awaitTermination()
    assert [(r.n, r.total) for r in spark.sql("SELECT n, total FROM wins").collect()] == [(5, 29.0)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for p in glob.glob(DATA + "/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got = catalogue.QUERIES[name](spark, DATA)
    want = c.execute(catalogue.ORACLE[name])
    cols = [x[0] for x in want.description]
    assert sorted(cols) == sorted(got.columns)
    order = sorted(cols)
    a = sorted(str([r[c] for c in order]) for r in got.collect())
    b = sorted(str([dict(zip(cols, r))[c] for c in order]) for r in want.fetchall())
    assert a == b


def test_table_functions(spark):
    from loamstack.functions import table_functions

    spark.createDataFrame([(1, "a/b", " Rust 80% C 20%", 5, "Done", 7), (2, "a/c", None, 1, "done ", 1), (3, "a/d", "Go", 1, None, None)], "id int, full_name string, language string, stars int, download_status string, code_lines int").createOrReplaceTempView("repositories")
    table_functions.register(spark)
    assert [r.id for r in spark.sql("SELECT * FROM repos_by_language('rust')").collect()] == [1]
    assert {(r.status, r.repos, r.code_lines) for r in spark.sql("SELECT * FROM download_stats()").collect()} == {("done", 2, 8), ("", 1, None)}
