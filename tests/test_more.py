import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loamstack.functions import markup, retry
from loamstack.functions import scalars as S
from loamstack.operators import logs, mutate, rollups
from loamstack.operators import timeseries as ts
from loamstack.sources import kvcache, tables
from loamstack.streaming import jobs, listener

ZONES = ["UTC", "America/New_York", "Asia/Kathmandu"]


@pytest.mark.parametrize("zone", ZONES)
def test_times_without_zone_do_not_depend_on_the_session(spark, zone):
    """Samples on both sides of a change of clocks."""
    at = [dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 1)]
    df = spark.createDataFrame([(t, "counter", "c", None, float(v)) for t, v in zip(at, (0, 1, 2))], "ts timestamp_ntz, kind string, name string, labels map<string,string>, value double")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert [r.rate for r in ts.rate_simple(ts.samples(df)).orderBy("ts").collect()] == [0.0, round(1 / 300, 6), round(1 / 300, 6)]
        assert [str(r.step_end) for r in ts.grid(ts.samples(df)).orderBy("step_end").collect()] == ["2024-03-10 01:59:30", "2024-03-10 02:30:30", "2024-03-10 03:01:30"]
        r = df.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(S.seconds_between(F.col("a"), F.col("b")), S.age_days(F.col("a"), F.expr("TIMESTAMP_NTZ '2024-03-12 01:58:00'")), S.time_bucket(F.col("a"), 3600)).first()
        assert r[0] == 62 * 60 and r[1] == 1 and str(r[2]) == "2024-03-10 01:00:00"
        assert spark.sql("SELECT TIMESTAMP_NTZ '1969-12-31 23:59:58.5' AS t").select(S.ntz_micros(F.col("t"))).first()[0] == -1_500_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def frame(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, kind string, name string, labels map<string,string>, value double")


def test_rules(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda k: t + dt.timedelta(seconds=30 * k + 5)
    rows = [(at(k), "gauge", "up", {"job": "a"}, v) for k, v in enumerate([1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0])]
    rows += [(at(k), "gauge", "up", {"job": "b"}, 0.0) for k in (0, 2, 4)]  # between samples the last one holds
    rows += [(at(0), "gauge", "up", {"job": "c"}, 0.0), (at(40), "gauge", "up", {"job": "c"}, 0.0), (at(0), "gauge", "up", None, None)]
    down = ts.evaluate(frame(spark, rows), ts.Rule("down", "up", "==", 0, 120)).collect()
    span = {s: [(r.at - r.since) // 30 for r in down if r.series == s] for s in ("job=a", "job=b", "job=c")}
    assert span["job=a"] == [4, 5] and sorted(span["job=b"]) == list(range(4, 14)) and sorted(span["job=c"]) == sorted(2 * list(range(4, 10)))
    disk = [(at(k), "gauge", n, {"mountpoint": m}, v) for k in range(3) for m in ("/", "/data") for n, v in (("avail", 5.0), ("size", 100.0))] + [(at(5), "gauge", "size", {"mountpoint": "/"}, 0.0)]
    low = ts.evaluate(frame(spark, disk), ts.Rule("disk", "avail", "<", 0.1, 60, divisor="size", labels={"mountpoint": "/"})).collect()
    assert {r.series for r in low} == {"mountpoint=/"} and {r.value for r in low} == {0.05} and max(r.at - r.since for r in low) == 120
    s = ts.samples(frame(spark, rows))
    assert [(r.series) for r in ts.silent(s, "up", 300, F.lit(at(30)).cast("timestamp_ntz")).orderBy("series").collect()] == ["", "job=a", "job=b"]
    assert ts.evaluate(frame(spark, []), ts.Rule("down", "up", "==", 0, 120)).count() == 0


def test_retry():
    calls, waits = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise retry.TypedError("network")
        return "done"

    assert retry.retry(call, retry.RetryPolicy(jitter=False), waits.append) == "done" and waits == [1.0, 2.0]
    for error in (retry.TypedError("network", retryable=False), retry.TypedError("permanent"), ValueError("x")):
        calls.clear()

        def fails(e=error):
            calls.append(1)
            raise e

        with pytest.raises(type(error)):
            retry.retry(fails, sleep=waits.append)
        assert len(calls) == 1
    calls.clear()

    def never():
        calls.append(1)
        raise retry.TypedError("transient")

    with pytest.raises(retry.TypedError):
        retry.retry(never, retry.RetryPolicy(attempts=4), waits.append)
    assert len(calls) == 4
    assert math.isclose(retry.RetryPolicy().delay(9, 0.0), 31.5)


def test_sources(spark, tmp_path, monkeypatch):
    (tmp_path / "t/sub").mkdir(parents=True)
    (tmp_path / "t/a.py").write_bytes(b"x = 1\n")
    (tmp_path / "t/sub/b.py").write_bytes(b"\xff\n")
    (tmp_path / "t/c.txt").write_bytes(b"")
    got = {r.file_path.rsplit("/", 1)[1]: (r.size, r.content) for r in tables.file_tree(spark, str(tmp_path / "t"), "*.py").collect()}
    assert got == {"a.py": (6, "x = 1\n"), "b.py": (2, "�\n")}
    (tmp_path / "gpu.csv").write_text("card 0, 35, 12, 2048, 24576, 61\n")
    r = tables.gpu_csv(spark, str(tmp_path / "gpu.csv")).first()
    assert r.name == "card 0" and r.mem_total == 24576 and r.temperature == 61
    tables.write_curve(spark.createDataFrame([(2, 0.5), (1, 0.75)], "step long, loss double"), str(tmp_path / "curve"))
    assert [tuple(x) for x in tables.curve_csv(spark, str(tmp_path / "curve")).collect()] == [(1, 0.75), (2, 0.5)]
    (tmp_path / "x.log").write_text("one\ntwo\n")
    lines = tables.log_lines(spark, str(tmp_path / "x.log")).collect()
    assert [x.line for x in lines] == ["one", "two"] and lines[0].file_path.endswith("x.log")
    (tmp_path / "secret").write_text("word\n")
    for k, v in {"DB_HOST": "h", "DB_PORT": "", "DB_NAME": "n", "DB_USER": "u", "DB_PASSWORD_FILE": str(tmp_path / "secret")}.items():
        monkeypatch.setenv(k, v)
    assert tables.jdbc_options() == {"url": "jdbc:postgresql://h:5432/n", "user": "u", "password": "word"}


def test_scalars(spark):
    one = lambda sql, f: spark.sql(f"SELECT {sql} AS x").select(f(F.col("x"))).first()[0]
    assert one("125.9D", S.elapsed_mmss) == "02:05" and one("0.5D", S.percent) == "50.00%" and one("TIMESTAMP '2024-01-02 03:04:05'", S.rfc3339) == "2024-01-02T03:04:05Z"
    assert one("'  a  b c '", lambda x: S.field(x, 2)) == "b" and one("'a'", lambda x: S.field(x, 2)) is None
    assert [one(v, lambda x: S.alternative(x, "d")) for v in ("NULL", "'false'", "'null'", "''", "'x'")] == ["d", "d", "d", "", "x"]
    assert abs((one("1", lambda _: S.now()) - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 600


def test_markup(spark):
    page = "<html><head><title> A &amp; b </title><style>p{}</style></head><body><p class=x>One <b>two</b>&nbsp;&lt;3</p><a href='/x?y=1'>l</a><A HREF=z>m</A><!-- no --><script>var a = '<p>';</script></body></html>"
    r = spark.createDataFrame([(page,), ("",), (None,)], "p string").select(markup.html_title(F.col("p")), markup.html_links(F.col("p")), markup.html_text(F.col("p"))).collect()
    assert r[0][0] == "A &amp; b" and r[0][1] == ["/x?y=1", "z"] and r[0][2] == "A & b One two <3 l m" and r[1][2] == "" and r[2][2] is None


def test_search(spark):
    d = spark.createDataFrame([(1, "The cache. cache_x CACHE"), (2, "caches"), (3, "a.b retry/cache"), (4, None), (5, "")], "id int, text string")
    assert [(r.id, r.hits) for r in logs.search(d, "text", ["cache", "retry"], 5, "id").collect()] == [(1, 2), (3, 2)]


def test_append_sink(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame(list(x), "id int, hash string")
    assert mutate.append_new(spark, path, rows((2, "a"), (1, "a"), (3, "b")), ["hash"], ["id"]) == 2
    assert mutate.append_new(spark, path, rows((4, "a"), (5, "c"), (6, None)), ["hash"], ["id"]) == 2
    assert mutate.append_new(spark, path, rows((7, "c")), ["hash"], ["id"]) == 0
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 5, 6]


def test_touch(spark):
    before = spark.createDataFrame([(1, None, "old"), (2, "b", "old"), (3, "c", "old")], "id int, v string, updated_at string")
    after = spark.createDataFrame([(1, None, "old"), (2, None, "old"), (3, "c", "old"), (4, "d", "own")], "id int, v string, updated_at string")
    assert {r.id: r.updated_at for r in mutate.touch(before, after, "id", F.lit("new")).collect()} == {1: "old", 2: "new", 3: "old", 4: "own"}


def test_last_write_wins(spark):
    empty = spark.createDataFrame([], "key string, value string, expires_at timestamp_ntz")
    e = spark.createDataFrame([("k", (9,), 1), ("k", (2,), 2)], "key string, doc struct<n:int>, seq int")
    now = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    assert kvcache.get(kvcache.put(empty, e, now, 60, "seq"), "k", "n int", now).first().doc.n == 2


def test_key_violations(spark):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (3, None)], "id int, k string")
    assert sorted(tuple(r) for r in mutate.key_violations(d, "t", ["id", "k"]).collect()) == [("t", "id", 1, 2), ("t", "k", 1, 1)]
    assert sorted(tuple(r) for r in mutate.key_violations(d.limit(0), "t", ["id", "k"]).collect()) == [("t", "id", 0, 0), ("t", "k", 0, 0)]


def test_cursor_batches(spark):
    f = spark.createDataFrame([(k, 70 + k % 5) for k in range(1, 101)] + [(200, None)], "id int, quality_score int")
    models = [(f"m{k}", k) for k in range(0, 99)] + [("none", None), ("end", 500), ("again", 50)]
    got = {r.model_name: (r.new_files, r.cursor, r.best) for r in rollups.cursor_batches(f, spark.createDataFrame(models, "model_name string, last_trained_id long")).collect()}
    assert got == {m: (100 - c + 1, 200, 74 if c < 99 else None) for m, c in models if c is not None and c < 200} | ({"m98": (3, 200, 74)} if True else {})
    assert rollups.cursor_batches(f, spark.createDataFrame([("x", None)], "model_name string, last_trained_id long")).count() == 0


def test_observed_and_spans(spark, tmp_path):
    df, seen = listener.observed(spark.range(10), "ten", most=F.max("id"))
    assert df.count() == 10 and seen.get == {"rows": 10, "most": 9}
    spans = listener.Spans("s", keep=50)
    spark.streams.addListener(spans)
    try:
        spark.range(3).write.parquet(str(tmp_path / "in"))
        q = jobs.file_stream(spark, str(tmp_path / "in"), "id long").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(50):
            if any(r["what"] == "end" for r in spans.rows):
                break
            import time

            time.sleep(0.2)
    finally:
        spark.streams.removeListener(spans)
    assert {r["what"] for r in spans.rows} >= {"start", "progress", "end"} and sum(r.get("rows", 0) for r in spans.rows) == 3


def test_an_epoch_is_not_handed_over_twice(spark, tmp_path):
    """The stream is stopped after the hand-over and before its own commit, and started again."""
    src, spill, check = str(tmp_path / "in"), str(tmp_path / "wait"), tmp_path / "cp"
    got = []
    handle = lambda df, n: got.append((n, sorted(r.id for r in df.collect())))

    def go():
        jobs.cursor_batches(jobs.file_stream(spark, src, "id int"), handle, str(check), spill, min_new=2).start().awaitTermination()

    spark.createDataFrame([(1,), (2,)], "id int").coalesce(1).write.mode("append").parquet(src)
    go()
    for f in (check / "commits").glob("*0"):  # the commit of the epoch is lost
        f.unlink()
    for f in (check / "commits").glob(".*0.crc"):
        f.unlink()
    spark.createDataFrame([(3,), (4,), (5,)], "id int").coalesce(1).write.mode("append").parquet(src)
    go()
    assert got == [(0, [1, 2]), (1, [3, 4, 5])]
