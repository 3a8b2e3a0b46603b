import random

import pytest
from pyspark.sql import functions as F

from loamstack.llm import radix_cap
from loamstack.llm.radix_cap import cap_contributors

SCHEMA = "who string, score int, id int, _who string, _left int, count int"


def brute(rows, k):
    kept = []
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for g in by.values():
        g.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, r[2] or 0))
        kept += g[:k]
    return kept


def random_rows(n, seed):
    r = random.Random(seed)
    return [(r.choice(["a", "a", "a", "b", None, "c"]), r.choice([None, -3, 0, 1, 1, 99, 300, -70000]), i * r.choice([1, -1]), "x", 1, 2) for i in range(n)]


@pytest.mark.parametrize("seed,k,most", [(1, 3, 100), (3, 0, 100), (2, 5, 1)])
def test_equals_sorting(spark, monkeypatch, seed, k, most):
    monkeypatch.setattr(radix_cap, "BROADCAST_ROWS", most)
    rows = random_rows(300, seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in cap_contributors(df, F.col("who"), "score", "id", max_count=k).collect()]
    out = [tuple(r) for r in cap_contributors(df, F.col("who"), "score", "id", max_count=k, left_out=True).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, k)))
    assert sorted(map(str, got + out)) == sorted(map(str, rows))


def test_repeated_rows(spark):
    df = spark.createDataFrame([("a", 5, 1, "x", 0, 0)] * 10 + [("a", 5, 1, "y", 0, 0)] * 3 + [("a", 4, 2, "z", 0, 0)], SCHEMA)
    assert cap_contributors(df, F.col("who"), "score", "id", max_count=4).count() == 4
    assert cap_contributors(df, F.col("who"), "score", "id", max_count=4, left_out=True).count() == 10
    same = spark.createDataFrame([("a", None, None, None, None, None)] * 9, SCHEMA)
    assert cap_contributors(same, F.col("who"), "score", "id", max_count=2).count() == 2


def test_share_empty_and_types(spark):
    df = spark.createDataFrame([("a", 1, i, "", 0, 0) for i in range(8)] + [("b", 1, 9, "", 0, 0), ("c", 1, 10, "", 0, 0)], SCHEMA)
    assert cap_contributors(df, F.col("who"), "score", "id", max_share=0.5).count() == 7
    assert cap_contributors(df.limit(0), F.col("who"), "score", "id", max_count=1).count() == 0
    with pytest.raises(TypeError):
        cap_contributors(df, F.col("who"), "who", "id", max_count=1)
    with pytest.raises(ValueError):
        cap_contributors(df, F.col("who"), "score", "id")


def test_extreme_values(spark):
    big = 2**63 - 1
    rows = [("a", s, i) for s in (big, -big - 1, 0, None) for i in (big, -big - 1, None, 5)]
    df = spark.createDataFrame(rows, "who string, score long, id long")
    got = {(r.score, r.id) for r in cap_contributors(df, F.col("who"), "score", "id", max_count=6).collect()}
    assert got == {(big, x) for x in (-big - 1, 5, big, None)} | {(0, -big - 1), (0, 5)}
