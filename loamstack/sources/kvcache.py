"""A key -> JSON document table with expiry: get, set, delete, exists and glob delete as pure DataFrame steps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def put(cache: DataFrame, entries: DataFrame, as_of: Column, ttl_seconds: int = 3600, order: str | None = None) -> DataFrame:
    """`cache(key, value, expires_at)` with `entries(key, doc struct)` set. Of a repeated key the last write in `order`, a column of
    `entries`, is kept; without one the keys must differ, else which of them is last is open."""
    last = F.col(order) if order else F.lit(0)
    new = entries.select("key", F.to_json("doc").alias("value"), last.alias("_o")).groupBy("key").agg(F.max_by("value", "_o").alias("value"))
    new = new.withColumn("expires_at", as_of + F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return cache.join(new, "key", "left_anti").unionByName(new)


def get(cache: DataFrame, key: str, schema: str, as_of: Column) -> DataFrame:
    """The live document under `key`, parsed; no row where it is missing or expired."""
    return cache.where((F.col("key") == key) & (F.col("expires_at") > as_of)).select(F.from_json("value", schema).alias("doc"))


def exists(cache: DataFrame, key: str, as_of: Column) -> bool:
    return not cache.where((F.col("key") == key) & (F.col("expires_at") > as_of)).limit(1).isEmpty()


def delete(cache: DataFrame, key: str) -> DataFrame:
    return cache.where(~F.col("key").eqNullSafe(key))


def glob_regex(pattern: str) -> str:
    """Redis-style glob (`*`, `?`, `[...]`) as an anchored regular expression."""
    out = "".join({"*": ".*", "?": "."}.get(x, x if x[0] == "[" else re.escape(x)) for x in re.findall(r"\[[^\]]*\]|.", pattern, re.S))
    return f"(?s)^{out}$"


def clear(cache: DataFrame, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(what stays, one row with the number removed)."""
    hit = F.coalesce(F.col("key").rlike(glob_regex(pattern)), F.lit(False))
    return cache.where(~hit), cache.agg(F.count_if(hit).alias("removed"))
