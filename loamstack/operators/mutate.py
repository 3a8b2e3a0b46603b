"""Insert, update and uniqueness: the write side as pure DataFrame steps."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in `order`; rows with a NULL in the key are no conflict and all stay.

    Planned with a partial limit before the shuffle, so a key that holds a third of all rows sends one row a task.
    """
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    w = Window.partitionBy(*key).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return df.where(~null).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn").unionByName(df.where(null))


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The rows that an insert with ON CONFLICT DO NOTHING adds: first of each key, keys already there left out."""
    return first_per_key(incoming, key, order).join(existing.select(*key), key, "left_anti").select(*incoming.columns)


def conflicts(df: DataFrame, key: str, identifier: str) -> DataFrame:
    """Keys delivered more than once: the surviving identifier and the number of rows ignored."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(identifier).alias("kept_id"), (F.count("*") - 1).alias("ignored")).where("ignored > 0")


def update_by_key(target: DataFrame, updates: DataFrame, key: str, columns: list[str], stamp: str | None = None, as_of: Column | None = None) -> DataFrame:
    """`target` with `columns` taken from `updates` (unique `key`) where one matches; `stamp` is set to `as_of` on those rows."""
    new = updates.select(F.col(key), F.struct(*columns).alias("_new"))
    out = target.join(new, key, "left")
    hit = F.col("_new").isNotNull()
    cols = {c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns}
    if stamp:
        cols[stamp] = F.when(hit, as_of).otherwise(F.col(stamp))
    return out.withColumns(cols).select(*target.columns)


def orphans(child: DataFrame, parent: DataFrame, foreign: str, primary: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    return child.where(F.col(foreign).isNotNull()).join(parent.select(F.col(primary).alias(foreign)), foreign, "left_anti").select(*child.columns)


def key_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of values that occur more than once, for each column that should be unique: one scan, all columns counted together."""
    each = df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys))).alias("e")).select("e.*")
    n = each.where("v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    one = n.agg(*(a for k in keys for a in (F.count_if(F.col("k") == k).alias(f"r_{k}"), F.coalesce(F.sum(F.when(F.col("k") == k, F.col("n") - 1)), F.lit(0)).cast("long").alias(f"s_{k}"))))
    rows = F.explode(F.array(*(F.struct(F.lit(table).alias("table_name"), F.lit(k).alias("key_name"), F.col(f"r_{k}").alias("repeated_values"), F.col(f"s_{k}").alias("surplus_rows")) for k in keys)))
    return one.select(rows.alias("e")).select("e.*")


def append_new(spark, path: str, incoming: DataFrame, key: list[str], order: list[str]) -> int:
    """The append sink of an insert that ignores conflicts: rows of `incoming` with new keys are added to the Parquet table at `path`.

    Returns how many. A missing table is begun. Run one writer at a time: Parquet has no lock.
    """
    try:
        existing = spark.read.parquet(path).select(*key)
    except AnalysisException:
        existing = incoming.select(*key).limit(0)
    rows = insert_ignore(existing, incoming, key, order)
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def touch(before: DataFrame, after: DataFrame, key: str, as_of: Column, stamp: str = "updated_at") -> DataFrame:
    """`after` with `stamp` set to `as_of` on the rows that differ from `before` in any other column, as an update trigger does."""
    others = [c for c in after.columns if c not in (key, stamp)]
    old = before.select(F.col(key), F.struct(*others).alias("_old"))
    changed = F.col("_old").isNotNull() & ~F.struct(*others).eqNullSafe(F.col("_old"))
    return after.join(old, key, "left").withColumn(stamp, F.when(changed, as_of).otherwise(F.col(stamp))).select(*after.columns)
