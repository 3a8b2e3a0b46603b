"""Counters, gauges, bounded histograms, rates and alerts over long-format samples (ts, kind, name, labels, value)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamstack.functions.scalars import ntz_micros, ntz_time, series_key


def samples(df: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Distinct samples with their series; repeated deliveries of one sample count once. `labels`: only series with these values."""
    for k, v in (labels or {}).items():
        df = df.where(F.col("labels")[k] == v)
    return df.select("ts", "kind", "name", series_key(F.col("labels")).alias("series"), "value").distinct()


def counter_totals(s: DataFrame) -> DataFrame:
    """Sum of the deltas of each counter name."""
    return s.where("kind = 'counter'").groupBy("name").agg(F.round(F.sum("value"), 4).alias("total"), F.count("*").alias("n"))


def gauge_latest(s: DataFrame) -> DataFrame:
    """Last value written of each gauge series; of equal times the greatest value."""
    return s.where("kind = 'gauge' AND value IS NOT NULL").groupBy("name", "series").agg(F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("last_ts"))


def histogram_window(s: DataFrame, keep: int = 1000) -> DataFrame:
    """The last `keep` observations of each histogram (per-task limit before the shuffle) and what they hold."""
    w = Window.partitionBy("name").orderBy(F.desc("ts"), F.desc("value"), F.desc("series"))
    kept = s.where("kind = 'histogram' AND value IS NOT NULL").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= keep)
    return kept.groupBy("name").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.sum("value"), 4).alias("total"))


def snapshot(s: DataFrame) -> DataFrame:
    """Rows `metric` and `value` of a text exposition."""
    c = counter_totals(s).select(F.col("name").alias("metric"), F.col("total").alias("value"))
    g = s.where("kind = 'gauge' AND value IS NOT NULL").groupBy("name").agg(F.max_by("value", F.struct("ts", "value", "series")).alias("value")).select(F.col("name").alias("metric"), "value")
    h = histogram_window(s).select(F.concat("name", F.lit("_count")).alias("metric"), F.col("n").cast("double").alias("value"))
    return c.unionByName(g).unionByName(h)


def exposition(s: DataFrame) -> DataFrame:
    """Sorted text lines `name value`, for write.text."""
    return snapshot(s).select(F.format_string("%s %.2f", "metric", "value").alias("line")).orderBy("line")


def increases(s: DataFrame) -> DataFrame:
    """Growth of each counter sample over the one before; after a reset the whole value counts."""
    w = Window.partitionBy("name", "series").orderBy("ts", "value")
    before = F.lag("value").over(w)
    return s.where("kind = 'counter' AND value IS NOT NULL").withColumn("inc", F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before))


def rate_simple(s: DataFrame, seconds: int = 300) -> DataFrame:
    """Growth in the trailing window over its length, at each sample; no extrapolation to the window's edges."""
    w = Window.partitionBy("name", "series").orderBy(ntz_micros(F.col("ts"))).rangeBetween(-seconds * 1_000_000, 0)
    return increases(s).select("ts", "name", "series", "value", F.round(F.sum("inc").over(w) / seconds, 6).alias("rate"))


def grid(s: DataFrame, step_seconds: int = 30) -> DataFrame:
    """Last value of every series in each evaluation step, stamped with the step's end."""
    us = step_seconds * 1_000_000
    end = ntz_time((F.floor(ntz_micros(F.col("ts")) / us) + 1) * us)
    return s.where("value IS NOT NULL").groupBy("kind", "name", "series", end.alias("step_end")).agg(F.max_by("value", F.struct("ts", "value")).alias("value"))


STEP, LOOKBACK = 30, 300


def evaluations(s: DataFrame, step: int = STEP, lookback: int = LOOKBACK) -> DataFrame:
    """(name, series, at, value) at every evaluation step: a sample holds until the next one, for `lookback` seconds at most.

    `at` is in seconds since 1970. A series that falls silent has no value once the look-back is over. Each sample gives at most
    lookback / step rows, whatever the table's size.
    """
    us, most = step * 1_000_000, lookback // step
    p = s.where("value IS NOT NULL").groupBy("name", "series", (F.floor(ntz_micros(F.col("ts")) / us) + 1).alias("k")).agg(F.max_by("value", F.struct("ts", "value")).alias("value"))
    nxt = F.lead("k").over(Window.partitionBy("name", "series").orderBy("k"))
    p = p.withColumn("n", F.least(F.coalesce(nxt - F.col("k"), F.lit(most)), F.lit(most)))
    return p.select("name", "series", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n").cast("bigint") - 1), lambda x: (F.col("k") + x) * step)).alias("at"), "value")


@dataclass(frozen=True)
class Rule:
    """An alert: `metric` (over `divisor` where given; its rate where `rate`; the time since it where `age`) compared with `bound`
    on the series with `labels`, for `hold` seconds without a break."""

    alert: str
    metric: str
    op: str
    bound: float
    hold: int
    divisor: str | None = None
    rate: bool = False
    age: bool = False
    labels: dict[str, str] = field(default_factory=dict)


def evaluate(df: DataFrame, rule: Rule, step: int = STEP) -> DataFrame:
    """(alert, series, at, since, value) of every step at which the rule fires, from raw samples (ts, kind, name, labels, value).

    A comparison that fails drops the step, as a missing value does: both end the time for which the alert has held.
    """
    s = samples(df.where(F.col("name").isin(*filter(None, (rule.metric, rule.divisor)))), rule.labels)
    if rule.rate:
        s = rate_simple(s).select("ts", F.lit("rate").alias("kind"), "name", "series", F.col("rate").alias("value"))
    e = evaluations(s, step)
    v = e.where(F.col("name") == rule.metric).select("series", "at", "value")
    if rule.divisor:
        d = e.where(F.col("name") == rule.divisor).select("series", "at", F.col("value").alias("divisor"))
        v = v.join(d, ["series", "at"]).select("series", "at", F.try_divide("value", "divisor").alias("value"))
    if rule.age:
        v = v.withColumn("value", F.col("at") - F.col("value"))
    met = v.where({">": F.col("value") > rule.bound, "<": F.col("value") < rule.bound, "==": F.col("value") == rule.bound}[rule.op])
    w = Window.partitionBy("series").orderBy("at")
    met = met.withColumn("island", F.col("at") - step * F.row_number().over(w))
    met = met.withColumn("since", F.min("at").over(Window.partitionBy("series", "island")))
    return met.where(F.col("at") - F.col("since") >= rule.hold).select(F.lit(rule.alert).alias("alert"), "series", "at", "since", F.round("value", 6).alias("value"))


def silent(s: DataFrame, name: str, seconds: int, as_of: Column) -> DataFrame:
    """Series of a metric without a sample in the last `seconds` before `as_of`, with the time of their last one."""
    last = s.where(F.col("name") == name).groupBy("name", "series").agg(F.max("ts").alias("last_ts"))
    return last.where(ntz_micros(as_of) - ntz_micros(F.col("last_ts")) > seconds * 1_000_000)


def firing(points: DataFrame, condition: Column, hold_seconds: int, keys: list[str]) -> DataFrame:
    """Steps at which `condition` has held without a break for at least `hold_seconds`: (keys, step_end, since).

    `points` has a row a step; NULL conditions count as not met, and a missing step does not break an island.
    """
    met = F.coalesce(condition, F.lit(False))
    w = Window.partitionBy(*keys).orderBy("step_end")
    p = points.withColumn("_met", met).withColumn("_island", F.sum(F.when(F.col("_met"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    p = p.where("_met").withColumn("since", F.min("step_end").over(Window.partitionBy(*keys, "_island")))
    held = ntz_micros(F.col("step_end")) - ntz_micros(F.col("since"))
    return p.where(held >= hold_seconds * 1_000_000).select(*keys, "step_end", "since")


def ratio(points: DataFrame, top: str, bottom: str) -> DataFrame:
    """One-to-one match of two metrics on step and series; a zero divisor gives NULL."""
    a = points.where(F.col("name") == top).select("step_end", "series", F.col("value").alias("a"))
    b = points.where(F.col("name") == bottom).select("step_end", "series", F.col("value").alias("b"))
    return a.join(b, ["step_end", "series"]).select("step_end", "series", F.round(F.try_divide("a", "b"), 6).alias("ratio"))


def staleness(s: DataFrame, name: str, as_of: Column) -> DataFrame:
    """Seconds between `as_of` and the last value of a gauge that holds epoch seconds."""
    g = gauge_latest(s.where(F.col("name") == name))
    return g.select("name", "series", F.round(F.floor(ntz_micros(as_of) / 1_000_000) - F.col("value"), 3).alias("seconds"))
