"""Structured Streaming forms: cursor reader with a gate, windowed rates, alert state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_stream(spark: SparkSession, folder: str, schema, max_files: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def _trigger(every: str | None) -> dict:
    """Of a stream: at an interval such as `30 seconds`, or once over all there is."""
    return {"processingTime": every} if every else {"availableNow": True}


def cursor_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, spill: str, min_new: int = 1000, every: str | None = None) -> DataStreamWriter:
    """Hand over new rows once at least `min_new` have gathered; until then they wait in the folder `spill`.

    Each epoch's rows are written under its number, and each hand-over takes all epochs that none before it took, up to its own;
    its number is written to `spill`/handed after `handle` returns. After a failure an epoch is written again over itself, an epoch
    handed over is not handed over again, and one whose `handle` did not return is repeated with the same number and the same rows, so
    a `handle` that writes by number has every row once. `every`: polling interval; None takes what there is and ends.
    """

    def each(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        try:
            done = spark.read.schema("upto long").json(f"{spill}/handed").agg(F.max("upto")).first()[0]
        except AnalysisException:
            done = None
        done = -1 if done is None else done
        if epoch <= done:
            return
        df.write.mode("overwrite").parquet(f"{spill}/rows/epoch={epoch}")
        waiting = spark.read.parquet(f"{spill}/rows").where((F.col("epoch") > done) & (F.col("epoch") <= epoch))
        if waiting.count() >= min_new:
            handle(waiting.drop("epoch"), epoch)
            spark.range(1).select(F.lit(epoch).cast("long").alias("upto")).coalesce(1).write.mode("append").json(f"{spill}/handed")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**_trigger(every))


def windowed_counts(stream: DataFrame, ts: str, key: str, late: str = "10 minutes", size: str = "5 minutes", step: str | None = None) -> DataFrame:
    """Events and their values by (sliding) window and key, with a watermark for late rows."""
    s = stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    w = F.window("_at", size, step) if step else F.window("_at", size)
    return s.groupBy(w.alias("w"), F.col(key)).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def alert_states(stream: DataFrame, threshold: float, hold_seconds: int, silent_seconds: int | None = None) -> DataFrame:
    """Alerts (name, series, at, state) of a stream (ts, name, series, value): pending while value > threshold, firing once it
    has been so for `hold_seconds`, inactive after. Rows within a batch are taken in time order; NULL values are skipped. With
    `silent_seconds` a series without rows for so long (of processing time) is reported as `silent` and forgotten."""
    timeout = GroupStateTimeout.ProcessingTimeTimeout if silent_seconds else GroupStateTimeout.NoTimeout

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        columns = ["name", "series", "at", "state"]
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], key[1], pd.Timestamp.now("UTC").tz_localize(None), "silent")], columns=columns)
            return
        since = state.get[0] if state.exists else -1
        ts, values = [], []
        for p in parts:
            p = p.dropna(subset=["value", "ts"])
            ts.append(p["ts"].to_numpy())
            values.append(p["value"].to_numpy())
        at, v = np.concatenate(ts), np.concatenate(values)
        out = []
        for k in np.lexsort((v, at)):
            t = pd.Timestamp(at[k])
            second = int(t.timestamp())
            since = (second if since < 0 else since) if v[k] > threshold else -1
            out.append((key[0], key[1], t, "inactive" if since < 0 else "firing" if second - since >= hold_seconds else "pending"))
        state.update((since,))
        if silent_seconds:
            state.setTimeoutDuration(silent_seconds * 1000)
        yield pd.DataFrame(out, columns=columns)

    typed = stream.select("name", "series", F.col("ts").cast("timestamp").alias("ts"), "value")
    return typed.groupBy("name", "series").applyInPandasWithState(step, "name string, series string, at timestamp, state string", "since long", "append", timeout)
