"""What runs report of themselves: observed batch metrics and the progress of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """`df` with metrics that come for free with the first action on it: rows, and any aggregates given by name."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items())), seen


class Spans(StreamingQueryListener):
    """Start, progress and end of each stream of a service, as plain rows; the last `keep` stay."""

    def __init__(self, service: str, keep: int = 1000):
        self.service, self.keep, self.rows = service, keep, []

    def _add(self, **row) -> None:
        self.rows.append({"service": self.service} | row)
        del self.rows[: -self.keep]

    def onQueryStarted(self, event) -> None:
        self._add(what="start", query=str(event.id), at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(what="progress", query=str(p.id), at=p.timestamp, batch=p.batchId, rows=p.numInputRows, milliseconds=p.batchDuration)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(what="end", query=str(event.id), error=event.exception)
