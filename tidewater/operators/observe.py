"""Inspection without per-row logging: named metrics observed on the data as it flows.

``observed(df, name)`` is an identity on rows; after an action the counts are
in ``metrics(name)``. Cheap: metrics are aggregated in the same tasks.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_OBSERVATIONS: dict[str, Observation] = {}


def observed(df: DataFrame, name: str, *extra: Column) -> DataFrame:
    obs = Observation(name)
    _OBSERVATIONS[name] = obs
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)


def metrics(name: str) -> dict:
    """Metrics of the last action over ``observed(.., name)`` (waits for it)."""
    return _OBSERVATIONS[name].get


class StreamMetrics(StreamingQueryListener):
    """The metrics observed under one name in a running stream, batch by batch.

    Register it with ``spark.streams.addListener``. A batch that reports again (after a restart) replaces what it reported.
    """

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[tuple[str, int], dict] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.batches[str(event.progress.id), event.progress.batchId] = seen.asDict()

    def onQueryTerminated(self, event) -> None:
        pass

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait for the report of a query's last batch: listeners hear of it a moment later."""
        last, until = query.lastProgress, time.monotonic() + seconds
        while last and (str(last["id"]), last["batchId"]) not in self.batches:
            if time.monotonic() > until:
                raise TimeoutError(f"no metrics {self.name} of batch {last['batchId']}")
            time.sleep(0.05)

    def table(self, spark: SparkSession, ddl: str) -> DataFrame:
        """A row per batch: batch_id and the observed metrics named in ``ddl``. Numbers of batches, not of rows, pass the driver."""
        names = [f.split()[0] for f in ddl.split(",")]
        rows = [(batch, *[m[n] for n in names]) for (_, batch), m in sorted(self.batches.items())]
        return spark.createDataFrame(rows, f"batch_id bigint, {ddl}")
