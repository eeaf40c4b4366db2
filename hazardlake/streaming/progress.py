"""What running streams report, as rows of a table, and streams that start again after a failure."""

from __future__ import annotations

import datetime
import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from hazardlake.streaming.sinks import run_continuously

SCHEMA = (
    "at timestamp, query_id string, run_id string, event string, batch_id bigint, n_input bigint, n_dropped bigint,"
    " n_state bigint, watermark string, duration_ms bigint, problem string"
)


class ProgressLog(StreamingQueryListener):
    """Appends starts, micro-batches and ends of the session's streams to the table at ``path``.

    ``event`` is started, batch, failed or stopped. ``n_dropped`` counts what the watermark turned away: for a windowed
    aggregate the late groups of a micro-batch, for other stateful steps its late rows. A second start of one
    ``query_id`` is a restart. Rows are held back until ``every`` of them are there or a stream ends.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self._spark, self._path, self._every = spark, path, every
        self._waiting: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self._spark.streams.removeListener(self)
        self.flush()

    def _add(self, event: object, kind: str, *values: object) -> None:
        padded = [*values, *[None] * (7 - len(values))]
        now = datetime.datetime.now(datetime.timezone.utc)
        with self._changed:
            self._waiting.append((now, str(event.id), str(event.runId), kind, *padded))

    def onQueryStarted(self, event) -> None:
        self._add(event, "started")

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        state = progress.stateOperators
        self._add(
            progress,
            "batch",
            progress.batchId,
            progress.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in state),
            sum(s.numRowsTotal for s in state),
            dict(progress.eventTime).get("watermark"),
            progress.batchDuration,
        )
        if len(self._waiting) >= self._every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(event, "failed" if event.exception else "stopped", *[None] * 6, event.exception)
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self) -> None:
        with self._changed:
            rows, self._waiting = self._waiting, []
            if rows:
                self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self._path)

    def wait_for(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Until the end of a run is recorded: reports come a little after the run itself."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"no end of run {query.runId} within {timeout} s")

    def table(self) -> DataFrame:
        self.flush()
        return self._spark.read.schema(SCHEMA).parquet(self._path)


def run_supervised(
    start: Callable[[], DataStreamWriter],
    every: str,
    restarts: int = 3,
    until: Callable[[StreamingQuery], bool] = lambda query: False,
    poll: float = 1.0,
) -> StreamingQuery:
    """Run a stream continuously and start it again from its checkpoint when it fails.

    ``start`` builds the writer anew. More than ``restarts`` failures without a finished micro-batch between them are
    raised. The stream is stopped when ``until`` holds, which is asked every ``poll`` seconds; returns the last run.
    """
    failures = 0
    while True:
        query = run_continuously(start(), every)
        try:
            while not query.awaitTermination(poll):
                if until(query):
                    query.stop()
            return query
        except StreamingQueryException:
            failures = 1 if query.lastProgress else failures + 1
            if failures > restarts:
                raise
