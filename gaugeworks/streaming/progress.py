"""Reports on every micro-batch of a query, while it runs."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class BatchReports(StreamingQueryListener):
    """Calls ``report`` with the progress of each batch that observes ``name``.

    A query remembers its latest reports only; a listener hears all of them, in
    either mode. :meth:`finish` waits until the last has been heard, and raises
    what a report failed with.
    """

    def __init__(self, spark: SparkSession, name: str, report: Callable):
        self._spark, self._name, self._report = spark, name, report
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._error: Exception | None = None
        spark.streams.addListener(self)

    def _end_of(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if self._name in event.progress.observedMetrics:
            try:
                self._report(event.progress)
            except Exception as error:  # noqa: BLE001 - raised by finish()
                self._error = error

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(event.runId).set()

    def finish(self, query: StreamingQuery, seconds: float = 300) -> None:
        heard = self._end_of(query.runId).wait(seconds)
        self._spark.streams.removeListener(self)
        if self._error is not None:
            raise self._error
        if not heard:
            raise TimeoutError(f"the end of query {query.runId} was not reported within {seconds} seconds")
