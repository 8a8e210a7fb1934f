"""Figures from streaming progress that lose nothing."""

from __future__ import annotations

import time
from collections import defaultdict
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressCounter(StreamingQueryListener):
    """Rows read and late rows dropped per query, over any number of batches.

    A query itself keeps only its last reports, so the counter has to listen from before the query starts. Counts belong to
    the query's id, which stays the same across restarts from one checkpoint; a batch that is reported twice counts once.
    """

    def __init__(self) -> None:
        self._lock = Lock()
        self._batches: dict[str, dict[tuple[str, int], tuple[int, int]]] = defaultdict(dict)
        self._totals: dict[str, tuple[int, int]] = defaultdict(lambda: (0, 0))

    @classmethod
    def listen(cls, spark: SparkSession) -> ProgressCounter:
        counter = cls()
        spark.streams.addListener(counter)
        return counter

    def records_read(self, query: StreamingQuery) -> int:
        """Rows that the query has read since the counter listens."""
        return self._after_last_report(query)[0]

    def late_rows_dropped(self, query: StreamingQuery) -> int:
        """Rows the watermark turned away, after partial aggregation."""
        return self._after_last_report(query)[1]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = (progress.numInputRows, sum(s.numRowsDroppedByWatermark for s in progress.stateOperators))
        with self._lock:
            key, batches = str(progress.id), self._batches[str(progress.id)]
            run = str(progress.runId)
            # Only the last batch of a run can be reported again, so older ones need not be kept.
            last = batches.get((run, progress.batchId), (0, 0))
            batches.clear()
            batches[(run, progress.batchId)] = tuple(max(a, b) for a, b in zip(last, figures, strict=True))
            self._totals[key] = tuple(
                total + max(0, new - old) for total, new, old in zip(self._totals[key], figures, last, strict=True))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _after_last_report(self, query: StreamingQuery, seconds: float = 10) -> tuple[int, int]:
        """Reports arrive a little after their batch: wait for the last one that the query itself knows."""
        last, end = query.lastProgress, time.monotonic() + seconds
        while last is not None and time.monotonic() < end:
            with self._lock:
                if any(run == str(last.runId) and batch >= last.batchId for run, batch in self._batches[str(query.id)]):
                    break
            time.sleep(0.05)
        with self._lock:
            return self._totals[str(query.id)]
