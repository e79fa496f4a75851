"""Progress of running streams (R1): what each trigger did, for tests and reports."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass
class Batch:
    """One micro-batch: when it was triggered (ISO time), its rows and duration."""
    batch_id: int
    started: str
    input_rows: int
    millis: int


@dataclass
class BatchLog(StreamingQueryListener):
    """Collects the micro-batches of the queries of one session by their run id.

    ``spark.streams.addListener(log)``; triggers without input are left out."""
    batches: dict[str, list[Batch]] = field(default_factory=dict)
    ended: dict[str, str | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self.batches.setdefault(str(event.runId), [])

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            with self._lock:
                self.batches.setdefault(str(p.runId), []).append(
                    Batch(p.batchId, p.timestamp, p.numInputRows, int(p.durationMs.get("triggerExecution", 0))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self.ended[str(event.runId)] = event.exception

    def of(self, run_id) -> list[Batch]:
        with self._lock:
            return list(self.batches.get(str(run_id), []))
