"""Running counters of a streaming query."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "event_counts"
REPORT_SECONDS = 5

log = logging.getLogger(__name__)


def with_counters(parsed: DataFrame) -> DataFrame:
    """Observe good and bad rows while they pass, at no extra scan."""
    return parsed.observe(
        METRICS,
        F.count_if(F.col("error").isNull()).alias("events"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
    )


class ThroughputListener(StreamingQueryListener):
    """Totals, errors, events per second and uptime over all observed micro-batches."""

    def __init__(self, report_seconds: float = REPORT_SECONDS, clock=time.monotonic):
        self.clock, self.report_seconds = clock, report_seconds
        self.started = self.reported = clock()
        self.total_events = self.total_errors = self.total_rows = 0

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        self.total_rows += event.progress.numInputRows
        seen = event.progress.observedMetrics.get(METRICS)
        if seen is not None:
            self.total_events += seen["events"]
            self.total_errors += seen["errors"]
        if self.clock() - self.reported >= self.report_seconds:
            self.reported = self.clock()
            log.info("%s", self.summary())

    def summary(self) -> dict:
        uptime = self.clock() - self.started
        return {
            "total_events": self.total_events,
            "errors": self.total_errors,
            "events_per_second": self.total_events / max(uptime, 1.0),
            "uptime_seconds": uptime,
        }
