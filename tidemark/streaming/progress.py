"""Progress of running streams, as they report it."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener

#: Name under which source rows are observed.
CONSUMED = "consumed"


class ConsumptionListener(StreamingQueryListener):
    """Adds up what every query read from its source, and what its watermark left out.

    The counts are those of batches that ended while the listener was registered; what a
    table has consumed since its first batch is stored with its snapshots.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = defaultdict(lambda: {"batches": 0, "rows": 0, "late": 0})

    def totals(self) -> dict[str, dict[str, int]]:
        """Batches, source rows and rows behind the watermark, by query name or id."""
        with self._lock:
            return {name: dict(counts) for name, counts in self._totals.items()}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(CONSUMED)
        with self._lock:
            counts = self._totals[progress.name or str(progress.id)]
            counts["batches"] += 1
            counts["rows"] += observed["rows"] if observed else progress.numInputRows
            counts["late"] += sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
