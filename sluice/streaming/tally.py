"""Running tallies of rows by a few known values, read from what Spark observes as a batch or a stream goes by."""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_OTHER = "(other)"


def _counts(by: str, values: Sequence[str]) -> list[Column]:
    named = [F.count_if(F.col(by) == v).alias(v) for v in values]
    return [*named, F.count_if(F.col(by).isNull() | ~F.col(by).isin(*values)).alias(_OTHER)]


def observed(df: DataFrame, name: str, by: str, values: Sequence[str]) -> DataFrame:
    """df with its rows counted by the values of a column as they go by; all others, null too, count as '(other)'.

    No pass of its own: counts are taken where the rows are read or written. Tallies reads them for a stream.
    """
    return df.observe(name, *_counts(by, values))


def observed_batch(df: DataFrame, by: str, values: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The same for a batch; ``.get`` of the second has the counts once an action over the first has ended."""
    seen = Observation()
    return df.observe(seen, *_counts(by, values)), seen


class Tallies(StreamingQueryListener):
    """Sums of what streams observed under a name: add it with spark.streams.addListener().

    A micro-batch counts once by its query and number, also when its progress is told again.
    """

    def __init__(self, name: str):
        self.name, self._seen, self._lock = name, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                key = (str(event.progress.id), event.progress.batchId)
                self._seen[key] = max(self._seen.get(key, Counter()), Counter(row.asDict()), key=lambda c: c.total())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, rows: int, seconds: float = 60) -> dict[str, int]:
        """Counts as soon as so many rows were told of, since progress is told a little later; what there is after ``seconds``."""
        end = time.monotonic() + seconds
        while sum(self.counts().values()) < rows and time.monotonic() < end:
            time.sleep(0.05)
        return self.counts()

    def counts(self) -> dict[str, int]:
        """Rows by value so far."""
        with self._lock:
            return dict(sum(self._seen.values(), Counter()))
