"""A balance of every micro-batch, with the rows that Spark drops behind the watermark.

A stateful operator leaves out rows older than the watermark without a trace in the output. Their number
is in the progress of the stream only, next to what ``observe`` counts on the way; a listener writes
both down, one row per batch, and the two sides must be equal.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.dedup import dedup_events
from tidemark.operators.route import is_valid
from tidemark.schemas import ddl

BALANCE_FIELDS = {
    "batch_id": "bigint",
    "n_in": "bigint",
    "n_invalid": "bigint",
    "n_kept": "bigint",
    "n_copies": "bigint",
    "n_dropped": "bigint",
}
_READ, _KEPT = "read", "kept"
#: The custom metric of the operator that drops copies.
_COPIES = "numDroppedDuplicateRows"


def audited_events(decoded: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Valid events of a stream, each id once, counted before and after.

    Copies are dropped before anything is summed: a sum combines rows before Spark looks at the
    watermark, so the number it reports there is not one of rows.
    """
    valid = is_valid()
    read = decoded.observe(
        _READ, F.count("*").alias("n_in"), F.count_if(~valid).alias("n_invalid")
    )
    once = dedup_events(read.filter(valid), delay=delay)
    return once.observe(_KEPT, F.count("*").alias("n_kept"))


@dataclass
class Balance(StreamingQueryListener):
    """Writes down the counts of `audited_events`, one row per batch that had input.

    The rows are on the driver, a few numbers per batch. The progress comes a little after the batch, so
    `of` waits for the end of a query before it reads.
    """

    rows: dict[tuple[str, int], tuple] = field(default_factory=dict)
    _ended: dict[str, Event] = field(default_factory=dict)

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        read = progress.observedMetrics.get(_READ)
        if read is None or not read.n_in:
            return
        states = progress.stateOperators
        kept = progress.observedMetrics[_KEPT].n_kept
        self.rows[str(progress.id), progress.batchId] = (
            progress.batchId,
            read.n_in,
            read.n_invalid,
            kept,
            sum(s.customMetrics.get(_COPIES, 0) for s in states),
            sum(s.numRowsDroppedByWatermark for s in states),
        )

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event()).set()

    def of(self, spark: SparkSession, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """The balance of a stream, its earlier runs included, once a run of it has ended."""
        if not self._ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} was reported within {seconds} seconds")
        own = [row for (stream, _), row in sorted(self.rows.items()) if stream == str(query.id)]
        return balanced(spark.createDataFrame(own, ddl(BALANCE_FIELDS)))


def balanced(counts: DataFrame) -> DataFrame:
    """Whether every record of a batch is accounted for: in = invalid + kept + copies + dropped."""
    out = F.col("n_invalid") + F.col("n_kept") + F.col("n_copies") + F.col("n_dropped")
    return counts.withColumn("conserved", F.col("n_in") == out)
