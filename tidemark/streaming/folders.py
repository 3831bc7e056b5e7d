"""Tables on plain parquet that grow by one folder per micro-batch, and the record of what is finished.

A batch counts once its finished mark is there. The mark is the last thing a batch writes, for all
tables of a job at once, so a reader sees whole batches or nothing; before a batch is written again
after a crash, its mark is taken back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rows import last_per_key
from tidemark.streaming.sinks import read_batches, write_batch

NONE = -1


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A parquet folder, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class CommitLog:
    """Which micro-batch of a job is the newest finished one, with one value kept beside it.

    Two marks of one row take turns, so the last finished one is there while the next is written.
    """

    path: str

    def _marks(self, spark: SparkSession) -> dict[int, tuple[int, bool, int | None]]:
        """slot -> (batch, finished, high in microseconds); two rows at most."""
        schema = "batch_id BIGINT, finished BOOLEAN, high TIMESTAMP, slot INT"
        marks = read_if_there(spark, self.path, schema)
        if marks is None:
            return {}
        rows = marks.select("slot", "batch_id", "finished", F.unix_micros("high").alias("micros"))
        return {r.slot: (r.batch_id, r.finished, r.micros) for r in rows.collect()}

    def newest(self, spark: SparkSession) -> int:
        """The newest finished batch, or `NONE`."""
        return max((b for b, finished, _ in self._marks(spark).values() if finished), default=NONE)

    def high(self, spark: SparkSession, batch_id: int) -> int | None:
        """The value kept with a batch that is one of the two last, in microseconds."""
        return next((m for b, _, m in self._marks(spark).values() if b == batch_id), None)

    def prepare(self, spark: SparkSession) -> None:
        """Write a mark of no batch into a new folder, so that readers find one."""
        unfinished = _mark_row(spark, NONE, finished=False)
        unfinished.write.mode("ignore").parquet(f"{self.path}/slot=0")

    def begin(self, spark: SparkSession, batch_id: int) -> int:
        """To be called before a batch writes anything; the slot for its mark.

        A stream that starts anew on the tables of another one would replace or repeat its rows, so
        a batch below the newest finished one is refused. Writing the newest batch again is a replay
        after a crash: its mark is taken back first.
        """
        self.prepare(spark)
        marks = self._marks(spark)
        newest = max((b for b, finished, _ in marks.values() if finished), default=NONE)
        if batch_id < newest:
            raise ValueError(
                f"{self.path} holds batches up to {newest}; batch {batch_id} belongs to another "
                "stream: keep its checkpoint, or use a new folder"
            )
        own = [slot for slot, (batch, _, _) in marks.items() if batch == batch_id]
        oldest = sorted({0, 1}, key=lambda slot: marks.get(slot, (NONE - 1,))[0])
        slot = (own or oldest)[0]
        self._mark(spark, slot, batch_id, finished=False)
        return slot

    def finish(
        self, spark: SparkSession, batch_id: int, slot: int, high: DataFrame | None = None
    ) -> None:
        """Make a batch count; ``slot`` is what `begin` gave. ``high`` is one row with the value to keep."""
        self._mark(spark, slot, batch_id, finished=True, high=high)

    def _mark(self, spark, slot: int, batch_id: int, finished: bool, high: DataFrame | None = None) -> None:
        row = _mark_row(spark, batch_id, finished, high)
        row.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")


def _mark_row(
    spark: SparkSession, batch_id: int, finished: bool, high: DataFrame | None = None
) -> DataFrame:
    if high is None:
        high = spark.range(1).select(F.lit(None).cast("timestamp").alias("high"))
    return high.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(finished).alias("finished"), "high"
    )


@dataclass(frozen=True)
class BatchTable:
    """Rows below ``path`` with their ``batch_id``; ``commits`` says which batches count.

    A batch costs what it brings. `fold` replaces the batches up to one by a smaller base, so that
    reading does not grow with the number of batches; their folders can then be removed. Rows that are
    kept as they are stand ``apart``: each fold adds a base of its own and writes only what came since.
    """

    path: str
    fields: Mapping[str, str]
    commits: CommitLog
    apart: bool = False

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Write one micro-batch that `CommitLog.begin` let pass; running it again replaces its folder.

        A batch that is folded here is below the newest finished one, so it does not get this far.
        """
        unfolded = _folded_mark(rows.sparkSession, NONE)
        unfolded.write.mode("ignore").parquet(f"{self.path}/folded/marker={NONE}")
        write_batch(rows.select(*self.fields), f"{self.path}/batches", batch_id)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The base, if there is one, and all newer finished batches (up to one, if given).

        The bounds are literals on the partition column, so folders outside them are not listed for
        reading.
        """
        newest = self.commits.newest(spark) if upto is None else upto
        if newest == NONE:
            return spark.createDataFrame([], read_schema(self.fields))
        folded = self._folded_up_to(spark)
        batches = read_batches(spark, f"{self.path}/batches", self.fields).filter(
            F.col("batch_id").between(folded + 1, newest)
        )
        if folded == NONE:
            return batches
        if not self.apart:
            base = spark.read.schema(batches.schema).parquet(f"{self.path}/base/upto={folded}")
            return batches.unionByName(base)
        base = spark.read.schema(f"{read_schema(self.fields)}, upto BIGINT").parquet(f"{self.path}/base")
        marks = spark.read.schema("upto BIGINT").parquet(f"{self.path}/folded")
        whole = base.join(marks, "upto", "left_semi")  # one without its mark was left by a crash
        return batches.unionByName(whole.drop("upto"))

    def fold(
        self,
        spark: SparkSession,
        upto: int,
        reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> None:
        """Write ``reduce`` of all rows up to a batch as the new base, or of those since the last one.

        Only batches before the newest finished one can be folded: that one may still be written again
        after a crash.
        """
        newest = self.commits.newest(spark)
        if upto >= newest:
            raise ValueError(f"{self.path}: cannot fold batch {upto}, the newest finished one is {newest}")
        done = self._folded_up_to(spark)
        if done >= upto:
            return
        rows = self.read(spark, upto)
        if self.apart:
            rows = rows.filter(F.col("batch_id") > done)
        folded = reduce(rows)
        folded.write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")
        _folded_mark(spark, upto).write.mode("overwrite").parquet(f"{self.path}/folded/marker={upto}")

    def _folded_up_to(self, spark: SparkSession) -> int:
        """The newest finished base; its marker is written after the base."""
        marks = read_if_there(spark, f"{self.path}/folded", "upto BIGINT")
        greatest = None if marks is None else marks.agg(F.max("upto")).first()[0]
        return NONE if greatest is None else greatest


def _folded_mark(spark: SparkSession, upto: int) -> DataFrame:
    return spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"))


def read_schema(fields: Mapping[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in {**fields, "batch_id": "bigint"}.items())


@dataclass(frozen=True)
class Versions:
    """Rows of an aggregate in ``update`` mode: the newest version of every row counts."""

    path: str
    fields: Mapping[str, str]
    keys: tuple[str, ...]

    @property
    def table(self) -> BatchTable:
        return BatchTable(f"{self.path}/versions", self.fields, CommitLog(f"{self.path}/finished"))

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        slot = self.table.commits.begin(spark, batch_id)
        self.table.write(rows, batch_id)
        self.table.commits.finish(spark, batch_id, slot)

    def _newest(self, versions: DataFrame) -> DataFrame:
        return last_per_key(versions, list(self.keys), ["batch_id"])

    def current(self, spark: SparkSession) -> DataFrame:
        return self._newest(self.table.read(spark)).drop("batch_id")

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Let one version per row stand for all batches up to a finished one."""
        self.table.fold(spark, upto, self._newest)


@dataclass(frozen=True)
class Snapshots:
    """The whole aggregate in ``complete`` mode. Two folders take turns; the newest finished counts."""

    path: str
    fields: Mapping[str, str]

    @property
    def commits(self) -> CommitLog:
        return CommitLog(f"{self.path}/finished")

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        slot = self.commits.begin(spark, batch_id)
        rows.select(*self.fields).write.mode("overwrite").parquet(self._slot(batch_id))
        self.commits.finish(spark, batch_id, slot)

    def current(self, spark: SparkSession) -> DataFrame:
        newest = self.commits.newest(spark)
        schema = ", ".join(f"{name} {kind}" for name, kind in self.fields.items())
        if newest == NONE:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._slot(newest))
