"""Helpers of the text operators: words, hashes, stored intermediate tables, input columns.

Rules that hold for every operator here unless its docstring says otherwise: a NULL text counts as
empty; only ``doc_id`` and the text are read, so further columns, whatever their names, change
nothing; an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.scratch import scratch_dir

SHINGLE = 5
BROADCAST_ROWS = 500_000
ROWS_AT_ONCE = 1_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, the latter never NULL."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here.

    A lost executor then costs a read of shared files and not a run of all that came before, and a
    table that is read more than once is computed once.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a stored table; it is broadcast only if it has at most ``BROADCAST_ROWS`` rows.

    For tables of a few hundred bytes a row; a larger one is joined as Spark sees fit, by a shuffle.
    """
    return df.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on, how)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text: what splitting bytes at white space gives."""
    return text.split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread sums of hashes over all 64 bits."""
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; position by position."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, size):
        out = out * _STEP + h[i : n + i]
    return mixed(out)


class RunHashes:
    """Hashes of any run of words, from sums over all of them at once."""

    def __init__(self, h: np.ndarray):
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * _powers(int(_STEP), len(h)), dtype=np.uint64, out=self.sums[1:])
        self.back = _powers(_INVERSE, len(h) + 1)

    def hash_of(self, start: np.ndarray, end: np.ndarray, tag: int = 0) -> np.ndarray:
        """A hash of the words from ``start`` to ``end``, their number and ``tag``."""
        return self._finished((self.sums[end] - self.sums[start]) * self.back[start], end - start, tag)

    def hash_without(self, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """`hash_of` of the words from ``start`` to ``end`` but the one ``at``."""
        before = self.sums[at] - self.sums[start]
        after = (self.sums[end] - self.sums[at + 1]) * np.uint64(_INVERSE)
        return self._finished((before + after) * self.back[start], end - start - 1, 0)

    @staticmethod
    def _finished(value: np.ndarray, words: np.ndarray, tag: int) -> np.ndarray:
        return mixed(value ^ (words.astype(np.uint64) * np.uint64(0x1000193) + np.uint64(tag)))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle."""
    h = word_hashes(words_of(text))
    if len(h) == 0:
        return h
    return np.unique(window_hashes(h, min(size, len(h))))


SAMPLED = 32
COMMON_IN_SAMPLE, MOST_COMMON = 3, 100_000


def common_hashes(
    docs: DataFrame, of: Callable[[bytes], np.ndarray], sampled: int = SAMPLED, least: int = COMMON_IN_SAMPLE
) -> np.ndarray:
    """Hashes that several of the sampled documents have, sorted, at most ``MOST_COMMON``.

    One document in ``sampled`` is read. Callers put these last in an order of hashes; any order gives
    the same results, this one keeps the groups of frequent hashes small.
    """
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sampled)) == 0)

    def rows(batch) -> Iterator[dict]:
        sets = [np.empty(0, np.uint64), *(np.unique(of(t)) for t in texts(batch))]
        found, counts = np.unique(np.concatenate(sets), return_counts=True)
        yield {"h": signed(found), "n": counts}

    counted = map_texts(sample, "h bigint, n bigint", rows).groupBy("h").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(MOST_COMMON)
    return np.sort(np.array([r.h for r in top.select("h").collect()], np.int64).view(np.uint64))


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def lowered(text: bytes) -> bytes:
    """A-Z in lower case, all other characters as they are."""
    return text.lower()


Rows = dict[str, np.ndarray | list]


def map_texts(
    df: DataFrame,
    schema: str,
    per_batch: Callable[[pa.RecordBatch], Iterator[Rows]],
    rows_at_once: int = ROWS_AT_ONCE,
    at_end: Callable[[], None] | None = None,
) -> DataFrame:
    """Run ``per_batch`` over Arrow batches inside the tasks; it yields columns of ``schema``.

    A batch is handed over in parts of ``rows_at_once``, which bounds what a task holds in Python.
    ``at_end`` runs when a task has no more, to let go of what the worker would keep for the next one.
    """
    arrow_schema = None

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, max(1, batch.num_rows), rows_at_once):
            yield batch.slice(at, rows_at_once)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in parts(batch)):
            for columns in per_batch(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type) for f in arrow_schema], schema=arrow_schema
                )
        if at_end is not None:
            at_end()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes, without decoding them."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def ids(batch: pa.RecordBatch, column: str = "doc_id") -> pa.Array:
    return batch.column(column)


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs Spark has."""
    return h.view(np.int64)


def group_of(key: F.Column, groups: int) -> F.Column:
    """``crc32(key as text) mod groups``, by which labels are split into learning and held out."""
    return F.crc32(key.cast("string").cast("binary")) % groups
