"""Audit of sources: how far each source's words are from every other source's, and which words stand out.

All pairs of a language's sources are compared over all its terms by *three-dimensional cube
partitioning*. Sources are dealt into blocks of ``GROUP_BLOCK``, terms into blocks of about
``TERM_BLOCK``. A slice is what one block of sources counts in one block of terms; it is sent to every
cell (sources, sources, terms) that needs it, once per block of partners. A cell holds two slices,
computes the part of each pair's divergence that its terms give, and the parts are added along the term
axis. A task's memory is two slices, however many sources and terms there are, and a source with a third
of all rows is one row of each slice, as any other.

All numbers are whole: with ``count`` occurrences of a term among ``N`` of all kept terms in the group,
``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and a term adds ``floor((p - q)**2 / q)``.

Rows: NULL text, lang and source count as ''. Repeated rows count as often as they stand there. Ties in
value are ranked by the item's UTF-8 bytes. A source without terms is compared like any other, a
language without kept terms gives pairs of value 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.common import stored

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000
GROUP_BLOCK = 16
TERM_BLOCK = 4096
HELD_TERMS = 200_000
_COUNTS = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("term", pa.string()),
        ("n", pa.int64()),
        ("docs", pa.int64()),
    ]
)
_PARTS = pa.schema([("lang", pa.string()), ("x", pa.int64()), ("y", pa.int64()), ("part", pa.int64())])


def _spacing() -> bytes:
    """Byte table: A-Z lower, other ASCII but letters a space, the rest as it is."""
    table = bytearray(range(256))
    for b in range(128):
        letter = bytes([b]).lower()
        table[b] = letter[0] if letter.isalpha() else 0x20
    return bytes(table)


_SPACED = _spacing()


def terms_of(text: bytes) -> list[bytes]:
    """``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased, of UTF-8 text.

    Bytes of characters beyond ASCII are all above the ASCII ones, so nothing is decoded.
    """
    return text.translate(_SPACED).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per group and term, added up as far as ``HELD_TERMS`` allows."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def flushed() -> pa.RecordBatch:
        rows = [
            (lang, source, term, count, docs[term])
            for (lang, source), (counts, docs) in held.items()
            for term, count in counts.items()
        ]
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                # a cast of bytes is checked and not decoded one by one
                pa.array(column, pa.binary()).cast(pa.string()) if f.name == "term" else pa.array(column, f.type)
                for column, f in zip(columns, _COUNTS)
            ],
            schema=_COUNTS,
        )

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        size = sum(len(counts) for counts, _ in held.values())
        for i, group in enumerate(zip(langs, sources)):
            words = terms_of(texts[i].as_py())
            counts, docs = held.setdefault(group, (Counter({b"": 0}), Counter()))
            size -= len(counts)
            counts.update(words)
            docs.update(set(words))
            size += len(counts)
            if size > HELD_TERMS:
                yield flushed()
                held, size = {}, 0
    if held:
        yield flushed()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` occurrences, ``docs`` documents; every group has a term ''."""
    read = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = read.mapInArrow(_counted, from_arrow_schema(_COUNTS))
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)``, in whole longs by a long division in steps of 1000.

    Exact for totals below 2 ** 63 / 1000; beyond that Spark's arithmetic raises and does not wrap.
    """
    left, out = count + 1, F.lit(0)
    for _ in range(3):
        out = out * 1000 + F.call_function("div", left * 1000, total)
        left = (left * 1000) % total
    return out + 1


def _over(window: Column) -> Column:
    return F.row_number().over(window)


def numbered_terms(counts: DataFrame) -> DataFrame:
    """Kept terms per language: ``term_block``, ``term_id`` in it, ``in_lang`` occurrences.

    Blocks are hashed, so their number is all that must be known, and ids need a block's terms only.
    """
    kept = (
        counts.filter(F.col("term") != "")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= LEAST_DOCUMENTS)
        .drop("docs")
    )
    kept = stored(kept, "divergence-kept")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_n"))
    sizes = stored(sizes, "divergence-langs")  # a row per language, known to be small once it is written
    blocks = F.expr(f"(v + {TERM_BLOCK - 1}) div {TERM_BLOCK}")
    dealt = kept.join(sizes, "lang").withColumn("term_block", F.pmod(F.xxhash64("term"), blocks))
    order = Window.partitionBy("lang", "term_block").orderBy("term")
    return dealt.withColumn("term_id", _over(order) - 1)


def _slices(groups: DataFrame, inside: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per (language, block of sources, block of terms), also where nothing is counted."""
    width = terms.groupBy("lang", "term_block").agg(F.count("*").cast("int").alias("width"))
    members = groups.groupBy("lang", "group_block").agg(
        F.first("v").alias("v"),
        F.collect_list(F.struct("group_id", "total")).alias("members"),
    )
    filled = inside.groupBy("lang", "group_block", "term_block").agg(
        F.collect_list(F.struct("group_id", "term_id", "n")).alias("entries")
    )
    return (
        members.join(width, "lang", "left")
        .fillna(0, ["term_block", "width"])
        .join(filled, ["lang", "group_block", "term_block"], "left")
        .select(
            "lang", "group_block", "term_block", "width", "v",
            F.col("members.group_id").alias("group_ids"),
            F.col("members.total").alias("totals"),
            F.col("entries.group_id").alias("rows"),
            F.col("entries.term_id").alias("columns"),
            F.col("entries.n").alias("counts"),
        )
    )


def _replicated(slices: DataFrame, groups: DataFrame) -> DataFrame:
    """Each slice once per cell it belongs to: (its block, another block) in order, and its terms."""
    last = groups.groupBy("lang").agg(F.max("group_block").alias("last"))
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))
    sent = slices.join(last, "lang").withColumn("partner", partner)
    return sent.select(
        F.least("group_block", "partner").alias("x_block"),
        F.greatest("group_block", "partner").alias("y_block"),
        *slices.columns,
    )


def shares(counts: np.ndarray, totals: np.ndarray, v: int) -> np.ndarray:
    """`_share` of a matrix of counts, a row per group. Divides in three steps so as to stay in 64 bits."""
    total = (totals + v)[:, None]
    left, out = counts + 1, np.zeros(counts.shape, np.int64)
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left %= total
    return out + 1


class _Slice:
    """A slice as a matrix of shares, a row per source and a column per term."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        def numbers(name: str) -> np.ndarray:
            values = batch.column(name)[i].values
            return np.empty(0, np.int64) if values is None else values.to_numpy().astype(np.int64)

        ids = numbers("group_ids")
        order = np.argsort(ids)
        self.ids = ids[order]
        counts = np.zeros((len(ids), batch.column("width")[i].as_py()), np.int64)
        counts[np.searchsorted(self.ids, numbers("rows")), numbers("columns")] = numbers("counts")
        self.p = shares(counts, numbers("totals")[order], batch.column("v")[i].as_py())

    def against(self, other: _Slice, lang: str) -> Iterator[tuple]:
        """Parts of the divergence of each source here, as p, from each source there, as q."""
        for x, p in zip(self.ids.tolist(), self.p):
            parts = ((p - other.p) ** 2 // other.p).sum(axis=1)
            for y, part in zip(other.ids.tolist(), parts.tolist()):
                if x != y:
                    yield lang, x, y, part


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A cell's one or two slices stand next to each other; parts of all pairs in both directions."""
    slices = ((batch, i) for batch in batches for i in range(batch.num_rows))
    cell = ("lang", "x_block", "y_block", "term_block")
    for (lang, *_), group in groupby(slices, lambda at: tuple(at[0].column(c)[at[1]].as_py() for c in cell)):
        sides = [_Slice(*at) for at in group]
        parts = list(sides[0].against(sides[-1], lang))
        if len(sides) == 2:
            parts += sides[1].against(sides[0], lang)
        if parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*parts), _PARTS)], schema=_PARTS
            )


def pair_divergences(groups: DataFrame, inside: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang``, ``x``, ``y`` (numbers of sources) and ``value``, for all ordered pairs of a language."""
    cell = ("lang", "x_block", "y_block", "term_block")
    sent = _replicated(_slices(groups, inside, terms), groups)
    dealt = sent.repartition(*cell).sortWithinPartitions(*cell, "group_block")
    parts = dealt.mapInArrow(_cells, from_arrow_schema(_PARTS))
    return parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("value"))


def source_divergence(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank`` within source and part."""
    counts = stored(term_counts(docs), "divergence-counts")
    terms = stored(numbered_terms(counts), "divergence-terms")
    inside = counts.filter(F.col("term") != "").join(terms, ["lang", "term"])
    inside = inside.select("lang", "source", "term", "term_block", "term_id", "n", "in_lang")
    inside = stored(inside, "divergence-inside")
    sums = inside.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = _over(Window.partitionBy("lang").orderBy("source")) - 1
    v = terms.groupBy("lang").agg(F.first("v").alias("v"), F.first("lang_n").alias("lang_n"))
    groups = (
        counts.filter(F.col("term") == "")
        .select("lang", "source")
        .join(sums, ["lang", "source"], "left")
        .join(v, "lang", "left")
        .fillna(0, ["total", "v", "lang_n"])
        .withColumn("group_id", number.cast("bigint"))
        .withColumn("group_block", F.expr(f"group_id div {GROUP_BLOCK}"))
    )
    groups = stored(groups, "divergence-groups")
    of_group = groups.select("lang", "source", "group_id", "group_block", "total", "v", "lang_n")
    inside = inside.join(of_group, ["lang", "source"])
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ("lang", "source", "part", "item", "value", "rank")

    x = groups.select("lang", F.col("group_id").alias("x"), "source")
    y = groups.select("lang", F.col("group_id").alias("y"), F.col("source").alias("item"))
    pairs = pair_divergences(groups, inside, terms).join(x, ["lang", "x"]).join(y, ["lang", "y"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    p = _share(F.col("n"), F.col("total") + F.col("v"))
    q = _share(F.col("in_lang"), F.col("lang_n") + F.col("v"))
    shown = inside.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    over = shown.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), "item",
        F.expr("(p - q) * (p - q) div q").alias("value"),
    )
    top = over.withColumn("rank", _over(ranks)).filter(F.col("rank") <= TERM_RANKS)
    return pairs.withColumn("rank", _over(ranks)).unionByName(top).select(*columns)
