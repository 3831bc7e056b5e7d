"""Near-duplicate lines by a deletion neighbourhood, counted in words.

Two lines are the same if one becomes the other by at most one word put in, left out or replaced, and
the shorter has at least ``NEAR_WORDS`` words; lines of ``SAME_WORDS`` words and more, that is all with a
word, also if they are equal. In a shorter line one word may be all that tells it from another. A line is dropped if the same line stands earlier (smaller doc_id, or same document above).

**Neighbourhood.** A line emits the hash of itself and of every variant with one word left out. Lines
within the bound meet on an equal variant: two lines that differ in word ``k`` on the variant without
word ``k``, a line with one word more on the other line itself. So the key is the variant and the place
of the gap, or the variant alone where it meets a whole line. On such a key every two lines are
within the bound, which is the verification, and the earliest line decides for all of them: no
pairs are made, and a key may have any number of lines.

**Which lines emit.** Variants cost as much as the text, but lines within the bound have a half in
common: first all lines emit hashes of their halves, and only lines whose half is also another line's
go on. Equal lines are one before that. Nothing within the bound is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    RunHashes,
    beside,
    free_name,
    id_and_text,
    ids,
    map_texts,
    signed,
    stored,
    texts,
    word_hashes,
)

SAME_WORDS = 1
NEAR_WORDS = 8
WORDS_AT_ONCE = 200_000


class Sequences(RunHashes):
    """Hashes of lines, of their halves, and of them without one word."""

    def __init__(self, lines: list[list[bytes]]):
        self.n = np.fromiter(map(len, lines), np.int64, len(lines))
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        super().__init__(word_hashes([w for words in lines for w in words]))

    def lines(self) -> np.ndarray:
        return self.hash_of(self.start, self.end)

    def halves(self) -> np.ndarray:
        """Four keys per line, of which lines within the bound have one in common.

        For the line's own length m and for m one less, as the other line may be shorter by a word:
        the first m // 2 words and the last m - m // 2 words.
        """
        keys = []
        for m in (self.n, self.n - 1):
            first = m // 2
            keys.append(self.hash_of(self.start, self.start + first, 1) + m.astype(np.uint64))
            keys.append(self.hash_of(self.end - (m - first), self.end, 2) + m.astype(np.uint64))
        return np.stack(keys, axis=1)

    def gaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each line and word: the line, the word's place, the hash of the line without it."""
        line = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(line))
        start = self.start[line]
        return line, at - start, self.hash_without(start, self.end[line], at)


LINES = "doc_id bigint, line int, h bigint, n int, halves array<bigint>"


def document_lines(docs: DataFrame) -> DataFrame:
    """Lines of at least ``SAME_WORDS`` words with their hash and, from ``NEAR_WORDS`` on, halves."""

    def rows(batch) -> Iterator[dict]:
        found: list[tuple[int, int, list[bytes]]] = []
        held = 0
        for i, text in enumerate(texts(batch)):
            for k, line in enumerate(text.split(b"\n")):
                words = line.split()
                if len(words) >= SAME_WORDS:
                    found.append((i, k, words))
                    held += len(words)
            if held >= WORDS_AT_ONCE:
                yield columns(batch, found)
                found, held = [], 0
        yield columns(batch, found)

    def columns(batch, found) -> dict:
        owner, number, lines = zip(*found, strict=True) if found else ((), (), ())
        sequences = Sequences(list(lines))
        halves = signed(np.ascontiguousarray(sequences.halves()))
        long_enough = sequences.n >= NEAR_WORDS
        return {
            "doc_id": ids(batch).take(np.array(owner, np.int64)),
            "line": number,
            "h": signed(sequences.lines()),
            "n": sequences.n,
            "halves": [row if near else None for row, near in zip(halves, long_enough, strict=True)],
        }

    return map_texts(docs, LINES, rows)


def neighbours(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Variants of chosen lines (doc_id, line): key, gap (-1: the line itself), doc_id, line, h."""
    per_doc = stored(chosen.groupBy("doc_id").agg(F.collect_set("line").alias("chosen")), "chosen-lines")
    read = beside(id_and_text(docs), per_doc, "doc_id")

    def rows(batch) -> Iterator[dict]:
        found: list[tuple[int, int, list[bytes]]] = []
        held = 0
        for i, (text, numbers) in enumerate(
            zip(texts(batch), batch.column("chosen").to_pylist(), strict=True)
        ):
            lines = text.split(b"\n")
            for k in numbers:
                # rows of one doc_id may have different texts
                words = lines[k].split() if k < len(lines) else []
                if len(words) >= NEAR_WORDS:
                    found.append((i, k, words))
                    held += len(words)
            if held >= WORDS_AT_ONCE:
                yield columns(batch, found)
                found, held = [], 0
        yield columns(batch, found)

    def columns(batch, found) -> dict:
        owner, number, lines = zip(*found, strict=True) if found else ((), (), ())
        sequences = Sequences(list(lines))
        whole = sequences.lines()
        line, place, without = sequences.gaps()
        at = np.concatenate([np.arange(len(whole)), line])
        return {
            "key": signed(np.concatenate([whole, without])),
            "gap": np.concatenate([np.full(len(whole), -1), place]),
            "doc_id": ids(batch).take(np.array(owner, np.int64)[at]),
            "line": np.array(number, np.int64)[at],
            "h": signed(whole)[at],
        }

    return map_texts(read, "key bigint, gap int, doc_id bigint, line int, h bigint", rows)


def near_duplicates(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h`` of distinct lines (h, n, halves, doc_id, line: the first place) with an earlier neighbour."""
    halves = distinct.filter("halves is not null").select(
        "doc_id", "line", "h", F.explode("halves").alias("half")
    )
    shared = halves.groupBy("half").agg(F.min("h").alias("least"), F.max("h").alias("greatest"))
    shared = shared.filter("least <> greatest").select("half")
    chosen = stored(
        halves.join(shared, "half", "left_semi").select("doc_id", "line").distinct(), "half-lines"
    )
    place = F.struct("doc_id", "line")
    near = stored(neighbours(docs, chosen), "line-variants")
    # lines that differ in one word: same variant, same gap
    gaps = near.filter("gap >= 0")
    earliest = gaps.groupBy("key", "gap").agg(F.min(place).alias("first"), F.count("*").alias("many"))
    earliest = earliest.filter("many > 1").drop("many")
    replaced = gaps.join(earliest, ["key", "gap"]).filter(F.col("first") < place).select("h")
    # a line with one word more: its variant is the other line itself
    whole = near.filter("gap = -1").groupBy("key").agg(F.min(place).alias("whole"))
    longer = gaps.groupBy("key").agg(F.min(place).alias("longer"))
    met = stored(whole.join(longer, "key"), "line-meetings")
    put_in = gaps.join(met, "key").filter(F.col("whole") < place).select("h")
    left_out = near.filter("gap = -1").join(met, "key").filter(F.col("longer") < place).select("h")
    return replaced.union(put_in).union(left_out).distinct()


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id and the numbers (from 0) of its lines that stand earlier, for documents that have some."""
    read = id_and_text(docs).filter("doc_id is not null")
    lines = stored(document_lines(read), "lines")
    place = F.struct("doc_id", "line")
    distinct = stored(
        lines.groupBy("h")
        .agg(
            F.min(place).alias("first"),
            F.count("*").alias("many"),
            F.min("n").alias("n"),
            F.first("halves").alias("halves"),
        )
        .select("h", "many", "n", "halves", F.col("first.doc_id").alias("doc_id"), F.col("first.line").alias("line")),
        "distinct-lines",
    )
    near = stored(near_duplicates(docs, distinct), "near-lines").withColumn("near", F.lit(True))
    judged = distinct.join(near, "h", "left").filter("many > 1 or near")
    judged = stored(
        judged.select(
            "h",
            F.coalesce("near", F.lit(False)).alias("near"),
            F.struct("doc_id", "line").alias("first"),
        ),
        "judged-lines",
    )
    gone = lines.select("doc_id", "line", "h").join(judged, "h").filter(F.col("near") | (place > F.col("first")))
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("gone"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with the lines that stand earlier taken out of ``text``.

    All rows and columns stay; ``n_chars``, if there is one, is the new text's length. A text whose
    lines are all dropped becomes empty. NULL and empty texts and rows without a doc_id are
    unchanged. Rows of one doc_id are one document: what is dropped in one is dropped in all.
    """
    name = free_name(docs, "gone")
    gone = stored(dropped_lines(docs).withColumnRenamed("gone", name), "gone-lines")
    numbers = F.col(name)
    left = F.filter(F.split("text", "\n", -1), lambda line, k: ~F.array_contains(numbers, k))
    text = F.when(numbers.isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    rows = beside(docs, gone, "doc_id", "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(numbers.isNull(), F.col("n_chars")).otherwise(length))
    return rows.select(*docs.columns)
