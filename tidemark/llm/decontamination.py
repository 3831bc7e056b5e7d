"""Benchmark passages in documents, found by SimHash over item-sized windows. Built-in functions only.

**Documents.** A window that is similar to an item has at least ``PERCENT`` of a hundred of its shingles. So
of any choice of the others plus one it has one: documents are looked up by that many of an item's
shingles only, those that the fewest items have. A phrase that many items share is no reason to compare
them with a document. Documents with too few shingles of an item at all places together go next.

**Windows.** A window has as many words as an item and lies where a shared shingle puts the item.

**Search.** Every window and item has a 64-bit SimHash of its words. Fingerprints are cut into ``BLOCKS`` of 16
bits: two that differ in at most ``RADIUS`` bits differ in at most ``RADIUS // BLOCKS`` bits of one block, so
items are looked up under every value that is so near to theirs, by item size, block and value. That finds
all fingerprints within the radius.

**Beyond the radius.** A replaced run of words can move a fingerprint further. What is in its place then still
lies in its place: a window that has shingles enough at their places in the item is checked whatever its
fingerprint. A window can be missed only if words were put in or left out, which shifts what follows, and its
fingerprint is beyond the radius as well.

**Check.** The pairs found are compared exactly: shared five-word shingles with their numbers of
occurrence, divided by all of either. ``PERCENT`` of a hundred and more is a match.

Words are runs without white space, in lower case. A text with fewer than five words is one shingle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SHINGLE, beside, id_and_text, stored

PERCENT = 75
RADIUS = 15
BITS = 64
BLOCKS, BLOCK_BITS = 4, 16
WINDOW = ("doc_id", "start", "n_words")


def with_word_hashes(df: DataFrame) -> DataFrame:
    """``words``: a hash per word of ``text``, which is dropped."""
    words = F.array_remove(F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+"), "")
    return df.withColumn("words", F.transform(words, lambda w: F.xxhash64(w))).drop("text")


def shingles_of(words: str) -> Column:
    """Hashes of all five-word shingles of an array of word hashes, in order of their start."""
    w = F.col(words)
    starts = F.sequence(F.lit(0), F.size(w) - SHINGLE)
    each = F.transform(starts, lambda i: F.xxhash64(*[w[i + k] for k in range(SHINGLE)]))
    return (
        F.when(F.size(w) >= SHINGLE, each)
        .when(F.size(w) > 0, F.array(F.xxhash64(w)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """A row per distinct text that has words: ``item`` (a number), names (item ids, maybe NULL), words,
    n_words, shingles."""
    read = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    named = read.groupBy("text").agg(F.collect_set(F.struct("item_id")).alias("names"))
    items = with_word_hashes(named).withColumn("shingles", shingles_of("words"))
    items = items.withColumn("n_words", F.size("words")).filter("n_words > 0")
    return items.withColumn("item", F.monotonically_increasing_id())


def rarest_shingles(items: DataFrame, percent: int) -> DataFrame:
    """``item`` and ``shingle``: of each item as many as any similar window must have one of.

    A window without these has too few of the item's shingles left for the similarity. Those that the
    fewest items have are taken; repeated ones count as often as they stand there.
    """
    each = items.select("item", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    times = each.groupBy("item", "n", "shingle").agg(F.count("*").alias("times"))
    common = times.groupBy("shingle").agg(F.count("*").alias("items"))
    order = Window.partitionBy("item").orderBy("items", "shingle")
    before = F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # at most n - ceil(n * percent / 100) shingles can be missing
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    chosen = times.join(common, "shingle").withColumn("before", F.coalesce(before, F.lit(0)))
    return chosen.filter(F.col("before") <= spare).select("item", "shingle")


def document_shingles(docs: DataFrame) -> DataFrame:
    """doc_id, size (words), at, shingle of every shingle of every document."""
    every = with_word_hashes(id_and_text(docs).filter("doc_id is not null"))
    return every.select(
        "doc_id", F.size("words").alias("size"), F.posexplode(shingles_of("words")).alias("at", "shingle")
    )


def windows_with_shingles_enough(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """doc_id, start, n_words, item, ``aligned``, ``needed``: windows where a shared shingle puts an item, of
    documents that have shingles enough of it. ``aligned`` are those at their places in that window.
    """
    rare = stored(rarest_shingles(items, percent), "benchmark-rare")
    met = beside(document_shingles(docs), rare, "shingle").select("doc_id", "item").distinct()
    met = stored(met, "benchmark-met")
    places = items.select("item", "n_words", F.posexplode("shingles").alias("place", "shingle"))
    sought = met.join(places, "item")
    touched = stored(met.select("doc_id").distinct(), "benchmark-documents")
    again = document_shingles(beside(docs.select("doc_id", "text"), touched, "doc_id"))
    hits = again.join(sought, ["doc_id", "shingle"])
    last = F.greatest(F.col("size") - F.col("n_words"), F.lit(0))
    start = F.least(F.greatest(F.col("at") - F.col("place"), F.lit(0)), last)
    placed = hits.select("doc_id", start.alias("start"), "n_words", "item")
    placed = stored(
        placed.groupBy("doc_id", "start", "n_words", "item").agg(F.count("*").alias("aligned")),
        "benchmark-places",
    )
    sizes = items.select("item", F.ceil(F.size("shingles") * percent / 100).alias("needed"))
    total = placed.groupBy("doc_id", "item").agg(F.sum("aligned").alias("total"))
    enough = total.join(sizes, "item").filter("total >= needed").select("doc_id", "item", "needed")
    return placed.join(enough, ["doc_id", "item"])


def simhash(weighted: DataFrame, key: list[str]) -> DataFrame:
    """A fingerprint per key of rows ``h``: bit b is set if most hashes have it set."""
    bit = [F.shiftright("h", b).bitwiseAND(F.lit(1)) for b in range(BITS)]
    votes = weighted.groupBy(*key).agg(
        *[F.sum(2 * bit[b] - 1).alias(f"v{b}") for b in range(BITS)]
    )
    print_ = F.lit(0).cast("bigint")
    for b in range(BITS):
        print_ = print_.bitwiseOR(F.when(F.col(f"v{b}") > 0, F.lit(_bit(b))).otherwise(F.lit(0)))
    return votes.select(*key, print_.alias("fingerprint"))


def _bit(b: int) -> int:
    return 1 << b if b < BITS - 1 else -(1 << b)


def block_value(k: int, fingerprint: str) -> Column:
    return F.shiftright(fingerprint, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def near_values(flips: int) -> list[int]:
    """All differences of at most ``flips`` bits between two block values."""
    return [
        sum(1 << bit for bit in bits) for n in range(flips + 1) for bits in combinations(range(BLOCK_BITS), n)
    ]


def within_radius(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of window (doc_id, start) and item of equal size whose fingerprints are that close."""
    blocks = [
        F.struct(F.lit(k).alias("block"), block_value(k, "fingerprint").alias("value"))
        for k in range(BLOCKS)
    ]
    left = windows.select("*", F.inline(F.array(*blocks)))
    differences = F.expr(f"array({', '.join(map(str, near_values(radius // BLOCKS)))})")
    right = items.select("item", "n_words", F.col("fingerprint").alias("other"), F.inline(F.array(*blocks)))
    right = right.withColumn("difference", F.explode(differences)).select(
        "item", "n_words", "other", "block",
        F.col("value").bitwiseXOR(F.col("difference").cast("bigint")).alias("value"),
    )
    right = stored(right, "benchmark-values")  # many rows an item: joined by the size they have
    near = left.join(right, ["n_words", "block", "value"]).filter(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= radius
    )
    return near.select(*windows.drop("fingerprint").columns, "item").distinct()


def window_words(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """The words of placed windows; ``mark`` tells rows of one doc_id with different texts apart."""
    touched = stored(placed.select("doc_id").distinct(), "benchmark-windows-of")
    read = with_word_hashes(beside(id_and_text(docs), touched, "doc_id"))
    words = F.slice("words", F.col("start") + 1, F.col("n_words")).alias("words")
    windows = read.join(placed.select(*WINDOW).distinct(), "doc_id").select(*WINDOW, words)
    marked = windows.withColumn("mark", F.xxhash64("words")).distinct()
    return stored(marked.withColumn("shingles", shingles_of("words")), "benchmark-window-words")


def candidate_pairs(
    windows: DataFrame, items: DataFrame, placed: DataFrame, radius: int = RADIUS
) -> DataFrame:
    """Windows and items to compare: fingerprints within the radius, or shingles enough in their places."""
    window, item = [*WINDOW, "mark"], ["item", "n_words"]
    prints = simhash(windows.select(*window, F.explode("words").alias("h")), window)
    item_prints = simhash(items.select(*item, F.explode("words").alias("h")), item)
    near = within_radius(prints, item_prints, radius)
    in_place = placed.filter("aligned >= needed").select(*WINDOW, "item")
    there = windows.select(*window).join(in_place, [*WINDOW])
    return near.unionByName(there).distinct()


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS
) -> DataFrame:
    """doc_id, item_id, start (word, from 0), similarity: the best window per document and item.

    NULL and empty texts on either side match nothing; rows without a doc_id are not looked at. Every text
    of an item_id is looked for, also those without one, which are reported as NULL. Rows of one doc_id are
    looked at one by one and reported as one document. A document that is shorter than an item is compared
    as a whole.
    """
    items = stored(benchmark_items(benchmark), "benchmark-items")
    placed = stored(windows_with_shingles_enough(docs, items, percent), "benchmark-placed")
    windows = window_words(docs, placed)
    window = [*WINDOW, "mark"]
    pairs = stored(candidate_pairs(windows, items, placed, radius), "benchmark-pairs")
    in_window = (
        windows.select(*window, F.explode("shingles").alias("h"))
        .groupBy(*window, "h")
        .agg(F.count("*").alias("times"))
    )
    in_item = (
        items.select("item", F.explode("shingles").alias("h"))
        .groupBy("item", "h")
        .agg(F.count("*").alias("times_item"))
    )
    window_size = windows.select(*window, F.size("shingles").alias("all_window"))
    item_size = items.select("item", F.size("shingles").alias("all_item"))
    shared = (
        pairs.join(in_window, window)
        .join(in_item, ["item", "h"])
        .groupBy(*window, "item")
        .agg(F.sum(F.least("times", "times_item")).alias("both"))
    )
    compared = shared.join(window_size, window).join(item_size, "item")
    either = F.col("all_window") + F.col("all_item") - F.col("both")
    matches = compared.filter(100 * F.col("both") >= percent * either).select(
        "doc_id", "item", "start", (F.col("both") / either).alias("similarity")
    )
    named = matches.join(items.select("item", F.explode("names.item_id").alias("item_id")), "item")
    best = named.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    )
    return best.select(
        "doc_id",
        "item_id",
        (-F.col("best.back")).alias("start"),
        F.col("best.similarity").alias("similarity"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all columns; rows without a doc_id stay."""
    found = benchmark_matches(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
