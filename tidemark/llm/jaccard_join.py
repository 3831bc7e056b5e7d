"""Exact set-similarity self-join of documents on word shingles, with set-relation skipping.

**Index.** A document's shingles have one global order: those that a sample finds in many documents
last, otherwise by hash. Two sets that are similar enough share a shingle within their first
``n - ceil(0.75 n) + 1``, so only those are indexed. Any order is right; this one keeps lists short.

**Answers from similar sets.** Equal sets are one. Then every set is compared with one set only, the
one that leads most of the index lists it is on, first inside its own batch, which also shortens
each list to one entry per batch before the shuffle, then across batches. The set with the greatest
share of frequent shingles leads, as the text that others are copies of is such a one. Sets found similar
answer alike: they form a group, and no pair inside a group is looked at again.

**Skipping in the lists.** What is left are pairs of different groups that meet on a list. Lists with
one group are skipped whole; the others are cut into blocks by set size, and a block meets only the
blocks whose sizes allow the similarity. A pair counts on a list only if the shingle stands early enough
in both for the rest to make up the overlap. Every set has a sketch of about two parity bits a shingle: two sets
differ in at least as many shingles as their sketches differ in bits, so pairs whose sketches are too
far apart are skipped as well. The others are compared exactly.

No link between different texts is lost, and no list is expanded into all its pairs inside a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    COMMON_IN_SAMPLE,
    SAMPLED,
    beside,
    common_hashes,
    id_and_text,
    ids,
    is_in,
    lowered,
    map_texts,
    mixed,
    shingle_set,
    signed,
    stored,
    texts,
)
from tidemark.llm.components import components

PERCENT = 75
FEWEST_BITS = 256
MEMORY_SETS, PAIRS_AT_ONCE, SETS_AT_ONCE = 500, 250, 4_000
FOLDED_COLUMNS = [f"q{i}" for i in range(FEWEST_BITS // 64)]
SETS = (
    "doc_id bigint, n_shingles bigint, sum_a bigint, sum_b bigint, rank int, indexed array<bigint>, "
    "sketch binary, " + ", ".join(f"{c} bigint" for c in FOLDED_COLUMNS)
)


def first_part(n, percent: int = PERCENT):
    """How many shingles of a set of n must contain one of every similar set's."""
    return n - (-(-percent * n // 100)) + 1


def in_order(shingles: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles in the order of the index, frequent ones last; how many are frequent."""
    is_common = is_in(shingles, common)
    ordered = np.concatenate([shingles[~is_common], shingles[is_common]])
    return ordered, int(is_common.sum())


def sketch(shingles: np.ndarray) -> np.ndarray:
    """For each of about two buckets a shingle whether an odd number of shingles falls into it; bytes.

    The number of buckets is a power of two, so a larger sketch folds into a smaller one.
    """
    bits = max(FEWEST_BITS, 1 << max(0, 2 * len(shingles) - 1).bit_length())
    place = (shingles >> np.uint64(20)).astype(np.int64) & (bits - 1)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch with fewer buckets, ``size`` bytes: the exclusive or of its parts."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def differing_bits(one: np.ndarray, other: np.ndarray) -> int:
    """In how many buckets two sketches differ, the larger one folded."""
    size = min(len(one), len(other))
    differ = folded(one, size) ^ folded(other, size)
    return int(np.bitwise_count(differ).sum())


def document_sets(
    docs: DataFrame,
    percent: int = PERCENT,
    sampled: int = SAMPLED,
    least: int = COMMON_IN_SAMPLE,
) -> DataFrame:
    """Per document: size, two sums that identify its set, and its indexed shingles."""
    read = id_and_text(docs)
    common = common_hashes(read, lambda text: shingle_set(lowered(text)), sampled, least)

    def rows(batch) -> Iterator[dict]:
        sizes, sums, ranks, part, sketches = [], [], [], [], []
        for text in texts(batch):
            s = shingle_set(lowered(text))
            n = len(s)
            ordered, frequent = in_order(s, common)
            sizes.append(n)
            sums.append((s.sum(dtype=np.uint64), mixed(s ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)))
            ranks.append(1000 - 1000 * frequent // max(1, n))
            part.append(signed(ordered[: first_part(n, percent)] if n else ordered))
            sketches.append(sketch(s))
        few = [folded(bits, FEWEST_BITS // 8).view(np.int64) for bits in sketches]
        words = np.array(few, np.int64).reshape(-1, len(FOLDED_COLUMNS))
        both = np.array(sums, np.uint64).reshape(-1, 2)
        yield {
            "doc_id": ids(batch),
            "n_shingles": sizes,
            "sum_a": signed(both[:, 0].copy()),
            "sum_b": signed(both[:, 1].copy()),
            "rank": ranks,
            "indexed": part,
            "sketch": [bits.tobytes() for bits in sketches],
            **{c: words[:, i] for i, c in enumerate(FOLDED_COLUMNS)},
        }

    return map_texts(read, SETS, rows)


# An index entry: the shingle, the document, and rank, size and place in one number, in that order.
ENTRY = ("h", "doc", "about")
STAR = "kind int, h bigint, doc bigint, about bigint, leader bigint"
POSTING, MEMBER, STAR_PAIR = 0, 1, 2
FIELD = 24
SIZE_OF = f"(about >> {FIELD}) & {(1 << FIELD) - 1}"
PLACE_OF = f"about & {(1 << FIELD) - 1}"


def batch_lists(sets: DataFrame) -> DataFrame:
    """Index lists inside each batch of documents.

    ``POSTING``: the leader of each list, one row per list and batch. ``MEMBER``: all documents of
    lists that have more than one here. ``STAR_PAIR``: per document the leader of most of its lists.
    """

    def rows(batch) -> Iterator[dict]:
        parts = batch.column("indexed")
        sizes = parts.value_lengths().to_numpy()
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        about = (batch.column("rank").to_numpy().astype(np.int64) << FIELD) + batch.column(
            "n_shingles"
        ).to_numpy()
        entry = {
            "h": parts.flatten().to_numpy(),
            "doc": np.repeat(batch.column("doc_id").to_numpy(), sizes),
            "about": (np.repeat(about, sizes) << FIELD) + place,
        }
        order = np.lexsort((entry["doc"], entry["about"] >> (2 * FIELD), entry["h"]))
        entry = {c: values[order] for c, values in entry.items()}
        h, doc = entry["h"], entry["doc"]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        lengths = np.diff(np.r_[first, len(h)])
        yield {
            "kind": np.full(len(first), POSTING),
            "leader": pa.nulls(len(first), pa.int64()),
            **{c: values[first] for c, values in entry.items()},
        }
        leader = np.repeat(doc[first], lengths)
        several = np.repeat(lengths, lengths) > 1
        a, b = best_leader(doc[several], leader[several])
        yield {
            "kind": np.full(several.sum(), MEMBER),
            "leader": pa.nulls(int(several.sum()), pa.int64()),
            **{c: values[several] for c, values in entry.items()},
        }
        nothing = np.zeros(len(a), np.int64)
        yield {
            "kind": np.full(len(a), STAR_PAIR),
            "doc": a,
            "leader": b,
            "h": nothing,
            "about": nothing,
        }

    return map_texts(sets, STAR, rows, rows_at_once=SETS_AT_ONCE)


def best_leader(owner: np.ndarray, leader: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per owner the other document that leads most of its lists, the smaller one on ties."""
    other = owner != leader
    owner, leader = owner[other], leader[other]
    if not len(owner):
        return owner, leader
    pairs, counts = np.unique(np.stack([owner, leader], axis=1), axis=0, return_counts=True)
    order = np.lexsort((pairs[:, 1], -counts, pairs[:, 0]))
    pairs = pairs[order]
    keep = np.r_[True, pairs[1:, 0] != pairs[:-1, 0]]
    return pairs[keep, 0], pairs[keep, 1]


def index_lists(entries: DataFrame) -> DataFrame:
    """`batch_lists` put together: the rows of lists of several batches now have the list's leader.

    Postings meet by their hash and come sorted, so a list of any length passes through as a stream;
    it has at most one row per batch of documents. Postings alone on their list are left out. The other
    rows pass through, spread over all tasks.
    """

    def run(batches):
        held = None  # the last posting before this batch, whose list may go on
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ENTRY}
            kind = batch.column("kind").to_numpy()
            passed = np.flatnonzero(kind != POSTING)
            yield batch.take(pa.array(passed))
            posting = kind == POSTING
            columns = {c: values[posting] for c, values in columns.items()}
            h, doc = columns["h"], columns["doc"]
            if not len(h):
                continue
            start = np.r_[True, h[1:] != h[:-1]]
            leader = doc[np.maximum.accumulate(np.where(start, np.arange(len(h)), 0))]
            keep = ~start | np.r_[h[1:] == h[:-1], False]
            before = None
            if held is not None and held["h"] == h[0]:
                same = np.cumsum(start) == 1
                leader[same] = held["leader"]
                keep |= same
                before = None if held["sent"] else held
            columns["leader"] = leader
            held = {c: values[-1] for c, values in columns.items()} | {"sent": bool(keep[-1])}
            arrays = []
            for c, values in columns.items():
                chosen = values[keep]
                if before is not None:
                    chosen = np.concatenate([np.array([before[c]], values.dtype), chosen])
                arrays.append(pa.array(chosen))
            rows = pa.array(np.full(len(arrays[0]), POSTING), pa.int32())
            yield pa.RecordBatch.from_arrays([rows, *arrays], names=["kind", *columns])

    rank = F.expr(f"about >> {2 * FIELD}")
    meets_at = F.when(F.col("kind") == POSTING, F.col("h")).otherwise(F.xxhash64("doc", "h"))
    dealt = entries.repartition(meets_at).sortWithinPartitions("h", rank, "doc")
    return dealt.mapInArrow(run, STAR)


def links(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those pairs ``a``, ``b`` whose sets are similar enough, compared on whole texts."""
    needed = stored(
        pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "compared"
    )
    read = stored(beside(id_and_text(docs), needed, "doc_id"), "compared-texts")
    texts_a = read.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    texts_b = read.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(texts_a, "a").join(texts_b, "b").select("a", "b", "text_a", "text_b")

    def rows(batch) -> Iterator[dict]:
        known: dict[bytes, np.ndarray] = {}

        def found(text: bytes) -> np.ndarray:
            if text not in known:
                if len(known) >= MEMORY_SETS:
                    known.clear()
                known[text] = shingle_set(lowered(text))
            return known[text]

        keep = []
        for one, other in zip(texts(batch, "text_a"), texts(batch, "text_b"), strict=True):
            x, y = found(one), found(other)
            inter = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * inter >= percent * (len(x) + len(y) - inter))
        at = np.flatnonzero(keep)
        yield {"a": batch.column("a").take(at), "b": batch.column("b").take(at)}

    return map_texts(both, "a bigint, b bigint", rows, rows_at_once=PAIRS_AT_ONCE)


def left_pairs(
    members: DataFrame, groups: DataFrame, sketches: DataFrame, percent: int = PERCENT
) -> DataFrame:
    """Pairs of different groups that meet on lists and can still be similar enough.

    ``members``: h, doc, about. A list with one group is skipped; in the others sets meet in the blocks
    of sizes that can be similar. A pair of n and m shingles must share at least
    ``0.75 / 1.75 (n + m)``, so it meets where both have the shingle that far from their end, and its
    sketches, folded to a few words, differ in at most as many bits as the sets may.
    """
    grouped = beside(members, groups, members["doc"] == groups["node"], "left").select(
        "h",
        "doc",
        F.expr(SIZE_OF).alias("n"),
        F.expr(PLACE_OF).alias("place"),
        F.coalesce("component", "doc").alias("group"),
    )
    grouped = stored(grouped, "list-members")
    mixed_lists = (
        grouped.groupBy("h")
        .agg(F.min("group").alias("least"), F.max("group").alias("greatest"))
        .filter("least <> greatest")
        .select("h")
    )
    few = stored(
        sketches.select("doc", "n", *FOLDED_COLUMNS).distinct(), "folded-sketches"
    )
    live = beside(grouped.join(mixed_lists, "h", "left_semi"), few, ["doc", "n"])
    columns = ["doc", "n", "place", "group", *FOLDED_COLUMNS]
    least_of_smaller = F.expr(f"({2 * percent} * n + {99 + percent}) div {100 + percent}")
    x = live.filter(F.col("place") <= F.col("n") - least_of_smaller).select(
        "h", _block(F.col("n")).alias("block"), *[F.col(c).alias(f"{c}_x") for c in columns]
    )
    smallest = F.expr(f"({percent} * n + 99) div 100")
    y = live.select(
        "h",
        F.explode(F.array_distinct(F.array(_block(F.col("n")), _block(smallest)))).alias("block"),
        *[F.col(c).alias(f"{c}_y") for c in columns],
    )
    smaller_first = (F.col("n_x") < F.col("n_y")) | (
        (F.col("n_x") == F.col("n_y")) & (F.col("doc_x") < F.col("doc_y"))
    )
    least_shared = F.expr(f"({percent} * (n_x + n_y) + {99 + percent}) div {100 + percent}")
    differ = F.lit(0)
    for c in FOLDED_COLUMNS:
        differ = differ + F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y")))
    met = (
        (x["h"] == y["h"])
        & (x["block"] == y["block"])
        & smaller_first
        & (F.col("group_x") != F.col("group_y"))
        & (100 * F.col("n_x") >= percent * F.col("n_y"))
        & (F.col("place_x") <= F.col("n_x") - least_shared)
        & (F.col("place_y") <= F.col("n_y") - least_shared)
        & ((100 + percent) * differ <= (100 - percent) * (F.col("n_x") + F.col("n_y")))
    )
    return x.join(y, met).select(F.col("doc_x").alias("a"), F.col("doc_y").alias("b")).distinct()


def _block(n: F.Column) -> F.Column:
    """Sizes by powers of four. A set and the smallest it can be similar to lie in one or two blocks."""
    return F.floor(F.log2(n.cast("double")) / 2).cast("int")


def near_by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a``, ``b`` but those whose sketches differ in more bits than similar sets can.

    ``sketches``: doc, n and sketch; rows of one document that differ each have their own.
    """
    for side in ("a", "b"):
        own = sketches.select(
            F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")
        )
        pairs = pairs.join(own, side)

    def rows(batch) -> Iterator[dict]:
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        sides = (batch.column(f"sketch_{side}").to_pylist() for side in "ab")
        differ = [
            differing_bits(np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8))
            for one, other in zip(*sides, strict=True)
        ]
        near = (100 + percent) * np.array(differ, np.int64) <= (100 - percent) * sizes
        at = np.flatnonzero(near)
        yield {"a": batch.column("a").take(at), "b": batch.column("b").take(at)}

    return map_texts(pairs, "a bigint, b bigint", rows).distinct()


def similar_groups(
    docs: DataFrame,
    percent: int = PERCENT,
    sampled: int = SAMPLED,
    least: int = COMMON_IN_SAMPLE,
) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links), one row per input row.

    Rows without words are linked with nothing. Rows of one doc_id count as one document. A NULL
    doc_id is never linked and has a NULL component. NULL text: no words.
    """
    sets = stored(document_sets(docs, percent, sampled, least), "sets")
    named = sets.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "sum_a", "sum_b"]
    firsts = stored(named.groupBy(*same).agg(F.min("doc_id").alias("first")), "equal-sets")
    rows = sets.select("doc_id", *same)
    alone = beside(
        named, firsts.select(F.col("first").alias("doc_id"), *same), ["doc_id", *same], "left_semi"
    )
    lists = stored(index_lists(batch_lists(alone)), "lists")
    shared = lists.filter(F.col("kind") == POSTING)
    across = (
        shared.filter("doc <> leader")
        .groupBy("doc", "leader")
        .agg(F.count("*").alias("met"))
        .groupBy("doc")
        .agg(F.max(F.struct("met", (-F.col("leader")).alias("low"))).alias("best"))
        .select(F.col("doc").alias("a"), (-F.col("best.low")).alias("b"))
    )
    inside = lists.filter(F.col("kind") == STAR_PAIR).select(
        F.col("doc").alias("a"), F.col("leader").alias("b")
    )
    sketches = stored(
        named.select(
            F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch", *FOLDED_COLUMNS
        ).distinct(),
        "sketches",
    )

    def compared(pairs: DataFrame, label: str) -> DataFrame:
        near = near_by_sketch(stored(pairs, label), sketches, percent)
        return links(stored(near, f"{label}-near"), docs, percent)

    stars = stored(compared(inside.union(across).distinct(), "star-pairs"), "stars")
    members = lists.filter(F.col("kind") != STAR_PAIR).select(*ENTRY)
    groups = stored(components(stars, "star-components"), "star-groups")
    left = left_pairs(members, groups, sketches, percent)
    rest = stored(compared(left, "left-pairs"), "rest")
    # rows of one doc_id are one node, whichever set they have
    several = rows.filter("n_shingles > 0").join(firsts, same)
    copies = several.select(F.col("doc_id").alias("a"), F.col("first").alias("b")).filter("a <> b")
    known = components(stars.union(rest).union(copies), "groups")
    return rows.join(known, rows["doc_id"] == known["node"], "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with the least doc_id of their group, with all columns.

    Documents without words are in no group and stay; so do rows without a doc_id.
    """
    dropped = (
        similar_groups(docs, percent)
        .filter("doc_id <> component_id")
        .select("doc_id")
        .distinct()
    )
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
