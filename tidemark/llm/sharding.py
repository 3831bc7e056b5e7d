"""Shards by fixed virtual slots and a versioned map from slot to shard.

A record is hashed, once and for all, into one of ``SLOTS`` slots. Bytes are added up per slot, a table
of fixed size, and slots are dealt to shards by their bytes: the largest slot first, each to the shard
that has least. What is stored is that map, a version of it per change. Growing by a shard, or putting
uneven shards right after new data, edits the map: some slots change hands, all other records stay
where they are, and older versions can still be read.

The law that holds is ``bytes``: the sizes of shards are as near to equal as slots allow. A slot is about
1 / ``SLOTS`` of all records, so no shard differs from the mean by more than one slot's bytes, unless a
single slot is larger than a whole share.

Only built-in functions: the greedy dealing is one ``aggregate`` over a sorted array of the slots. A
record's place in its shard is the number of records in the shard's earlier slots plus its rank in its
own slot, so no task orders more than a slot.

Rows: a NULL text has no bytes: a size of 8 and the checksum 0. The hash takes ``doc_id`` and the text's checksum, so
rows with one ``doc_id`` or without any are spread by their texts; rows equal in both share a slot, in an
order that makes no difference. An empty table gives no rows, and a map that deals empty slots in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.streaming.folders import read_if_there
from tidemark.streaming.scratch import scratch_dir

SLOTS = 8192
SHARDS = 24
OVERHEAD = 8
LAW = "bytes"
MAP = "virtual_slot int, size bigint, n bigint, shard int"


def slot_of(doc_id: Column, checksum: Column) -> Column:
    """The virtual slot: 52 bits of an md5, so that any system can compute it."""
    key = F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("-")), checksum.cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint"), F.lit(SLOTS)).cast("int")


def slotted(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and ``virtual_slot`` of every row; the only read of texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return rows.withColumn("virtual_slot", slot_of(F.col("doc_id"), F.col("text_crc32")))


def slot_sizes(rows: DataFrame) -> DataFrame:
    """``virtual_slot``, ``size`` and ``n`` (rows) of all slots, also of empty ones."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    every = rows.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").fillna(0, ["size", "n"])


def _dealt(slots: Column, loads: Column) -> Column:
    """Slots in their order, each given to the shard with the least load so far, the first of equals."""

    def give(state: Column, slot: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1

        def to(shard: Column) -> Column:
            grown = F.transform(
                state["loads"], lambda load, i: F.when(i == shard, load + slot["size"]).otherwise(load)
            )
            return F.struct(
                grown.alias("loads"), F.concat(state["shards"], F.array(shard)).alias("shards")
            )

        return F.transform(F.array(least), to)[0]  # one element, so that the least is sought once

    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("shards"))
    return F.aggregate(slots, start, give)["shards"]


def _placed(slots: DataFrame) -> DataFrame:
    """A map from one row of ``slots``, at most ``SLOTS`` in an array, and ``loads`` of the shards."""
    shards = _dealt(F.col("slots"), F.col("loads")).alias("shards")
    each = slots.select(F.inline(F.arrays_zip("slots", shards)))
    return each.select("slots.virtual_slot", "slots.size", "slots.n", F.col("shards").alias("shard"))


def _by_size() -> Column:
    """What sorts slots the largest first, then by number."""
    return F.struct((-F.col("size")).alias("down"), "virtual_slot", "size", "n")


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A map of all slots onto ``shards`` shards of nearly equal bytes."""
    slots = F.array_sort(F.collect_list(_by_size())).alias("slots")
    return _placed(sizes.agg(slots).withColumn("loads", F.array_repeat(F.lit(0).cast("bigint"), shards)))


def rebalanced(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map edited for ``shards`` shards, more or fewer than now, and for the slots' sizes of today.

    A shard above an equal share gives up its smallest slots as long as a full share is left, and a
    shard that is no more gives up all; these are dealt, the largest first, to whoever has least.
    Nothing else moves. Slots that are larger than a share each need a shard; the others share the rest.
    """
    now = current.select("virtual_slot", "shard").join(sizes, "virtual_slot")
    every_slot = Window.partitionBy(F.lit(0))
    now = now.withColumn("large", F.col("size") * shards > F.sum("size").over(every_slot))
    usual = F.sum(F.when(~F.col("large"), F.col("size")).otherwise(0)).over(every_slot)
    share = usual / F.greatest(F.lit(shards) - F.sum(F.col("large").cast("int")).over(every_slot), F.lit(1))
    load = F.sum("size").over(Window.partitionBy("shard"))
    up_to = Window.partitionBy("shard").orderBy("size", "virtual_slot")
    judged = now.select(
        "*", share.alias("share"), load.alias("load"), F.sum("size").over(up_to).alias("given")
    )
    beyond = (F.col("size") > 0) & (F.col("given") <= F.col("load") - F.col("share"))
    judged = judged.withColumn("moves", (F.col("shard") >= shards) | beyond)
    stay = judged.filter(~F.col("moves")).select("virtual_slot", "size", "n", "shard")
    held = stay.groupBy("shard").agg(F.sum("size").alias("load"))
    every = current.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(held, "shard", "left").select(
        F.lit(None).alias("slot"), F.struct("shard", F.coalesce("load", F.lit(0)).alias("load")).alias("held")
    )
    moving = judged.filter("moves").select(_by_size().alias("slot"), F.lit(None).alias("held"))
    both = moving.unionByName(loads).agg(  # collect_list leaves NULLs out
        F.array_sort(F.collect_list("slot")).alias("slots"),
        F.array_sort(F.collect_list("held"))["load"].alias("loads"),
    )
    return stay.unionByName(_placed(both))


@dataclass(frozen=True)
class SlotMap:
    """Versions of a map below ``path``, one folder each; none is ever changed."""

    path: str

    def newest(self, spark: SparkSession) -> int:
        """The newest version, 0 if there is none."""
        versions = read_if_there(spark, self.path, f"{MAP}, version int")
        return 0 if versions is None else versions.agg(F.max("version")).first()[0] or 0

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.schema(MAP).parquet(f"{self.path}/version={version}")

    def append(self, edited: DataFrame) -> int:
        """Store a further version; its number."""
        version = self.newest(edited.sparkSession) + 1
        rows = edited.select("virtual_slot", "size", "n", "shard")
        rows.coalesce(1).write.parquet(f"{self.path}/version={version}")
        return version


def placed_rows(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows with their ``shard`` and ``slot``, the place in the shard, gapless from 0.

    The map has ``SLOTS`` rows, so it is broadcast.
    """
    earlier = (
        Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    places = slot_map.select("virtual_slot", "shard", first)
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(places), "virtual_slot").withColumn("slot", F.col("first") + F.col("nth"))


def shards_of(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row's shard of ``shards``, and beside it the shard in the map edited for one more.

    ``next_shard`` differs from ``shard`` only for the slots that changed hands.
    """
    spark = docs.sparkSession
    rows = stored(slotted(docs), "sharding-rows")
    sizes = stored(slot_sizes(rows), "sharding-slots")
    versions = SlotMap(scratch_dir(spark, "slot-map"))
    first = versions.read(spark, versions.append(first_map(sizes, shards)))
    grown = versions.read(spark, versions.append(rebalanced(first, sizes, shards + 1)))
    after = grown.select("virtual_slot", F.col("shard").alias("next_shard"))
    placed = placed_rows(rows, first).join(F.broadcast(after), "virtual_slot")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard",
    )
