"""Changes that never arrived, found from the images alone.

In a whole log every old image is the new image of the change before it. Summed over a key with opposite
signs, hashes of images cancel one by one, and what is left is the image that stands now: nothing for a
deleted row. If a change is missing, its neighbours do not cancel. Sums need no order, so this is one
hash aggregate with partial sums, no sort and no window, and a key with a third of all rows is no burden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import change_key, is_applicable
from tidemark.schemas import KEY, ROW_FIELDS

_SUM = "decimal(20,0)"
IMAGE_FIELDS = tuple(c for c in ROW_FIELDS if c != KEY)


def _hash(image: str) -> Column:
    """A hash of an image, NULL where there is none.

    The place of a field is part of it, since hashing passes over NULLs.
    """
    columns = [F.coalesce(F.col(f"{image}.{c}").cast("string"), F.lit("\0")) for c in IMAGE_FIELDS]
    return F.when(F.col(image).isNotNull(), F.xxhash64(*columns))


def chain_sums(envelopes: DataFrame, order: str = "offset") -> DataFrame:
    """Per key: how many changes, images that came and went, their sums, and the last new image.

    ``order`` is the change's place in the log, a whole number. Changes that name no row are left out.
    """
    key = change_key()
    old, new = _hash("before"), _hash("after")
    images = envelopes.filter(is_applicable(key)).select(
        key.alias(KEY), old.alias("old"), new.alias("new"), F.col(order).alias("at")
    )
    return images.groupBy(KEY).agg(
        F.count("*").alias("changes"),
        (F.count("new") - F.count("old")).alias("standing"),
        (
            F.coalesce(F.sum(F.col("new").cast(_SUM)), F.lit(0))
            - F.coalesce(F.sum(F.col("old").cast(_SUM)), F.lit(0))
        ).alias("left_over"),
        F.max("at").alias("last_at"),
        F.max_by("new", "at").alias("last_new"),
    )


def chain_breaks(
    envelopes: DataFrame, base: DataFrame | None = None, order: str = "offset"
) -> DataFrame:
    """Keys whose log lacks a change: ``sku``, ``changes``, ``standing`` (rows that seem to stand).

    A whole log leaves one image standing, the last one, or none after a deletion. ``base`` is the state
    before the log, if it does not start from nothing. A lost change at the very end of a key's log leaves
    no trace in it, and losses that cancel (a value set and set back) are no difference.
    """
    sums = chain_sums(envelopes, order)
    if base is not None:
        columns = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in IMAGE_FIELDS]
        known = base.select(F.col(KEY).alias("_key"), F.xxhash64(*columns).alias("_image"))
        sums = sums.join(known, F.col(KEY) == F.col("_key"), "left")
        sums = sums.withColumns(
            {
                "standing": F.col("standing") + F.col("_image").isNotNull().cast("int"),
                "left_over": F.col("left_over") + F.coalesce(F.col("_image").cast(_SUM), F.lit(0)),
            }
        )
    stands = F.coalesce(F.col("last_new").cast(_SUM), F.lit(0))
    whole = (F.col("standing") == F.col("last_new").isNotNull().cast("int")) & (
        F.col("left_over") == stands
    )
    return sums.filter(~whole).select(KEY, "changes", "standing")
