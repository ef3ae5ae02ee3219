"""Exact deduplication by progressive refinement: length, then a hash of the prefix, then a hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable

PREFIX_CHARS = 256
# Bits that say which groups go on to the next level. They take SLOTS / 8 bytes (1 MB), whatever the size of the data.
SLOTS = 1 << 23
# Bits of one bitmap that Spark's bitmap functions make.
BITMAP_BITS = 32_768


def _slot(*keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)) + 1


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of the slots of those key values that more than one row has (at most SLOTS / BITMAP_BITS rows)."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    slots = twice.select(_slot(*map(F.col, keys)).alias("_slot"))
    return slots.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits")
    )


def _flagged(rows: DataFrame, bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``_on``: whether their key's slot is set. No row moves: the bitmaps have a fixed size and are broadcast."""
    slot = _slot(*map(F.col, keys))
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    on = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1, F.lit(False))
    joined = rows.withColumn("_at", F.bitmap_bucket_number(slot)).join(
        F.broadcast(bitmaps), F.col("_at") == F.col("_bucket"), "left"
    )
    return joined.withColumn("_on", on).drop("_at", "_bucket", "_bits")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Groups of rows with the same text: ``id_col``, the ``carry`` columns, ``keep_id``, ``group_size``, ``kept``.

    Level one counts lengths. Level two hashes the first PREFIX_CHARS characters of the rows whose length repeats.
    Level three reads and hashes (SHA-256) the whole text of the rows whose length and prefix repeat; rows with the
    same length and hash are equal. A level learns from the one before through a bitmap of fixed size, so texts never
    travel, and a slot that two keys share only sends some rows on for nothing.

    The largest id of a group stays. Null texts count as empty; a null id stays only where the group has no other;
    rows that repeat an id and a text are all kept or all dropped; an empty table gives no rows. Ids of any type that
    has an order will do, and other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.struct(F.lit(0).alias("_"), *carry).alias("_rest"))
    rows = rows.withColumn("_size", F.octet_length("_text").cast("long"))
    prefix = F.xxhash64(F.substring("_text", 1, PREFIX_CHARS))

    by_size = stable(_repeated(rows, "_size"))
    second = _flagged(rows, by_size, "_size")
    by_prefix = stable(_repeated(second.where("_on").withColumn("_prefix", prefix), "_size", "_prefix"))
    second = second.withColumn("_prefix", F.when(F.col("_on"), prefix)).withColumnRenamed("_on", "_long")
    third = _flagged(second, by_prefix, "_size", "_prefix").withColumn("_on", F.col("_on") & F.col("_long"))
    hashed = stable(third.select("_id", "_rest", "_size", F.when(F.col("_on"), F.unhex(F.sha2("_text", 256))).alias("_hash")))

    alone = hashed.where(F.col("_hash").isNull()).select("*", F.col("_id").alias("_keep"), F.lit(1).cast("long").alias("_n"))
    many = hashed.where(F.col("_hash").isNotNull())
    # Written by itself, so that the rows of a large group need not follow its one result row into one task.
    groups = many.groupBy("_size", "_hash").agg(F.max("_id").alias("_largest"), F.count(F.lit(1)).alias("_rows"))
    groups = stable(groups.where("_rows > 1"))
    found = many.join(groups, ["_size", "_hash"], "left").select(
        *many.columns,
        F.when(F.col("_rows").isNull(), F.col("_id")).otherwise(F.col("_largest")).alias("_keep"),
        F.coalesce("_rows", F.lit(1)).cast("long").alias("_n"),
    )
    found = alone.unionByName(found)
    return found.select(
        F.col("_id").alias(id_col),
        *[F.col("_rest")[c].alias(c) for c in carry],
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
    )
