"""Reading of the test tables and small helpers that the operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are what stands between these characters: space and 0x09 to 0x0D, as bytes.split() has it.
WORD_GAP = "[ \\t\\n\\u000B\\f\\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


MOST_BITS = 1 << 27  # of a bitmap, which is broadcast: 16 MB


def with_likely(rows: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """The rows with ``likely``: false only where the key, a long, is none of the ids, a staged frame of one column.

    A bitmap of the ids' hashes is broadcast, 16 bits an id as far as they fit, so no row moves. It spares rows with
    texts a shuffle; a join must still sort out what it lets pass.
    """
    bits = min(MOST_BITS, max(1 << 15, 16 * ids.count()))

    def slot(of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(bits))

    at = slot(F.col(ids.columns[0]).cast("long"))
    of = ids.select(F.bitmap_bucket_number(at).alias("_bucket"), F.bitmap_bit_position(at).alias("_at"))
    maps = of.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    place = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.col("_bits").isNotNull() & (F.getbit(byte, (place % 8).cast("int")) == 1)
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(slot(key))).join(F.broadcast(maps), "_bucket", "left")
    return joined.withColumn("likely", F.coalesce(found, F.lit(False))).drop("_bucket", "_bits")
