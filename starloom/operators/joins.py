"""Join helpers: broadcast only behind a size check.

A dimension is broadcast when its rows are measured at no more than
``max_bytes``; otherwise it is returned untouched and Spark plans a shuffle
(sort-merge) join, where AQE's skew-join handling splits hot keys of the
fact side. The measurement is one aggregate over the dimension's projected
columns (pass a materialised dimension so it is a scan of its stored rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a dimension projection may have to be broadcast.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# What any value takes in a row, beside a string's own bytes.
VALUE_BYTES = 16
# Bits of ``split_by_keys``' bitmaps for each key: one row in so many is taken for a met one by chance.
BITS_A_KEY = 16
BITMAP_BITS = 32768  # of one of Spark's bitmaps


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: a fixed cost per value plus the strings' lengths."""
    row = F.lit(VALUE_BYTES * len(df.columns))
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row = row + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return df.agg(F.sum(row.cast("long")).alias("n")).first()["n"] or 0


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str, max_bytes: int = BROADCAST_MAX_BYTES):
    """``rows`` in those whose ``key`` is not among ``keys``, and the others, without a shuffle of them.

    Hashes of the keys are broadcast, or bitmaps of them where these are larger than
    ``max_bytes``; None if the bitmaps are, too (or the types differ). Rows without a key, and any whose hash is there by chance, are among the
    others: a join on the key itself tells them apart.
    """
    if rows.schema[key].dataType != keys.schema[key].dataType:
        return None
    hashes = keys.select(F.xxhash64(key).alias("_h")).distinct()
    n = measured_bytes(hashes) // VALUE_BYTES
    no_key = F.col(key).isNull()
    if n * VALUE_BYTES > max_bytes:
        bits = -(-n * BITS_A_KEY // BITMAP_BITS) * BITMAP_BITS
        if bits // 8 > max_bytes:
            return None
        place = F.pmod(F.col("_h"), F.lit(bits))
        maps = hashes.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit")) \
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        at = rows.withColumn("_h", F.xxhash64(key)).withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
        byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        met = F.coalesce(F.getbit(byte, F.expr("cast(_bit % 8 as int)")) == 1, F.lit(False)) | no_key
        marked = at.join(F.broadcast(maps), "_bucket", "left").withColumn("_met", met)
        return marked.where(~F.col("_met")).select(*rows.columns), marked.where(F.col("_met")).select(*rows.columns)
    def by(how):
        return rows.where(~no_key).join(F.broadcast(hashes), F.xxhash64(key) == F.col("_h"), how)
    return by("left_anti"), by("left_semi").unionByName(rows.where(no_key))


# --- hexadecimal hashes in half the bytes ---------------------------------------

HEX_BYTES = 16


def packed(c) -> Column:
    """Text as bytes, 32 lower-case hexadecimal digits as the 16 bytes they stand for, so that
    shuffles move half of them; one text has one form (see ``unpacked``)."""
    c = F.col(c) if isinstance(c, str) else c
    is_hex = (F.octet_length(c) == 2 * HEX_BYTES) & (F.translate(c, "0123456789abcdef", "") == "")
    # any other text ends in a mark, which never makes it 16 bytes long
    mark = F.when(F.octet_length(c) == HEX_BYTES - 1, F.lit(bytes([2, 2]))).otherwise(F.lit(bytes([1])))
    return F.when(is_hex, F.unhex(c)).otherwise(F.concat(F.encode(c, "UTF-8"), mark))


def unpacked(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    n = F.octet_length(c)
    marks = F.when((n == HEX_BYTES + 1) & (F.hex(F.substring(c, HEX_BYTES + 1, 1)) == "02"), F.lit(2)).otherwise(F.lit(1))
    return F.when(n == HEX_BYTES, F.lower(F.hex(c))).otherwise(F.decode(F.substring(c, F.lit(1), n - marks), "UTF-8"))


def hash_keys(df: DataFrame, but=()) -> list[str]:
    """The text columns that hold surrogate keys."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name.endswith("_key") and f.name not in but]


def with_packed(df: DataFrame, cols) -> DataFrame:
    return df.select(*[packed(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def with_unpacked(df: DataFrame, cols) -> DataFrame:
    return df.select(*[unpacked(c).alias(c) if c in cols else F.col(c) for c in df.columns])
