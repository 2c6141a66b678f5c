"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What separates words: every ASCII character that is neither a digit nor a small letter.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as a table to the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sketchloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of `written` that no later step reads."""
    for table_ in tables:
        context = table_.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table_._written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that grows with the input: both sides are shuffled, whatever size Spark expects.

    Spark takes a written table for as large as its compressed files and an exploded one for as large as if each array had one
    member, and would send tables of several hundred MB to the driver and from there to all executors.
    """
    return df.hint("merge")


def maybe_in(rows: DataFrame, keys: DataFrame, key: str, bits: int = 24) -> DataFrame:
    """The rows whose long `key` may be among the keys, found without a shuffle of the rows.

    The keys' hashes are marked in bitmaps of 2 ** bits bits in all, 2 MB at most whatever the number
    of keys, so these may be broadcast. Rows with one of the keys always pass; of the others a
    share passes that grows with the number of keys, so an exact join has to follow.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1
    bit = F.bitmap_bit_position(place)
    marked = keys.select(F.bitmap_bucket_number(place).alias("_mi_bucket"), bit.alias("_mi_bit"))
    maps = marked.groupBy("_mi_bucket").agg(F.bitmap_construct_agg("_mi_bit").alias("_mi_map"))
    byte = F.conv(F.hex(F.substring("_mi_map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("_mi_bucket"))
    return met.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1).select(*[rows[c] for c in rows.columns])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words_of(text: Column) -> Column:
    """Lower-cased words (runs of digits, letters and all non-ASCII characters)."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def chunks(sizes: list[int], most: int):
    """Consecutive (begin, end) ranges of items whose sizes sum to at most `most`, one item at least."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Lookup:
    """Positions of 64-bit keys in a fixed list, found for whole arrays at once (open addressing)."""

    FREE = np.uint64(0xFFFFFFFFFFFFFFFF)
    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, self.FREE, np.uint64)
        self.at = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._home(keys)
        while len(left):
            free = self.keys[slot] == self.FREE
            self.keys[slot[free]] = keys[left[free]]
            won = free & (self.keys[slot] == keys[left])
            self.at[slot[won]] = left[won]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, or -1."""
        slot = self._home(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.at[slot], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there != self.FREE))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.at[slot[hit]]
            more = ~hit & (there != self.FREE)
            left, slot = left[more], slot[more]
        return out
