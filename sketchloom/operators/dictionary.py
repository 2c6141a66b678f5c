"""Dictionary of all hashes: union, dense ids, encoding and decoding, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bit_length, ceil_log2
from .ordered import row_numbers


def union_hashes(postings: DataFrame) -> DataFrame:
    return postings.select("h").distinct()


def dense_ids(hashes: DataFrame) -> DataFrame:
    """h, id: the 1-based rank of every hash, counted in ranges of the hashes."""
    return row_numbers(hashes.select("h"), ["h"], "id")


def matched(found: Column, key: Column) -> Column:
    """found, or an error that names the key where nothing was found."""
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("not in the dictionary: "), F.coalesce(key.cast("string"), F.lit("null"))))).otherwise(found)


def encode(postings: DataFrame, dictionary: DataFrame, must_match: bool = True) -> DataFrame:
    """acc, id; a hash that the dictionary lacks is an error, or a null id for misses() to report."""
    id_ = matched(F.col("id"), F.col("h")) if must_match else F.col("id")
    return postings.join(dictionary, "h", "left").select("acc", id_.alias("id"))


def decode(ids: DataFrame, dictionary: DataFrame, must_match: bool = True) -> DataFrame:
    """acc, h; an id that the dictionary lacks (0, or more than it has) is an error, or a null hash."""
    h = matched(F.col("h"), F.col("id")) if must_match else F.col("h")
    return ids.join(dictionary, "id", "left").select("acc", h.alias("h"))


def misses(keys: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    """Keys that the dictionary lacks; encoding and decoding are whole when there is none."""
    return keys.join(dictionary, key, "left_anti")


def summary(postings: DataFrame, n_sets: int | None = None) -> DataFrame:
    """One row: sets, members, smallest and largest hash, distinct hashes, log2 and bits of an id."""
    one = postings.agg(
        F.count_distinct("acc").alias("n_sets"),
        F.count("*").alias("n_members"),
        F.min("h").alias("min_hash"),
        F.max("h").alias("max_hash"),
        F.count_distinct("h").alias("n_unique"),
    )
    n = F.col("n_unique")
    return one.withColumn("log2_unique", F.round(F.log2(F.greatest(n, F.lit(1))), 6)).withColumn(
        "bits_needed", F.when(n <= 1, 1).otherwise(ceil_log2(n)).cast("int")
    )


def elias_fano_params(postings: DataFrame) -> DataFrame:
    """acc, n, universe, low_bits: floor(log2(universe / n)) where the universe is larger, else 0."""
    sets = postings.groupBy("acc").agg(F.count("*").alias("n"), F.max("h").alias("universe"))
    return sets.withColumn("low_bits", F.when(F.col("universe") > F.col("n"), bit_length(F.expr("universe div n")) - 1).otherwise(0).cast("int"))
