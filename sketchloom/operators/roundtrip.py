"""Signatures taken apart, rebuilt and compared: skeletons, members, canonical forms, reports, the verdict."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signature_md5  # noqa: F401
from ..sources.files import as_hash, held, signature_texts, signatures_of


def keyed_texts(spark: SparkSession, path: str, recursive: bool, packed: bool) -> DataFrame:
    """folder (below the path, "" for the path itself), name, path, size and text of every signature file."""
    root = re.escape(re.sub(r"^\w+:(//[^/]*)?", "", path.rstrip("/")))
    below = F.regexp_extract("path", root + r"/(?:(.*)/)?[^/]+$", 1)
    return signature_texts(spark, path, recursive, packed).select(below.alias("folder"), F.substring_index("path", "/", -1).alias("name"), "path", "size", "text")


def entries(x: Column, but: str, shown: Column) -> Column:
    """A JSON object's text with its keys in order and the key `but`, where it has it, as `shown`."""
    parts = F.try_variant_get(x, "$", "map<string,variant>")
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(parts)), lambda k: F.concat(k, F.lit(":"), F.when(k == but, shown).otherwise(F.to_json(F.element_at(parts, k))))), ","), F.lit("}"))


def canonical(text: Column) -> Column:
    """JSON whose key order, order of hashes and order of records don't matter, as a text; every other value does.

    Hashes in `mins` are compared as a sorted list of numbers, or by key where it is a map of abundances. A list
    `abundances` is compared as it stands: if pairs were reordered, its order has changed and so has the form. Lists
    inside the list of records are compared as they stand.
    """

    def listed(parts: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(F.array_sort(parts), ","), F.lit("]"))

    def signature(x: Column) -> Column:
        hashes = F.transform(held(x, "mins", "array<string>"), lambda h: F.trim(h).cast("decimal(38,0)"))
        numbers = F.concat(F.lit("["), F.array_join(F.sort_array(hashes).cast("array<string>"), ","), F.lit("]"))
        return F.coalesce(entries(x, "mins", F.coalesce(numbers, F.to_json(held(x, "mins")))), F.to_json(x))

    def record(x: Column) -> Column:
        own = held(x, "signatures", "array<variant>")
        return F.when(own.isNotNull(), entries(x, "signatures", listed(F.transform(own, signature)))).otherwise(signature(x))

    v = F.parse_json(text)
    several = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(listed(F.transform(several, record)), record(v))


def canonical_files(spark: SparkSession, path: str, recursive: bool = True, packed: bool = True) -> DataFrame:
    """folder, name, path, size in bytes and sha256 of the canonical form of every signature file."""
    return keyed_texts(spark, path, recursive, packed).select("folder", "name", "path", "size", F.sha2(canonical(F.col("text")), 256).alias("sha256"))


def compare_files(originals: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """filename, original_size_bytes, status, original_path, rebuilt_path and reason of two tables of canonical_files.

    Files belong together that have the same name in the same folder below their roots.
    """
    b = rebuilt.select("folder", "name", F.col("path").alias("rebuilt_path"), F.col("sha256").alias("sha_b"))
    status = F.when(F.col("sha_b").isNull(), "MISSING").when(F.col("sha256") == F.col("sha_b"), "PASS").otherwise("FAIL")
    reason = F.when(F.col("sha_b").isNull(), "no rebuilt file").when(F.col("sha256") == F.col("sha_b"), "").otherwise(F.concat(F.lit("canonical forms differ: "), "sha256", F.lit(" "), "sha_b"))
    return originals.join(b, ["folder", "name"], "left").select(
        F.col("name").alias("filename"), F.col("size").alias("original_size_bytes"), status.alias("status"), F.col("path").alias("original_path"), "rebuilt_path", reason.alias("reason")
    )


#: `mins` and `abundances` in the text of a signature; a quote inside a string has a backslash before it.
MINS, ABUNDANCES = (rf'(?<!\\)"{key}"\s*:\s*' for key in ("mins", "abundances"))
TAKEN = '"abundances":[null]'  # where a list of abundances was taken out


def take_apart(spark: SparkSession, path: str, recursive: bool = True, packed: bool = True) -> DataFrame:
    """folder, name, skeleton (the text with empty members) and parts (the members of each signature) of every file.

    Members are hashes h with their abundances abund, in the file's order: those of lists `abundances`, or the
    values of a map `mins`; null where there are none. Lists and maps of members are empty in the skeleton; lists of abundances are
    taken where every one in the file is as long as its hashes, else they stay. A file with `mins`
    outside its signatures is an error.
    """
    texts = keyed_texts(spark, path, recursive, packed).withColumn("sigs", signatures_of(F.parse_json("text")))
    paired = lambda x: F.coalesce(F.size(held(x, "abundances", "array<bigint>")) == F.size(held(x, "mins", "array<string>")), held(x, "abundances").isNull())
    texts = texts.withColumn("whole", F.forall("sigs", paired)).withColumn("found", F.regexp_count("text", F.lit(MINS + r"[\[{]")))

    def members(x: Column) -> Column:
        hashes = F.transform(held(x, "mins", "array<string>"), lambda h: as_hash(F.trim(h)))
        counts = F.when(F.col("whole"), held(x, "abundances", "array<bigint>"))
        pairs = F.zip_with(hashes, F.coalesce(counts, F.transform(hashes, lambda h: F.lit(None).cast("bigint"))), lambda h, a: F.struct(h.alias("h"), a.alias("abund")))
        keyed = F.transform(F.map_entries(held(x, "mins", "map<string,bigint>")), lambda e: F.struct(as_hash(e["key"]).alias("h"), e["value"].alias("abund")))
        return F.coalesce(pairs, keyed)

    empty = F.regexp_replace(F.regexp_replace("text", MINS + r"\[[^\]]*\]", '"mins":[]'), MINS + r"\{[^}]*\}", '"mins":{}')
    taken = F.regexp_replace(empty, ABUNDANCES + r"\[[^\]]+\]", TAKEN)
    wrong = F.raise_error(F.concat(F.lit("mins outside the signatures of "), "path"))
    skeleton = F.when(F.col("found") != F.size("sigs"), wrong).otherwise(F.when(F.col("whole"), taken).otherwise(empty))
    return texts.select("folder", "name", skeleton.alias("skeleton"), F.transform("sigs", members).alias("parts"))


def rebuild(skeletons: DataFrame, parts: DataFrame) -> DataFrame:
    """folder, name, record (the text with its members) and error of every skeleton; members that are missing are an error row."""
    both = skeletons.select("folder", "name", "skeleton").join(parts.select("folder", "name", "parts"), ["folder", "name"], "left")
    places = MINS + r"(\[\]|\{\})"
    kinds, between = F.regexp_extract_all("skeleton", F.lit(places), F.lit(1)), F.split("skeleton", places, -1)
    digits = lambda own, key: F.array_join(F.transform(own, lambda x: x[key].cast("string")), ",")
    as_list = lambda own: F.concat(F.lit("["), digits(own, "h"), F.lit("]"))
    as_map = lambda own: F.concat(F.lit("{"), F.array_join(F.transform(own, lambda x: F.concat(F.lit('"'), x["h"].cast("string"), F.lit('":'), x["abund"].cast("string"))), ","), F.lit("}"))
    filled = F.transform("parts", lambda own, i: F.concat(F.get(between, i), F.lit('"mins":'), F.when(F.get(kinds, i) == "[]", as_list(own)).otherwise(as_map(own))))
    text = F.concat(F.array_join(filled, ""), F.get(between, F.size(between) - 1))
    counted = F.filter(F.arrays_zip(F.col("parts").alias("own"), kinds.alias("kind")), lambda x: (x["kind"] == "[]") & F.get(x["own"], F.lit(0))["abund"].isNotNull())
    around = F.split(text, re.escape(TAKEN), -1)
    lists = F.transform(counted, lambda x, i: F.concat(F.get(around, i), F.lit('"abundances":['), digits(x["own"], "abund"), F.lit("]")))
    record = F.concat(F.array_join(lists, ""), F.get(around, F.size(around) - 1))
    n, m = F.size(kinds), F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts"))
    fits = F.col("parts").isNotNull() & (n == m)
    said = F.concat(F.lit("members of "), m.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" signatures"))
    return both.select("folder", "name", F.when(fits, record).alias("record"), F.when(~fits, said).alias("error"))


def write_records(records: DataFrame, root: str) -> int:
    """A file for each rebuilt record, in its folder below the root, which all machines mount; and their count.

    A file appears whole or not at all.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder, name, record in zip(batch["folder"], batch["name"], batch["record"], strict=True):
                at = os.path.join(root, folder)
                os.makedirs(at, exist_ok=True)
                part = os.path.join(at, f".{name}-{uuid.uuid4().hex}")
                with open(part, "w") as f:
                    f.write(record)
                os.replace(part, os.path.join(at, name))
            yield pd.DataFrame({"n": [len(batch)]})

    return records.where("record is not null").select("folder", "name", "record").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def compare(originals: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """name, status: PASS where the canonical forms are equal, FAIL where not, MISSING where there is none.

    Both have name and record; records are compared by the digest of their canonical form.
    """
    a = originals.select("name", digest("record").alias("a"))
    b = rebuilt.select("name", digest("record").alias("b"), F.lit(True).alias("there"))
    status = F.when(F.col("there").isNull(), "MISSING").when(F.col("a") == F.col("b"), "PASS").otherwise("FAIL")
    return a.join(b, "name", "left").select("name", status.alias("status"))


def digest(record: str):
    """SHA-256 of a record struct as JSON; arrays must be sorted by the caller, keys have a fixed order."""
    return F.sha2(F.to_json(F.struct(F.col(record))), 256)


def verdict(report: DataFrame) -> DataFrame:
    """One row: counts of each status and whether all passed."""
    counts = {s.lower(): F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "FAIL", "MISSING")}
    return report.agg(F.count("*").alias("total"), *counts.values()).withColumn(
        "ok", (F.col("total") > 0) & (F.col("pass") == F.col("total")) & (F.col("fail") == 0) & (F.col("missing") == 0)
    )


def extremes(sizes: DataFrame, n: int) -> DataFrame:
    """name, size, kind: the n largest and the n smallest, ties by name."""
    large = sizes.orderBy(F.desc("size"), "name").limit(n).withColumn("kind", F.lit("largest"))
    small = sizes.orderBy("size", "name").limit(n).withColumn("kind", F.lit("smallest"))
    return large.union(small)


def random_rest(sizes: DataFrame, taken: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n of the names outside `taken`, at random by the seed; fewer than 3 n names are an error."""
    if sizes.limit(3 * n).count() < 3 * n:
        raise ValueError(f"{3 * n} names are needed")
    return sizes.join(taken.select("name"), "name", "left_anti").orderBy(F.xxhash64("name", F.lit(seed)), "name").limit(n)
