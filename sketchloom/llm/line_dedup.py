"""Line dedup: explode normalised lines, hash them, count documents per hash, drop repeats, reassemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

BLANKS = " \t\n\x0b\x0c\r"


def marked(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """docs with _ld_lines, the lines of the text, and _ld_drop, the positions to drop (null for none).

    Lines are exploded and hashed once and written, so that the counts and the join that finds the
    lines of a repeated key both read the table; a key of any number of lines is aggregated before it
    is shuffled, and as both sides of that join are plain shuffles, a hot key is split at run time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("_ld_text", text).withColumn("_ld_mark", F.xxhash64(text))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(BLANKS)))
    lines = written(
        rows.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.col("_ld_mark").alias("mark"), F.posexplode(F.split("_ld_text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "mark", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "mark", "pos", F.unhex(F.md5("key")).alias("digest")),
        "lines",
    )
    if min_docs == 2:  # two documents hold a key when its smallest and largest doc_id differ
        held = lines.groupBy("digest").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        shared = held.where("keeper < last").select("digest", "keeper")
    else:
        held = lines.select("digest", "doc_id").distinct().groupBy("digest").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
        shared = held.where(F.col("n") >= min_docs).select("digest", "keeper")
    drops = (
        lines.join(written(shared, "keys"), "digest")
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy(F.col("doc_id").alias("_ld_id"), F.col("mark").alias("_ld_of"))
        .agg(F.collect_set("pos").alias("_ld_drop"))
    )
    met = (F.col("doc_id") == F.col("_ld_id")) & (F.col("_ld_mark") == F.col("_ld_of"))
    return rows.join(drops.hint("shuffle_hash"), met, "left").withColumn("_ld_lines", F.split("_ld_text", "\n", -1))


def kept_text() -> Column:
    lines = F.col("_ld_lines")
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_drop"))
    return F.when(F.col("_ld_drop").isNull(), F.col("_ld_text")).otherwise(F.array_join(F.transform(kept_at, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """docs with `kept_text`, `n_lines` (before dropping) and `n_dropped`.

    A line's key is the line without blanks at both ends and with A-Z in lower case. Keys of at
    least `min_chars` code points that occur in at least `min_docs` documents lose all their lines
    except in the smallest doc_id that holds them, where every one stays. Keys are compared by
    128-bit digests.

    Null or empty text is one empty line. Rows without a doc_id neither count as a document nor
    lose lines. Rows that repeat a doc_id count as one document. An empty table gives no rows. Other
    columns pass through; columns that have the name of a result are replaced by it.
    """
    results = {
        "kept_text": kept_text(),
        "n_lines": F.size("_ld_lines").cast("long"),
        "n_dropped": F.coalesce(F.size("_ld_drop"), F.lit(0)).cast("long"),
    }
    return marked(docs, min_chars, min_docs).select(*[c for c in docs.columns if c not in results], *[x.alias(c) for c, x in results.items()])


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what stays of each document."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256")
    )


def line_dedup_stage(docs: DataFrame) -> DataFrame:
    """docs with repeated lines taken out of `text`; `n_chars`, where there is one, counts what stays.

    All other columns are kept as they are, whatever their names. A document that loses every line
    stays as a row with empty text, a null text becomes empty, and an empty table stays empty.
    """
    new = {"text": kept_text(), "n_chars": F.char_length(kept_text()).cast("long")}
    return marked(docs, 10, 2).select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])
