"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER

#: The query's rules: (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def url_parts(url) -> tuple:
    """Host (A-Z in lower case) and path of a url; both empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    pattern = "^([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(rest, pattern, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, pattern, 2), F.lit(""))


def _digest(host, path):
    return F.sha2(F.concat_ws("\x00", host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """page_id, url, host, path, rule and verdict for every row of pages.

    `rules` has host, path and verdict. A rule fits its host and all subdomains if the url's path
    starts with the rule's. The longest host and path wins, then the longest host, then block.
    Each url is expanded into the host suffixes and path prefixes of the shapes (labels in the
    host, length of the path) that rules have; the shapes, not the rules, reach the driver, and
    they are bounded by the longest rule. Expressions meet rules on the first `prefix_hex` digits
    of their digests; equal full digests confirm a hit.

    Null urls and urls without `://` have empty host and path and fit no rule; repeated rows and
    repeated ids are judged one by one; empty tables give empty results; other columns are left out.
    """
    known = rules.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    )
    shapes = known.select(F.size(F.split("r_host", r"\.")).alias("labels"), F.char_length("r_path").alias("n")).distinct().collect()
    posted = known.select(
        F.substring(_digest(F.col("r_host"), F.col("r_path")), 1, prefix_hex).alias("r_prefix"),
        _digest(F.col("r_host"), F.col("r_path")).alias("r_digest"),
        F.struct(
            (F.char_length("r_host") + F.char_length("r_path")).alias("n"),
            F.char_length("r_host").alias("h"),
            (F.col("r_verdict") == "block").alias("b"),
            F.concat("r_host", "r_path").alias("rule"),
            F.col("r_verdict").alias("verdict"),
        ).alias("r_rank"),
    )
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", "url", F.monotonically_increasing_id().alias("row")).withColumns({"host": host, "path": path})
    labels = F.size(F.split("host", r"\."))
    digests = F.array_compact(
        F.array(
            *[
                F.when(
                    (labels >= s.labels) & (F.char_length("path") >= s.n) & (F.col("host") != ""),
                    _digest(F.substring_index("host", ".", -s.labels), F.substring("path", 1, s.n)),
                )
                for s in shapes
            ]
        )
    ) if shapes else F.array().cast("array<string>")
    asked = urls.withColumn("digest", F.explode_outer(digests)).withColumn("prefix", F.substring("digest", 1, prefix_hex))
    best = F.max("r_rank")
    return (
        asked.join(posted, (F.col("prefix") == F.col("r_prefix")) & (F.col("digest") == F.col("r_digest")), "left")
        .groupBy("row", "page_id", "url", "host", "path")
        .agg(best.alias("best"))
        .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )


def url_filter_report(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")
