"""Approximate nearest neighbours: multi-index hashing of learned binary codes, cut by Hamming distance, reranked on the vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


@dataclass
class Coder:
    """Rotations learned by iterative quantisation; codes are `parts` substrings of `width` bits each."""

    scale: float  # the largest component, by which vectors are divided before they are coded
    top: float  # the largest squared length of the divided vectors
    mean: np.ndarray
    planes: np.ndarray
    width: int
    parts: int  # the substrings that are indexed
    flips: int  # the bits in which a probed substring may differ
    radius: int  # the bits in which a whole code may differ

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors of one length whose angles order the inner products with a query."""
        x = x / self.scale
        gap = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))
        return np.hstack([x, gap[:, None]])

    def codes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One number of `width` bits for each substring, those that are indexed first."""
        bits = (self.lift(x, query) - self.mean) @ self.planes > 0
        return (bits.reshape(len(x), -1, self.width) @ (1 << np.arange(self.width))).astype(np.uint16)


def fit(sample: np.ndarray, scale: float, top: float, bits: int, width: int, near: int, recall: float, rounds: int = 10, asked: int = 512) -> Coder:
    """Rotations, the number of substrings and their radius, and the radius of whole codes, from distinct sample vectors.

    Each rotation turns the principal axes so that signs lose least; `bits` are filled with several
    rotations. The radius of substrings is the least with which all of them retrieve the share `recall` of the
    true `near` neighbours in the sample; then the fewest substrings that do so are indexed. The radius of
    whole codes keeps 99 of 100 of the neighbours.
    """
    dim, parts = sample.shape[1], max(1, bits // width)
    bits = parts * width
    coder = Coder(scale, top, np.zeros(dim + 1), np.zeros((dim + 1, bits)), width, parts, 0, bits)
    lifted = coder.lift(sample, False)
    coder.mean = lifted.mean(axis=0)
    centred = lifted - coder.mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, : min(dim, bits)]
    flat = (centred @ axes)[:: max(1, len(centred) // 2048)]
    rng, planes = np.random.default_rng(0), []
    for _ in range(-(-bits // axes.shape[1])):
        turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = v.T @ u.T
        planes.append(axes @ turn)
    coder.planes = np.hstack(planes)[:, :bits]
    ask = np.arange(0, len(sample), max(1, len(sample) // asked))
    score = (sample[ask] / scale) @ (sample / scale).T
    score[np.arange(len(ask)), ask] = -np.inf
    best = np.argsort(-score, axis=1)[:, : min(near, len(sample) - 1)]
    if best.size:
        gap = np.bitwise_count(coder.codes(sample[ask], True)[:, None] ^ coder.codes(sample, False)[best])
        found = [np.mean(gap.min(axis=2) <= t) for t in range(width + 1)]
        coder.flips = next(t for t in range(width + 1) if found[t] >= recall)
        held = np.logical_or.accumulate(gap <= coder.flips, axis=2).mean(axis=(0, 1))
        coder.parts = int(np.argmax(held >= recall)) + 1
        coder.radius = int(np.ceil(np.quantile(gap.sum(axis=2, dtype=int), 0.99)))
    return coder


class MultiIndex:
    """One shard of rows: the postings of each indexed substring, the whole codes and the vectors."""

    def __init__(self, coder: Coder, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.coder, self.rows, self.ids, self.vectors = coder, rows, ids, vectors
        codes = coder.codes(vectors, False)
        self.codes = np.ascontiguousarray(codes)
        indexed = codes[:, : coder.parts].astype(np.int64)
        self.order = np.argsort(indexed, axis=0, kind="stable").T.astype(np.int32)
        counts = np.stack([np.bincount(c, minlength=1 << coder.width) for c in indexed.T])
        self.ends = np.cumsum(counts, axis=1)
        self.counts = counts
        masks = np.arange(1 << coder.width)
        self.masks = masks[np.argsort(np.bitwise_count(masks), kind="stable")]
        self.within = np.cumsum(np.bincount(np.bitwise_count(masks), minlength=coder.width + 1))
        self.touched = 0

    def met(self, code: np.ndarray, flips: int) -> np.ndarray:
        """The rows of which some indexed substring differs in at most `flips` bits from the code's.

        By the pigeonhole principle these are all rows whose indexed bits differ in fewer than
        parts * (flips + 1), and of those further off the ones that share a bucket.
        """
        values = code[: self.coder.parts, None].astype(np.int64) ^ self.masks[None, : self.within[min(flips, self.coder.width)]]
        part = np.arange(self.coder.parts)[:, None]
        size, last = self.counts[part, values], self.ends[part, values]
        part, probe = np.nonzero(size)
        size, last = size[part, probe], last[part, probe]
        at = np.repeat(last - np.cumsum(size), size) + np.arange(size.sum())
        seen = np.zeros(len(self.ids), bool)
        seen[self.order[np.repeat(part, size), at]] = True
        return np.flatnonzero(seen)

    def nearest(self, row: int, query: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and inner products of the k best rows in the probed buckets and within the radius of whole codes.

        Where fewer than k are within the radius, all rows in the buckets are ranked; where the buckets hold fewer, one
        more bit is flipped, until there are k or all rows are met.
        """
        flips = self.coder.flips
        while True:
            at = self.met(code, flips)
            self.touched += len(at)
            at = at[self.rows[at] != row]
            if len(at) >= k or flips >= self.coder.width:
                break
            flips += 1
        near = at[np.bitwise_count(self.codes[at] ^ code).sum(axis=1, dtype=int) <= self.coder.radius]
        at = near if len(near) >= k else at
        with np.errstate(all="ignore"):
            score = (self.vectors[at] * query).sum(axis=1)
        order = np.where(np.isnan(score), -np.inf, score)
        if len(at) > k:
            kth = np.partition(order, len(at) - k)[len(at) - k]
            at, score, order = at[order >= kth], score[order >= kth], order[order >= kth]
        best = np.lexsort((self.ids[at], -order))[:k]
        return at[best], score[best]


def arrays(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and vectors of batches with the columns row, vec_id and embedding."""
    parts = [[b.column(b.schema.get_field_index(c)) for b in batches] for c in ("row", "vec_id", "embedding")]
    rows, ids = (np.concatenate([c.to_numpy() for c in p]) for p in parts[:2])
    return rows, ids, np.concatenate([c.flatten().to_numpy() for c in parts[2]]).reshape(len(rows), -1)


def search(coder: Coder, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of every shard in rows (shard, asks, row, vec_id, embedding) by shard, the shard's own rows before those that ask.

    A shard's rows are indexed once; what asks is streamed past the index in batches.
    """
    shard, own, index = None, [], None
    for batch in batches:
        shards, asks = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("shard", "asks"))
        ends = [*(np.flatnonzero((shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(shards)]
        for begin, end in zip([0, *ends[:-1]], ends, strict=True):
            if begin == end:
                continue
            if shards[begin] != shard:
                shard, own, index = shards[begin], [], None
            if not asks[begin]:
                own.append(batch.slice(begin, end - begin))
            elif own:
                index = index or MultiIndex(coder, *arrays(own))
                rows, ids, vectors = arrays([batch.slice(begin, end - begin)])
                codes = coder.codes(vectors, True)
                found = [index.nearest(r, v, c, k) for r, v, c in zip(rows, vectors, codes, strict=True)]
                many = [len(at) for at, _ in found]
                at, score = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.record_batch([pa.array(np.repeat(rows, many)), pa.array(np.repeat(ids, many)), pa.array(index.ids[at]), pa.array(score)], names=["row", "query_id", "vec_id", "score"])


def nearest(
    embeddings: DataFrame,
    is_query: str = "vec_id % 20 = 0",
    k: int = 20,
    bits: int = 2048,
    width: int = 16,
    recall: float = 0.94,
    sample_rows: int = 8192,
    shard_rows: int = 32768,
    most_rows: int = 262_144,
) -> DataFrame:
    """query_id, rank, vec_id and score: for each query row its k nearest rows by inner product.

    Rotations, the number of indexed substrings of `width` bits, their radius and that of whole codes are fitted on
    about `sample_rows` vectors, drawn by the hash of vec_id. Every row is coded and lies in one shard, which has
    an index of its own; there are as many shards as hold `shard_rows` each, but no more than tasks run at a time
    (or as many as keep them below `most_rows`). Queries are streamed past every shard: rows moved are the table
    and queries times shards, so on a given cluster they grow with the table. In a shard a query reads the
    buckets of its probes, drops the rows whose whole codes are beyond the radius, and ranks the rest by exact inner
    products in double precision. Ties go to the smaller vec_id.

    Vectors that are null or zero or hold null or non-finite components, rows without a vec_id, and
    vectors of another length than most (of equal counts the longer) take no part. A row is no
    candidate of its own query. With fewer rows than k all are returned; an empty table or a table
    without queries gives no rows; other columns are left out. Repeated rows are found one by one, and
    rows that repeat a query are asked one by one, each with ranks of its own. Inner products beyond a
    double are infinite; those that are no number come last.
    """
    spark = embeddings.sparkSession
    found = "query_id long, rank int, vec_id long, score double"
    vector = F.col("embedding")
    good = (
        embeddings.where("vec_id is not null and embedding is not null")
        .where(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("embedding"))
        .where(F.exists("embedding", lambda x: x != 0))
    )
    largest = F.max(F.array_max(F.transform("embedding", F.abs)))
    sizes = good.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"), largest.alias("scale"))
    size = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    if size is None:
        return spark.createDataFrame([], found)
    kept = good.where(F.size("embedding") == size.dim)
    good = written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")  # rows keep their numbers
    top = good.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x / size.scale) * (x / size.scale)))).first()[0]
    share = min(1.0, sample_rows / size.n)
    drawn = good.where(F.pmod(F.xxhash64("vec_id", F.lit("codes")), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("embedding").toPandas()
    sample = np.unique(np.array(drawn["embedding"].tolist(), np.float64).reshape(-1, size.dim), axis=0)
    blank = Coder(size.scale, top, np.zeros(size.dim + 1), np.eye(size.dim + 1, width), width, 1, width, width)
    coder = fit(sample, size.scale, top, bits, width, max(1, round(k * len(sample) / size.n)), recall) if len(sample) else blank
    shared = spark.sparkContext.broadcast(coder)

    shards = max(min(-(-size.n // shard_rows), spark.sparkContext.defaultParallelism), -(-size.n // most_rows))
    own = good.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).withColumn("asks", F.lit(False))
    asking = good.where(is_query).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("asks", F.lit(True))
    dealt = own.unionByName(asking).select("shard", "asks", "row", "vec_id", "embedding").repartition(shards, "shard").sortWithinPartitions("shard", "asks")

    hits = dealt.mapInArrow(lambda batches: search(shared.value, k, batches), "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
