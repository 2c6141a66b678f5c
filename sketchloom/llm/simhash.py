"""SimHash near-dedup: fingerprints of shingles, linked through rings of segments within proportional budgets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, written
from .components import connected

LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def words_in(text: bytes, piece: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text (runs of bytes that are no blanks), in pieces of the text."""
    at = 0
    while at < len(text):
        blank = SPACE.search(text, min(at + piece, len(text)))
        end = blank.start() if blank else len(text)
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, width: int, seed: int, piece: int = 1 << 22) -> Iterator[np.ndarray]:
    """XXH64 of every run of `width` words, repeats included; of all words where there are fewer."""
    words: list[bytes] = []
    n, seen = 0, 0
    for more in words_in(text.translate(LOWERED), piece):
        words, seen = words[n:] + more, seen + len(more)
        n = max(0, len(words) - width + 1)
        if n:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate([[0], ends[: n - 1] + 1])
            yield np.array([xxhash.xxh64_intdigest(joined[b:e], seed) for b, e in zip(begins.tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64)
    if 0 < seen < width:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """64 bits, each set where over half the shingles' hashes have it; 0 without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width, seed):
        for at in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id and fp, the fingerprint as a long of the same bits, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", width, seed) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def ring(distance: int) -> list[tuple[int, int]]:
    """(shift, bits) of distance + 1 segments of 64 bits, of equal length but for the last."""
    size = -(-64 // (distance + 1))
    return [(at, min(size, 64 - at)) for at in range(0, 64, size)]


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest place of each part) after the parts of a and b have been joined."""
    while len(a := a[keep := label[a] != label[b]]):
        b = b[keep]
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        root = np.arange(len(label))
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        label = root[label]
    return label


def ring_links(fp: np.ndarray, bucket: np.ndarray, start: int, distance: int, most: int = 2_000_000) -> np.ndarray:
    """The label of every fingerprint: its bucket's members that links of at most `distance` bits connect, by the first place.

    Members of a bucket agree in segment `start` of the ring. If x and y differ in no more than
    distance bits, then from some segment on, every chain of k consecutive segments differs in at
    most k * distance / segments. So the next segment is looked up with as many flipped bits as the
    chain of two leaves, and the chain of three is checked, before all bits are counted. Runs of
    members that are all in the part of the one who asks are passed over.
    """
    parts = ring(distance)
    budget = [k * distance // len(parts) for k in range(len(parts) + 1)]
    chain = [parts[(start + k) % len(parts)] for k in range(3)]
    shift, bits = chain[1]
    key = (bucket.astype(np.uint64) << np.uint64(bits)) | ((fp >> np.uint64(shift)) & np.uint64((1 << bits) - 1))
    order = np.lexsort((fp, key))
    key, x = key[order], fp[order]
    label = np.arange(len(x))
    beside = np.flatnonzero((bucket[order][1:] == bucket[order][:-1]) & (np.bitwise_count(x[1:] ^ x[:-1]) <= distance))
    label = merged(label, beside, beside + 1)

    three = np.uint64(sum(((1 << w) - 1) << s for s, w in chain))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
    last = np.append(first[1:], len(x))
    asked, lo, into = [np.arange(len(x))], [np.arange(1, len(x) + 1)], [run]
    masks = [sum(1 << i for i in at) for k in range(1, budget[2] + 1) for at in combinations(range(bits), k)]
    for mask in masks:
        other = key[first] ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(key[first], other), len(first) - 1)
        met = (key[first][at] == other) & (other > key[first])
        row = np.flatnonzero(met[run])
        asked, lo, into = [*asked, row], [*lo, first[at[run[row]]]], [*into, at[run[row]]]
    asked, lo, into = (np.concatenate(v) for v in (asked, lo, into))
    size = last[into] - lo
    while len(asked):
        low, high = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first)
        open_ = (size > 0) & ~((low[into] == high[into]) & (low[into] == label[asked]))
        asked, lo, into, size = (v[open_] for v in (asked, lo, into, size))
        n = max(1, int(np.searchsorted(np.cumsum(size), most, side="right")))
        own, many = asked[:n], size[:n]
        a = np.repeat(own, many)
        b = np.repeat(lo[:n] + many - np.cumsum(many), many) + np.arange(many.sum())
        asked, lo, into, size = (v[n:] for v in (asked, lo, into, size))
        apart = x[a] ^ x[b]
        near = np.flatnonzero(np.bitwise_count(apart & three) <= budget[3])
        near = near[np.bitwise_count(apart[near]) <= distance]
        label = merged(label, a[near], b[near])
    out = np.empty(len(x), np.int64)
    out[order] = order[label]
    return out


def near_links(prints: DataFrame, distance: int = 4, block: int = 65_536) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints (fp) of at most `distance` differing bits: one a member and bucket at most.

    Fingerprints meet in buckets of one segment of the ring, of which there are at most
    (distance + 1) * 2^bits. A bucket of more than `block` members is dealt into blocks that
    all meet each other. Tasks hold one chunk of whole buckets or two blocks.
    """
    parts = ring(distance)
    bits = max(w for _, w in parts)
    value = [F.lit(k << bits) + F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1) for k, (s, w) in enumerate(parts)]
    posted = prints.select("fp", F.explode(F.array(*[v.cast("int") for v in value])).alias("bucket"))
    large = posted.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 2), lambda k: F.when(k < own, k * F.col("blocks") + own).otherwise(own * F.col("blocks") + k + 1))
    dealt = posted.join(F.broadcast(large), "bucket", "left").select("fp", "bucket", F.explode(F.coalesce(met, F.array(F.lit(-1)))).alias("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "pair", "fp")], axis=1)
            held = np.concatenate([held, rows])
            if len(held) >= block and (held[0, :2] != held[-1, :2]).any():
                whole = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))[-1] + 1
                yield linked(held[:whole])
                held = held[whole:]
        yield linked(held)

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        starts = rows[:, 0] >> bits
        for start in np.unique(starts):
            own = rows[starts == start]
            group = np.cumsum(np.concatenate([[0], (own[1:, :2] != own[:-1, :2]).any(axis=1)]))
            label = ring_links(own[:, 2].astype(np.uint64), group, int(start), distance)
            under = np.flatnonzero(label != np.arange(len(label)))
            a.append(own[under, 2])
            b.append(own[label[under], 2])
        a, b = (np.concatenate([np.zeros(0, np.int64), *v]) for v in (a, b))
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair").select("bucket", "pair", "fp").mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Words are runs of characters that are no ASCII blanks, with A-Z in lower case; a document of fewer
    words than `width` has one shingle of all, one without words the fingerprint zero. Documents link
    where fingerprints differ in at most `distance` bits; component_id is the smallest doc_id that
    links reach. Equal fingerprints are one before any comparison, so copies of any number cost
    nothing; no bucket has a limit.

    Null text counts as empty; all documents without words link. Rows without a doc_id have a
    fingerprint and the component_id of those they link with (null where none has a doc_id). Rows that
    repeat a doc_id are compared each by its own text. An empty table gives no rows; other columns are left out.
    """
    rows = written(fingerprints(docs, width, seed), "fingerprints")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    links = written(near_links(prints.select("fp"), distance), "links")
    classes = connected(links)
    named = written(prints.join(classes, prints["fp"] == classes["node"], "left").select("fp", "first", F.coalesce("class", "fp").alias("class")), "classes")
    discard(links)
    least = written(named.groupBy("class").agg(F.min("first").alias("component_id")), "least")
    found = named.join(least, "class").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
