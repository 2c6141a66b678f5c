"""MinHash near-dedup: BagMinHash signatures of shingle multisets, banding, verified overlap, classes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, chunks, discard, maybe_in, mix64, written
from .components import connected

#: Bytes to their lower-cased word byte, or 0 between words.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[: ord("0")] = 0
FOLD[ord("9") + 1 : ord("a")] = 0
FOLD[ord("z") + 1 : 128] = 0
for _u, _l in zip(UPPER, LOWER, strict=True):
    FOLD[ord(_u)] = ord(_l)

BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, 64-bit hash, count) of every distinct shingle of `width` words, by text and hash.

    A text of fewer words has one shingle of all its words; a text without words, one of its bytes.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(x) + 1 for x in texts], np.int64)
    text_ends = np.cumsum(sizes)
    letters = FOLD[data]
    inside = letters != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]  # the last byte is a line feed, so every word ends
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters.astype(np.uint64) * powers(BASE, len(data)), out=total[1:])
    word = mix64((total[end] - total[begin]) * powers(INVERSE, len(data))[begin] + (end - begin).astype(np.uint64))
    owner = np.searchsorted(text_ends, begin, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    parts_owner, parts_hash = [], []
    if len(word) >= width:
        hashed = np.zeros(len(word) - width + 1, np.uint64)
        for k in range(width):
            hashed = hashed * BASE + word[k : k + len(hashed)]
        whole = owner[: len(hashed)] == owner[width - 1 :]
        parts_owner.append(owner[: len(hashed)][whole])
        parts_hash.append(mix64(hashed[whole]))
    short = np.flatnonzero(n_words < width)
    firsts = np.cumsum(n_words) - n_words
    own = []
    for i in short:
        if n_words[i]:
            h = np.uint64(n_words[i])
            for w in word[firsts[i] : firsts[i] + n_words[i]]:
                h = np.multiply(h, BASE, dtype=np.uint64) + w
            own.append(int(mix64(np.array([h], np.uint64))[0]))
        else:
            own.append(int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little"))
    parts_owner.append(short)
    parts_hash.append(np.array(own, np.uint64))
    owner, hashed = np.concatenate(parts_owner), np.concatenate(parts_hash)
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashed[at], np.diff(np.append(at, len(owner)))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes to numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def bag_minhash(owner: np.ndarray, element: np.ndarray, count: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash signatures, n x m: equal with the probability of the weighted Jaccard similarity.

    Every element owns a Poisson process over the plane of weight and time for each of m places;
    a place's value is the first point below the element's weight, over all elements. Weights are
    cut at 1, 2, 4, ...: each slab is one process of its own rate, which is taken whole where it
    lies below the weight and thinned by the points' own weights where the weight ends in it. Points
    come in order of time and only up to a limit, which is raised for the texts that have an empty
    place: so all points below the largest minimum are seen, and few beyond.
    """
    top = np.zeros(len(count), np.int64)
    while (more := count > (1 << top)).any():
        top += more
    # slab j covers weights (2^(j-1), 2^j], slab 0 covers (0, 1]
    index = np.repeat(np.arange(len(count)), top + 1)
    slab = np.arange(len(index)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    width = np.where(slab == 0, 1, 1 << np.maximum(slab - 1, 0))
    low = np.where(slab == 0, 0, width)
    who, weight = owner[index], count[index]
    seed = mix64(element[index] + slab.astype(np.uint64) * BASE)
    mass = np.bincount(owner, weights=count, minlength=n)
    limit = (np.log(m) + 3) / np.maximum(mass, 1)  # of time, by text
    time = np.full((n, m), np.inf)
    tag = np.zeros((n, m), np.uint64)
    todo = np.ones(n, bool)
    while todo.any():
        at = np.flatnonzero(todo[who])
        state, rate = seed[at], width[at] * float(m)
        now = np.zeros(len(at))
        step = np.zeros(1, np.uint64)
        points: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            step += np.uint64(1)
            draw = mix64(state + step * INVERSE)
            now = now - np.log(unit(draw)) / rate
            soon = now <= limit[who[at]]
            at, state, rate, now, draw = at[soon], state[soon], rate[soon], now[soon], draw[soon]
            other = mix64(draw + BASE)
            place = (other >> np.uint64(40)).astype(np.int64) % m
            cell = low[at] + 1 + ((other & np.uint64(0xFFFFFFFFFF)).astype(np.float64) * 2.0**-40 * width[at]).astype(np.int64)
            below = cell <= weight[at]
            points.append((who[at][below], place[below], now[below], draw[below]))
        text, place, when, draw = (np.concatenate([p[i] for p in points]) for i in range(4))
        order = np.lexsort((when, place, text))
        text, place, when, draw = text[order], place[order], when[order], draw[order]
        first = np.ones(len(text), bool)
        first[1:] = (text[1:] != text[:-1]) | (place[1:] != place[:-1])
        time[text[first], place[first]] = when[first]
        tag[text[first], place[first]] = draw[first]
        todo = np.isinf(time).any(axis=1) & (mass > 0)
        limit[todo] *= 2
    return tag


def overlaps(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the shingle multisets of some texts and the sizes of their pairwise intersections.

    A shingle that stands k times is k levels, and every level that two texts or more have is a
    column of bits; columns are taken in slices, so that memory doesn't grow with them.
    """
    owner, hashed, count = shingles(texts, width)
    n = len(texts)
    total = np.bincount(owner, weights=count, minlength=n).astype(np.int64)
    index = np.repeat(np.arange(len(owner)), count)
    level = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
    _, column, df = np.unique(hashed[index] + level.astype(np.uint64) * INVERSE, return_inverse=True, return_counts=True)
    kept = df > 1
    place = np.cumsum(kept) - 1
    shared = kept[column]
    row, column = owner[index][shared], place[column[shared]]
    both = np.zeros((n, n), np.int64)
    slice_ = 1 << 15
    for begin in range(0, int(kept.sum()), slice_):
        here = (column >= begin) & (column < begin + slice_)
        wide = min(slice_, int(kept.sum()) - begin)
        bits = np.zeros((n, -(-wide // 64) * 64), bool)
        bits[row[here], column[here] - begin] = True
        words = np.packbits(bits, axis=1).view(np.uint64)
        step = max(1, (1 << 22) // max(1, n * words.shape[1]))
        for i in range(0, n, step):
            both[i : i + step] += np.bitwise_count(words[i : i + step, None] & words[None]).sum(axis=2, dtype=np.int64)
    return total, both


def forest(nodes: np.ndarray, texts: list[bytes], similarity: float, width: int) -> list[tuple[int, int]]:
    """Links (node, smallest node of its part) that join what overlaps by `similarity` among the texts."""
    total, both = overlaps(texts, width)
    near = both >= similarity * (total[:, None] + total[None] - both) * (1 - 1e-12)
    np.fill_diagonal(near, True)
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    while True:
        least = np.array([rank[x].min() for x in near])
        if (least == rank).all():
            break
        rank = least
    roots = nodes[order][rank]
    return [(int(a), int(b)) for a, b in zip(nodes, roots, strict=True) if a != b]


SIGNED = "doc_id long, digest binary, bands array<long>, sketch binary"


def signed(docs: DataFrame, bands: int, rows: int, width: int, seed: int = 0) -> DataFrame:
    """doc_id, digest, band keys and a sketch of 16 bits a place of the text, for every row."""
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.encode() for x in batch.column("text").to_pylist()]
            keys, sketches = [], []
            for b, e in chunks([len(x) for x in texts], 1_000_000):
                tag = mix64(bag_minhash(*shingles(texts[b:e], width), e - b, m) + np.uint64(seed))
                key = np.zeros((e - b, bands), np.uint64)
                for r in range(rows):
                    key = mix64(key * BASE + tag[:, r::rows])
                key = mix64(key + np.arange(bands, dtype=np.uint64) * INVERSE)
                keys += list(key.view(np.int64))
                sketches += [x.tobytes() for x in tag.astype(np.uint16)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("digest"), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "digest", "bands", "sketch"],
            )

    return docs.select("doc_id", "digest", "text").mapInArrow(run, SIGNED)


def compared(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """a, b and alike, the share of places in which their sketches agree."""
    both = pairs.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(
        sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.array([np.frombuffer(s, np.uint16) for s in batch.column(c).to_pylist()]) for c in ("sketch_a", "sketch_b"))
                yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array((x == y).mean(axis=1))], names=["a", "b", "alike"])

    return both.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long, alike double")


def settled(band: np.ndarray, node: np.ndarray, sketch: np.ndarray, joins: float, stays: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (pivots, nodes) of all bands of a block: the rounds of `candidate_groups` on arrays."""
    at = np.lexsort((node, band))
    while len(at):
        head = np.ones(len(at), bool)
        head[1:] = band[at][1:] != band[at][:-1]
        pivot, own = at[np.flatnonzero(head)[np.cumsum(head) - 1]][~head], at[~head]
        alike = (sketch[pivot] == sketch[own]).mean(axis=1)
        yield node[pivot[alike >= joins]], node[own[alike >= joins]]
        at = own[alike < stays]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest node of its part, node) that connect what the links (a, b) connect: one a node at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
    under = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[under]], nodes[under]


def candidate_groups(heads: DataFrame, similarity: float, places: int, most_rows: int = 2048, rounds: int = 4) -> DataFrame:
    """node and class of all nodes that may be linked: links lie within one class.

    In each bucket every member's sketch is compared with the smallest member's. Distance is a
    metric, so with d = 1 - similarity two linked members are both within 2d of it, where one of
    them is within d; or else both are further than d. Members within 3d join its class, and those
    beyond 2d form the bucket of the next round, until none has two members: a bucket costs its
    size in each round. Both limits leave four standard errors of a sketch.

    While a bucket has over `most_rows` members, up to `rounds` rounds run over all tables, which
    thins out buckets of near copies. The other rounds run inside blocks of buckets; a bucket that
    is still larger is dealt into several blocks, each of which meets all its others. A block returns
    one link a node at most, however many of its pairs join.
    """
    far = 1 - similarity
    sketches = heads.select("doc_id", "sketch")
    error = lambda x: 4 * (x * (1 - x) / places) ** 0.5
    joins = 1 - 3 * far - error(1 - 3 * far)
    stays = 1 - 2 * far + error(1 - 2 * far)
    rest = heads.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    links, spent = [], []
    for k in range(rounds + 1):
        sizes = written(rest.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1"), "sizes")
        spent.append(sizes)
        largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
        if k == rounds or (largest or 0) <= most_rows:
            break
        met = written(rest.join(sizes.select("band", "pivot"), "band").where("node <> pivot"), "buckets")
        pairs = met.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        alike = written(compared(pairs, sketches), "alike")
        links.append(alike.where(F.col("alike") >= joins).select("a", "b"))
        beyond = alike.where(F.col("alike") < stays).select(F.col("a").alias("pivot"), F.col("b").alias("node"))
        rest = written(met.join(beyond, ["pivot", "node"]).select("node", "band"), "rest")
        spent += [met, alike, rest]

    bins = int((total or 0) / most_rows) + 1
    n = F.ceil(F.col("n") / most_rows).cast("int")
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    others = F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j")))
    alone = F.array(F.struct(F.pmod(F.xxhash64("band"), F.lit(bins)).cast("int").alias("i"), F.lit(-1).alias("j")))
    dealt = (
        rest.join(sizes.select("band", "n"), "band")
        .join(sketches, F.col("node") == F.col("doc_id"))
        .withColumn("at", F.explode(F.when(n > 1, others).otherwise(alone)))
        .select("node", "band", "sketch", (n > 1).alias("large"), F.when(n > 1, F.col("band")).otherwise(-1).alias("of"), "at.i", "at.j")
    )

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        sketch = np.array([np.frombuffer(x, np.uint16) for x in rows["sketch"]])
        a = b = np.zeros(0, np.int64)
        for pivots, own in settled(rows["band"].to_numpy(), rows["node"].to_numpy(), sketch, joins, stays):
            a, b = np.concatenate([a, pivots]), np.concatenate([b, own])
            if len(a) > 8 * len(rows):
                a, b = spanning(a, b)
        a, b = spanning(a, b)
        return pd.DataFrame({"a": a, "b": b})

    links.append(dealt.groupBy("large", "of", "i", "j").applyInPandas(link, "a long, b long"))
    linked = written(reduce(DataFrame.union, links), "links")
    discard(*spent)
    return connected(linked)


def near_links(texts: DataFrame, groups: DataFrame, similarity: float, width: int, most_rows: int = 2048, most_bytes: int = 8_000_000) -> DataFrame:
    """Links (a, b) between texts of one class of candidates, enough to connect all that overlap by `similarity`.

    `groups` has node, digest and class; a node's text is the one of this digest. Whole texts are
    compared in blocks of about `most_rows` rows and `most_bytes` bytes: a larger class has several
    blocks, each of which meets all its others; small classes share a block. Texts in no class are
    sorted out before the shuffle.
    """
    own = maybe_in(texts.withColumnRenamed("doc_id", "node"), groups, "node").withColumn("digest", F.unhex(F.md5("text")))
    spare = written(own.join(groups, ["node", "digest"]).dropDuplicates(["node"]).drop("digest"), "candidates")
    size = F.greatest(F.count("*") / most_rows, F.sum(F.octet_length("text")) / most_bytes)
    sizes = spare.groupBy("class").agg(size.alias("size"))
    whole = sizes.agg(F.sum("size")).first()[0] or 0
    bins = int(whole * 2) + 1
    blocks = written(sizes.withColumn("n", F.when(F.col("size") > 0.5, F.ceil("size")).otherwise(0).cast("int")), "sizes")
    large = F.col("n") > 0
    own = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    alone = F.array(F.struct(F.pmod(F.xxhash64("class"), F.lit(bins)).cast("int").alias("i"), F.lit(-1).alias("j")))
    dealt = (
        spare.join(blocks.select("class", "n"), "class")
        .withColumn("at", F.explode(F.when(large, others).otherwise(alone)))
        .select("node", "text", "class", F.when(large, F.col("class")).otherwise(-1).alias("of"), "at.i", "at.j")
    )

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby("class"):
            out += forest(part["node"].to_numpy(), [x.encode() for x in part["text"]], similarity, width)
        return pd.DataFrame(out, columns=["a", "b"])

    return dealt.groupBy("of", "i", "j").applyInPandas(link, "a long, b long")


def near_classes(docs: DataFrame, similarity: float = 0.8, width: int = 5, bands: int = 24, rows: int = 4) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its class) for every row with a doc_id.

    Documents are near-duplicates when the multisets of their shingles of `width` words overlap by
    at least `similarity` (weighted Jaccard); classes are what chains of such links connect. Words
    are runs of digits, letters and non-ASCII characters, with A-Z in lower case.

    Equal texts form one node, whatever their number. Nodes that share a band are candidates; their
    sketches put those that may be linked into classes of candidates, and within these whole texts
    are compared, all with all, in blocks. No bucket or class has a limit.

    Null text counts as empty; all empty texts are copies of each other. Rows without a doc_id are
    left out. Of rows that repeat a doc_id one text counts, that of the least digest. An empty table
    gives no rows.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signatures = written(signed(texts.withColumn("digest", F.unhex(F.md5("text"))), bands, rows, width), "signatures")
    chosen = signatures.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    nodes = written(chosen.groupBy("digest").agg(F.min("doc_id").alias("node")), "nodes")
    members = written(chosen.join(nodes, "digest").select("doc_id", "node"), "members")
    heads = signatures.join(nodes.select(F.col("node").alias("doc_id"), "digest"), ["doc_id", "digest"]).dropDuplicates(["doc_id"])
    heads = written(heads.select("doc_id", "bands", "sketch"), "heads")
    discard(signatures)
    groups = written(candidate_groups(heads, similarity, bands * rows).join(nodes, "node"), "groups")
    discard(heads)
    classes = connected(near_links(texts, groups, similarity, width))
    return members.join(classes, "node", "left").select("doc_id", F.coalesce("class", "node").alias("class_id"))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    return near_classes(docs)


def near_dedup_stage(docs: DataFrame) -> DataFrame:
    """One document of each class: the one with the smallest doc_id. All columns are kept.

    Rows without a doc_id stay; of rows that repeat a kept doc_id all stay.
    """
    classes = near_classes(docs).select(F.col("doc_id").alias("_nd_id"), F.col("class_id").alias("_nd_class"))
    gone = classes.where("_nd_id <> _nd_class")
    return docs.join(gone, docs["doc_id"] == gone["_nd_id"], "left_anti")
