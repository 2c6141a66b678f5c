"""Thresholded similarity joins: exact over hash sets, in grids of blocks over vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jaccard, quantise
from ..sources.staging import dropped, staged
from .ordered import row_numbers
from .sketch import set_classes, set_sizes

#: dot / d > 0.05 (a + b) is the same as Jaccard > 1 / 19.
STORED = 0.05


def rarity(postings: DataFrame, sizes: DataFrame, share: float) -> DataFrame:
    """acc, h, n (the set's size) and late of the hashes that several sets hold: whether h is among the commonest that a set may leave out.

    Sets of a and b hashes are linked by more than share (a + b) common ones, which are at most b, so a
    set has more than share / (1 - share) of its hashes in common with any other: at least
    one of two sets' common hashes is left when each leaves out so many of the commonest. Hashes are in
    classes of frequency (four to an octave), and a set leaves out whole classes, from the commonest down, so
    no set is sorted. Hashes of one set alone meet nothing and go at once. `sizes` has acc and n of the sets that are
    wanted; others count for the frequencies, which may be of any order that is the same for all. `dropped` deletes the table behind the rows.
    """
    counts = postings.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h", F.floor(F.log2("k") * 4).cast("int").alias("often"))
    placed = staged(postings.join(counts.hint("merge"), "h").select("acc", "h", "often"), "placed", spent=True)
    classes = placed.groupBy("acc", "often").agg(F.count("*").alias("k"))
    down = Window.partitionBy("acc").orderBy(F.desc("often"))
    tails = classes.withColumn("upto", F.sum("k").over(down)).join(sizes.hint("merge"), "acc")
    fits = F.col("upto") <= F.floor(F.col("n") * (share / (1 - share)))
    cuts = tails.groupBy("acc", "n").agg(F.min(F.when(fits, F.col("often"))).alias("cut"))
    late = F.coalesce(F.col("often") >= F.col("cut"), F.lit(False))
    out = placed.join(cuts.hint("merge"), "acc").select("acc", "h", F.col("n").cast("int").alias("n"), late.alias("late"))
    out._staged_at = placed._staged_at
    return out


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begins[k], begins[k] + 1, ... of sizes[k] places each, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Lists:
    """A list of longs for each set of a block: the values one after the other, and where each list begins."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.begins = np.cumsum(sizes) - sizes

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def part(self, begin: int, end: int) -> Lists:
        at = self.begins[begin] if begin < len(self.begins) else 0
        return Lists(self.values[at : at + self.sizes[begin:end].sum()], self.sizes[begin:end])

    def among(self, hashes: np.ndarray) -> Lists:
        """The values' places in sorted hashes; others are left out."""
        if not len(hashes):
            return Lists(np.zeros(0, np.int64), np.zeros_like(self.sizes))
        place = np.searchsorted(hashes, self.values)
        found = hashes[np.minimum(place, len(hashes) - 1)] == self.values
        return Lists(place[found], np.bincount(self.owner[found], minlength=len(self.sizes)))


class Sets:
    """Sets of one side of a block pair."""

    rows = 10_000

    def __init__(self, batches: list[pa.RecordBatch]):
        columns = {c: [b.column(b.schema.get_field_index(c)) for b in batches] for c in ("acc", "n", "early", "late")}
        self.acc = pa.concat_arrays(columns["acc"])
        self.n = np.concatenate([c.to_numpy() for c in columns["n"]]).astype(np.int64)
        for name in ("early", "late"):
            values = np.concatenate([c.flatten().to_numpy() for c in columns[name]])
            setattr(self, name, Lists(values, np.concatenate([c.value_lengths().to_numpy() for c in columns[name]]).astype(np.int64)))

    def parts(self, members: int = 500_000) -> Iterator[tuple[int, int]]:
        """Ranges of sets of about so many members."""
        upto = np.cumsum(self.early.sizes + self.late.sizes)
        cuts = np.flatnonzero(np.diff(upto // members)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(upto)], strict=True)

    def hold(self) -> None:
        """Lays the sets out to meet others: hashes as their places in one sorted list, and the sets by early hash."""
        if hasattr(self, "hashes"):
            return
        self.hashes = np.unique(np.concatenate([self.early.values, self.late.values]))
        self.early, self.late = self.early.among(self.hashes), self.late.among(self.hashes)
        order = np.argsort(self.early.values, kind="stable")
        self.holders = self.early.owner[order].astype(np.int32)
        self.held = np.bincount(self.early.values, minlength=len(self.hashes))
        self.first = np.cumsum(self.held) - self.held
        self.keys = np.sort(self.early.owner * len(self.hashes) + self.early.values)


def within(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Whether asked ones are among sorted keys."""
    if not len(keys):
        return np.zeros(len(asked), bool)
    return keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked


def common_of(a: Sets, b: Sets, begin: int, end: int, own: bool, share: float, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places i in a (which is held) and j in b, and the number of common hashes, of the sets of b[begin:end] with more than share (n + m); with `own` b is a, and i < j.

    Sets meet on early hashes. For the pairs that may still reach the limit the late ones of each are looked up in the other set.
    """
    size = len(a.hashes)
    early, late = (x.part(begin, end) if own else x.part(begin, end).among(a.hashes) for x in (b.early, b.late))
    m, hidden = b.n[begin:end], b.late.sizes[begin:end]
    keys = np.sort(np.concatenate([x.owner * size + x.values for x in (early, late)]))
    meet = a.held[early.values]
    work = np.bincount(early.owner, meet, len(early.sizes)).astype(np.int64)  # pairs of each set of b
    upto = np.cumsum(work)
    cuts = (np.flatnonzero(np.diff(upto // cells)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(work)], strict=True):
        places = slice(early.begins[lo], early.begins[lo] + early.sizes[lo:hi].sum())
        values, sizes, owner = early.values[places], meet[places], np.repeat(np.arange(lo, hi), early.sizes[lo:hi])
        if hi - lo == 1:  # one set may meet any number
            counts, steps = np.zeros(len(a.n), np.int64), np.flatnonzero(np.diff(np.cumsum(sizes) // cells)) + 1
            for x, y in zip(np.split(values, steps), np.split(sizes, steps), strict=True):
                counts += np.bincount(a.holders[spread(a.first[x], y)], minlength=len(a.n))
            i = np.flatnonzero(counts)
            j, common = np.full(len(i), lo), counts[i]
        else:
            pairs = np.repeat(owner, sizes) * len(a.n) + a.holders[spread(a.first[values], sizes)]
            pairs, common = np.unique(pairs, return_counts=True)
            j, i = np.divmod(pairs, len(a.n))
        least = share * (a.n[i] + m[j])
        keep = (np.minimum(a.n[i], m[j]) > least) & (common + a.late.sizes[i] + hidden[j] > least)
        if own:
            keep &= i < j + begin
        i, j, common = i[keep], j[keep], common[keep]
        more = np.cumsum(a.late.sizes[i] + late.sizes[j])
        steps = np.flatnonzero(np.diff(more // cells)) + 1
        for x, y, n in zip(*(np.split(c, steps) for c in (i, j, common)), strict=True):
            for one, other, lists, known in ((x, y, a.late, keys), (y, x, late, a.keys)):
                k = np.repeat(np.arange(len(x)), lists.sizes[one])
                met = within(known, other[k] * size + lists.values[spread(lists.begins[one], lists.sizes[one])])
                n = n + np.bincount(k[met], minlength=len(x))
            linked = n > share * (a.n[x] + m[y])
            yield x[linked], y[linked] + begin, n[linked]


def similarity_join(postings: DataFrame, share: float = STORED, ids: DataFrame | None = None, tasks: int | None = None, block_members: int = 3_000_000, cells: int = 2_000_000) -> DataFrame:
    """row, col, common, jaccard and q of all pairs of distinct sets with common > share (a + b).

    With `ids` (id) only the rows of these are made, from the postings of these sets alone on one side.

    Accessions with equal sets are one, by the smallest, so copies don't multiply; each unordered
    pair is counted once and mirrored, and every set meets itself. Sets are dealt into blocks, and blocks meet in a
    triangular grid (with `ids`, in a grid of asked sets by all), each pair in one task, which holds one block and streams the other past it: pairs are counted
    where they meet and never shuffled or written. Blocks are as many as make `tasks` block pairs (three a core unless given), or more
    where one would have over `block_members` hashes, so memory is bounded; beyond that rows moved grow with the square of the hashes.
    Sets meet on their hashes without the commonest ones that they may leave out (see `rarity`), and so a hash that most sets hold is
    never joined with itself. For the pairs that have met, and may still reach the limit, the hashes left
    out are then looked up in the other set, so the counts are exact.
    """
    spark, whole = postings.sparkSession, ids is None
    postings = staged(postings.select("acc", "h"), "postings")
    classes = staged(set_classes(postings).where("acc = rep").select("acc", "n"), "classes", spent=True)
    members = rarity(postings, classes, share)
    lists = [F.collect_list(F.when(F.col("late") == late, F.col("h"))).alias(name) for name, late in (("early", False), ("late", True))]
    sets = staged(members.groupBy("acc").agg(F.first("n").alias("n"), *lists), "sets", spent=True)
    dropped(postings, members)
    asked = lambda df, acc: df if whole else df.join(ids.select(F.col("id").alias(acc)).distinct(), acc, "left_semi")
    tasks = tasks or 3 * cores(sets)
    count = lambda df: df.agg(F.count("*"), F.sum(F.size("early") + F.size("late"))).first()
    block = lambda k: F.pmod(F.xxhash64("acc"), F.lit(k)).cast("int").alias("block")
    columns = ["acc", "n", "early", "late"]
    n, size = count(sets)
    most = lambda n, size, k: max(1, min(k, -(-n // 64)), -(-(size or 0) // block_members))  # small tables have few blocks
    if whole:
        side = most(n, size, round((2 * tasks) ** 0.5))
        meet = [x for one in range(side) for other in range(one, side) for x in [(one, one * side + other, 0), *([(other, one * side + other, 1)] if one != other else [])]]
        grid = spark.createDataFrame(meet, "block int, pair int, side int")  # bounded by the square of the blocks a side
        placed = sets.select("*", block(side)).join(F.broadcast(grid), "block").select("pair", "side", *columns)
    else:
        rows = staged(asked(sets, "acc"), "rows")
        high = most(*count(rows), 1)
        wide = most(n, size, round(tasks / high))
        to = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
        x = rows.select(block(high), to(wide).alias("to"), *columns).select((F.col("block") * wide + F.col("to")).alias("pair"), F.lit(0).alias("side"), *columns)
        y = sets.select(block(wide), to(high).alias("to"), *columns).select((F.col("to") * wide + F.col("block")).alias("pair"), F.lit(1).alias("side"), *columns)
        placed = x.union(y)

    def found(a: Sets, b: Sets, own: bool) -> Iterator[pa.RecordBatch]:
        a.hold()
        for begin, end in b.parts():
            for i, j, common in common_of(a, b, begin, end, own, share, cells):
                row, col, n, m = a.acc.take(pa.array(i)), b.acc.take(pa.array(j)), a.n[i], b.n[j]
                edges = pa.record_batch([row, col, pa.array(common), pa.array(n), pa.array(m)], names=["row", "col", "common", "a", "b"])
                if not whole:
                    yield edges.filter(pc.not_equal(row, col))
                    continue
                yield edges
                yield pa.record_batch([col, row, pa.array(common), pa.array(m), pa.array(n)], names=["row", "col", "common", "a", "b"])

    kind = dict(sets.dtypes)["acc"]
    pairs = over_pairs(placed, lambda a: found(a, a, True) if whole else iter(()), lambda a, b, last: found(a, b, False), f"row {kind}, col {kind}, common long, a long, b long", Sets)
    own = asked(classes, "acc").select(F.col("acc").alias("row"), F.col("acc").alias("col"), F.col("n").alias("common"), F.col("n").alias("a"), F.col("n").alias("b"))
    score = jaccard(F.col("common"), F.col("a"), F.col("b"))
    return pairs.union(own).select("row", "col", "common", score.alias("jaccard"), quantise(score).alias("q"))


def set_pairs(postings: DataFrame) -> DataFrame:
    """a, b, common, distance: neighbouring sets (by acc) with their exact Jaccard distance."""
    sizes = set_sizes(postings)
    nxt = postings.select((F.col("acc") - 1).alias("acc"), "h")
    common = postings.join(nxt, ["acc", "h"]).groupBy("acc").agg(F.count("*").alias("common"))
    other = sizes.select((F.col("acc") - 1).alias("acc"), F.col("n").alias("m"))
    both = sizes.join(other, "acc").join(common, "acc", "left").withColumn("common", F.coalesce("common", F.lit(0)))
    return both.select(
        F.col("acc").alias("a"),
        (F.col("acc") + 1).alias("b"),
        "common",
        (F.col("n") + F.col("m") - F.col("common")).alias("together"),
        (1 - jaccard(F.col("common"), F.col("n"), F.col("m"))).alias("distance"),
    )


# --- vectors --------------------------------------------------------------------------------------
def vectors_in(df: DataFrame) -> DataFrame:
    """vec_id, v (as it is stored) and n2, the squared length, of vectors that are neither null nor zero and have finite entries."""
    n2 = F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    good = df.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).withColumn("n2", n2)
    return good.where((F.col("n2") > 0) & (F.col("n2") < float("inf")))  # null, NaN and infinite entries give such sums


def vector_classes(vectors: DataFrame) -> DataFrame:
    """rep, v and n2: the distinct vectors, each by the smallest vec_id that has it."""
    return vectors_in(vectors).groupBy("v", "n2").agg(F.min("vec_id").alias("rep"))


class Block:
    """Vectors of one side of a block pair, as doubles here and not before."""

    #: of the side that is streamed, at a time
    rows = 4096

    def __init__(self, batches: list[pa.RecordBatch]):
        columns = [[b.column(b.schema.get_field_index(c)) for b in batches] for c in ("vec_id", "n2", "v")]
        self.ids, self.n2 = (np.concatenate([c.to_numpy() for c in columns[k]]) for k in (0, 1))
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in columns[2]])
        self.v = flat.astype(np.float64).reshape(len(self.ids), -1)


def over_pairs(placed: DataFrame, inside: Callable, across: Callable, schema: str, block: type = Block) -> DataFrame:
    """Results of all block pairs of rows (pair, side and the columns of a `block`).

    A task holds the first side of one pair and streams the second past it in batches:
    across(held, batch, last) for each, and inside(held) for a pair of one side only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, first, held, waiting = None, [], None, None

        def done():
            if waiting is not None:
                yield from across(held, waiting, True)
            elif first:
                yield from inside(block(first))

        for batch in batches:
            pairs, sides = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("pair", "side"))
            ends = sorted({*(np.flatnonzero((pairs[1:] != pairs[:-1]) | (sides[1:] != sides[:-1])) + 1).tolist(), *range(block.rows, len(pairs), block.rows), len(pairs)})
            begin = 0
            for end in ends:
                if end == begin:
                    continue
                part = batch.slice(begin, end - begin)
                if pairs[begin] != pair:
                    yield from done()
                    pair, first, held, waiting = pairs[begin], [], None, None
                if sides[begin] == 0:
                    first.append(part)
                elif first:
                    if held is None:
                        held, first = block(first), [True]
                    if waiting is not None:
                        yield from across(held, waiting, False)
                    waiting = block([part])
                begin = end
        yield from done()

    sorted_ = placed.repartition("pair").sortWithinPartitions("pair", "side")
    return sorted_.mapInArrow(run, schema)


def cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def edges_of(a: Block, b: Block, rows: slice, first_col: Callable[[int], int] | None, share: float, dim_scale: float) -> list[np.ndarray]:
    """row, col, dot and jaccard of the pairs of a[rows] and b over the limit; with first_col only later columns of each row."""
    dot = a.v[rows] @ b.v.T / dim_scale
    total = (a.n2[rows, None] + b.n2[None]) / dim_scale
    keep = dot > share * total
    if first_col is not None:
        keep &= np.arange(len(b.ids))[None] >= np.array([first_col(i) for i in range(rows.start, rows.start + len(dot))])[:, None]
    i, j = np.nonzero(keep)
    dot = dot[i, j]
    return [a.ids[rows][i], b.ids[j], dot, dot / (total[i, j] - dot)]


def vector_matrix(vectors: DataFrame, share: float = STORED, dim_scale: float = 1.0, tasks: int | None = None, block_bytes: int = 1 << 26, cells: int = 4_000_000) -> DataFrame:
    """row, col, dot, jaccard and q of all pairs of distinct vectors with dot > share (a + b), a and b their squared lengths.

    dot and squared lengths are those of the vectors over `dim_scale`. Equal vectors are one, by their
    smallest vec_id (`vector_classes` has them), so copies don't multiply; pairs are given both ways and
    every vector meets itself.

    The distinct vectors are dealt by length into blocks, and blocks meet in a triangular grid, each
    unordered pair once. There are as many blocks a side as make `tasks` pairs (three a core unless
    given), or more where a block would exceed `block_bytes`; so each vector is sent to a number
    of tasks that depends on the cluster and not on the number of vectors. As a dot product is at most the product of the
    lengths, block pairs whose lengths are further apart than the limit allows are not built.

    Vectors that are null or zero or hold null or non-finite entries, and vectors of another length
    than most (of equal counts the longer), take no part; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    heads = staged(vector_classes(vectors).select(F.col("rep").alias("vec_id"), "v", "n2"), "vectors")
    size = heads.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    edge = "row long, col long, dot double, jaccard double"
    if size is None:
        return spark.createDataFrame([], edge).withColumn("q", quantise(F.col("jaccard")))
    heads = heads.where(F.size("v") == size.dim)
    side = max(1, round((2 * (tasks or 3 * cores(heads))) ** 0.5), -(-size["count"] * size.dim * 8 // block_bytes))
    side = min(side, -(-size["count"] // 64))  # small tables have few blocks
    per = -(-size["count"] // side)
    blocks = staged(row_numbers(heads, ["n2", "vec_id"], "place").withColumn("block", F.expr(f"int((place - 1) div {per})")).drop("place"), "blocks")
    ranges = sorted((r.lo, r.hi, r.block) for r in blocks.groupBy("block").agg(F.min("n2").alias("lo"), F.max("n2").alias("hi")).collect())  # one row a block
    apart = ((1 + (1 - 4 * share * share) ** 0.5) / (2 * share)) ** 2 * (1 + 1e-9) if share > 0 else float("inf")
    meet, pair = [], 0
    for i, (_, high, one) in enumerate(ranges):
        meet.append((one, pair, 0))
        pair += 1
        for low, _, other in ranges[i + 1 :]:
            if low <= high * apart:
                meet += [(one, pair, 0), (other, pair, 1)]
                pair += 1
    grid = spark.createDataFrame(meet, "block int, pair int, side int")  # bounded by the square of the blocks a side

    def found(parts: list[np.ndarray]) -> pa.RecordBatch:
        row, col, dot, score = parts
        both = [np.concatenate([row, col]), np.concatenate([col, row]), np.concatenate([dot, dot]), np.concatenate([score, score])]
        return pa.record_batch([pa.array(x) for x in both], names=["row", "col", "dot", "jaccard"])

    def across(a: Block, b: Block, last: bool) -> Iterator[pa.RecordBatch]:
        step = max(1, cells // max(1, len(b.ids)))
        for at in range(0, len(a.ids), step):
            yield found(edges_of(a, b, slice(at, at + step), None, share, dim_scale))

    def inside(a: Block) -> Iterator[pa.RecordBatch]:
        step = max(1, cells // max(1, len(a.ids)))
        for at in range(0, len(a.ids), step):
            yield found(edges_of(a, a, slice(at, at + step), lambda i: i + 1, share, dim_scale))

    pairs = over_pairs(blocks.join(F.broadcast(grid), "block"), inside, across, edge)
    length = (F.col("n2") / dim_scale).alias("dot")
    own = heads.select(F.col("vec_id").alias("row"), F.col("vec_id").alias("col"), length, F.lit(1.0).alias("jaccard"))
    return pairs.union(own).withColumn("q", quantise(F.col("jaccard")))


def vector_hits(queries: DataFrame, database: DataFrame, least: float = STORED, top: int | None = None, dim_scale: float = 1.0, tasks: int | None = None, block_bytes: int = 1 << 26, sums: bool = False, cells: int = 1_000_000) -> DataFrame:
    """query_idx, vec_id, dot, jaccard: database vectors with estimated Jaccard >= least.

    The estimate is I / (A + B - I) with I = dot / dim_scale and A, B the squared lengths over it; 0
    where the denominator is not positive. With `top`, only the best `top` of each part of the database are sent on, of exactly
    equal ones those of the smallest ids. With `sums` the rows are query_idx, n and dot: the number and the summed dot products of
    the hits in each part that has any.

    Queries and database meet in a grid of about `tasks` block pairs (three a core unless given),
    with the sides that move the fewest rows, or more query blocks where one would exceed
    `block_bytes`. A task holds its queries and streams its part of the database past them, about `cells` pairs
    at a time, whose hits are sent on before the next ones are made. Null vectors take no part.
    """
    pick = lambda df: df.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    a, b = pick(queries), pick(database)
    (n, dim), m = a.agg(F.count("*"), F.max(F.size("v"))).first(), b.count()
    tasks = tasks or 3 * cores(a)
    high = max(1, round((tasks * n / max(1, m)) ** 0.5), -(-n * (dim or 1) * 8 // block_bytes))
    wide = max(1, min(round(tasks / high), -(-m // 64)))
    deal = lambda k, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(k)).cast("int")
    copies = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    x = a.withColumn("i", deal(high, "left")).withColumn("j", copies(wide)).withColumn("side", F.lit(0))
    y = b.withColumn("j", deal(wide, "right")).withColumn("i", copies(high)).withColumn("side", F.lit(1))
    placed = x.unionByName(y).select((F.col("i") * wide + F.col("j")).alias("pair"), "side", "vec_id", F.lit(0.0).alias("n2"), "v")

    def best(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        query, ids, dot, score = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((ids, -score, query))
        query, ids, dot, score = query[order], ids[order], dot[order], score[order]
        if len(query) == 0:
            return [query, ids, dot, score]
        first = np.concatenate([[True], query[1:] != query[:-1]])
        begins = np.flatnonzero(first)
        sizes = np.diff(np.append(begins, len(query)))
        limit = score[begins + np.minimum(sizes, top) - 1] - 1e-9  # what rounding makes equal stays
        equal = np.flatnonzero(first | np.concatenate([[True], score[1:] != score[:-1]]))
        place = np.arange(len(query)) - np.repeat(equal, np.diff(np.append(equal, len(query))))
        keep = (score >= np.repeat(limit, sizes)) & (place < top)
        return [query[keep], ids[keep], dot[keep], score[keep]]

    def rows(held: Block, query: np.ndarray, ids: np.ndarray, dot: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(held.ids[query]), pa.array(ids), pa.array(dot), pa.array(score)], names=["query_idx", "vec_id", "dot", "jaccard"])

    def across(held: Block, part: Block, last: bool) -> Iterator[pa.RecordBatch]:
        step = max(1, cells // Block.rows)
        if not hasattr(held, "own"):
            held.own = np.einsum("ij,ij->i", held.v, held.v) / dim_scale
            held.best, held.hits, held.dots, held.limit = {}, np.zeros(len(held.ids), np.int64), np.zeros(len(held.ids)), np.full(len(held.ids), least)
        other = np.einsum("ij,ij->i", part.v, part.v) / dim_scale
        for at in range(0, len(held.ids), step):
            dot = held.v[at : at + step] @ part.v.T / dim_scale
            score = held.own[at : at + step, None] + other[None] - dot  # the union's size
            score = np.divide(dot, score, out=np.zeros_like(dot), where=score > 0)
            i, j = np.nonzero(score >= held.limit[at : at + step, None])
            dot, score = dot[i, j], score[i, j]
            i += at
            if sums:
                held.hits += np.bincount(i, minlength=len(held.ids))
                held.dots += np.bincount(i, dot, len(held.ids))
            elif top is not None:
                found = [i, part.ids[j], dot, score]
                held.best[at] = query, _, _, score = best([held.best[at], found] if at in held.best else [found])
                full = np.flatnonzero(np.bincount(query) >= top)  # what is below their limit need not be sorted any more
                held.limit[full] = np.maximum(least, score[np.searchsorted(query, full) + top - 1] - 1e-9)
            else:
                yield rows(held, i, part.ids[j], dot, score)
        if last and sums:
            some = held.hits > 0
            yield pa.record_batch([pa.array(held.ids[some]), pa.array(held.hits[some]), pa.array(held.dots[some])], names=["query_idx", "n", "dot"])
        elif last and top is not None:
            for found in held.best.values():
                yield rows(held, *found)

    return over_pairs(placed, lambda held: iter(()), across, "query_idx long, n long, dot double" if sums else "query_idx long, vec_id long, dot double, jaccard double")
