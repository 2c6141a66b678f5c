"""Document fingerprints: chains of content words after common-word anchors, compared by pruned Jaccard."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, maybe_in, shuffled, words_of, written
from .components import connected

# The common words at which chains begin.
ANCHORS = (
    "the of and a to in is that it for was on are with be at this from or as by an "
    "de la le et les des en un une du que qui dans est pour "
    "der die und den von zu das mit sich auf ist im dem ein eine "
    "el los las y se del por con su".split()
)


def with_spots(df: DataFrame, text: str, name: str, chain: int = 2) -> DataFrame:
    """df with `name`: the sorted distinct spot signatures of a text column, as 64-bit hashes.

    A signature is an anchor and the `chain` content words (words that are no anchors) after it. A
    text without a full chain has one signature, of all its words; a text without words, of itself.
    """
    words, content = F.col("_sp_words"), F.col("_sp_content")
    n = F.size(words)
    # before the j-th anchor, at word i, stand i - j content words
    spot = lambda x, j: F.when(
        F.get(content, x["i"] - j + chain - 1).isNotNull(), F.xxhash64(x["w"], *[F.get(content, x["i"] - j + k) for k in range(chain)])
    )
    anchor = lambda w, i: F.when(w.isin(ANCHORS), F.struct(w.alias("w"), i.alias("i")))
    return (
        df.withColumn("_sp_words", words_of(F.col(text)))
        .withColumn("_sp_content", F.filter("_sp_words", lambda w: ~w.isin(ANCHORS)))
        .withColumn("_sp_at", F.array_compact(F.transform("_sp_words", anchor)))
        .withColumn("_sp_spots", F.sort_array(F.array_distinct(F.array_compact(F.transform("_sp_at", spot)))))
        .withColumn(
            name,
            F.when(F.size("_sp_spots") > 0, F.col("_sp_spots")).otherwise(
                F.array(F.when(n > 0, F.xxhash64(words)).otherwise(F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
            ),
        )
        .drop("_sp_words", "_sp_content", "_sp_at", "_sp_spots")
    )


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets, or 0 where it is below `least`.

    It is at most the smaller size over the larger, so sets of too different sizes aren't intersected.
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(small < least * (1 - 1e-12) * large, F.lit(0.0)).when(exact < least, F.lit(0.0)).otherwise(exact)


def as_text(spots: Column) -> Column:
    return F.array_join(F.transform(spots, lambda x: F.lower(F.hex(x))), " ")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two keys that are never null: `at` (doc_id, the least long for null) and `mark` (hash of the text)."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"at": at, "mark": F.xxhash64("text", F.col("doc_id").isNull())})


def followers(texts: DataFrame, rows: int = 500_000) -> DataFrame:
    """at, mark, n, next_at and next_mark: each document and the next by ascending doc_id.

    Documents are distinct pairs of doc_id and text; null ids come first, texts of one id by mark,
    and the first follows the last. doc_ids are dealt into ranges of about `rows` each; within a range
    the next is a window's lead, and the last of a range is followed by the first of the next range.
    """
    ids = written(texts.select("at", "mark", F.char_length("text").alias("n")).distinct(), "ids")
    parts = max(1, -(-ids.count() // rows))
    ranged = written(ids.repartitionByRange(parts, "at", "mark").withColumn("part", F.spark_partition_id()), "ranges")
    discard(ids)
    key = F.struct("at", "mark")
    inside = Window.partitionBy("part").orderBy("at", "mark")
    over = Window.orderBy("part")
    heads = ranged.groupBy("part").agg(F.min(key).alias("head"))
    first = F.first("head").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(over), first).alias("after"))
    return (
        ranged.withColumn("follows", F.lead(key).over(inside))
        .join(heads, "part")
        .withColumn("follows", F.coalesce("follows", "after"))
        .select("at", "mark", "n", F.col("follows.at").alias("next_at"), F.col("follows.mark").alias("next_mark"))
    )


def fingerprint_report(docs: DataFrame, similarity: float = 0.8, chain: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, how alike they and the next one's are, and the text's class.

    The edited text ends in the beginning of the next document instead of its own last quarter;
    next_id is that document. class_id is the smallest doc_id of the documents that are alike anywhere
    in the table (`spot_classes`). Texts are shuffled once, by document; the next one's beginning and
    signatures are sent to the document before.

    Null text counts as empty, whose edited text is empty. Rows that repeat a doc_id and text are
    one document in the order and get a row each; a table of one document follows itself; rows without
    a doc_id have no class; an empty table gives no rows; other columns are left out.
    """
    texts = keyed(docs)
    classes = spot_classes(docs, similarity, chain).select(F.col("doc_id").alias("at"), "class_id")
    order = followers(texts).join(shuffled(classes), "at", "left")
    copies = Window.partitionBy("at", "mark").orderBy("at")
    dealt = texts.withColumn("first", F.lag(F.lit(1)).over(copies).isNull())
    heads = order.select("next_at", "next_mark", F.floor(F.col("n") / 4).cast("int").alias("take"), F.col("at").alias("for_at"), F.col("mark").alias("for_mark"), "class_id")
    giving = dealt.where("first").join(shuffled(heads), (F.col("at") == F.col("next_at")) & (F.col("mark") == F.col("next_mark")))
    giving = with_spots(giving.select("for_at", "for_mark", "class_id", "take", "text", F.col("doc_id").alias("next_id")), "text", "next_spots", chain).select(
        "for_at", "for_mark", "class_id", "next_id", "next_spots", F.substring(F.col("text"), F.lit(1), F.col("take")).alias("borrowed")
    )
    n = F.char_length("text")
    own = dealt.join(shuffled(giving), (F.col("at") == F.col("for_at")) & (F.col("mark") == F.col("for_mark"))).select(
        "doc_id",
        "text",
        "next_id",
        "next_spots",
        F.expr("if(doc_id is null, null, class_id)").alias("class_id"),
        n.cast("long").alias("n_chars"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - F.floor(n / 4).cast("int")), "borrowed").alias("edited"),
    )
    own = with_spots(with_spots(own, "text", "spots", chain), "edited", "edited_spots", chain)
    return own.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("spots")).alias("fingerprint"),
        as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        "next_id",
        "class_id",
    )


def kept(df: DataFrame, name: str) -> DataFrame:
    """As `written`, and the shuffle files of the rows' plan go when they are written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


#: Longs of a set's parity bits.
PARITY = 8


def parity(spots: Column) -> Column:
    """For each of 64 * PARITY values of the lowest bits of a signature, whether an odd number of the set's signatures have it."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
    word = lambda x: F.shiftright(x, 6).bitwiseAND(PARITY - 1)
    flip = lambda i: lambda bits, x: F.when(word(x) == i, bits.bitwiseXOR(bit(x))).otherwise(bits)
    return F.array(*[F.aggregate(spots, F.lit(0).cast("long"), flip(i)) for i in range(PARITY)])


def may_be_alike(x: str, y: str, similarity: float) -> Column:
    """Whether two sets that meet in a bucket may be alike: false only if they aren't or meet in a rarer signature too.

    `n` is a set's size and `pos` the number of its signatures that are rarer than the bucket's: no others are
    common to both sets if this is the rarest common one. Parity bits differ in at most as many places as the
    sets have signatures that they don't share.
    """
    of = lambda c: (F.col(f"{x}.{c}"), F.col(f"{y}.{c}"))
    (n, m), (i, j), (a, b) = of("n"), of("pos"), of("bits")
    least = F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-9)
    differ = sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(1, PARITY)), F.bit_count(a[0].bitwiseXOR(b[0])))
    fitting = F.least(n, m) >= similarity * (1 - 1e-12) * F.greatest(n, m)
    return fitting & (F.least(n - i, m - j) >= least) & (differ <= n + m - 2 * least)


def ranked_sets(rows: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """at, node, n and ranked: the first signatures, from the rarest on, of each node that may be like another.

    `rows` has at and spots, `nodes` at, node and n. Alike sets share one of the first
    n - ceil(similarity * n) + 1 signatures of each in any order common to all. They are ordered by how
    often their 32-bit hashes occur. A hash that occurs once comes first and meets nothing, so only
    the number of these matters. `ranked` has the hash and its place in the set's order. Of all signatures only
    the hash and the row's number are shuffled.
    """
    spots = maybe_in(rows, nodes, "at").select("at", F.explode("spots").alias("spot")).select("at", F.hash("spot").alias("spot"))
    common = kept(spots.groupBy("spot").count().where("count > 1"), "common")
    ranked = spots.join(shuffled(common), "spot").groupBy("at").agg(F.sort_array(F.collect_list(F.struct("count", "spot"))).alias("all"))
    alone = F.col("n") - F.size("all")
    first = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9).cast("int") + 1 - alone
    place = lambda x, i: F.struct(x["spot"].alias("spot"), (i + alone).alias("pos"))
    ranked = ranked.join(shuffled(nodes), "at").where(first > 0).select("at", "node", "n", F.transform(F.slice("all", F.lit(1), first), place).alias("ranked"))
    ranked = kept(ranked, "ranked")
    discard(common)
    return ranked


def spot_classes(docs: DataFrame, similarity: float = 0.8, chain: int = 2, rounds: int = 3) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its class) for every row with a doc_id.

    Documents are alike when their sets of spot signatures have a Jaccard similarity of at least
    `similarity`; classes are what chains of such links connect. Equal sets form one node, whatever
    their number. Nodes meet in buckets of a rare signature and a range of lengths: ranges grow by
    1 / similarity, and a bucket takes the sets of two neighbouring ones.

    First, every bucket's members are compared with the next `rounds` ones in one random order, at a cost of
    their number, which puts most near copies into one class. Then all pairs of different classes are
    met in the buckets that still have several, so no link between classes is lost whatever
    `rounds` is. Pairs that can't be alike by length, place of the signature or parity bits are
    left out where they meet, and the sets of the others compared.

    Null text counts as empty; texts without words are alike when they are equal. Rows without a
    doc_id are left out. Of rows that repeat a doc_id one counts, that of the least digest of its
    signatures. An empty table gives no rows; other columns are left out.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = with_spots(texts, "text", "spots", chain).withColumn("digest", F.unhex(F.md5(as_text(F.col("spots")))))
    signed = kept(signed.select("doc_id", "digest", "spots", F.monotonically_increasing_id().alias("at")), "spots")
    own = F.struct("digest", "at", F.size("spots").alias("n"))
    chosen = kept(signed.groupBy("doc_id").agg(F.min(own).alias("own")).select("doc_id", "own.*"), "chosen")
    nodes = kept(chosen.groupBy("digest").agg(F.min(F.struct("doc_id", "at", "n")).alias("own")).select("digest", F.col("own.doc_id").alias("node"), "own.at", "own.n"), "nodes")
    members = kept(chosen.join(shuffled(nodes), "digest").select("doc_id", "node"), "members")
    nodes_at = nodes.select("at", "node", "n")
    rows = signed.select("at", "spots")
    ranked = ranked_sets(rows, nodes_at, similarity)
    heads = maybe_in(rows, ranked, "at").join(shuffled(ranked), "at")
    heads = kept(heads.select("node", "n", "spots", "ranked", parity(F.col("spots")).alias("bits")), "heads")
    discard(signed, chosen, nodes, ranked)
    part = F.floor(F.log(F.col("n").cast("double")) / log(1 / similarity) + 1e-9).cast("int")

    def buckets(classed: DataFrame) -> DataFrame:
        """A row of each node for each bucket that it lies in."""
        rows = classed.select("node", "class", "n", "bits", part.alias("own"), F.explode("ranked").alias("r"))
        return rows.select("node", "class", "n", "bits", "own", "r.spot", "r.pos", F.explode(F.array("own", F.col("own") + 1)).alias("part"))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes that are alike."""
        a, b = (shuffled(heads.select(F.col("node").alias(c), F.col("spots").alias(f"spots_{c}"))) for c in "ab")
        both = pairs.distinct().join(a, "a").join(b, "b")
        return kept(both.where(likeness(F.col("spots_a"), F.col("spots_b"), similarity) > 0).select("a", "b"), "links")

    pair = [f("x.node", "y.node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    classed = heads.withColumn("class", F.col("node"))
    if rounds:
        after = Window.partitionBy("spot", "part").orderBy(F.xxhash64("node"), "node", "pos")
        me = F.struct("node", "n", "pos", "bits")
        next_ones = F.array(*[F.lead(me, k).over(after) for k in range(1, rounds + 1)])
        met = buckets(classed).select(me.alias("x"), next_ones.alias("ys")).select("x", F.explode("ys").alias("y"))
        links = linked(met.where((F.col("x.node") != F.col("y.node")) & may_be_alike("x", "y", similarity)).select(*pair))
        classes = kept(connected(links), "classes")
        classed = heads.join(shuffled(classes), "node", "left").withColumn("class", F.coalesce("class", "node"))
    left = buckets(classed)
    # all pairs of a bucket of up to rounds + 1 members have been compared
    mixed = left.groupBy("spot", "part").agg(F.count("*").alias("rows"), F.min("class").alias("low"), F.max("class").alias("high"))
    mixed = mixed.where((F.col("rows") > rounds + 1 if rounds else F.col("rows") > 1) & (F.col("low") < F.col("high"))).select("spot", "part")
    left = kept(left.join(shuffled(mixed), ["spot", "part"]), "unsettled")
    before = F.struct("x.n", "x.node") < F.struct("y.n", "y.node")
    met = left.alias("x").join(shuffled(left.where("own = part")).alias("y"), ["spot", "part"])
    more = linked(met.where((F.col("x.class") != F.col("y.class")) & before & may_be_alike("x", "y", similarity)).select(*pair))
    discard(left, heads)
    if rounds:
        more = more.union(classes.select(F.col("node").alias("a"), F.col("class").alias("b")))
    classes = connected(more)
    return members.join(shuffled(classes), "node", "left").select("doc_id", F.coalesce("class", "node").alias("class_id"))
