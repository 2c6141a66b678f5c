"""Queries on similarity edges (row, col, q): neighbours, cuts, slices, re-indexing, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dequantise
from ..sources.files import FORMAT_VERSION, check_version
from ..sources.staging import staged
from .ordered import row_numbers


def neighbours(edges: DataFrame, ids: DataFrame, top: int | None = 10) -> DataFrame:
    """query, rank, neighbor, q, jaccard: edges of the asked rows by q descending, then col."""
    order = Window.partitionBy("row").orderBy(F.desc("q"), "col")
    ranked = edges.join(ids.select(F.col("id").alias("row")).distinct(), "row").withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select(F.col("row").alias("query"), "rank", F.col("col").alias("neighbor"), "q", dequantise(F.col("q")).alias("jaccard"))


def top_exact(edges: DataFrame, n: int) -> DataFrame:
    """The n best edges of every row; equal q by col."""
    order = Window.partitionBy("row").orderBy(F.desc("q"), "col")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("row", "col", "q")


def top_or_threshold(edges: DataFrame, n: int, least: float) -> DataFrame:
    """Edges of rank <= n by q (ties kept), or with q / 255 >= least; n = 0 leaves the threshold alone.

    q has 256 values, so each row's cut comes from its histogram, and rows are never sorted.
    """
    down = Window.partitionBy("row").orderBy(F.desc("q"))
    counts = edges.groupBy("row", "q").agg(F.count("*").alias("n"))
    cuts = (
        counts.withColumn("upto", F.sum("n").over(down))
        .where((F.col("upto") >= n) & F.lit(n > 0))
        .groupBy("row")
        .agg(F.max("q").alias("cut"))
    )
    fewer = F.lit(0) if n > 0 else F.lit(256)
    return (
        edges.join(cuts, "row", "left")
        .where((F.col("q") >= F.coalesce("cut", fewer)) | (F.col("q") / 255.0 >= least))
        .select("row", "col", "q")
    )


def filter_edges(edges: DataFrame, least: float) -> DataFrame:
    return edges.where(F.col("q") / 255.0 >= least)


def slice_tiles(edges: DataFrame, rows: DataFrame, cols: DataFrame, width: int = 65_536) -> DataFrame:
    """r, r_pos, row, tile, c_pos, cols and values: the asked rows and columns as dense rows of at most `width` cells.

    Both lists (pos, id) are stated by the user and keep order and repeats; columns are numbered in their
    order and cut into tiles. Only edges between asked ids are joined and shuffled; each row of a
    tile is then laid out from its edges in order of columns, with zeros between them, as one
    array. `r` is the place of the row in its list, from 0.
    """
    r = staged(row_numbers(rows.select(F.col("pos").alias("r_pos"), F.col("id").alias("row")), ["r_pos", "row"], "r").withColumn("r", F.col("r") - 1), "rows")
    numbered = row_numbers(cols.select(F.col("pos").alias("c_pos"), F.col("id").alias("col")), ["c_pos", "col"], "k")
    c = staged(numbered.select("c_pos", "col", F.floor((F.col("k") - 1) / width).cast("int").alias("tile"), ((F.col("k") - 1) % width).cast("int").alias("k")), "columns")
    entry = F.sort_array(F.collect_list(F.struct("k", "c_pos", "col")))
    tiles = c.groupBy("tile").agg(entry.alias("t")).select("tile", F.size("t").alias("cells"), F.col("t.c_pos").alias("c_pos"), F.col("t.col").alias("cols"))
    hits = edges.select("row", "col", dequantise(F.col("q")).alias("x")).join(r.select("row", "r"), "row").join(c.select("col", "tile", "k"), "col")
    sparse = hits.groupBy("r", "tile").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("e"))
    grid = r.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(c.agg(F.max("tile")).first()[0] or 0)))).join(sparse, ["r", "tile"], "left")
    # the columns come last, a copy for each of `parts` groups of rows, so that no row is shuffled with them
    parts = 3 * r.sparkSession.sparkContext.defaultParallelism
    grouped = lambda df, group: df.withColumn("group", group).repartition(parts, "tile", "group")  # not fewer for small tables: cells are many
    tiles = grouped(tiles, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    grid = grouped(grid, F.pmod("r", F.lit(parts)).cast("int")).join(tiles.hint("merge"), ["tile", "group"])
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    last = F.get("e", F.size("e") - 1)["k"]
    runs = F.transform("e", lambda h, i: F.concat(zeros(h["k"] - F.coalesce(F.get("e", i - 1)["k"], F.lit(-1)) - 1), F.array(h["x"])))
    dense = F.when(F.col("e").isNull(), zeros(F.col("cells"))).otherwise(F.concat(F.flatten(runs), zeros(F.col("cells") - last - 1)))
    return grid.select("r", "r_pos", "row", "tile", "c_pos", "cols", dense.alias("values"))


def named_tiles(tiles: DataFrame, names: DataFrame) -> DataFrame:
    """Tiles with accessions (idx, acc) for the numbers of rows and columns."""
    rows = names.select(F.col("idx").alias("row"), F.col("acc").alias("row_acc"))
    places = tiles.groupBy("tile").agg(F.first("cols").alias("cols")).select("tile", F.posexplode("cols").alias("k", "col"))
    cols = places.join(names.select(F.col("idx").alias("col"), "acc"), "col", "left").groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("k", "acc")))["acc"].alias("names"))
    return tiles.join(rows, "row", "left").join(cols, "tile").select("r", "r_pos", F.col("row_acc").alias("row"), "tile", "c_pos", F.col("names").alias("cols"), "values")


def matrix_slice(edges: DataFrame, rows: DataFrame, cols: DataFrame, width: int = 65_536) -> DataFrame:
    """r_pos, c_pos, row, col, jaccard of the asked rows and columns, 0 where there is no edge: the cells of `slice_tiles`."""
    cells = slice_tiles(edges, rows, cols, width)
    return cells.select("r_pos", "row", F.inline(F.arrays_zip("c_pos", F.col("cols").alias("col"), F.col("values").alias("jaccard")))).toDF("r_pos", "row", "c_pos", "col", "jaccard").select("r_pos", "c_pos", "row", "col", "jaccard")


def reindex(edges: DataFrame, mapping: DataFrame, must_match: bool = True) -> DataFrame:
    """Edges between the mapped accessions (old, new), under their new numbers.

    Edges of accessions that are not mapped are left out. With must_match a mapped accession that the
    matrix lacks is an error; every accession has at least the edge to itself.
    """
    if must_match:
        lost = mapping.join(edges.select(F.col("row").alias("old")).distinct(), "old", "left_anti").limit(5).collect()
        if lost:
            raise KeyError(f"not in the matrix: {[r.old for r in lost]}")
    rows = mapping.select(F.col("old").alias("row"), F.col("new").alias("new_row"))
    cols = mapping.select(F.col("old").alias("col"), F.col("new").alias("new_col"))
    return edges.join(rows, "row").join(cols, "col").select(F.col("new_row").alias("row"), F.col("new_col").alias("col"), "q")


def neighbour_counts(edges: DataFrame, accessions: DataFrame) -> DataFrame:
    """row, n for every accession, 0 where it has no edge."""
    counts = edges.groupBy("row").agg(F.count("*").alias("n"))
    return accessions.select(F.col("acc").alias("row")).join(counts, "row", "left").select("row", F.coalesce("n", F.lit(0)).alias("n"))


def q_histogram(edges: DataFrame, shards: int, n_rows: int) -> DataFrame:
    """shard, q, n for all 256 values in every shard of consecutive rows."""
    size = -(-n_rows // shards)
    counts = edges.groupBy(F.floor(F.col("row") / size).cast("int").alias("shard"), "q").agg(F.count("*").alias("n"))
    spark = edges.sparkSession
    cells = spark.range(256 * shards).select((F.col("id") / 256).cast("int").alias("shard"), (F.col("id") % 256).cast("int").alias("q"))
    return cells.join(counts, ["shard", "q"], "left").select("shard", "q", F.coalesce("n", F.lit(0)).alias("n"))


def delta_gaps(edges: DataFrame) -> DataFrame:
    """row, pos, first, gap: columns of a row as their first and the steps between them."""
    order = Window.partitionBy("row").orderBy("col")
    before = F.lag("col").over(order)
    return edges.select(
        "row",
        F.row_number().over(order).alias("pos"),
        F.when(before.isNull(), F.col("col")).alias("first"),
        (F.col("col") - before).alias("gap"),
    )


def delta_decode(gaps: DataFrame) -> DataFrame:
    """row, col from delta_gaps."""
    order = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return gaps.select("row", F.sum(F.coalesce("first", "gap")).over(order).alias("col"))


def matrix_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """row, col, q_a, q_b wherever two matrices differ; null where one has no edge."""
    x = a.select("row", "col", F.col("q").alias("q_a"))
    y = b.select("row", "col", F.col("q").alias("q_b"))
    return x.join(y, ["row", "col"], "full").where(~F.col("q_a").eqNullSafe(F.col("q_b")))


def in_order(edges: DataFrame) -> DataFrame:
    """Edges by ascending row and col, as a cut leaves them to be written."""
    return edges.orderBy("row", "col")


def write_matrix(edges: DataFrame, path: str, n_rows: int, shards: int) -> None:
    """Edges as Parquet, a folder for each shard of consecutive rows, sorted by row and col in small row groups; the format version and the layout.

    What the folder held before is replaced.
    """
    spark, size = edges.sparkSession, max(1, -(-n_rows // shards))
    sharded = edges.withColumn("shard", F.expr(f"int(row div {size})"))
    placed = sharded.repartitionByRange(shards, "shard", "row").sortWithinPartitions("shard", "row", "col")
    placed.write.mode("overwrite").option("parquet.block.size", 1 << 23).partitionBy("shard").parquet(f"{path}/edges")
    for name, value in (("version", FORMAT_VERSION), ("rows", n_rows), ("shards", shards)):
        spark.createDataFrame([(str(value),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def stated(spark: SparkSession, path: str, name: str) -> int | None:
    found = spark.read.text(f"{path}/{name}").first()
    return int(found.value) if found else None


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """shard, row, col and q of a written matrix; another format version is an error."""
    check_version(stated(spark, path, "version") or "0")
    return spark.read.parquet(f"{path}/edges")


def stored_rows(spark: SparkSession, path: str, ids: DataFrame, listed: int = 1000) -> DataFrame:
    """The edges of the asked rows (id) of a written matrix, read from their shards alone.

    The shards of the ids are named in the scan, so others aren't listed; inside, files and row groups are sorted by
    row, and those outside the asked range (or list, up to `listed` ids) are passed over.
    """
    size = max(1, -(-stated(spark, path, "rows") // stated(spark, path, "shards")))
    asked = ids.where("id is not null").select(F.col("id").alias("row"), F.expr(f"int(id div {size})").alias("shard")).distinct()
    within = [r.shard for r in asked.select("shard").distinct().collect()]  # at most as many as there are shards
    low, high, n = asked.agg(F.min("row"), F.max("row"), F.count("*")).first()
    edges = read_matrix(spark, path).where(F.col("shard").isin(within))
    if n:
        edges = edges.where(F.col("row").between(low, high) if n > listed else F.col("row").isin([r["row"] for r in asked.select("row").collect()]))
    return edges.join(asked, ["shard", "row"], "left_semi")


def stored_neighbours(spark: SparkSession, path: str, ids: DataFrame, top: int | None = 10) -> DataFrame:
    """`neighbours` of the asked ids in a written matrix."""
    return neighbours(stored_rows(spark, path, ids), ids, top)
