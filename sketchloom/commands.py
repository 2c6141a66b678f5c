"""The library's steps as commands: python -m sketchloom COMMAND ...; all tables and folders are paths that Spark reads and writes."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import dictionary as D
from .operators import matrix as M
from .operators import roundtrip as R
from .operators import similarity as S
from .operators import sketch as K
from .operators.ordered import row_numbers
from .operators.projection import as_int16, project
from .sources import files
from .sources.fasta import read_fasta
from .sources.metadata import read_metadata, typed
from .sources.staging import staged


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sketchloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, does: str, *places: str) -> argparse.ArgumentParser:
        own = sub.add_parser(name, help=does, description=does)
        for x in places:
            own.add_argument(x)
        return own

    add("sketch", "hash sets (acc, h) of signature files", "signatures", "out").add_argument("--ksize", type=int, default=31)
    own = add("dna", "hash sets of FASTA records; of reads only hashes that occur twice count", "fasta", "out")
    own.add_argument("--mode", choices=("assembly", "reads"), required=True)
    own.add_argument("-k", type=int, default=31)
    own.add_argument("-s", "--scaled", type=int, default=1000)
    own = add("build", "a folder of vectors of hash sets", "postings", "out")
    own.add_argument("-d", "--dimension", type=int, default=2048)
    own.add_argument("--spacing", type=int, help="of the projection's draws; dimension / 64 unless given")
    own = add("matrix", "the matrix of all pairs of a folder of vectors, in shards", "vectors", "out")
    own.add_argument("--shards", type=int, default=1)
    own = add("search", "the nearest vectors of a folder to hash sets", "vectors", "postings", "out")
    own.add_argument("--top", type=int, default=10)
    own = add("query", "neighbours, slices, cuts and counts of a matrix", "matrix")
    mode = own.add_mutually_exclusive_group(required=True)
    mode.add_argument("--ids", nargs="+", help="neighbours of these accessions")
    mode.add_argument("--ids-file", help="neighbours of the accessions of a file")
    mode.add_argument("--rows-file", help="a slice of these rows; needs --cols-file")
    mode.add_argument("--nf", nargs=2, metavar=("N", "J"), help="the N best (ties kept) or all of J and more of every row, as a matrix")
    mode.add_argument("--subset-file", help="the matrix of these accessions alone, numbered in their order")
    mode.add_argument("--counts", action="store_true", help="the neighbours of every accession")
    mode.add_argument("--histogram", action="store_true", help="the 256 stored values in every shard")
    own.add_argument("--cols-file")
    cut = own.add_mutually_exclusive_group()
    cut.add_argument("--top", type=int, default=10)
    cut.add_argument("--all", action="store_true", help="all neighbours")
    own.add_argument("--write", help="a file (slices: csv, tsv or npy), the ending of one file for each query, or a folder; printed where it is left out")
    add("dictionary", "the union of hash sets with dense ids, the sets in ids, and a summary", "postings", "out")
    own = add("roundtrip", "take signature files apart and rebuild them", "signatures", "out")
    own = add("compare", "the report of rebuilt signature files against the originals; fails unless all pass", "originals", "rebuilt")
    own.add_argument("--write")
    add("metadata", "SQL over the metadata table (as `metadata`)", "table", "sql")
    return p


def names_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/names")


def listed(spark: SparkSession, ids: DataFrame, names: DataFrame) -> DataFrame:
    """pos, id (the row of the matrix) and acc of known ids in their order, repeats kept; others are warned of."""
    known = files.known_ids(ids, names)
    return known.join(names.select(F.col("acc").alias("id"), "idx"), "id").select("pos", F.col("idx").alias("id"), F.col("id").alias("acc"))


def in_file(spark: SparkSession, path: str) -> DataFrame:
    """pos and id of the ids of a file, in its order."""
    trimmed = F.btrim("value", F.lit(" \t\r\n"))
    lines = files.read_lines(spark, path).where("value not like '#%'").select(F.col("line").alias("pos"), trimmed.alias("id"))
    return lines.where("id <> ''")


def named(found: DataFrame, names: DataFrame, *columns: str) -> DataFrame:
    """Rows of the matrix replaced by accessions in these columns."""
    for c in columns:
        found = found.join(names.select(F.col("idx").alias(c), F.col("acc").alias(f"{c}_acc")), c).drop(c).withColumnRenamed(f"{c}_acc", c)
    return found


def shown(df: DataFrame, write: str | None) -> None:
    if write:
        df.write.mode("overwrite").option("header", True).csv(write)
    else:
        df.show(1000, truncate=False)


def query(spark: SparkSession, a: argparse.Namespace) -> None:
    names, rows = names_of(spark, a.matrix), M.stated(spark, a.matrix, "rows")
    edges = M.read_matrix(spark, a.matrix).select("row", "col", "q")
    if a.ids or a.ids_file:
        asked = spark.createDataFrame(list(enumerate(a.ids)), "pos long, id string") if a.ids else in_file(spark, a.ids_file)
        found = M.stored_neighbours(spark, a.matrix, listed(spark, asked, names), None if a.all else a.top)
        found = named(found, names, "query", "neighbor").select("query", "rank", "neighbor", "jaccard")
        if a.write:
            folder, _, name = a.write.rpartition("/")
            files.write_neighbours(found, folder or ".", name)
        else:
            shown(found.orderBy("query", "rank"), None)
    elif a.rows_file:
        if not a.cols_file:
            raise SystemExit("--rows-file needs --cols-file")
        r, c = (listed(spark, in_file(spark, x), names) for x in (a.rows_file, a.cols_file))
        tiles = M.slice_tiles(M.stored_rows(spark, a.matrix, r), r.select("pos", "id"), c.select("pos", "id"))
        if a.write and a.write.endswith(".npy"):
            files.write_slice_npy(tiles, a.write, r.count(), c.count())
        elif a.write:
            files.write_slice(M.named_tiles(tiles, names), a.write)
        else:
            cells = M.matrix_slice(M.stored_rows(spark, a.matrix, r), r.select("pos", "id"), c.select("pos", "id"))
            shown(named(cells, names, "row", "col").orderBy("r_pos", "c_pos").select("row", "col", "jaccard"), None)
    elif a.nf:
        if not a.write:
            raise SystemExit("--nf needs --write")
        M.write_matrix(M.top_or_threshold(edges, int(a.nf[0]), float(a.nf[1])), a.write, rows, M.stated(spark, a.matrix, "shards"))
        names.write.mode("overwrite").parquet(f"{a.write}/names")
    elif a.subset_file:
        if not a.write:
            raise SystemExit("--subset-file needs --write")
        chosen = row_numbers(in_file(spark, a.subset_file).groupBy("id").agg(F.min("pos").alias("pos")), ["pos"], "new").withColumn("new", F.col("new") - 1)
        mapping = staged(chosen.join(names.select(F.col("acc").alias("id"), F.col("idx").alias("old")), "id", "left").select("id", "old", "new"), "subset")
        lost = [r.id for r in mapping.where("old is null").limit(5).collect()]
        if lost:
            raise SystemExit(f"not in the matrix: {', '.join(lost)}")
        M.write_matrix(M.reindex(edges, mapping), a.write, mapping.count(), M.stated(spark, a.matrix, "shards"))
        mapping.select(F.col("new").alias("idx"), F.col("id").alias("acc")).write.mode("overwrite").parquet(f"{a.write}/names")
    elif a.counts:
        shown(named(M.neighbour_counts(edges, names.select(F.col("idx").alias("acc"))), names, "row").select("row", "n").orderBy("row"), a.write)
    else:
        shown(M.q_histogram(edges, M.stated(spark, a.matrix, "shards"), rows).orderBy("shard", "q"), a.write)


def run(spark: SparkSession, a: argparse.Namespace) -> int:
    """Runs one command; 1 where a comparison fails, else 0."""
    if a.command == "sketch":
        files.read_signatures(spark, a.signatures, a.ksize, recursive=True).select("acc", "h").distinct().write.mode("overwrite").parquet(a.out)
    elif a.command == "dna":
        chunks = read_fasta(spark, a.fasta, a.k - 1).where("name is not null").select(F.col("name").alias("id"), "seq")
        least = 2 if a.mode == "reads" else 1
        K.dna_postings(chunks, a.k, a.scaled, parts=True).where(F.col("abund") >= least).select(F.col("id").alias("acc"), "h").write.mode("overwrite").parquet(a.out)
    elif a.command == "build":
        vectors = as_int16(project(spark.read.parquet(a.postings), a.dimension, a.spacing))
        files.write_vectors(row_numbers(vectors, ["acc"], "idx").withColumn("idx", F.col("idx") - 1), a.out, a.dimension, a.spacing)
    elif a.command == "matrix":
        v = files.open_vectors(spark, a.vectors)
        edges = S.vector_matrix(v.select(F.col("idx").alias("vec_id"), F.col("v").alias("embedding")), dim_scale=float(files.dimension(a.vectors)))
        M.write_matrix(edges.select("row", "col", "q"), a.out, v.count(), a.shards)
        v.select("idx", "acc").write.mode("overwrite").parquet(f"{a.out}/names")
    elif a.command == "search":
        dim, spacing = files.dimension(a.vectors), files.spacing(a.vectors)
        own = staged(row_numbers(project(spark.read.parquet(a.postings), dim, spacing), ["acc"], "place"), "queries")
        base = files.open_vectors(spark, a.vectors)
        pick = lambda df, c: df.select(F.col(c).alias("vec_id"), F.col("v").alias("embedding"))
        hits = S.vector_hits(pick(own.withColumn("place", F.col("place") - 1), "place"), pick(base, "idx"), top=a.top, dim_scale=float(dim))
        best = hits.withColumn("rank", F.expr("row_number() over (partition by query_idx order by jaccard desc, vec_id)")).where(F.col("rank") <= a.top)
        files.write_hits(best.join(base.select(F.col("idx").alias("vec_id"), "acc"), "vec_id").select("query_idx", F.col("acc").alias("vec_id"), "jaccard"), a.out)
    elif a.command == "query":
        query(spark, a)
    elif a.command == "dictionary":
        members = spark.read.parquet(a.postings)
        ids = D.dense_ids(D.union_hashes(members))
        ids.write.mode("overwrite").parquet(f"{a.out}/ids")
        D.encode(members, spark.read.parquet(f"{a.out}/ids")).write.mode("overwrite").parquet(f"{a.out}/sets")
        D.summary(members).coalesce(1).write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{a.out}/summary")
    elif a.command == "roundtrip":
        whole = staged(R.take_apart(spark, a.signatures), "parts")
        made = staged(R.rebuild(whole, whole), "records")
        R.write_records(made, a.out)
        bad = made.where("error is not null").select("folder", "name", "error").limit(20).collect()
        for r in bad:
            print(f"{r.folder}/{r.name}: {r.error}")
        return int(bool(bad))
    elif a.command == "compare":
        report = staged(R.compare_files(R.canonical_files(spark, a.originals), R.canonical_files(spark, a.rebuilt)), "report")
        shown(report.orderBy("original_path"), a.write)
        return int(not R.verdict(report).first().ok)
    else:
        typed(read_metadata(spark, a.table)).createOrReplaceTempView("metadata")
        spark.sql(a.sql).show(1000, truncate=False)
    return 0


def main(args: Sequence[str] | None = None) -> int:
    a = parser().parse_args(args)
    return run(SparkSession.builder.appName(f"sketchloom {a.command}").getOrCreate(), a)
