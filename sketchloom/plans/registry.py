"""The registered queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import dictionary as D
from ..operators import matrix as M
from ..operators import roundtrip as R
from ..operators import similarity as S
from ..operators import sketch as K
from ..operators.ordered import members_around, ranged, row_numbers, running_sum
from ..operators.projection import as_int16, project
from ..sources.fasta import read_fasta
from ..sources.staging import shared_dir, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# The word shingles of documents, their hashes, the sketch postings and the edges, as SQL.
SHINGLES = r"""shingles AS (SELECT acc, unnest(list_transform(range(1, greatest(1, len(ws) - 1)), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) AS sh
  FROM (SELECT doc_id AS acc, string_split_regex(text, '\s+') AS ws FROM documents WHERE text IS NOT NULL)),
hashes AS (SELECT acc, CAST(CAST(concat('0x', substr(md5(sh), 1, 13)) AS UBIGINT) AS BIGINT) AS h FROM shingles)"""
POSTINGS = SHINGLES + ",\npostings AS (SELECT DISTINCT acc, h FROM hashes WHERE h < 1125899906842624)"
EDGES = POSTINGS + """,
lists AS (SELECT acc, list_sort(list(h)) AS hs FROM postings GROUP BY acc),
reps AS (SELECT acc, min(acc) OVER (PARTITION BY hs) AS rep, len(hs) AS n FROM lists),
pairs AS (SELECT x.acc AS "row", y.acc AS "col", count(*) AS common FROM postings x JOIN postings y ON x.h = y.h
  WHERE x.acc IN (SELECT rep FROM reps) AND y.acc IN (SELECT rep FROM reps) GROUP BY x.acc, y.acc),
scored AS (SELECT "row", "col", common, common / CAST(a.n + b.n - common AS DOUBLE) AS jaccard
  FROM pairs JOIN reps a ON "row" = a.acc JOIN reps b ON "col" = b.acc WHERE common > 0.05 * (a.n + b.n)),
edges AS (SELECT "row", "col", common, jaccard, CAST(floor(least(jaccard, 1) * 255 + 0.5) AS INTEGER) AS q FROM scored)"""
DEQ = "floor(q / 255.0::DOUBLE * 1000 + 0.5) / 1000.0::DOUBLE"


def postings(spark, d):
    return K.shingle_postings(table(spark, d, "documents"))


def edges(spark, d):
    return S.similarity_join(postings(spark, d))


def asked_edges(spark, d):
    """The edges of the asked ids alone."""
    return S.similarity_join(postings(spark, d), ids=asked(spark, d))


def asked(spark, d):
    """The asked ids: documents whose id is divisible by 20."""
    return table(spark, d, "documents").where("doc_id % 20 = 0").select(F.col("doc_id").alias("id"))


ASKED = "asked AS (SELECT doc_id AS id FROM documents WHERE doc_id % 20 = 0)"


# --- sketches -------------------------------------------------------------------------------------
@query("kmer_extract", """SELECT id, count(DISTINCT kmer) AS n, min(kmer) AS first_kmer, max(kmer) AS last_kmer FROM
  (SELECT doc_id AS id, unnest(list_transform(range(1, greatest(1, length(t) - 29)), lambda i: substr(t, i, 31))) AS kmer
    FROM (SELECT doc_id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z .]', chr(1), 'g') AS t FROM documents))
  WHERE NOT contains(kmer, chr(1)) GROUP BY id""")
def kmer_extract(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq"))
    return K.kmer_sets(docs, 31, "A-Z .").groupBy("id").agg(F.count("*").alias("n"), F.min("kmer").alias("first_kmer"), F.max("kmer").alias("last_kmer"))


@query("fasta_windows", """SELECT id, count(DISTINCT kmer) AS n, min(kmer) AS first_kmer, max(kmer) AS last_kmer FROM
  (SELECT doc_id AS id, unnest(list_transform(range(1, greatest(1, length(t) - 29)), lambda i: substr(t, i, 31))) AS kmer
    FROM (SELECT doc_id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g') AS t FROM documents)) GROUP BY id""")
def fasta_windows(spark, d):
    """The letters of documents written as FASTA records of 60 letters a line, read back in splits, and their windows across lines."""
    upper = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    lines = F.regexp_replace(F.regexp_replace(upper, "[^A-Z]", ""), "(.{60})", "$1\n")
    path = f"{shared_dir(spark)}/sketchloom/fasta-{uuid.uuid4().hex}"
    table(spark, d, "documents").where("text is not null").select(F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit("\n"), lines)).write.text(path)
    chunks = read_fasta(spark, path).select(F.col("name").cast("long").alias("id"), "seq", "whole")
    return K.kmer_stats(chunks, 31, "A-Z")


query("fracminhash", f"WITH {POSTINGS} SELECT acc, h FROM postings")(postings)


@query("abundance_filter", f"WITH {SHINGLES} SELECT acc, h, count(*) AS abund FROM hashes WHERE h < 1125899906842624 GROUP BY acc, h HAVING count(*) >= 2")
def abundance_filter(spark, d):
    return K.abundant_postings(table(spark, d, "documents"))


@query("set_size", f"WITH {POSTINGS} SELECT acc, count(*) AS n FROM postings GROUP BY acc")
def set_size(spark, d):
    return K.set_sizes(postings(spark, d))


@query("set_distinct", "SELECT o_custkey AS acc, count(DISTINCT l_partkey) AS n, sum(DISTINCT l_partkey) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def set_distinct(spark, d):
    parts = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.expr("o_orderkey = l_orderkey")).select(F.col("o_custkey").alias("acc"), "l_partkey").distinct()
    return parts.groupBy("acc").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("total"))


@query("set_classes", f"WITH {EDGES} SELECT acc, rep, n FROM reps")
def set_classes(spark, d):
    return K.set_classes(postings(spark, d))


# --- dictionary -----------------------------------------------------------------------------------
@query("union_dict", f"WITH {POSTINGS} SELECT DISTINCT h FROM postings")
def union_dict(spark, d):
    return D.union_hashes(postings(spark, d))


@query("dense_ids", f"WITH {POSTINGS} SELECT h, row_number() OVER (ORDER BY h) AS id FROM (SELECT DISTINCT h FROM postings)")
def dense_ids(spark, d):
    return D.dense_ids(union_dict(spark, d))


IDS = POSTINGS + ", dict AS (SELECT h, row_number() OVER (ORDER BY h) AS id FROM (SELECT DISTINCT h FROM postings))"


@query("dict_encode", f"WITH {IDS} SELECT acc, id FROM postings JOIN dict USING (h)")
def dict_encode(spark, d):
    members = staged(postings(spark, d), "postings")
    return D.encode(members, D.dense_ids(D.union_hashes(members)))


@query("dict_decode", f"WITH {IDS} SELECT acc, h FROM postings JOIN dict USING (h)")
def dict_decode(spark, d):
    members = staged(postings(spark, d), "postings")
    ids = staged(D.dense_ids(D.union_hashes(members)), "dictionary")
    return D.decode(D.encode(members, ids), ids)


@query("dict_misses", f"WITH {POSTINGS} SELECT DISTINCT acc, h FROM hashes WHERE h < 2251799813685248 AND h NOT IN (SELECT h FROM postings)")
def dict_misses(spark, d):
    wider = K.shingle_postings(table(spark, d, "documents"), scaled=2)
    return D.misses(wider, union_dict(spark, d), "h").select("acc", "h")


@query("hash_summary", f"""WITH {POSTINGS} SELECT count(DISTINCT acc) AS n_sets, count(*) AS n_members, min(h) AS min_hash, max(h) AS max_hash, count(DISTINCT h) AS n_unique,
  round(log2(greatest(count(DISTINCT h), 1)), 6) AS log2_unique, CAST(CASE WHEN count(DISTINCT h) <= 1 THEN 1 ELSE ceil(log2(count(DISTINCT h))) END AS INTEGER) AS bits_needed FROM postings""")
def hash_summary(spark, d):
    return D.summary(postings(spark, d))


@query("ef_params", f"""WITH {POSTINGS} SELECT acc, count(*) AS n, max(h) AS universe, CAST(CASE WHEN max(h) > count(*) THEN floor(log2(max(h) // count(*))) ELSE 0 END AS INTEGER) AS low_bits FROM postings GROUP BY acc""")
def ef_params(spark, d):
    return D.elias_fano_params(postings(spark, d))


@query("union_all", "SELECT l_partkey AS key FROM lineitem UNION ALL SELECT p_partkey FROM part")
def union_all(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("key")).union(table(spark, d, "part").select("p_partkey"))


@query("set_intersect", "SELECT o_custkey AS key FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_intersect(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("key")).intersect(table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey"))


@query("set_except", "SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity >= 49 EXCEPT SELECT p_partkey FROM part WHERE p_size <= 25")
def set_except(spark, d):
    return table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("key")).subtract(table(spark, d, "part").where("p_size <= 25").select("p_partkey"))


@query("anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left_anti")


# --- similarity -----------------------------------------------------------------------------------
NEXT = POSTINGS + """, sizes AS (SELECT acc, count(*) AS n FROM postings GROUP BY acc),
common AS (SELECT x.acc, count(*) AS common FROM postings x JOIN postings y ON y.acc = x.acc + 1 AND x.h = y.h GROUP BY x.acc)"""


@query("jaccard_exact", f"""WITH {NEXT} SELECT a.acc AS a, b.acc AS b, coalesce(common, 0) AS common, a.n + b.n - coalesce(common, 0) AS together,
  round(1 - coalesce(common, 0) / CAST(a.n + b.n - coalesce(common, 0) AS DOUBLE), 9) AS distance FROM sizes a JOIN sizes b ON b.acc = a.acc + 1 LEFT JOIN common ON common.acc = a.acc""")
def jaccard_exact(spark, d):
    return S.set_pairs(postings(spark, d)).withColumn("distance", F.round("distance", 9))


@query("similarity_join", f'WITH {EDGES} SELECT "row", "col", common, q FROM edges')
def similarity_join(spark, d):
    return edges(spark, d).select("row", "col", "common", "q")


@query("quantize", f'WITH {EDGES} SELECT "row", "col", round(jaccard, 9) AS jaccard, q FROM edges')
def quantize(spark, d):
    return edges(spark, d).select("row", "col", F.round("jaccard", 9).alias("jaccard"), "q")


@query("dequantize", f'WITH {EDGES} SELECT "row", "col", q, {DEQ} AS jaccard FROM edges')
def dequantize(spark, d):
    return edges(spark, d).select("row", "col", "q", X.dequantise(F.col("q")).alias("jaccard"))


VECTORS = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


@query("vector_norm", f"WITH {VECTORS} SELECT vec_id, round(sqrt(list_inner_product(e, e)), 6) AS norm, round(list_inner_product(e, e), 6) AS norm2 FROM v")
def vector_norm(spark, d):
    n2 = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.sqrt(n2), 6).alias("norm"), F.round(n2, 6).alias("norm2")).where("norm2 > 0")


def hits(spark, d, least=0.05, top=None):
    v = table(spark, d, "embeddings")
    return S.vector_hits(v.where("vec_id % 20 = 0"), v, least, top)


HITS = VECTORS + """, p AS (SELECT x.vec_id AS query_idx, y.vec_id, list_inner_product(x.e, y.e) AS dot, list_inner_product(x.e, x.e) + list_inner_product(y.e, y.e) AS norms FROM v x, v y WHERE x.vec_id % 20 = 0),
hits AS (SELECT query_idx, vec_id, dot, CASE WHEN norms - dot > 0 THEN dot / (norms - dot) ELSE 0 END AS jaccard FROM p)"""


@query("dot_product", f"WITH {HITS} SELECT query_idx, vec_id, round(dot, 6) AS dot FROM hits WHERE jaccard >= 0.05")
def dot_product(spark, d):
    return hits(spark, d).select("query_idx", "vec_id", F.round("dot", 6).alias("dot"))


@query("jaccard_est", f"WITH {HITS} SELECT query_idx, vec_id, round(jaccard, 6) AS jaccard FROM hits WHERE jaccard >= 0.05")
def jaccard_est(spark, d):
    return hits(spark, d).select("query_idx", "vec_id", F.round("jaccard", 6).alias("jaccard"))


@query("hv_topk", f"""WITH {HITS}, r AS (SELECT query_idx, vec_id, jaccard, row_number() OVER (PARTITION BY query_idx ORDER BY round(jaccard, 9) DESC, vec_id) AS rank FROM hits WHERE jaccard >= 0.05)
  SELECT query_idx, rank, vec_id, round(jaccard, 6) AS jaccard FROM r WHERE rank <= 10""")
def hv_topk(spark, d):
    best = hits(spark, d, top=10).select("query_idx", "vec_id", F.col("jaccard").alias("score"))
    ranked = best.withColumn("rank", F.expr("row_number() over (partition by query_idx order by round(score, 9) desc, vec_id)"))
    return ranked.where("rank <= 10").select("query_idx", "rank", "vec_id", F.round("score", 6).alias("jaccard"))


@query("sim_threshold", f"WITH {HITS} SELECT query_idx, vec_id, CAST(floor(least(jaccard, 1) * 255 + 0.5) AS INTEGER) AS q FROM hits WHERE dot > 0.05 * dot / jaccard + 0.05 * dot AND jaccard > 0")
def sim_threshold(spark, d):
    """dot > 0.05 (a + b), which for positive Jaccard is dot > 0.05 (dot / J + dot)."""
    return hits(spark, d, 1 / 19).where("jaccard > 1/19d").select("query_idx", "vec_id", X.quantise(F.col("jaccard")).alias("q"))


REPS = """v AS (SELECT min(vec_id) AS vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL GROUP BY embedding)"""


@query("vector_matrix", f"""WITH {REPS}, n AS (SELECT vec_id, e, list_inner_product(e, e) AS n2 FROM v), p AS (SELECT x.vec_id AS "row", y.vec_id AS "col", list_inner_product(x.e, y.e) AS dot, x.n2 + y.n2 AS total FROM n x, n y WHERE x.n2 > 0 AND y.n2 > 0)
  SELECT "row", "col", round(dot, 6) AS dot, CAST(floor(least(dot / (total - dot), 1) * 255 + 0.5) AS INTEGER) AS q FROM p WHERE dot > 0.05::DOUBLE * total""")
def vector_matrix(spark, d):
    """The matrix of all pairs of distinct vectors over the stored threshold."""
    return S.vector_matrix(table(spark, d, "embeddings")).select("row", "col", F.round("dot", 6).alias("dot"), "q")


@query("vector_classes", "SELECT vec_id, min(vec_id) OVER (PARTITION BY embedding) AS rep FROM embeddings WHERE embedding IS NOT NULL AND list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0")
def vector_classes(spark, d):
    """The vector that stands for each in the matrix: of equal ones the smallest id."""
    v = S.vectors_in(table(spark, d, "embeddings"))
    return v.select("vec_id", "v").join(S.vector_classes(table(spark, d, "embeddings")).select("rep", "v"), "v").select("vec_id", "rep")


@query("intersection_est", f"WITH {HITS} SELECT query_idx, count(*) AS n, round(sum(dot), 4) AS estimated FROM hits WHERE jaccard >= 0.05 GROUP BY query_idx")
def intersection_est(spark, d):
    v = table(spark, d, "embeddings")
    parts = S.vector_hits(v.where("vec_id % 20 = 0"), v, sums=True)
    return parts.groupBy("query_idx").agg(F.sum("n").alias("n"), F.round(F.sum("dot"), 4).alias("estimated"))


MIXED = """mixed AS (SELECT acc, word, xor(z2, z2 >> 31) AS x FROM (SELECT acc, word, CAST((xor(z1, z1 >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT) AS z2 FROM
  (SELECT acc, word, CAST((xor(z0, z0 >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT) AS z1 FROM
  (SELECT acc, word, CAST((h::UHUGEINT + 11400714819323198485::UHUGEINT + (word * {step})::UHUGEINT) % 18446744073709551616::UHUGEINT AS UBIGINT) AS z0 FROM postings, range({words}) w(word)))))"""
VALUES = f"WITH {POSTINGS}, {MIXED}, v AS (SELECT acc, word * 64 + n AS component, CAST(sum(1 - 2 * CAST((x >> n) & 1 AS INTEGER)) AS BIGINT) AS value FROM mixed, range(64) t(n) GROUP BY acc, word, n)"
VALUES_64, VALUES_2048 = VALUES.replace("{step}", "64").replace("{words}", "1"), VALUES.replace("{step}", "2048").replace("{words}", "32")


@query("project", f"{VALUES_64} SELECT acc, component, value FROM v")
def project64(spark, d):
    """Vectors of 64 components, one row for each."""
    return project(postings(spark, d), 64).select("acc", F.posexplode("v").alias("component", "value")).select("acc", F.col("component").cast("long").alias("component"), F.col("value").cast("long").alias("value"))


@query("build_vectors", f"""{VALUES_2048} SELECT acc, list(CAST(greatest(least(value, 32767), -32768) AS SMALLINT) ORDER BY component) AS v, CAST(sum(value * value) AS DOUBLE) / 2048 AS n2 FROM v GROUP BY acc HAVING sum(value * value) > 0""")
def build_vectors(spark, d):
    return as_int16(project(postings(spark, d), 2048))


@query("hv_query", f"""{VALUES_64}, n2 AS (SELECT acc, sum(value * value) / 64.0::DOUBLE AS n FROM v GROUP BY acc), p AS (SELECT x.acc AS query_idx, y.acc AS vec_id, sum(x.value * y.value) / 64.0::DOUBLE AS dot FROM v x JOIN v y USING (component) WHERE x.acc % 20 = 0 GROUP BY ALL),
s AS (SELECT query_idx, vec_id, CASE WHEN a.n + b.n - dot > 0 THEN dot / (a.n + b.n - dot) ELSE 0 END AS jaccard FROM p JOIN n2 a ON a.acc = query_idx JOIN n2 b ON b.acc = vec_id WHERE a.n > 0 AND b.n > 0)
SELECT query_idx, vec_id, round(jaccard, 6) AS jaccard FROM s WHERE jaccard >= 0.05""")
def hv_query(spark, d):
    """Sketches of documents searched by their projected vectors: every twentieth against all."""
    vectors = staged(project(postings(spark, d), 64).select(F.col("acc").alias("vec_id"), F.col("v").alias("embedding")), "vectors")
    found = S.vector_hits(vectors.where("vec_id % 20 = 0"), vectors, dim_scale=64.0)
    return found.select("query_idx", "vec_id", F.round("jaccard", 6).alias("jaccard"))


# --- matrix ---------------------------------------------------------------------------------------
RANKED = 'ranked AS (SELECT "row", "col", q, row_number() OVER (PARTITION BY "row" ORDER BY q DESC, "col") AS rank FROM edges)'


def top_sql(n: str) -> str:
    return f'WITH {EDGES}, {ASKED}, {RANKED} SELECT "row" AS query, rank, "col" AS neighbor, q, {DEQ} AS jaccard FROM ranked WHERE "row" IN (SELECT id FROM asked){n}'


@query("topk_neighbors", top_sql(" AND rank <= 10"))
def topk_neighbors(spark, d):
    return M.neighbours(asked_edges(spark, d), asked(spark, d))


@query("all_neighbors", top_sql(""))
def all_neighbors(spark, d):
    return M.neighbours(asked_edges(spark, d), asked(spark, d), None)


@query("neighbors", f'WITH {EDGES}, {ASKED} SELECT "row", "col", q FROM edges WHERE "row" IN (SELECT id FROM asked)')
def neighbors(spark, d):
    return asked_edges(spark, d).select("row", "col", "q")


@query("topn_exact", f'WITH {EDGES}, {RANKED} SELECT "row", "col", q FROM ranked WHERE rank <= 5')
def topn_exact(spark, d):
    return M.top_exact(edges(spark, d), 5)


@query("topn_or_threshold", f'WITH {EDGES}, r AS (SELECT "row", "col", q, rank() OVER (PARTITION BY "row" ORDER BY q DESC) AS rank FROM edges) SELECT "row", "col", q FROM r WHERE rank <= 5 OR q / 255.0 >= 0.2')
def topn_or_threshold(spark, d):
    return M.top_or_threshold(staged(edges(spark, d).select("row", "col", "q"), "edges"), 5, 0.2)


@query("matrix_filter", f'WITH {EDGES} SELECT "row", "col", q FROM edges WHERE q / 255.0 >= 0.2')
def matrix_filter(spark, d):
    return M.filter_edges(edges(spark, d), 0.2).select("row", "col", "q")


@query("neighbor_count", f'WITH {EDGES}, c AS (SELECT "row", count(*) AS n FROM edges GROUP BY "row") SELECT doc_id AS "row", coalesce(n, 0) AS n FROM documents LEFT JOIN c ON doc_id = "row"')
def neighbor_count(spark, d):
    return M.neighbour_counts(edges(spark, d), table(spark, d, "documents").select(F.col("doc_id").alias("acc")))


@query("q_histogram", f"""WITH {EDGES}, size AS (SELECT CAST(ceil(count(*) / 4.0) AS BIGINT) AS s FROM documents), c AS (SELECT CAST("row" // s AS INTEGER) AS shard, q, count(*) AS n FROM edges, size GROUP BY ALL)
  SELECT CAST(i // 256 AS INTEGER) AS shard, CAST(i % 256 AS INTEGER) AS q, coalesce(n, 0) AS n FROM range(1024) t(i) LEFT JOIN c ON shard = i // 256 AND q = i % 256""")
def q_histogram(spark, d):
    return M.q_histogram(edges(spark, d), 4, table(spark, d, "documents").count())


GAPS = """gaps AS (SELECT "row", "col", row_number() OVER w AS pos, lag("col") OVER w AS before FROM edges WINDOW w AS (PARTITION BY "row" ORDER BY "col"))"""


@query("delta_gaps", f'WITH {EDGES}, {GAPS} SELECT "row", pos, CASE WHEN before IS NULL THEN "col" END AS first, "col" - before AS gap FROM gaps')
def delta_gaps(spark, d):
    return M.delta_gaps(edges(spark, d))


VECTOR_EDGES = f"""{REPS}, n AS (SELECT vec_id, e, list_inner_product(e, e) AS n2 FROM v), p AS (SELECT x.vec_id AS "row", y.vec_id AS "col", list_inner_product(x.e, y.e) AS dot, x.n2 + y.n2 AS total FROM n x, n y WHERE x.n2 > 0 AND y.n2 > 0),
edges AS (SELECT "row", "col", CAST(floor(least(dot / (total - dot), 1) * 255 + 0.5) AS INTEGER) AS q FROM p WHERE dot > 0.05::DOUBLE * total)"""


def stored(spark, d) -> str:
    """The folder of the vectors' matrix, written in 16 shards of rows."""
    path = f"{shared_dir(spark)}/sketchloom/matrix-{uuid.uuid4().hex}"
    ids = table(spark, d, "embeddings").agg(F.max("vec_id")).first()[0]
    M.write_matrix(S.vector_matrix(table(spark, d, "embeddings")).select("row", "col", "q"), path, (ids or 0) + 1, 16)
    return path


def asked_vectors(spark, d):
    return table(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("id"))


@query("stored_topk", f'WITH {VECTOR_EDGES}, {RANKED} SELECT "row" AS query, rank, "col" AS neighbor, q, {DEQ} AS jaccard FROM ranked WHERE "row" % 20 = 0 AND rank <= 10')
def stored_topk(spark, d):
    """The ten nearest of every twentieth vector, looked up in the written matrix."""
    return M.stored_neighbours(spark, stored(spark, d), asked_vectors(spark, d))


@query("stored_cut", f'WITH {VECTOR_EDGES}, r AS (SELECT "row", "col", q, rank() OVER (PARTITION BY "row" ORDER BY q DESC) AS rank FROM edges) SELECT "row", "col", q FROM r WHERE rank <= 5 OR q / 255.0 >= 0.2')
def stored_cut(spark, d):
    """The five best or all of 0.2 of every row of the written matrix."""
    return M.top_or_threshold(M.read_matrix(spark, stored(spark, d)).select("row", "col", "q"), 5, 0.2)


@query("stored_counts", f'WITH {VECTOR_EDGES} SELECT "row", count(*) AS n FROM edges GROUP BY "row"')
def stored_counts(spark, d):
    """The neighbours of every vector that stands for others, counted in the written matrix."""
    reps = S.vector_classes(table(spark, d, "embeddings")).select(F.col("rep").alias("acc"))
    return M.neighbour_counts(M.read_matrix(spark, stored(spark, d)), reps)


@query("delta_decode", f'WITH {EDGES} SELECT "row", "col" FROM edges')
def delta_decode(spark, d):
    return M.delta_decode(delta_gaps(spark, d))


def listed(spark, d, source):
    docs = table(spark, d, "documents").where(F.col("source") == source).select(F.col("doc_id").alias("id"))
    return docs.select(F.expr("id div 20").alias("pos"), "id")


@query("slice", f"""WITH {EDGES}, r AS (SELECT doc_id // 20 AS r_pos, doc_id AS "row" FROM documents WHERE source = 'src1'), c AS (SELECT doc_id // 20 AS c_pos, doc_id AS "col" FROM documents WHERE source = 'src2')
  SELECT r_pos, c_pos, r."row", c."col", coalesce({DEQ}, 0.0::DOUBLE) AS jaccard FROM r CROSS JOIN c LEFT JOIN edges e ON e."row" = r."row" AND e."col" = c."col" """)
def slice_(spark, d):
    rows = listed(spark, d, "src1")
    return M.matrix_slice(S.similarity_join(postings(spark, d), ids=rows), rows, listed(spark, d, "src2"))


@query("matrix_reindex", f"""WITH {EDGES}, m AS (SELECT doc_id AS old, 1000000 - doc_id AS new FROM documents WHERE lang = 'en')
  SELECT a.new AS "row", b.new AS "col", q FROM edges JOIN m a ON "row" = a.old JOIN m b ON "col" = b.old""")
def matrix_reindex(spark, d):
    mapping = table(spark, d, "documents").where("lang = 'en'").select(F.col("doc_id").alias("old"), (1000000 - F.col("doc_id")).alias("new"))
    return M.reindex(edges(spark, d), mapping, must_match=False)


@query("matrix_diff", f"""WITH {EDGES}, a AS (SELECT "row", "col", q FROM edges WHERE q >= 100), b AS (SELECT "row", "col", CASE WHEN q > 200 THEN q - 1 ELSE q END AS q FROM edges WHERE q >= 120)
  SELECT coalesce(a."row", b."row") AS "row", coalesce(a."col", b."col") AS "col", a.q AS q_a, b.q AS q_b FROM a FULL JOIN b ON a."row" = b."row" AND a."col" = b."col" WHERE a.q IS DISTINCT FROM b.q""")
def matrix_diff(spark, d):
    e = staged(edges(spark, d).where("q >= 100").select("row", "col", "q"), "edges")  # all that either side has
    return M.matrix_diff(e.where("q >= 100"), e.where("q >= 120").withColumn("q", F.expr("if(q > 200, q - 1, q)")))


@query("id_lookup", "SELECT l.doc_id, source FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def id_lookup(spark, d):
    return table(spark, d, "labels").select("doc_id").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")


@query("unknown_ids", "SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)")
def unknown_ids(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("id")).distinct().join(table(spark, d, "labels").select(F.col("doc_id").alias("id")), "id", "left_anti")


@query("neighbor_names", "SELECT d.doc_id, coalesce('label-' || l.quality, 'UNKNOWN') AS name FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def neighbor_names(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", F.coalesce(F.concat(F.lit("label-"), "quality"), F.lit("UNKNOWN")).alias("name"))


# --- succinct structures --------------------------------------------------------------------------
@query("bit_width", "SELECT l_returnflag, max(l_partkey) AS most, CAST(ceil(log2(max(l_partkey) + 1)) AS INTEGER) AS width FROM lineitem GROUP BY l_returnflag")
def bit_width(spark, d):
    most = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.max("l_partkey").alias("most"))
    return most.withColumn("width", F.greatest(F.lit(1), X.bit_length(F.col("most"))))


GAP_STATS = f"WITH {EDGES}, {GAPS}, g AS (SELECT q2.\"row\", count(*) AS n, sum(q2.\"col\" - before) AS total FROM gaps q2 WHERE before IS NOT NULL GROUP BY q2.\"row\")"


@query("rice_param", GAP_STATS + """ SELECT "row", n, CAST(total AS BIGINT) AS total, CAST(greatest(0, 1 + floor(log2(ln((sqrt(5.0::DOUBLE) + 1) / 2 - 1) / ln(1 - n / CAST(total + n AS DOUBLE))))) AS INTEGER) AS k FROM g""")
def rice_param(spark, d):
    g = delta_gaps(spark, d).where("gap is not null").groupBy("row").agg(F.count("*").alias("n"), F.sum("gap").alias("total"))
    p = F.col("n") / (F.col("total") + F.col("n"))
    k = F.floor(F.log2(F.log((F.sqrt(F.lit(5.0)) + 1) / 2 - 1) / F.log(1 - p)))
    return g.withColumn("k", F.greatest(F.lit(0), 1 + k).cast("int"))


@query("code_lengths", """SELECT l_orderkey, l_linenumber, CAST(2 * floor(log2(l_partkey + 1)) + 1 AS INTEGER) AS gamma,
  CAST(2 * floor(log2(floor(log2(l_partkey + 1)) + 1)) + 1 + floor(log2(l_partkey + 1)) AS INTEGER) AS delta, CAST((l_partkey >> 5) + 6 AS BIGINT) AS rice FROM lineitem""")
def code_lengths(spark, d):
    x = F.col("l_partkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.gamma_bits(x).alias("gamma"), X.delta_bits(x).alias("delta"), X.rice_bits(x, 5).alias("rice"))


@query("bit_ops", "SELECT o_orderkey, bit_count(o_custkey) AS ones, CAST(floor(log2(o_custkey)) AS INTEGER) AS msb, CAST(ceil(log2(o_custkey)) AS INTEGER) AS up, CAST(log2(o_custkey & -o_custkey) AS INTEGER) AS lsb FROM orders WHERE o_custkey > 0")
def bit_ops(spark, d):
    x = F.col("o_custkey")
    return table(spark, d, "orders").where("o_custkey > 0").select("o_orderkey", F.bit_count(x).alias("ones"), (X.bit_length(x) - 1).alias("msb"), X.ceil_log2(x).alias("up"), (X.bit_length(x.bitwiseAND(-x)) - 1).alias("lsb"))


@query("sdc_code", "SELECT o_orderkey, CAST(floor(log2(o_custkey + 1)) AS INTEGER) AS len, CAST(o_custkey + 1 - pow(2, floor(log2(o_custkey + 1))) AS BIGINT) AS code FROM orders")
def sdc_code(spark, d):
    length, code = X.dense_code(F.col("o_custkey"))
    return table(spark, d, "orders").select("o_orderkey", length.alias("len"), code.alias("code"))


@query("freq_dict", "SELECT l_partkey AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS code FROM lineitem GROUP BY l_partkey")
def freq_dict(spark, d):
    """Codes by falling frequency, equal counts by value; counted in ranges of (count, value)."""
    counts = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("value")).agg(F.count("*").alias("n"))
    ranked = row_numbers(counts.withColumn("less", -F.col("n")), ["less", "value"], "code")
    return ranked.select("value", "n", (F.col("code") - 1).alias("code"))


@query("rank1", "SELECT doc_id, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ones FROM labels")
def rank1(spark, d):
    """Ones before each place."""
    bits = table(spark, d, "labels").select("doc_id", F.expr("int(coalesce(toxic = 1, false))").alias("bit"))
    return running_sum(ranged(bits, "doc_id"), ["doc_id"], "bit", "ones").select("doc_id", "ones")


def around(spark, d):
    """The customers that have orders, before and after every customer's key."""
    return members_around(table(spark, d, "orders").select(F.col("o_custkey").alias("x")).distinct(), table(spark, d, "customer").select(F.col("c_custkey").alias("x")))


@query("next_geq", "SELECT c_custkey AS x, (SELECT min(o_custkey) FROM orders WHERE o_custkey >= c_custkey) AS next_geq FROM customer")
def next_geq(spark, d):
    return around(spark, d).select("x", "next_geq")


@query("prev_leq", "SELECT c_custkey AS x, (SELECT max(o_custkey) FROM orders WHERE o_custkey <= c_custkey) AS prev_leq FROM customer")
def prev_leq(spark, d):
    return around(spark, d).select("x", "prev_leq")


@query("locate", "SELECT c_custkey AS x, (SELECT max(o_custkey) FROM orders WHERE o_custkey <= c_custkey) AS low, (SELECT min(o_custkey) FROM orders WHERE o_custkey > c_custkey) AS high FROM customer")
def locate(spark, d):
    """The members on both sides: the last up to x and the first beyond it."""
    return around(spark, d).select("x", F.col("prev_leq").alias("low"), F.col("next_gt").alias("high"))


BINS = [0, 100, 1000, 10000, 50000, 100000, 200000, 10**9]


@query("bin_locate", f"SELECT o_orderkey, CAST(CASE {' '.join(f'WHEN o_totalprice < {b} THEN {i}' for i, b in enumerate(BINS))} END AS INTEGER) - 1 AS bin FROM orders")
def bin_locate(spark, d):
    """The bin of each price among fixed ends: comparisons in the scan, no join."""
    bin_ = sum((F.col("o_totalprice") >= b).cast("int") for b in BINS) - 1
    return table(spark, d, "orders").select("o_orderkey", bin_.alias("bin"))


# --- metadata, scalars, reports -------------------------------------------------------------------
@query("metadata_scan", "SELECT doc_id, lang, source, n_chars FROM documents")
def metadata_scan(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")


@query("metadata_filter", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) >= DATE '1994-01-01' AND lower(o_orderpriority) = '1-urgent'")
def metadata_filter(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("orders_metadata")
    return spark.sql("SELECT o_orderkey, o_orderdate FROM orders_metadata WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) >= DATE '1994-01-01' AND lower(o_orderpriority) = '1-urgent'")


@query("filter_eq", "SELECT p_partkey, p_name FROM part WHERE p_size = 31")
def filter_eq(spark, d):
    return table(spark, d, "part").where("p_size = 31").select("p_partkey", "p_name")


@query("json_array_extract", "SELECT l_orderkey AS id, l_partkey AS h, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey")
def json_array_extract(spark, d):
    """The members of `mins` arrays in JSON records, one record for each order."""
    records = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("mins")).select(F.col("l_orderkey").alias("id"), F.to_json(F.struct("mins")).alias("record"))
    mins = F.from_json("record", "mins array<long>")["mins"]
    return records.select("id", F.explode(mins).alias("h")).groupBy("id", "h").agg(F.count("*").alias("n"))


@query("map_keys", "SELECT l_orderkey AS id, l_partkey AS h, sum(l_linenumber) AS abund FROM lineitem GROUP BY l_orderkey, l_partkey")
def map_keys(spark, d):
    """Hashes and abundances of `mins` that are JSON objects (hash to abundance)."""
    counted = table(spark, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.sum("l_linenumber").alias("n"))
    records = counted.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct(F.col("l_partkey").cast("string"), "n"))).alias("mins"))
    mins = F.from_json(F.to_json(F.struct("mins")), "mins map<string, long>")["mins"]
    return records.select(F.col("l_orderkey").alias("id"), F.explode(mins).alias("key", "abund")).select("id", F.col("key").cast("long").alias("h"), "abund")


@query("accession_from_path", "SELECT page_id, split_part(string_split(url, '/')[-1], '.', 1) AS acc FROM pages")
def accession_from_path(spark, d):
    return table(spark, d, "pages").select("page_id", X.accession_of(F.col("url")).alias("acc"))


@query("name_rewrite", "SELECT page_id, regexp_replace(regexp_replace(url, '\\.html$', '_ids.u64'), '_ids\\.u64$', '_mins.u64') AS name FROM pages")
def name_rewrite(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_replace(F.regexp_replace("url", r"\.html$", "_ids.u64"), r"_ids\.u64$", "_mins.u64").alias("name"))


@query("clamp16", "SELECT l_orderkey, l_linenumber, greatest(least(CAST(floor(l_extendedprice) AS BIGINT), 32767), -32768) AS v FROM lineitem")
def clamp16(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.clamp16(F.floor("l_extendedprice")).alias("v"))


@query("scale_dim", "SELECT vec_id, i - 1 AS component, round(embedding[i]::DOUBLE / sqrt(len(embedding)), 9) AS value FROM embeddings, range(1, 65) t(i) WHERE i <= len(embedding)")
def scale_dim(spark, d):
    """Every component over the square root of the dimension."""
    parts = table(spark, d, "embeddings").select("vec_id", F.size("embedding").alias("dim"), F.posexplode("embedding").alias("component", "x"))
    return parts.select("vec_id", F.col("component").cast("long").alias("component"), F.round(F.col("x").cast("double") / F.sqrt("dim"), 9).alias("value"))


@query("size_report", "SELECT source, count(*) AS files, sum(n_chars) AS bytes, round(sum(n_chars) / 1048576.0, 3) AS mib FROM documents GROUP BY source")
def size_report(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("files"), F.sum("n_chars").alias("bytes"), F.round(F.sum("n_chars") / 1048576.0, 3).alias("mib"))


@query("human_time", """SELECT event_id, CASE WHEN s < 60 THEN printf('%.1f s', floor(s * 10 + 0.5) / 10) WHEN s < 3600 THEN printf('%.1f min', floor(s / 60 * 10 + 0.5) / 10) ELSE printf('%.1f h', floor(s / 3600 * 10 + 0.5) / 10) END AS took
  FROM (SELECT event_id, value * 100 AS s FROM events)""")
def human_time(spark, d):
    return table(spark, d, "events").select("event_id", X.human_time(F.col("value") * 100).alias("took"))


REPORT = POSTINGS + """, dict AS (SELECT DISTINCT h FROM postings WHERE acc IN (SELECT doc_id FROM labels)),
report AS (SELECT acc AS name, CASE WHEN count(dict.h) = 0 THEN 'MISSING' WHEN count(dict.h) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM postings LEFT JOIN dict USING (h) GROUP BY acc)"""


def report(spark, d):
    """Every document's set against the one rebuilt with the dictionary of the labelled documents: the same, another, or none."""
    original = staged(postings(spark, d), "postings")
    known = D.union_hashes(original.join(table(spark, d, "labels").select(F.col("doc_id").alias("acc")), "acc", "left_semi"))
    ids = staged(D.dense_ids(known), "dictionary")
    rebuilt = D.decode(D.encode(original, ids, must_match=False).where("id is not null"), ids)
    records = [x.groupBy(F.col("acc").alias("name")).agg(F.struct(F.sort_array(F.collect_list("h")).alias("mins")).alias("record")) for x in (original, rebuilt)]
    return R.compare(*records)


@query("roundtrip_missing", f"WITH {REPORT} SELECT name FROM report WHERE status = 'MISSING'")
def roundtrip_missing(spark, d):
    return report(spark, d).where("status = 'MISSING'").select("name")


@query("count_if", f"WITH {REPORT} SELECT status, count(*) AS n FROM report GROUP BY status")
def count_if(spark, d):
    return report(spark, d).groupBy("status").agg(F.count("*").alias("n"))


@query("roundtrip_verdict", f"""WITH {REPORT} SELECT count(*) AS total, count(*) FILTER (status = 'PASS') AS "pass", count(*) FILTER (status = 'FAIL') AS fail, count(*) FILTER (status = 'MISSING') AS missing,
  count(*) > 0 AND count(*) FILTER (status = 'PASS') = count(*) AS ok FROM report""")
def roundtrip_verdict(spark, d):
    return R.verdict(report(spark, d))


@query("extremes", """(SELECT doc_id AS name, n_chars AS size, 'largest' AS kind FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10) UNION ALL
  (SELECT doc_id, n_chars, 'smallest' FROM documents ORDER BY n_chars, doc_id LIMIT 10)""")
def extremes(spark, d):
    return R.extremes(table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("size")), 10)


@query("random_rest")
def random_rest(spark, d):
    sizes = table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("n_chars").alias("size"))
    return R.random_rest(sizes, R.extremes(sizes, 10), 10)


@query("ef_roundtrip", f"WITH {POSTINGS} SELECT acc, count(*) AS n FROM postings GROUP BY acc")
def elias_fano_roundtrip(spark, d):
    """Sizes of the sets after Elias-Fano encoding and decoding."""
    from ..sources.blobs import ef_decode, ef_encode

    sets = postings(spark, d).groupBy("acc").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    return sets.select("acc", ef_decode(ef_encode("hs")).alias("back"), "hs").where("back = hs").select("acc", F.size("back").cast("long").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents, joined by similarity: every asked document's neighbours."""
    return topk_neighbors(spark, sf_dir)
