import gzip
import json
import struct

import numpy as np
import pytest

from sketchloom.operators import dictionary, matrix, roundtrip, similarity, sketch
from sketchloom.operators.projection import project, signs
from sketchloom.plans import QUERIES
from sketchloom.sources import blobs, files


def rows(df):
    return sorted(map(tuple, df.collect()))


def sets(spark, **members):
    return spark.createDataFrame([(a, h) for a, hs in members.items() for h in hs], "acc string, h long")


def test_similarity_join_by_hand(spark):
    p = sets(spark, a=range(10), b=range(5, 15), c=range(10), d=[100])
    got = {(r["row"], r["col"]): (r.common, r.q) for r in similarity.similarity_join(p).collect()}
    assert got[("a", "b")] == got[("b", "a")] == (5, 85)  # 5 of 15
    assert got[("d", "d")] == (1, 255) and ("c", "c") not in got and len(got) == 5
    assert rows(sketch.set_classes(p).select("acc", "rep")) == [("a", "a"), ("b", "b"), ("c", "a"), ("d", "d")]


def test_dense_ids_are_ranks(spark):
    values = [5, 1 << 51, 17, 3, (1 << 52) - 1]
    got = rows(dictionary.dense_ids(spark.createDataFrame([(v,) for v in values], "h long")))
    assert got == [(h, i + 1) for i, h in enumerate(sorted(values))]


def test_top_or_threshold_keeps_ties(spark):
    e = spark.createDataFrame([(1, c, q) for c, q in enumerate([90, 80, 80, 70, 60, 20])] + [(2, 0, 3)], "row int, col int, q int")
    assert rows(matrix.top_or_threshold(e, 2, 0.27).select("row", "q")) == [(1, 70), (1, 80), (1, 80), (1, 90), (2, 3)]
    assert rows(matrix.top_or_threshold(e, 0, 0.3).select("q")) == [(80,), (80,), (90,)]
    assert rows(matrix.delta_decode(matrix.delta_gaps(e))) == rows(e.select("row", "col"))


def sign_by_hand(h, dim, spacing):
    out, mask = [], (1 << 64) - 1
    for i in range(0, dim, 64):
        z = (h + i * spacing + 0x9E3779B97F4A7C15) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        z ^= z >> 31
        out += [1 - 2 * (z >> n & 1) for n in range(64)]
    return out[:dim]


@pytest.mark.parametrize(("dim", "spacing"), [(64, None), (128, None), (100, 1), (2048, 32)])
def test_signs(dim, spacing):
    hashes = np.array([0, 1, 179527421241, 2**53 + 5], np.uint64)
    got = signs(hashes, dim, spacing)
    assert got.tolist() == [sign_by_hand(int(h), dim, dim // 64 if spacing is None else spacing) for h in hashes]


def test_projection_adds_up(spark):
    p = sets(spark, a=range(50), b=range(50, 90), c=range(90))
    v = {r.acc: np.array(r.v) for r in project(p.repartition(5), 128).collect()}
    assert (v["a"] + v["b"] == v["c"]).all()


def test_blobs_round_trip():
    for values in ([], [0], [7], [0, 0, 1, 5, 1000], sorted(np.random.default_rng(1).integers(0, 2**62, 300).tolist())):
        assert blobs.unpack(blobs.pack(np.array(values, np.uint64))).tolist() == list(values)
    with pytest.raises(ValueError, match="blob"):
        blobs.unpack(b"EFU2" + bytes(36))


def test_signature_files(spark, tmp_path):
    sig = lambda mins, k=31: {"ksize": k, "mins": mins}
    (tmp_path / "x.1.sig").write_text(json.dumps([{"name": "x", "signatures": [sig([1, "2"]), sig([9], 21)]}]))
    (tmp_path / "y.sig").write_bytes(gzip.compress(json.dumps({"signatures": [sig({"5": 3})]}).encode()))
    got = [tuple(r) for r in files.read_signatures(spark, str(tmp_path)).select("acc", "h", "abund").orderBy("acc", "h").collect()]
    assert [r[:2] for r in got] == [("x", 1), ("x", 2), ("y", 5)] and got[2][2] == 3


def test_text_and_binary_files(spark, tmp_path):
    (tmp_path / "h.txt").write_text("a: 3 1 2\nb:\nno colon\nc: 7\n")
    assert rows(files.read_hash_text(spark, str(tmp_path / "h.txt"))) == [("a", 1), ("a", 2), ("a", 3), ("c", 7)]
    (tmp_path / "n.txt").write_text("acc1 0.5\n\nbroken\nacc2 12.25\n")
    assert rows(files.read_norms(spark, str(tmp_path / "n.txt"))) == [(0, "acc1", 0.5), (1, "acc2", 12.25)]
    (tmp_path / "ids.txt").write_text("# note\n a \n\nb\n")
    assert rows(files.read_ids(spark, str(tmp_path / "ids.txt"))) == [("a",), ("b",)]
    (tmp_path / "k.u64").write_bytes(struct.pack("<3Q", 4, 5, 6))
    assert rows(files.read_u64(spark, str(tmp_path / "k.u64")).select("h")) == [(4,), (5,), (6,)]
    (tmp_path / "v.bin").write_bytes(np.arange(8, dtype="<i2").tobytes())
    assert [r.v for r in files.read_vectors(spark, str(tmp_path / "v.bin"), 4).orderBy("idx").collect()] == [[0, 1, 2, 3], [4, 5, 6, 7]]
    assert files.shards(["a/shard_0", "a/shard_3/", "a/other"]) == 4
    with pytest.raises(ValueError, match="version"):
        files.check_version("2")


def test_verdict(spark):
    a = spark.createDataFrame([("x", (1,)), ("y", (2,)), ("z", (3,))], "name string, record struct<v int>")
    b = spark.createDataFrame([("x", (1,)), ("y", (9,))], "name string, record struct<v int>")
    report = roundtrip.compare(a, b)
    assert rows(report) == [("x", "PASS"), ("y", "FAIL"), ("z", "MISSING")]
    assert not roundtrip.verdict(report).first().ok and roundtrip.verdict(roundtrip.compare(b, b)).first().ok


def test_windows_of_texts_with_other_letters(spark, tmp_path):
    plain = "the quick brown fox jumps over it."
    texts = [plain, f"D\u00e9j\u00e0 vu \u2013 {plain} stra\u00dfe \U0001f642 {plain}", "\u0131\u017f" * 40, None, "short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.id: r for r in QUERIES["kmer_extract"](spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1}
    for i in got:
        upper = "".join(c.upper() if c.isascii() else c for c in texts[i])
        own = {w for w in (upper[j : j + 31] for j in range(len(upper) - 30)) if set(w) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ .")}
        assert (got[i].n, got[i].first_kmer, got[i].last_kmer) == (len(own), min(own), max(own))


def test_slice_in_tiles_keeps_repeats(spark):
    e = spark.createDataFrame([(1, 2, 255), (3, 4, 51), (9, 9, 9)], "row long, col long, q int")
    r = [(0, 3), (1, 1), (2, 1), (3, None), (3, 1), (3, 1)] + [(i, 100 + i) for i in range(4, 30)]
    c = [(0, 2), (1, 4), (2, 2), (2, 2)] + [(i, 200 + i) for i in range(3, 20)]
    ids = [spark.createDataFrame(x, "pos long, id long") for x in (r, c)]
    q = {(1, 2): 1.0, (3, 4): 0.2}
    want = sorted(((i, j, str(a), b, q.get((a, b), 0.0)) for i, a in r for j, b in c))
    for cells in (matrix.matrix_slice(e, *ids), matrix.matrix_slice(e, *ids, width=4)):
        assert sorted((x[0], x[1], str(x[2]), *x[3:]) for x in cells.collect()) == want
        plan = cells._jdf.queryExecution().optimizedPlan().toString()
        assert "Cross" not in plan
