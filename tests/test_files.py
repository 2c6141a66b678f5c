"""Readers, sinks, the signature round trip and DNA sketches on small files."""

import gzip
import hashlib
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sketchloom import functions as X
from sketchloom.operators import dictionary, matrix, ordered, roundtrip, sketch
from sketchloom.operators.projection import project, signs
from sketchloom.sources import files


def sig(mins, k=31, **more):
    return {"ksize": k, "mins": mins, **more}


def test_signature_folders(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.sig").write_text(json.dumps({"signatures": [sig([1])]}))
    (tmp_path / "deep" / "b.sig").write_text(json.dumps([sig([2])]))
    (tmp_path / "notes.txt").write_text("no signature")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("signatures/x.gz", gzip.compress(json.dumps([{"signatures": [sig([3, "x", "4"], abundances=[5, 6]), sig([9], 21)]}]).encode()))
        z.writestr("manifest.csv", "other")
    got = lambda r: sorted((x.acc, x.h, x.abund) for x in files.read_signatures(spark, str(tmp_path), recursive=r).collect())
    assert got(False) == [("a", 1, None), ("c", 3, 5), ("c", 4, 6)] and got(True) == [("a", 1, None), ("b", 2, None), ("c", 3, 5), ("c", 4, 6)]
    batches = files.with_batch(files.signature_files(spark, str(tmp_path), True), f"file:{tmp_path}")
    assert sorted((r.path.rsplit("/", 1)[-1], r.batch) for r in batches.collect()) == [("a.sig", ""), ("b.sig", "deep"), ("c.zip", "")]


@pytest.mark.parametrize("bad", [sig([1, 2], abundances=[1]), sig([1 << 63])])
def test_signatures_that_are_errors(spark, tmp_path, bad):
    (tmp_path / "a.sig").write_text(json.dumps([bad]))
    with pytest.raises(PySparkException, match=r"abundances of|2\^63"):
        files.read_signatures(spark, str(tmp_path)).collect()


def test_hashes_beyond_a_long(spark, tmp_path):
    (tmp_path / "h.txt").write_text(f"a: 3 {(1 << 63) - 1}\n")
    assert {r.h for r in files.read_hash_text(spark, str(tmp_path / "h.txt")).collect()} == {3, (1 << 63) - 1}
    (tmp_path / "big.txt").write_text(f"a: 3 {1 << 63}\n")
    (tmp_path / "big.u64").write_bytes(struct.pack("<2Q", 1, 1 << 63))
    for read, name in ((files.read_hash_text, "big.txt"), (files.read_u64, "big.u64")):
        with pytest.raises(PySparkException, match=r"2\^63"):
            read(spark, str(tmp_path / name)).collect()


def test_uints_and_set_lines(spark, tmp_path):
    sets = spark.createDataFrame([("a", [1, 2, 70000]), ("b", [])], "acc string, hs array<long>")
    for bits in (32, 64):
        assert files.write_uints(sets, str(tmp_path / str(bits)), bits) == 2
    assert np.fromfile(tmp_path / "32" / "a.u32", "<u4").tolist() == [1, 2, 70000]
    assert [r.h for r in files.read_u64(spark, str(tmp_path / "64")).orderBy("acc", "pos").collect()] == [1, 2, 70000]
    with pytest.raises(PySparkException, match="fit 32 bits"):
        files.write_uints(spark.createDataFrame([("a", [1 << 32])], sets.schema), str(tmp_path / "no"), 32)
    (tmp_path / "sets.txt").write_text("5 6\n\n7\n")
    assert sorted(map(tuple, files.read_set_lines(spark, str(tmp_path / "sets.txt")).collect())) == [(0, 5), (0, 6), (2, 7)]
    files.write_hash_text(spark.createDataFrame([("a", 2), ("a", 1)], "acc string, h long"), str(tmp_path / "out"))
    assert sorted(map(tuple, files.read_hash_text(spark, str(tmp_path / "out")).collect())) == [("a", 1), ("a", 2)]


def test_lines_are_counted_over_splits(spark, tmp_path):
    lines = [f"acc{i} {i}.5" for i in range(20_000)]
    (tmp_path / "n.txt").write_text("\n".join([*lines[:10], "", "broken", *lines[10:]]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = sorted(map(tuple, files.read_norms(spark, str(tmp_path / "n.txt")).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, f"acc{i}", i + 0.5) for i in range(20_000)]


def test_id_lists(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# note\n\tb\t\n \n  a \r\n #c\nb\n")
    ids = files.read_ids(spark, str(tmp_path / "ids.txt"))
    assert [r.id for r in ids.collect()] == ["b", "a", "#c", "b"]
    with pytest.warns(UserWarning, match="#c"):
        assert sorted(r.id for r in files.known_ids(ids, spark.createDataFrame([("a",), ("b",)], "acc string")).collect()) == ["a", "b", "b"]


def test_vector_folder(spark, tmp_path):
    p = spark.createDataFrame([(a, h) for a, hs in (("x", range(40)), ("y", range(10, 90)), ("z", [7])) for h in hs], "acc string, h long")
    made = ordered.row_numbers(project(p, 128), ["acc"], "idx").withColumn("idx", F.col("idx") - 1)
    folder = str(tmp_path / "db")
    assert files.write_vectors(made, folder, 128) == 3
    assert files.vector_count(spark, f"{folder}/vectors.bin", 128).first().n == 3
    back = files.open_vectors(spark, folder)
    assert sorted(map(tuple, back.collect())) == sorted((r.idx, r.acc, r.v, r.n2) for r in made.collect())
    assert [r.idx for r in files.read_vectors(spark, f"{folder}/vectors.bin", 128, block_rows=2).orderBy("idx").collect()] == [0, 1, 2]
    (tmp_path / "db" / "version.txt").write_text("2\n")
    with pytest.raises(ValueError, match="version"):
        files.open_vectors(spark, folder)


def test_vectors_that_wrap_at_16_bits(spark):
    hashes = np.array([5], np.uint64)
    p = spark.createDataFrame([("a", 5)] * 40_000, "acc string, h long")  # each component is 40000 or -40000
    got = {wrap: np.array(project(p, 64, spacing=1, wrap16=wrap).first().v) for wrap in (False, True)}
    assert (got[False] == 40_000 * signs(hashes, 64, 1)[0].astype(int)).all()
    assert (got[True] == (40_000 * signs(hashes, 64, 1)[0].astype(int)).astype(np.int16)).all()


def test_matrix_is_written_and_read_back(spark, tmp_path):
    e = spark.createDataFrame([(r, c, (r * c) % 256) for r in range(9, -1, -1) for c in range(3)], "row int, col int, q int")
    for _ in range(2):  # the second writing replaces the first
        matrix.write_matrix(e, str(tmp_path / "m"), 10, 3)
    back = matrix.read_matrix(spark, str(tmp_path / "m"))
    assert [tuple(r) for r in matrix.in_order(back.select("row", "col", "q")).collect()] == sorted(map(tuple, e.collect()))
    assert {r.shard for r in back.where("row = 9").collect()} == {2} and back.count() == 30
    assert files.shards([p.name for p in (tmp_path / "m" / "edges").iterdir()]) == 0 and len(list((tmp_path / "m" / "edges").glob("shard=*"))) == 3
    spark.createDataFrame([("7",)], "value string").write.mode("overwrite").text(str(tmp_path / "m" / "version"))
    with pytest.raises(ValueError, match="version 7"):
        matrix.read_matrix(spark, str(tmp_path / "m"))
    with pytest.raises(KeyError, match="99"):
        matrix.reindex(e, spark.createDataFrame([(1, 5), (99, 6)], "old int, new int"))


def test_sinks(spark, tmp_path):
    hits = spark.createDataFrame([("b", 1, "b", 1.0), ("a", 2, "c", 0.25), ("a", 1, "a", 1.0)], "query string, rank int, neighbor string, jaccard double")
    assert files.write_neighbours(hits, str(tmp_path / "n"), "out.csv") == 2
    assert (tmp_path / "n" / "a_out.csv").read_text() == "ID,Jaccard\na,1\nc,0.25\n" and (tmp_path / "n" / "b_out.csv").exists()
    with pytest.raises(ValueError, match="csv"):
        files.write_neighbours(hits, str(tmp_path / "n"), "out.xml")
    found = spark.createDataFrame([(1, 5, 0.5), (0, 7, 0.25), (0, 3, 1.0)], "query_idx long, vec_id long, jaccard double")
    files.write_hits(found, str(tmp_path / "hits.tsv"))
    assert (tmp_path / "hits.tsv").read_text() == "QueryIndex\tAccession\tJaccard_Similarity\n0\t3\t1\n0\t7\t0.25\n\n1\t5\t0.5\n\n"
    e = spark.createDataFrame([(1, 2, 255), (3, 4, 51)], "row long, col long, q int")
    for width in (65_536, 1):
        tiles = matrix.slice_tiles(e, *[spark.createDataFrame(x, "pos long, id long") for x in ([(0, 3), (1, 1), (2, 1)], [(0, 2), (1, 4)])], width=width)
        files.write_slice(tiles, str(tmp_path / "s.csv"))
        assert (tmp_path / "s.csv").read_text() == "Accession,2,4,\n3,0,0.2,\n1,1,0,\n1,1,0,\n"
        files.write_slice_npy(tiles, str(tmp_path / "s.npy"), 3, 2, width)
        assert np.load(tmp_path / "s.npy").tolist() == np.array([[0, 0.2], [1, 0], [1, 0]], np.float32).tolist()
    with pytest.raises(ValueError, match="npy"):
        files.write_slice_npy(tiles, str(tmp_path / "s.npz"), 3, 2)


def test_metadata_and_sizes(spark, tmp_path):
    (tmp_path / "m.csv.gz").write_bytes(gzip.compress(b'acc,Organism,extra,jattr\nx,mouse,1,"{""a"": 1}"\n'))
    csv = files.read_metadata(spark, str(tmp_path / "m.csv.gz"))
    assert csv.columns == [*files.METADATA, "extra"] and len(files.METADATA) == 42
    row = csv.first()
    assert (row.acc, row.organism, row.extra, row.country, json.loads(row.jattr)) == ("x", "mouse", "1", None, {"a": 1})
    csv.write.parquet(str(tmp_path / "m.parquet"))
    assert files.read_metadata(spark, str(tmp_path / "m.parquet")).first() == row
    a = spark.createDataFrame([("s", 3 << 20), ("s", 1 << 20), ("t", 5)], "batch string, length long")
    got = {r.batch: r for r in files.size_report(a, a.where("length > 5 and length < 2000000")).collect()}
    assert (got["s"].input_files, got["s"].output_mib, got["s"].ratio) == (2, 1.0, 4.0) and got["t"].ratio is None and got["t"].output_files == 0


def test_signature_round_trip(spark, tmp_path):
    rng = np.random.default_rng(0)
    for i in range(4):
        record = [{"name": f"n{i}", "version": 0.4, "signatures": [sig(rng.integers(0, 1 << 54, 30).tolist(), seed=42), sig([str(i), "7"], 21)]}]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"s{i}.sig").write_text(json.dumps(record))
    whole = roundtrip.take_apart(spark, str(tmp_path / "in"))
    assert all('"mins":[]' in r.skeleton for r in whole.collect())
    made = roundtrip.rebuild(whole, whole.where("name <> 's3.sig'"))
    assert [(r.name, r.error) for r in made.where("error is not null").collect()] == [("s3.sig", "members of 0 of 2 signatures")]
    (tmp_path / "out").mkdir()
    assert roundtrip.write_records(made, str(tmp_path / "out")) == 3
    record = json.loads((tmp_path / "out" / "s2.sig").read_text())
    record[0]["name"] = "other"
    (tmp_path / "out" / "s2.sig").write_text(json.dumps(record))
    a, b = (roundtrip.canonical_files(spark, str(tmp_path / x)) for x in ("in", "out"))
    report = roundtrip.compare_files(a, b)
    assert {r.filename: r.status for r in report.collect()} == {"s0.sig": "PASS", "s1.sig": "PASS", "s2.sig": "FAIL", "s3.sig": "MISSING"}
    assert report.where("filename = 's0.sig'").first().original_size_bytes == (tmp_path / "in" / "s0.sig").stat().st_size
    assert not roundtrip.verdict(report).first().ok


def forms(spark, *records):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, text string")
    return [r.form for r in df.orderBy("i").select(roundtrip.canonical(F.col("text")).alias("form")).collect()]


def test_canonical_forms(spark):
    a = [{"x": 1, "signatures": [sig([3, 1]), sig([9], 21)]}, {"x": 2}]
    same = [{"x": 2}, {"signatures": [sig([9], 21), sig(["1", 3])], "x": 1}]
    others = [[{"x": 1, "signatures": [sig([3, 1, 1]), sig([9], 21)]}, {"x": 2}], [{"x": 1.5, "signatures": a[0]["signatures"]}, {"x": 2}], a[:1], a[0], [{"x": None, "signatures": a[0]["signatures"]}, {"x": 2}]]
    found = forms(spark, a, same, *others)
    assert found[0] == found[1] and len(set(found)) == 1 + len(others)
    # hashes have no order, a list of abundances has
    one = forms(spark, *[sig([3, 1], abundances=[30, 10]), sig([1, 3], abundances=[30, 10]), sig([1, 3], abundances=[10, 30])])
    assert one[0] == one[1] != one[2]
    maps = forms(spark, *[sig({"3": 1, "1": 2}), sig({"1": 2, "3": 1}), sig({"1": 1, "3": 2})])
    assert maps[0] == maps[1] != maps[2]
    big = forms(spark, sig([(1 << 64) - 1, 5]), sig([5, (1 << 64) - 1]), sig([5, (1 << 64) - 2]))
    assert big[0] == big[1] != big[2]


def test_mins_outside_the_signatures_are_an_error(spark, tmp_path):
    (tmp_path / "x.sig").write_text(json.dumps([{"signatures": [sig([1])], "other": {"mins": [7]}}]))
    with pytest.raises(PySparkException, match="outside the signatures"):
        roundtrip.take_apart(spark, str(tmp_path)).collect()
    quoted = [{"name": 'a "mins":[1,2] b', "signatures": [sig([4, 2], abundances=[1, 5])]}]
    (tmp_path / "x.sig").write_text(json.dumps(quoted))
    whole = roundtrip.take_apart(spark, str(tmp_path))
    assert json.loads(roundtrip.rebuild(whole, whole).first().record) == quoted


def test_round_trip_of_abundances_maps_and_folders(spark, tmp_path):
    """Files of one name in two folders, pairs out of order, maps of abundances, empty members."""
    files_ = {
        "b1/x.sig": [{"name": "one", "signatures": [sig([9, 3], abundances=[90, 30]), sig([], 21, abundances=[])]}],
        "b2/x.sig": {"name": "two", "signatures": [sig({"70": 7, "5": 50}), sig([8, 2, 8])]},
        "b2/deep/x.sig": [{"name": "three", "signatures": [sig([4, 1], abundances=[1])]}, {"name": "four"}],
        "x.sig": sig(["12", 11]),
    }
    for name, record in files_.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps(record))
    whole = roundtrip.take_apart(spark, f"file://{tmp_path}/in/")
    assert {(r.folder, r.name) for r in whole.collect()} == {("b1", "x.sig"), ("b2", "x.sig"), ("b2/deep", "x.sig"), ("", "x.sig")}
    made = roundtrip.rebuild(whole.select("folder", "name", "skeleton"), whole.select("folder", "name", "parts").repartition(3))
    got = {f"{r.folder}/{r.name}".lstrip("/"): json.loads(r.record) for r in made.collect()}
    assert got.pop("x.sig") == sig([12, 11]) and got == {k: v for k, v in files_.items() if k != "x.sig"}
    assert roundtrip.write_records(made, str(tmp_path / "out")) == roundtrip.write_records(made, str(tmp_path / "out")) == 4
    a, b = (roundtrip.canonical_files(spark, str(tmp_path / x)) for x in ("in", "out"))
    report = roundtrip.compare_files(a, b)
    assert [r.status for r in report.collect()] == ["PASS"] * 4 and roundtrip.verdict(report).first().ok
    swapped = json.loads((tmp_path / "out/b1/x.sig").read_text())
    swapped[0]["signatures"][0] |= {"mins": [3, 9], "abundances": [30, 90]}
    (tmp_path / "out/b1/x.sig").write_text(json.dumps(swapped))
    (tmp_path / "out/b2/x.sig").unlink()
    assert {r.original_path.split("/in/")[1]: r.status for r in roundtrip.compare_files(a, roundtrip.canonical_files(spark, str(tmp_path / "out"))).collect()} == {
        "b1/x.sig": "FAIL", "b2/x.sig": "MISSING", "b2/deep/x.sig": "PASS", "x.sig": "PASS",
    }


def test_md5_of_a_signature(spark):
    df = spark.createDataFrame([(31, [10, 9, 100])], "ksize int, mins array<long>")
    assert df.select(roundtrip.signature_md5(F.col("ksize"), F.col("mins")).alias("m")).first().m == hashlib.md5(b"31910100").hexdigest()


def test_members_against_their_md5sum(spark, tmp_path):
    good = hashlib.md5(b"31910100").hexdigest()
    (tmp_path / "a.sig").write_text(json.dumps([{"signatures": [sig([10, 9, 100], md5sum=good), sig([5])]}]))
    assert files.read_signatures(spark, str(tmp_path), verify=True).count() == 4
    (tmp_path / "b.sig").write_text(json.dumps([{"signatures": [sig([10, 9, 101], md5sum=good)]}]))
    with pytest.raises(PySparkException, match="md5sum"):
        files.read_signatures(spark, str(tmp_path), verify=True).count()
    assert files.read_signatures(spark, str(tmp_path)).count() == 7


def murmur_by_hand(data, seed):
    mask = (1 << 64) - 1
    turn = lambda x, k: ((x << k) | (x >> (64 - k))) & mask
    c1, c2, a, b = 0x87C37B91114253D5, 0x4CF5AD432745937F, seed, seed
    for i in range(len(data) // 16):
        x, y = struct.unpack_from("<QQ", data, 16 * i)
        a ^= turn(x * c1 & mask, 31) * c2 & mask
        a = ((turn(a, 27) + b) * 5 + 0x52DCE729) & mask
        b ^= turn(y * c2 & mask, 33) * c1 & mask
        b = ((turn(b, 31) + a) * 5 + 0x38495AB5) & mask
    x, y = struct.unpack("<QQ", data[len(data) // 16 * 16 :].ljust(16, b"\0"))
    a ^= (turn(x * c1 & mask, 31) * c2 & mask) ^ len(data)
    b ^= (turn(y * c2 & mask, 33) * c1 & mask) ^ len(data)
    a = (a + b) & mask
    b = (a + b) & mask
    for k in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        a, b = ((x ^ (x >> 33)) * k & mask for x in (a, b))
    return ((a ^ (a >> 33)) + (b ^ (b >> 33))) & mask


def test_murmur_hash_of_known_text():
    assert int(sketch.murmur64(np.frombuffer(b"hello", np.uint8)[None], 0)[0]) == 0xCBD8A7B341BD9B02
    rng = np.random.default_rng(1)
    for n in (1, 8, 15, 16, 31, 40):
        data = rng.integers(0, 256, (20, n)).astype(np.uint8)
        assert sketch.murmur64(data, 42).tolist() == [murmur_by_hand(x.tobytes(), 42) for x in data]


def test_dna_sketches(spark):
    rng = np.random.default_rng(2)
    seq = "".join(rng.choice(list("ACGTacgt"), 3000)) + "N" + "ACGT" * 20
    back = seq.upper()[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = {}
    for i in range(len(seq) - 30):
        w = seq[i : i + 31].upper()
        if "N" not in w:
            h = murmur_by_hand(min(w, w[::-1].translate(str.maketrans("ACGT", "TGCA"))).encode(), 42)
            if h <= (1 << 64) // 10:
                want[h] = want.get(h, 0) + 1
    df = spark.createDataFrame([(1, seq), (2, back), (3, "ACG"), (4, None)], "id long, seq string")
    got = sketch.dna_postings(df, 31, 10).collect()
    for i in (1, 2):  # both strands have one sketch
        assert {r.h: r.abund for r in got if r.id == i} == want
    assert {r.id for r in got} == {1, 2}


def test_dictionaries_must_match(spark):
    ids = dictionary.dense_ids(spark.createDataFrame([(30,), (10,), (20,)], "h long"))
    p = spark.createDataFrame([("a", 10), ("a", 30)], "acc string, h long")
    assert sorted(map(tuple, dictionary.encode(p, ids).collect())) == [("a", 1), ("a", 3)]
    assert sorted(map(tuple, dictionary.decode(dictionary.encode(p, ids), ids).collect())) == [("a", 10), ("a", 30)]
    with pytest.raises(PySparkException, match="not in the dictionary: 11"):
        dictionary.encode(spark.createDataFrame([("a", 11)], p.schema), ids).collect()
    for bad in (0, 4):
        with pytest.raises(PySparkException, match=f"not in the dictionary: {bad}"):
            dictionary.decode(spark.createDataFrame([("a", bad)], "acc string, id long"), ids).collect()
    assert dictionary.encode(spark.createDataFrame([("a", 11)], p.schema), ids, must_match=False).first().id is None


def test_order_over_ranges(spark):
    rng = np.random.default_rng(3)
    x = rng.permutation(2000).tolist()
    df = spark.createDataFrame([(v, v % 7) for v in x], "x long, w long")
    assert sorted((r.x, r.n) for r in ordered.row_numbers(df.select("x"), ["x"], "n", rows=300).collect()) == [(v, v + 1) for v in range(2000)]
    total = {r.x: r.s for r in ordered.running_sum(ordered.ranged(df, "x", rows=300), ["x"], "w", "s").collect()}
    assert total == {v: sum(u % 7 for u in range(v)) if v else None for v in range(2000)}
    members = sorted(set(rng.integers(0, 5000, 200).tolist()))
    asked = [-1, *rng.integers(0, 5000, 500).tolist(), 9000]
    tables = [spark.createDataFrame([(v,) for v in vs], "x long") for vs in (members, asked)]
    for r in ordered.members_around(*tables, rows=100).collect():
        assert r.next_geq == min((m for m in members if m >= r.x), default=None) and r.prev_leq == max((m for m in members if m <= r.x), default=None)
        assert r.next_gt == min((m for m in members if m > r.x), default=None)


def test_units_and_confidence(spark):
    df = spark.createDataFrame([(0,), (1023,), (1536,), (5 << 40,)], "n long")
    assert [r.b for r in df.select(X.human_bytes(F.col("n")).alias("b")).collect()] == ["0.0 B", "1023.0 B", "1.5 KiB", "5.0 TiB"]
    rows = [("fr", "fr", "fr", 48.85, 2.35, 48.86, 2.35, 48.85, 2.36), ("fr", "de", None, 48.85, 2.35, 52.5, 13.4, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, x1 double, y1 double, x2 double, y2 double, x3 double, y3 double")
    points = [(F.col(f"x{i}"), F.col(f"y{i}")) for i in (1, 2, 3)]
    assert [r.c for r in df.select(X.confidence([F.col("a"), F.col("b"), F.col("c")], points).alias("c")).collect()] == [6, 0]


def test_streamed_set_sizes(spark, tmp_path):
    from sketchloom.streaming import stream_set_sizes

    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 50}" for j in range(200))) for i in range(5)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    query = stream_set_sizes(spark.readStream.schema(docs.schema).parquet(str(tmp_path / "docs"))).writeStream.format("memory").queryName("sizes").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    want = sketch.shingle_postings(docs).groupBy("acc").agg(F.count("*").alias("n"), F.min("h"), F.max("h"))
    assert sorted(map(tuple, spark.table("sizes").collect())) == sorted(map(tuple, want.collect()))


def test_random_rest_needs_three_times_the_names(spark):
    sizes = spark.createDataFrame([(i, i) for i in range(8)], "name long, size long")
    assert roundtrip.random_rest(sizes, roundtrip.extremes(sizes, 2), 2).count() == 2
    with pytest.raises(ValueError, match="9 names"):
        roundtrip.random_rest(sizes, roundtrip.extremes(sizes, 3), 3)
