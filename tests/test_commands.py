"""The commands on small files, from signatures to neighbours."""

import json

import numpy as np
import pytest

from sketchloom.commands import main, parser


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Signatures of ten sets, their postings, vectors and matrix."""
    root = tmp_path_factory.mktemp("db")
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 54, 400).tolist()
    (root / "sigs/b").mkdir(parents=True)
    for i in range(10):
        mins = sorted({*base[: 40 * i], *rng.integers(0, 1 << 54, 50).tolist()})
        (root / "sigs" / ("b" if i % 2 else ".") / f"A{i}.sig").write_text(json.dumps([{"name": f"A{i}", "signatures": [{"ksize": 31, "mins": mins}]}]))
    for args in (["sketch", "sigs", "postings"], ["build", "postings", "vectors", "-d", "1024"], ["matrix", "vectors", "matrix", "--shards", "3"]):
        assert main([args[0], *(str(root / a) if a in ("sigs", "postings", "vectors", "matrix") else a for a in args[1:])]) == 0
    return root


def test_modes_exclude_each_other():
    for bad in (["query", "m"], ["query", "m", "--ids", "a", "--counts"], ["query", "m", "--ids", "a", "--top", "3", "--all"], ["dna", "x", "y"], ["nothing"]):
        with pytest.raises(SystemExit):
            parser().parse_args(bad)


def test_neighbours_slices_and_cuts(spark, made, tmp_path):
    m = str(made / "matrix")
    (tmp_path / "ids.txt").write_text("# asked\nA9\n A7 \nunknown\n")
    with pytest.warns(UserWarning, match="unknown"):
        assert main(["query", m, "--ids-file", str(tmp_path / "ids.txt"), "--top", "3", "--write", str(tmp_path / "out.csv")]) == 0
    lines = (tmp_path / "A9_out.csv").read_text().splitlines()
    assert lines[:2] == ["ID,Jaccard", "A9,1"] and len(lines) == 4 and lines[2].startswith("A8,0.7") and (tmp_path / "A7_out.csv").exists()
    assert main(["query", m, "--ids", "A9", "--all", "--write", str(tmp_path / "all.tsv")]) == 0
    assert len((tmp_path / "A9_all.tsv").read_text().splitlines()) > 8
    (tmp_path / "cols.txt").write_text("A8\nA9\nA8\n")
    slice_ = ["query", m, "--rows-file", str(tmp_path / "ids.txt"), "--cols-file", str(tmp_path / "cols.txt"), "--write"]
    with pytest.warns(UserWarning):
        main([*slice_, str(tmp_path / "s.csv")])
        main([*slice_, str(tmp_path / "s.npy")])
    text = (tmp_path / "s.csv").read_text().splitlines()
    assert text[0] == "Accession,A8,A9,A8," and text[1].startswith("A9,") and text[1].split(",")[2] == "1"
    assert np.load(tmp_path / "s.npy").shape == (2, 3) and np.load(tmp_path / "s.npy")[0, 1] == 1
    with pytest.raises(SystemExit, match="cols-file"):
        main(slice_[:4])
    assert main(["query", m, "--nf", "2", "0.9", "--write", str(tmp_path / "cut")]) == 0
    assert spark.read.parquet(str(tmp_path / "cut/edges")).count() == 19
    assert main(["query", str(tmp_path / "cut"), "--counts", "--write", str(tmp_path / "counts")]) == 0
    assert {int(r.n) for r in spark.read.option("header", True).csv(str(tmp_path / "counts")).collect()} == {1, 2}
    (tmp_path / "subset.txt").write_text("A5\nA9\n")
    assert main(["query", m, "--subset-file", str(tmp_path / "subset.txt"), "--write", str(tmp_path / "sub")]) == 0
    assert {(r["row"], r["col"]) for r in spark.read.parquet(str(tmp_path / "sub/edges")).collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert main(["query", m, "--histogram", "--write", str(tmp_path / "histogram")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "histogram")).count() == 768


def test_search_dictionary_round_trip_and_metadata(spark, made, tmp_path, capsys):
    spark.read.parquet(str(made / "postings")).where("acc in ('A3', 'A9')").write.parquet(str(tmp_path / "q"))
    assert main(["search", str(made / "vectors"), str(tmp_path / "q"), str(tmp_path / "hits.tsv"), "--top", "2"]) == 0
    lines = (tmp_path / "hits.tsv").read_text().splitlines()
    assert lines[1] == "0\tA3\t1" and lines[4] == "1\tA9\t1" and lines[3] == "" and len(lines) == 7
    assert main(["dictionary", str(made / "postings"), str(tmp_path / "d")]) == 0
    assert spark.read.parquet(str(tmp_path / "d/sets")).count() == spark.read.parquet(str(made / "postings")).count()
    assert main(["roundtrip", str(made / "sigs"), str(tmp_path / "back")]) == 0
    assert main(["compare", str(made / "sigs"), str(tmp_path / "back"), "--write", str(tmp_path / "report")]) == 0
    (tmp_path / "back/b/A1.sig").unlink()
    assert main(["compare", str(made / "sigs"), str(tmp_path / "back"), "--write", str(tmp_path / "report")]) == 1
    (tmp_path / "m.csv").write_text("acc,platform,releasedate\nX1,ILLUMINA,2023-02-01\nX2,ILLUMINA,2021-02-01\n")
    assert main(["metadata", str(tmp_path / "m.csv"), "select acc from metadata where platform = 'ILLUMINA' and releasedate > date '2022-01-01'"]) == 0
    said = capsys.readouterr().out
    assert "X1" in said and "X2" not in said
    (tmp_path / "x.fa").write_text(">r1\n" + "ACGTTGCATTACGGAT" * 20 + "\n>r2\n" + "ACGTTGCATTACGGATCCAGTAGGCTTACAGGATTCCGATATCGGCAAT" + "\n")
    for mode in ("reads", "assembly"):
        assert main(["dna", str(tmp_path / "x.fa"), str(tmp_path / mode), "--mode", mode, "-k", "15", "-s", "2"]) == 0
    reads, assembly = ({tuple(r) for r in spark.read.parquet(str(tmp_path / x)).collect()} for x in ("reads", "assembly"))
    assert reads < assembly
