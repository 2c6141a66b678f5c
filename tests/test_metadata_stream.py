"""Typed metadata, and sketches of a stream against those of the whole table."""

import json
import struct
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sketchloom.operators.projection import project
from sketchloom.sources import metadata
from sketchloom.streaming import stream_sketches


@pytest.mark.parametrize("order", ["<", ">"])
def test_points(spark, order):
    rng = np.random.default_rng(0)
    points = [(0.0, -0.0), (1.0, -2.5), (179.99999999, -89.1), (5e-324, 2.2250738585072014e-308), (-1.7976931348623157e308, 1e-310), *map(tuple, rng.uniform(-180, 180, (50, 2)).tolist())]
    made = lambda x, y: struct.pack(f"{order}BIdd", order == "<", 1, x, y)
    wkb = [(i, bytearray(made(*p))) for i, p in enumerate(points)]
    wkb += [(100, bytearray(struct.pack(f"{order}BIIdd", order == "<", 0x20000001, 4326, 3.0, 4.0))), (101, bytearray(b"\x01")), (102, None), (103, bytearray(struct.pack(f"{order}BIdd", order == "<", 2, 3.0, 4.0))), (104, bytearray(b""))]
    df = spark.createDataFrame(wkb, "i int, b binary")
    got = {r.i: r.p for r in df.select("i", metadata.wkb_point(F.col("b")).alias("p")).collect()}
    assert all((got[i].lon, got[i].lat) == p for i, p in enumerate(points)) and tuple(got[100]) == (3.0, 4.0)
    assert all(got[i] is None for i in (101, 102, 103, 104))
    texts = df.select("i", metadata.wkb_point(F.lower(F.hex("b")), True).alias("p"))
    assert {r.i: r.p for r in texts.collect()} == got


def test_typed_table(spark, tmp_path):
    point = struct.pack("<BIdd", 1, 1, 10.5, -3.25)
    rows = [
        ("A1", "WGS", "ILLUMINA", "Soil metagenome", "2023-05-01", "12", "250.5", '[{"k":"a","v":"1"},{"k":"b","v":null}]', '{"a": 1, "x y": "z"}', bytearray(point), "5"),
        ("A2", "WGS", "ILLUMINA", "soil metagenome", "2022-05-01 10:00:00", "many", None, "no json", "no json", None, "six"),
        ("A3", "AMPLICON", None, None, "never", None, "-3", None, None, bytearray(b"xx"), None),
    ]
    names = ["acc", "assay_type", "platform", "organism", "releasedate", "mbytes", "elevation", "attributes", "jattr", "lat_lon", "confidence"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'binary' if n == 'lat_lon' else 'string'}" for n in names))
    df.write.parquet(str(tmp_path / "m.parquet"))
    df.withColumn("lat_lon", F.hex("lat_lon")).coalesce(1).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(str(tmp_path / "c"))
    (tmp_path / "m.csv.gz").write_bytes(next(Path(tmp_path / "c").glob("*.csv.gz")).read_bytes())
    for path in ("m.parquet", "m.csv.gz"):
        t = metadata.typed(metadata.read_metadata(spark, str(tmp_path / path)))
        kinds = dict(t.dtypes)
        assert (kinds["releasedate"], kinds["mbytes"], kinds["elevation"], kinds["attributes"], kinds["lat_lon"], kinds["confidence"]) == ("date", "bigint", "double", metadata.PAIRS, "struct<lon:double,lat:double>", "int")
        got = {r.acc: r for r in t.collect()}
        assert str(got["A1"].releasedate) == "2023-05-01" and str(got["A2"].releasedate) == "2022-05-01" and got["A3"].releasedate is None
        assert (got["A1"].mbytes, got["A2"].mbytes, got["A1"].confidence, got["A2"].confidence) == (12, None, 5, None)
        assert tuple(got["A1"].lat_lon) == (10.5, -3.25) and got["A3"].lat_lon is None
        assert [tuple(r) for r in metadata.attributes_of(t).orderBy("acc", "k").collect()] == [("A1", "a", "1"), ("A1", "b", None)]
        found = t.select("acc", metadata.attribute(F.col("jattr"), "x y").alias("x"), metadata.attribute(F.col("jattr"), "a").alias("a")).where("x is not null").collect()
        assert [tuple(r) for r in found] == [("A1", "z", "1")]
        soil = t.where("assay_type = 'WGS' and platform = 'ILLUMINA' and releasedate >= date '2023-01-01' and lower(organism) = 'soil metagenome'").select("acc")
        assert [r.acc for r in soil.collect()] == ["A1"]
        spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
        plan = soil.select("acc")._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        assert "EqualTo(assay_type,WGS)" in plan and "EqualTo(platform,ILLUMINA)" in plan
    assert json.loads(rows[0][8])["a"] == 1


def test_a_stream_gives_what_the_table_gives(spark, tmp_path):
    """Files of postings in any order, with repeats within and between them."""
    rng = np.random.default_rng(1)
    rows = [(f"a{a}", int(h)) for a in range(6) for h in rng.integers(0, 1 << 54, 40)]
    for i in range(4):
        own = [rows[j] for j in rng.integers(0, len(rows), 150)]
        spark.createDataFrame(own + own[:20], "acc string, h long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("acc string, h long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    last, batches = {}, []

    def keep(df, i):
        found = df.collect()
        batches.append(len(found))
        last.update({r.acc: r for r in found})

    query = stream_sketches(stream, 128).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).foreachBatch(keep).start()
    assert query.awaitTermination(240)
    table = spark.read.parquet(str(tmp_path / "in")).distinct()
    want = {r.acc: r for r in project(table, 128).join(table.groupBy("acc").agg(F.count("*").alias("n")), "acc").collect()}
    assert len(batches) == 4 and set(last) == set(want)
    assert all((last[a].n, last[a].v, last[a].n2) == (want[a].n, want[a].v, want[a].n2) for a in want)
