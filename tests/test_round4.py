"""Operators on tables whose work must not grow with the square of a block, and odd rows in them."""

import re

import numpy as np
import pytest

from sketchloom.operators import matrix, ordered, similarity
from sketchloom.plans import QUERIES


def test_members_around_sums_up_no_frame_anew(spark):
    members = spark.createDataFrame([(3,), (None,), (7,)], "x long")
    asked = spark.createDataFrame([(None,), (1,), (3,), (3,), (5,), (8,)], "x long")
    got = ordered.members_around(members, asked, rows=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, 3, 3, None), (3, 3, 7, 3), (3, 3, 7, 3), (5, 7, 7, 3), (8, None, None, 7), (None, None, None, None)]
    # a frame that ends with the last row is read again for each of its rows
    frames = re.findall(r"specifiedwindowframe\(RangeFrame[^)]*\)", got._jdf.queryExecution().optimizedPlan().toString())
    assert len(frames) >= 3 and not any("unboundedfollowing" in f for f in frames)


@pytest.mark.parametrize(("tasks", "block", "cells"), [(1, 1 << 20, 1 << 20), (20, 700, 50), (3, 1 << 20, 1)])
def test_set_pairs_are_counted_where_they_meet(spark, monkeypatch, tasks, block, cells):
    rng = np.random.default_rng(5)
    sets = {f"s{a:03}": set(rng.integers(10, 2000, rng.integers(1, 80)).tolist()) | set(range(a % 4)) for a in range(150)}
    for a in range(0, 60, 3):  # near copies, copies and a set that holds another
        sets[f"t{a}"] = set(sorted(sets[f"s{a:03}"])[1:]) | {9000 + a}
        sets[f"u{a}"] = set(sets[f"s{a:03}"])
    sets["v"] = set(range(10, 900))
    postings = spark.createDataFrame([(a, int(h)) for a, hs in sets.items() for h in hs], "acc string, h long").repartition(3)
    reps = {a for a, x in sets.items() if a == min(b for b, y in sets.items() if x == y)}
    want = {(a, b): len(sets[a] & sets[b]) for a in reps for b in reps if len(sets[a] & sets[b]) > 0.05 * (len(sets[a]) + len(sets[b]))}
    written = []
    monkeypatch.setattr(similarity, "staged", lambda df, name, *a, f=similarity.staged, **k: written.append(name) or f(df, name, *a, **k))
    got = similarity.similarity_join(postings, tasks=tasks, block_members=block, cells=cells).collect()
    assert {(r["row"], r["col"]): r.common for r in got} == want and len(got) == len(want)
    assert not {"pairs", "edges"} & set(written)  # they grow with the square of the sets
    asked = spark.createDataFrame([(a,) for a in ("s001", "s001", "v", "t3", "u3", "none")], "id string")
    some = similarity.similarity_join(postings, ids=asked, tasks=tasks, block_members=block, cells=cells).collect()
    assert {(r["row"], r["col"]): r.common for r in some} == {k: n for k, n in want.items() if k[0] in ("s001", "v", "t3", "u3")}
    assert len(some) == len({(r["row"], r["col"]) for r in some})


def test_hits_are_sent_on_in_bounded_pieces(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 6))
    x[100:300] = x[100]  # one vector with many copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 20 = 0")
    every = similarity.vector_hits(queries, df, tasks=3).collect()
    for cells in (1, 10_000, 1_000_000):
        best = similarity.vector_hits(queries, df, top=4, tasks=1, cells=cells).collect()
        sums = {r.query_idx: (r.n, round(r.dot, 6)) for r in similarity.vector_hits(queries, df, tasks=1, sums=True, cells=cells).collect()}
        for q in {r.query_idx for r in every}:
            own = sorted((-round(r.jaccard, 9), r.vec_id) for r in every if r.query_idx == q)
            got = sorted((-round(r.jaccard, 9), r.vec_id) for r in best if r.query_idx == q)
            assert got[:4] == own[:4] and len(got) < 50  # not all copies
            assert sums[q] == (len(own), round(sum(r.dot for r in every if r.query_idx == q), 6))
        assert len(sums) == len({r.query_idx for r in every})


def test_slices_shuffle_no_row_with_its_columns(spark):
    e = spark.createDataFrame([(i, j, (i * j) % 256) for i in range(40) for j in range(40) if (i + j) % 3], "row long, col long, q int")
    rows, cols = (spark.createDataFrame([(k, i) for k, i in enumerate(range(a, 40, 2))], "pos long, id long") for a in (0, 1))
    tiles = matrix.slice_tiles(e, rows, cols, width=7)
    plan = tiles._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RebalancePartitions" if "RebalancePartitions" in plan else "RepartitionByExpression [tile") < plan.index("collect_list")
    got = {(r.row, c): v for r in tiles.collect() for c, v in zip(r.cols, r["values"], strict=True)}
    assert got == {(i, j): round(((i * j) % 256) / 255 * 1000) / 1000 if (i + j) % 3 else 0.0 for i in range(0, 40, 2) for j in range(1, 40, 2)}


@pytest.mark.parametrize("name", ["matrix_diff", "topn_or_threshold"])
def test_edges_read_twice_are_made_once(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "InArrow" not in plan
