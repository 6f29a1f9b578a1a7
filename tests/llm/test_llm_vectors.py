"""Searches against brute force on awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
import llm_tables as tables
from pyspark.sql import functions as F

from faultline.llm import curves, mtree
from faultline.llm.queries import QUERIES


def usable(rows, zero):
    found = {}
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is None or not v or len(v) != 16 or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            found[r["vec_id"]] = v
    ids = np.array(sorted(found))
    return ids, np.array([found[i] for i in ids])


@pytest.fixture(scope="module")
def vectors(spark):
    return tables.embeddings(spark).repartition(4).cache()


def test_curve_neighbours(spark, vectors):
    ids, x = usable(vectors.collect(), zero=False)
    got = curves.nearest(vectors, "vec_id % 20 = 0", k=10).collect()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        far = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        best = np.lexsort((ids, far))[:10]
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [r["score"] for r in own] == pytest.approx([far[ids == r["vec_id"]][0] for r in own], abs=1e-12)
        assert own == sorted(own, key=lambda r: (r["score"], r["vec_id"]))
        hits += len({r["vec_id"] for r in own} & set(ids[best].tolist()))
        total += 10
    assert len(got) == total and hits / total >= 0.9
    assert curves.nearest(tables.no_embeddings(spark), "vec_id % 20 = 0").count() == 0


def test_curve_recall_on_the_given_embeddings(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=float)
    got = QUERIES["op1_curve_neighbours"](spark, sf).collect()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = ((x - x[ids == q][0]) ** 2).sum(axis=1)
        far[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, far))[:10]].tolist())
        hits += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
        total += 10
    assert hits / total >= 0.9


def test_hilbert_numbers_are_a_walk_over_all_cells():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * axes), axis=-1).reshape(-1, axes)
        numbers = curves.hilbert(cells, bits)
        assert sorted(numbers.tolist()) == list(range(side**axes))
        walk = cells[np.argsort(numbers)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("subtree, leaf, block", [(8192, 512, 512), (64, 16, 8)])
def test_inner_products(spark, vectors, monkeypatch, subtree, leaf, block):
    monkeypatch.setattr(mtree, "SUBTREE", subtree)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", block)
    monkeypatch.setattr(mtree, "BLOCKS_PER_TASK", 2)
    ids, x = usable(vectors.collect(), zero=True)
    whole = np.floor(64 * x).astype(np.int64)
    got = mtree.top_k(vectors, "vec_id % 20 = 0", k=20).collect()
    wanted = set()
    for q in ids[ids % 20 == 0]:
        score = whole @ whole[ids == q][0]
        best = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        wanted |= {(int(q), r + 1, int(ids[i]), int(score[i])) for r, i in enumerate(best)}
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)
    assert mtree.top_k(tables.no_embeddings(spark), "vec_id % 20 = 0").count() == 0


def test_tree_pages_cover_their_vectors():
    x = np.random.default_rng(2).normal(size=(3000, 5))
    root = mtree.Node(x, np.arange(len(x)), None)
    seen = []

    def walk(node, parent):
        if parent is not None:
            assert node.to_parent == pytest.approx(np.linalg.norm(node.centre - parent.centre))
        if node.ids is not None:
            assert np.all(np.diff(node.far) >= 0)
            assert np.linalg.norm(node.x - node.centre, axis=1).max() <= node.radius + 1e-9
            seen.extend(node.ids.tolist())
        for child in node.children:
            walk(child, node)

    walk(root, None)
    assert sorted(seen) == list(range(3000))


def test_fewer_candidates_than_wanted(spark):
    rows = [(20 * i, [float(i), 1.0]) for i in range(3)]
    few = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for run in (curves.nearest, mtree.top_k):
        got = run(few, "vec_id % 20 = 0").groupBy("query_id").agg(F.count("*").alias("n")).collect()
        assert {r["query_id"]: r["n"] for r in got} == {0: 2, 20: 2, 40: 2}
