"""Hard negatives, centroids and neighbours against brute force, and odd vectors."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import centroids, graphs, negatives, vectors
from candlewick.llm.queries import REGISTRY

SF = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")


@pytest.fixture
def odd_vectors(spark):
    """Nulls in every column, non-finite and short vectors, zeros, repeated rows, a clashing extra column."""
    rows = [
        (0, 1, [1.0, 0.5], "a"),
        (0, 1, [1.0, 0.5], "a"),
        (100, 2, [0.5, 1.0], None),
        (None, 1, [1.0, 0.25], "c"),
        (3, None, [1.0, 0.25], "d"),
        (4, 1, None, "e"),
        (5, 1, [1.0, None], "f"),
        (6, 1, [NAN, 1.0], "g"),
        (7, 1, [INF, 1.0], "h"),
        (8, 1, [], "i"),
        (9, 1, [0.0, 0.0], "j"),
        (10, 2, [1.0], "k"),
        (11, 2, [1.0, 0.5], "l"),
        (12, 1, [1e300, -1e300], "m"),
        (13, 2, [1e-300, 1e-300], "n"),
    ]
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, score string")


@pytest.fixture
def no_vectors(spark):
    return spark.createDataFrame([], "vec_id long, label int, embedding array<float>")


def test_inner_products_are_exact():
    rng = np.random.default_rng(0)
    for low, high, dims in [(-9, 10, 64), (-1, 1, 3), (-(2**40), 2**40, 13), (0, 1, 5), (-(2**62), 2**62, 8)]:
        a, b = rng.integers(low, high, (300, dims)), rng.integers(low, high, (7, dims))
        got = negatives.inner_products(negatives.bit_planes(a), b)
        assert (got.astype(np.int64) == a @ b.T).all()
    wide, short = rng.integers(-9, 9, (5, 20)), rng.integers(-9, 9, (4, 11))
    assert (negatives.inner_products(negatives.bit_planes(wide), short) == wide[:, :11] @ short.T).all()


def brute_negatives(rows, every):
    """Plain loops over ``(id, label, integers)``; ids ascending."""
    out = []
    for a, label, q in rows:
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, r, strict=True)) for i, _, r in rows}
        ranked = sorted(rows, key=lambda r: (-score[r[0]], r[0]))
        for p in [r[0] for r in ranked if r[1] == label and r[0] != a][:5]:
            hard = [r[0] for r in ranked if r[1] != label and 80 * score[p] <= 100 * score[r[0]] <= 100 * score[p]][:5]
            out += [(a, p, rank, n, score[p], score[n]) for rank, n in enumerate(hard, 1)]
    return sorted(out)


def test_negatives_in_small_shards(spark, monkeypatch):
    """Ties, one label on most rows, shards and blocks of a few rows."""
    monkeypatch.setattr(negatives, "SHARD", 40)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(0, 9) > 6), [int(x) for x in rng.integers(-3, 4, 5)]) for i in range(200)]
    frame = spark.createDataFrame([(i, k, [x / 256 for x in q]) for i, k, q in rows], "vec_id long, label int, embedding array<double>")
    got = negatives.mine(frame.repartition(5), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, 10)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_negatives_of_odd_vectors(odd_vectors, no_vectors):
    got = sorted(map(tuple, negatives.mine(odd_vectors, F.col("vec_id") % 100 == 0).collect()), key=str)
    # both rows of id 0 are anchors; the row without id scores 73,728, rows 10 and 100 score 65,536, row 11 too much
    twice = [r for r in got if r[0] == 0]
    assert len(twice) == 2 * len(set(twice)) and all(r[1] != 0 for r in twice)
    assert {r[1:] for r in twice if r[1] is None} == {(None, 1, 10, 73728, 65536), (None, 2, 100, 73728, 65536)}
    assert all(80 * r[4] <= 100 * r[5] <= 100 * r[4] for r in got)
    assert negatives.mine(no_vectors, F.col("vec_id") % 100 == 0).count() == 0


def brute_clusters(rows, k, rounds, dims, scale):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if len(v) == dims]
    starts = sorted(kept, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())[:k]
    centres = [q for _, q in starts]

    def near(q):
        return min((sum((x - y) ** 2 for x, y in zip(q, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        mine = [near(q)[1] for _, q in kept]
        for j in range(len(centres)):
            group = [q for (_, q), m in zip(kept, mine, strict=True) if m == j]
            if group:
                centres[j] = [sum(x) // len(group) for x in zip(*group, strict=True)]
    last = {i: near(q) for i, q in kept}
    inertia = [sum(d for d, m in last.values() if m == j) for j in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, j, d, inertia[j], sum(inertia), digest[j]) for i, (d, j) in last.items())


def first():
    return F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)


@pytest.mark.parametrize(("k", "rounds", "dims"), [(16, 3, 3), (1, 2, 3), (2, 3, 2), (40, 6, 2)])
def test_clusters_against_brute_force(spark, monkeypatch, k, rounds, dims):
    """Small integers, so that equal distances and equal centroids abound."""
    monkeypatch.setattr(centroids, "SHARD", 50)
    rng = np.random.default_rng(k)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, dims)]) for i in range(230)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = centroids.cluster(frame, first(), k, rounds, dims, scale=1)
    assert sorted(map(tuple, got.collect())) == brute_clusters(rows, k, rounds, dims, 1)


def test_bounds_skip_distances():
    """Over rounds of well-parted clusters, most distances are never computed, and none is wrong."""
    rng = np.random.default_rng(5)
    x = (rng.integers(-900, 900, (16, 8))[rng.integers(0, 16, 4000)] + rng.integers(-60, 60, (4000, 8))).astype(np.int64)
    centres = centroids.Centres(x[:16])
    held = centroids.scan(x, centres)
    for _ in range(4):
        means = np.array([x[held.first == j].sum(axis=0) // max(1, (held.first == j).sum()) if (held.first == j).any() else c for j, c in enumerate(centres.at)])
        held.drift(centres.moved(means))
        centres = centroids.Centres(means)
        done = centroids.shallot(x, centres, held)
        whole = centroids.scan(x, centres)
        assert (held.first == whole.first).all() and (held.lower <= whole.lower * (1 + 1e-9)).all()
    assert done < 0.4 * 16 * len(x)


def test_clusters_of_odd_vectors(odd_vectors, no_vectors):
    got = centroids.cluster(odd_vectors, first(), 3, 2, 2).collect()
    assert sorted((r.vec_id if r.vec_id is not None else -1) for r in got) == [-1, 0, 0, 3, 9, 11, 12, 13, 100]
    assert centroids.cluster(no_vectors, first()).count() == 0
    alone = centroids.cluster(odd_vectors.where("vec_id = 9"), first(), 16, 3, 2).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in alone] == [(9, 0, 0, 0)]


def test_neighbours_recall(spark):
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = np.array(sorted(rows))
    x = np.stack([rows[i] for i in ids])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in REGISTRY["op13_nearest"][0](spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids if i % 50 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        near = x @ x[ids.searchsorted(q)]
        near[ids.searchsorted(q)] = -2
        assert np.allclose([s for _, _, s in found], [near[ids.searchsorted(i)] for _, i, _ in found], atol=1e-12, rtol=0)
        hits += len(set(ids[np.argsort(-near)[:5]]) & {i for _, i, _ in found})
    assert hits / (5 * len(got)) >= 0.95


def test_neighbours_among_copies_in_small_shards(spark, monkeypatch):
    """One vector on a third of the rows: the smallest ids of equal scores, from all shards."""
    monkeypatch.setattr(graphs, "SHARD", 60)
    monkeypatch.setattr(graphs, "BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(v) for v in rng.normal(size=3)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in graphs.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([v for _, v in rows])
    want = 0
    for q, found in got.items():
        score = graphs.cosines(np.repeat(x[q : q + 1], len(x), axis=0), x)
        order = [int(i) for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:5]
        want += [i for _, i, _ in sorted(found)] == order
    assert len(got) == 8 and want >= 7
    assert [i for _, i, _ in sorted(got[0])] == [3, 6, 9, 12, 15]


def test_graph_among_near_copies():
    """A third are one vector with little noise: nearer to it than to each other, yet found from each other."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x[500:1000] = x[500] + np.append(np.zeros((1, 32)), rng.normal(size=(499, 32)) * 1e-3, axis=0)
    points = graphs.unit(x)
    node, far, _ = graphs.Graph(points, graphs.Shape()).build().search(points[500:1000:10], 96)
    true = np.argsort(-(points[500:1000:10] @ points.T), axis=1)[:, :6]
    assert (np.diff(far, axis=1) >= 0).all()
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(node.tolist(), true.tolist(), strict=True)]) > 0.95


def test_neighbours_of_odd_vectors(odd_vectors, no_vectors):
    got = {(r.query_id, r.vec_id): r.score for r in graphs.nearest(odd_vectors, F.col("vec_id") % 50 == 0, k=20).collect()}
    assert {q for q, _ in got} == {0, 100}
    assert {i for q, i in got if q == 100} == {0, None, 3, 10, 11, 12, 13} and not any(q == i for q, i in got)
    assert abs(got[100, 10] - 0.5 / 1.25**0.5) < 1e-15 and abs(got[100, 13] - 1.5 / 2.5**0.5) < 1e-15
    assert graphs.nearest(no_vectors, F.col("vec_id") % 50 == 0).count() == 0
    few = graphs.nearest(odd_vectors.where("vec_id IN (0, 11)"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 11)] * 2


def test_best_keeps_ties_in_order():
    scores = np.array([[5, 7, 7, 5, 7]])
    assert vectors.best(scores, np.array([[True, True, False, True, True]]), 3)[1].tolist() == [1, 4, 0]
    assert vectors.best(scores, np.zeros((1, 5), bool), 3)[1].tolist() == []
