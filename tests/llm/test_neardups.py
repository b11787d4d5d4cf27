"""Near-duplicates against brute force, and the sketch's own properties."""

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import neardups
from candlewick.llm.common import Scratch, components

from .conftest import SF


def shingles(text, k):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(docs, k, percent):
    sets = {i: shingles(t or "", k) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(docs, like):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardups.near_duplicates(docs, like).collect()}


@pytest.mark.parametrize(("k", "percent"), [(5, 80), (3, 85)])
def test_documents_against_brute_force(spark, texts, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(docs, neardups.Likeness(k, percent)) == brute(texts, k, percent)


def test_groups_near_the_threshold(spark):
    """One large group whose members are linked to some of the others only."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(200, rng.integers(0, 14), replace=False):
            words[at] = f"x{rng.integers(0, 3)}"
        docs.append((i, " ".join(words)))
    want = brute(docs, 3, 85)
    assert 1 < len({root for _, root in want.values()}) < 100
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert got(frame, neardups.Likeness(3, 85)) == want


def test_odd_rows(odd_docs, no_docs):
    found = neardups.near_duplicates(odd_docs).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in found) == [(-1, 1, -1), (1, 0, 1), (2, 0, 2), (3, 2996, 3), (4, 2996, 3), (4, 2996, 3), (5, 1, 5), (6, 0, 6), (7, 1, 7)]
    assert neardups.near_duplicates(no_docs).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[400:2400])
    one, two, both = (neardups.registers(np.sort(x), np.array([0, len(x)])) for x in (a, b, np.union1d(a, b)))
    assert (np.maximum(one, two) == both).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    found = neardups.estimate(one, two, np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(found - true) < 0.15
    assert neardups.registers(*neardups.shingle_sets(pa.array(["", None]), 3)).sum() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(90, 100), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.id: r.label for r in components(frame, Scratch(spark, "chain"), "c").collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 90 for i in [90, *range(100, 140)]}}
