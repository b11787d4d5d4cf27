"""Operators on documents against brute force, the oracle SQL and odd inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import arrays, contamination, fingerprints, lines, substrings
from candlewick.llm.fmindex import FmIndex
from candlewick.llm.queries import REGISTRY

from .conftest import SF

WITH_SQL = sorted(name for name, (_, sql) in REGISTRY.items() if sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_oracle(spark, oracle, name):
    run, sql = REGISTRY[name]
    df = run(spark, SF)
    res = oracle.execute(sql)
    names = sorted(d[0] for d in res.description)
    assert sorted(df.columns) == names
    want = sorted(map(str, res.fetchall()))
    order = [d[0] for d in oracle.execute(sql).description]
    assert sorted(str(tuple(r)) for r in df.select(*order).collect()) == want


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


words = st.lists(st.sampled_from(["a", "b", "ab", "é", "\n", "  "]), max_size=40).map(" ".join)


@given(st.lists(words, max_size=5))
@settings(max_examples=60, deadline=None)
def test_words_and_windows(texts):
    data, offsets = arrays.flatten(pa.array(texts, pa.string()))
    hashes, first = arrays.hash_words(data, offsets, arrays.UNSPACED)
    flat = [w for t in texts for w in spaced(t)]
    assert np.diff(first).tolist() == [len(spaced(t)) for t in texts]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    text, start, end = arrays.windows(first, 3)
    assert len(text) == sum(max(0, len(spaced(t)) - 2) for t in texts)
    keys = arrays.hash_spans(hashes, start, end).tolist()
    assert len(set(keys)) == len({tuple(flat[s:e]) for s, e in zip(start, end, strict=True)})


@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=4), min_size=1, max_size=5))
@settings(max_examples=100, deadline=None)
def test_index_counts_and_locates(body, wanted):
    text = np.array([0, *body, 0])
    index = FmIndex(text, 4, sample=3)
    rows = np.zeros((len(wanted), 4), np.int64)
    for i, w in enumerate(wanted):
        rows[i, : len(w)] = w
    low, high = index.search(rows, np.array([len(w) for w in wanted]))
    for w, a, b in zip(wanted, low, high, strict=True):
        want = [i for i in range(len(text)) if text[i : i + len(w)].tolist() == w]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_passages_in_blocks(spark, texts, oracle, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {r.doc_id: r for r in contamination.find_test_passages(docs, bench).collect()}
    monkeypatch.setattr(contamination, "PHRASE_BYTES", 2000)
    parts = {r.doc_id: r for r in contamination.find_test_passages(docs, bench).collect()}
    assert parts == whole and sum(len(r["items"]) for r in whole.values()) > 0


def test_passages_of_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "word7 word8"), (2, None), (None, "LINE"), (3, "")], "item_id long, text string")
    found = sorted(contamination.find_test_passages(odd_docs, bench).collect(), key=lambda r: (r.doc_id or -1, r.n_words))
    got = [(r.doc_id, r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in found]
    assert (None, 4, [(1, 2), (3, 4)], ["None"]) in got and (2, 0, [], []) in got
    assert [r for r in got if r[0] == 4] == [(4, 3000, [(7, 9)], ["1"])] * 2
    assert contamination.find_test_passages(no_docs, bench).count() == 0
    assert contamination.find_test_passages(odd_docs, bench.limit(0)).count() == 9


def test_windows_of_odd_rows(odd_docs, no_docs):
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substrings.drop_repeated_windows(odd_docs).collect())
    assert got[3, 3000, 0] == 1 and got[4, 3000, 3000] == 2 and got[2, 0, 0] == 1 and got[None, 4, 0] == 1
    assert substrings.drop_repeated_windows(no_docs).count() == 0


@pytest.mark.parametrize("length", [2, 4])
def test_windows_against_brute_force(spark, length):
    rng = np.random.default_rng(length)
    docs = [(i, " ".join(rng.choice(list("abcde"), rng.integers(0, 40)))) for i in range(60)]
    got = {r.doc_id: tuple(r) for r in substrings.drop_repeated_windows(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), length).collect()}
    first = {}
    for i, text in docs:
        w = spaced(text)
        gone = {k for s in range(len(w) - length + 1) if first.get(tuple(w[s : s + length]), i) < i for k in range(s, s + length)}
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), i)
        assert got[i] == (i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))


def test_levels_go_on_until_nothing_is_repeated(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, "x " + text), (3, " ".join(f"v{i}" for i in range(50)))], "doc_id long, text string")
    levels = substrings.repeat_levels(docs, 10)
    assert {k: v.where("earlier").count() for k, v in levels.items()} == {10: 31, 20: 21, 40: 1, 80: 0}


def test_lines_of_odd_rows(odd_docs, no_docs):
    got = sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.kept) for r in lines.drop_common_lines(odd_docs, 2).collect() if r.doc_id not in (3, 4, 7))
    assert got == [(-1, 2, 0, "a line\nanother line"), (1, 1, 0, ""), (2, 1, 0, ""), (5, 4, 0, "one two\n\n  One Two \n"), (6, 3, 0, "\n\n")]
    assert lines.drop_common_lines(odd_docs, 2).where("doc_id in (3, 4) and n_dropped = 1 and kept = ''").count() == 3
    assert lines.drop_common_lines(no_docs, 2).count() == 0


def test_lines_do_not_depend_on_batches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, many = (lines.drop_common_lines(docs, 3, batches).collect() for batches in (1, 7))
    assert sorted(one) == sorted(many) and sum(r.n_dropped for r in one) > 0


def test_fingerprints_and_edits(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs.repartition(5)).collect()}
    by_print = defaultdict(set)
    for at, (i, text) in enumerate(texts):
        after, quarter = texts[(at + 1) % len(texts)][1], len(text) // 4
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == sha(text[: len(text) - quarter] + after[:quarter])
        by_print[got[i].fingerprint].add(text)
    assert all(len(v) == 1 for v in by_print.values()) and len(by_print) == len({t for _, t in texts})
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.4
    assert all(0 <= x <= 1 for r in got.values() for x in (r.near_edited, r.near_next))


def test_fingerprints_add_and_subtract():
    a, b = ["one two three four", "five"], ["six seven eight nine ten"]
    both = fingerprints.fingerprint(a + b)
    assert (fingerprints.fingerprint(b + a[::-1]) == both).all()
    assert (fingerprints.insert(fingerprints.fingerprint(a), b[0]) == both).all()
    assert (fingerprints.delete(both, b[0]) == fingerprints.fingerprint(a)).all()
    assert (fingerprints.from_text(fingerprints.to_text(both[None])[0]) == both).all()


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    got = fingerprints.edited_fingerprints(odd_docs).collect()
    assert len(got) == 9 and {r.doc_id for r in got} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert {r.near_next for r in got if r.doc_id == 3} == {1.0}
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
