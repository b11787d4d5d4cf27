"""The corpus pipeline stage by stage, against plain versions of each stage."""

from collections import Counter

import pytest

import corpus_pipeline
from candlewick.llm import lines

from .conftest import SF
from .test_neardups import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_lines(docs):
    keys = {i: [x.strip(lines.STRIPPED).translate(lines.TABLE) for x in t.split("\n")] for i, t in docs.items()}
    count = Counter(k for ks in keys.values() for k in set(ks))
    return {i: "\n".join(x for x, k in zip(t.split("\n"), keys[i], strict=True) if not k or count[k] < 10) for i, t in docs.items()}


def plain_words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def plain_leak(text, windows):
    words = [w for w in plain_words(text) if w]
    return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def test_each_stage_against_a_plain_version(spark, oracle, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [t for (t,) in oracle.execute("SELECT text FROM benchmark").fetchall()]
    windows = set()
    for text in bench:
        words = [w for w in plain_words(text) if w]
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        if name == "language_id":
            texts = {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            texts = plain_lines(texts)
        elif name == "near_dedup":
            texts = _kept(texts)
        elif name == "decontamination":
            texts = {i: t for i, t in texts.items() if not plain_leak(t, windows)}
        else:
            assert {r.doc_id for r in rows} == set(texts) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
            continue
        assert docs.columns == COLUMNS
        assert {r.doc_id: r.text for r in rows} == texts and len(rows) == len(texts)
        assert all(r.n_chars == len(r.text) for r in rows)


def _kept(texts):
    roots = brute(sorted(texts.items()), 5, 80)
    return {i: t for i, t in texts.items() if roots[i][1] == i}


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_pieces", "ids", "score", "round_trip"] and got.count() > 50


@pytest.mark.parametrize("rows", [0, 9])
def test_odd_and_empty_tables(spark, odd_docs, rows):
    """Repeated rows, nulls and a clashing column ``key`` and ``row`` pass every stage."""
    docs = odd_docs.selectExpr("*", "'s' AS source", "5L AS n_chars", "1 AS key", "2 AS row", "3 AS score", "'x' AS lang_pred").limit(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, stage(spark, docs, SF)
        assert docs.columns == columns
    got = sorted(r.doc_id or -1 for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert got == ([-1, 3, 5, 7] if rows else [])


def test_near_duplicates_are_found_by_text_whatever_the_ids(spark):
    """Unrelated rows without id, and of one id, all stay; so does a text whose only copy goes."""
    def words(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [
        (None, words("a")), (None, words("b")), (None, words("c")), (5, words("b") + " end"), (None, words("c")),
        (7, words("d")), (7, words("e")), (7, words("f")), (6, words("e") + " end"), (7, words("d")),
        (8, words("g")), (9, words("g")), (9, words("h")), (3, words("h").upper()), (11, ""), (12, ""), (None, " "), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, row long").repartition(5)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    want = [
        (None, words("a")), (None, words("b")), (None, words("c")), (7, words("d")), (6, words("e") + " end"), (7, words("f")),
        (8, words("g")), (3, words("h").upper()), (11, ""), (12, ""), (None, " "), (None, None),
    ]
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(t)) for i, t in want)


def test_the_last_stage_finds_three_paths_of_a_text(spark, monkeypatch):
    """Three scores a text reach the stage, where one path has no second."""
    made, plain = [], corpus_pipeline.tokens.encode_checked
    monkeypatch.setattr(corpus_pipeline.tokens, "encode_checked", lambda *a: made.append(plain(*a)) or made[0])
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in corpus_pipeline.encode_pieces(spark, docs, SF).collect()}
    scores = {r.doc_id: r.scores for r in made[0].collect()}
    assert [len(scores[i]) for i in (1, 2)] == [3, 1] and scores[1] == sorted(scores[1], reverse=True)
    assert all(r.round_trip and r.score == scores[i][0] for i, r in got.items())
