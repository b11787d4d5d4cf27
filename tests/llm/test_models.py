"""Classifiers: brute-force sums, held-out accuracy, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from candlewick.llm import language, pieces, toxicity
from candlewick.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_model(language.VOCABULARY)[1]


def test_forward_sums_all_segmentations(vocabulary):
    random = np.random.default_rng(0)
    model = language.Model(vocabulary, ["a", "b"], random.random((len(vocabulary.texts), 2)) / 32000)
    single = set(vocabulary.byte_ids.tolist())
    known = {t: i for i, t in enumerate(vocabulary.texts) if t and i not in single}

    def brute(word, lang):
        total = 0.0
        for at in range(0, len(word), language.PART):
            part, alpha = word[at : at + language.PART], [1.0]
            for end in range(1, len(part) + 1):
                alpha.append(alpha[-1] * model.chances[vocabulary.byte_ids[part[end - 1]], lang])
                alpha[-1] += sum(alpha[s] * model.chances[known[part[s:end]], lang] for s in range(end) if part[s:end] in known)
            total += np.log(alpha[-1])
        return total

    texts = ["the cat", "", None, "été " + "x" * 70, "中文 \U0001f600 cat", "the the the"]
    got = model.texts(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        words = (text or "").split()
        assert np.allclose(row, [sum(brute(b" " + w.encode(), k) for w in words) for k in (0, 1)])


def test_languages_held_out(spark):
    got = REGISTRY["op8_language_id"][0](spark, SF)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in got.collect() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held if docs[r.doc_id].lang]) > 0.95


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet"), sample=20)
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(odd_docs, model).collect()]
    assert len(got) == 9 and all(0 <= s <= 1 for _, _, s in got)
    assert {i for i, lang, s in got if lang == "und" and s == 0} == {1, 2, 6}
    assert language.predict(no_docs, model).count() == 0
    blank = language.fit(no_docs)
    assert {r.lang_pred for r in language.predict(odd_docs, blank).collect()} == {"und"}


def test_toxic_texts_held_out(spark):
    got = {r.doc_id: r for r in REGISTRY["op6_toxicity"][0](spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic is not None}
    held = [(got[i].predicted, t) for i, t in labels.items() if got[i].held_out]
    assert len(got) == 1000 and len(held) > 50
    assert np.mean([p == t for p, t in held]) > 0.9


def test_misspellings_share_ngrams():
    clean = [f"the cat sat on mat number {i} and was happy with it" for i in range(150)]
    toxic = [f"you stupid cat sat on mat number {i} and was happy" for i in range(150)]
    examples = [(r, s, t) for t, texts in enumerate((clean, toxic)) for r, s in toxicity.bags(pa.array(texts))]
    model = toxicity.Model(*toxicity.train(examples))
    score = model.scores(pa.array(["the stupidd cat sat", "the sstupid cat sat", "the quiet cat sat", "", None]))
    assert score[0] > 0.5 and score[1] > 0.5 and score[2] < 0.5 and score[3] == score[4]


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    assert {r.score for r in toxicity.score(odd_docs, model).collect() if r.doc_id in (1, 2)} == {0.5}
    assert toxicity.score(odd_docs, toxicity.fit(no_docs, labels)).count() == 9
    assert toxicity.score(no_docs, model).count() == 0


def test_toxicity_scores_equal_a_plain_loop():
    """Bag, average and score of single texts, n-gram by n-gram."""
    import math

    from candlewick.llm import arrays

    weights = np.random.default_rng(1).normal(0, 1, toxicity.ROWS).astype(np.float32)
    model = toxicity.Model(weights, -0.5)
    texts = ["You are SO bad bad", "", None, "a", "h\u00e9llo w\u00f6rld \u00c9", "x" * 3000, "two\nlines\there"]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want, counts = [], []
    for text in texts:
        found = []
        for word in (text or "").translate(lower).split():
            edged = np.array([ord(c) for c in f" {word} "], np.uint32)
            for size in range(toxicity.SHORTEST, toxicity.LONGEST + 1):
                for at in range(len(edged) - size + 1):
                    gram = edged[at : at + size].copy()
                    found.append(int(arrays.hash_spans(gram, np.array([0]), np.array([size]))[0] % np.uint64(toxicity.ROWS)))
        counts.append(len(found))
        logit = -0.5 + sum(float(weights[r]) for r in found) / (len(found) + toxicity.NEUTRAL)
        want.append(1 / (1 + math.exp(-logit)))
    column = pa.array(texts, pa.string())
    assert np.allclose(model.scores(column), want, rtol=0, atol=1e-9)
    for (rows_of, shares), n in zip(toxicity.bags(column), counts, strict=True):
        assert len(set(rows_of.tolist())) == len(rows_of)
        assert abs(float(shares.sum()) - n / (n + toxicity.NEUTRAL)) < 1e-4
