"""N-best segmentations against all segmentations, and exact round trips."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import tokens
from candlewick.llm.queries import REGISTRY

from .conftest import SF


@pytest.fixture(scope="module")
def encoder():
    return tokens.read_encoder()


def all_paths(encoder, body):
    found = []

    def go(at, score, ids):
        if at == len(body):
            found.append((score, ids))
            return
        edges = [(at + 1, int(encoder.pieces.byte_ids[body[at]]))]
        edges += [(at + n, encoder.known[body[at : at + n]]) for n in range(1, len(body) - at + 1) if body[at : at + n] in encoder.known]
        for end, piece in edges:
            go(end, score + encoder.logs[piece], [*ids, piece])

    go(0, 0.0, [])
    return sorted(found, key=lambda x: -x[0])


def swapped(ids, swap):
    for x in sorted(swap, key=lambda x: -x["start"]):
        ids = ids[: x["start"]] + list(x["ids"]) + ids[x["start"] + x["count"] :]
    return ids


@pytest.mark.parametrize("text", ["the", "ab cd", "a\nb", "  é", "on on"])
@pytest.mark.parametrize("n", [1, 2, 5])
def test_best_paths_of_all_paths(encoder, text, n):
    every = all_paths(encoder, (" " + text).encode())
    ids, begins, scores, swaps = encoder.encode(pa.array([text]), n)
    assert np.allclose(scores[0], [s for s, _ in every[:n]])
    made = [swapped(ids.tolist(), s) for s in swaps[0]]
    assert len({tuple(x) for x in made}) == len(made)
    for score, path in zip(scores[0], made, strict=True):
        assert np.isclose(sum(encoder.logs[i] for i in path), score)
        assert encoder.decode(np.array(path), np.array([0, len(path)])) == [text]


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.sampled_from(["▁ a", "\n\n", "  ", "\t x"]), max_size=6))
@settings(max_examples=60, deadline=None)
def test_any_text_comes_back(texts):
    encoder = _shared()
    ids, begins, _, _ = encoder.encode(pa.array(texts, pa.string()), 2)
    assert encoder.decode(ids, begins) == texts


def _shared(kept=[]):  # noqa: B006
    if not kept:
        kept.append(tokens.read_encoder())
    return kept[0]


def test_query_round_trips_every_text(spark):
    got = REGISTRY["op10_sentencepiece"][0](spark, SF).collect()
    assert len(got) == 200 and all(r.round_trip and r.best_score >= (r.second_score or -np.inf) for r in got)


def test_odd_rows(spark, odd_docs, no_docs, encoder):
    got = tokens.decode(tokens.encode(odd_docs, encoder, 2), encoder).collect()
    assert len(got) == 9 and all(r.decoded == (r.text or "") for r in got)
    assert {(len(r["ids"]), tuple(r.scores)) for r in got if r.doc_id in (1, 2)} == {(0, (0.0,))}
    assert tokens.encode(no_docs, encoder).count() == 0


def test_checked_in_one_pass_is_encode_then_decode(spark, odd_docs, no_docs, encoder):
    docs = odd_docs.where("doc_id IS NULL OR doc_id <> 7")
    apart = tokens.decode(tokens.encode(docs, encoder, 3), encoder).collect()
    got = tokens.encode_checked(docs, encoder, 3).collect()
    assert Counter(str(r[:-1]) for r in got) == Counter(str(tuple(r)) for r in apart)
    assert all(r.alike for r in got) and max(len(r.scores) for r in got) == 3
    assert tokens.encode_checked(no_docs, encoder, 3).count() == 0


def test_a_segmentation_of_another_text_is_found(encoder):
    ids, begins, _, swaps = encoder.encode(pa.array(["the cat"]), 3)
    assert tokens._alike(encoder, [ids.tolist()], swaps) == [True]
    swaps[0][2][0]["ids"] = [encoder.known[b"x"]]
    assert tokens._alike(encoder, [ids.tolist()], swaps) == [False]
