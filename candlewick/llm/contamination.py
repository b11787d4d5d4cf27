"""Benchmark decontamination: an FM-index per shard of documents, searched for test phrases."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candlewick.llm import arrays as A
from candlewick.llm.common import carried, carried_type, prepare, shards, tidied
from candlewick.llm.fmindex import FmIndex

#: Text in one index, and phrase text searched at once (more phrases: one more pass each).
SHARD_BYTES = 2 << 20
PHRASE_BYTES = 4 << 20

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SCHEMA = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


@dataclass(frozen=True)
class Phrases:
    """Distinct test windows as rows of word numbers, and the items each of them belongs to."""

    words: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    of_window: np.ndarray
    of_item: np.ndarray
    items: list


def phrases(items: list[tuple], width: int) -> Phrases:
    data, offsets = A.flatten(pa.array([text for _, text in items], pa.string()))
    hashes, first = A.hash_words(A.LOWER[data], offsets, A.ALNUM)
    words, number = np.unique(hashes, return_inverse=True)
    item, start, end = A.windows(first, width, short=True)
    rows = np.zeros((len(start), width + 1), np.int64)
    for at in range(width):
        inside = start + at < end
        rows[inside, at] = number[start[inside] + at] + 1
    rows[:, width] = end - start
    distinct, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.empty(0, np.int64))
    pairs = np.unique(np.stack([which.reshape(-1), item], axis=1), axis=0)
    return Phrases(words, distinct[:, :width], distinct[:, width], pairs[:, 0], pairs[:, 1], [i for i, _ in items])


def _symbols(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Word numbers from 1; 0 for a word of no phrase."""
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at + 1, 0)


def _sequence(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index text and each position's word.

    Words of no phrase and ends of documents are gaps; neighbouring gaps are one.
    """
    word = np.flatnonzero(symbols)
    doc = np.searchsorted(first, word, side="right")
    cut = np.zeros(len(word), np.int64)
    cut[1:] = (np.diff(word) > 1) | (np.diff(doc) > 0)
    at = np.arange(1, len(word) + 1) + np.cumsum(cut)
    text, origin = np.zeros(at[-1] + 2, np.int64), np.zeros(at[-1] + 2, np.int64)
    text[at], origin[at] = symbols[word], word
    return text, origin


def find(hashes: np.ndarray, first: np.ndarray, wanted: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Start word and window of every occurrence in the shard."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(hashes) or not len(wanted.lengths):
        return none
    symbols = _symbols(hashes, wanted.words)
    if not symbols.any():
        return none
    text, origin = _sequence(symbols, first)
    index = FmIndex(text, len(wanted.words) + 1)
    low, high = index.search(wanted.patterns, wanted.lengths)
    count = np.maximum(high - low, 0)
    return origin[index.locate(A.ranges(low, count))], np.repeat(np.arange(len(count)), count)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(wanted: Phrases):
    def scanned(shard: pa.Table) -> pa.RecordBatch:
        n = shard.num_rows
        data, offsets = A.flatten(shard["text"])
        hashes, first = A.hash_words(A.LOWER[data], offsets, A.ALNUM)
        start, window = find(hashes, first, wanted)
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + wanted.lengths[window], -1)
        inside = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
        inside_doc = inside[1:-1]
        opens = inside_doc & ~inside[:-2]
        heads = first[:-1][first[:-1] < len(hashes)]
        opens[heads] = inside_doc[heads]
        closes = inside_doc & ~inside[2:]
        tails = first[1:][first[1:] > 0] - 1
        closes[tails] = inside_doc[tails]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        doc = np.searchsorted(first, begin, side="right") - 1
        spans: list[list] = [[] for _ in range(n)]
        for d, b, e in zip(doc.tolist(), (begin - first[doc]).tolist(), (end - first[doc]).tolist(), strict=True):
            spans[d].append((b, e))
        items: list[set] = [set() for _ in range(n)]
        hits = np.unique(np.stack([np.searchsorted(first, start, side="right") - 1, window], axis=1), axis=0)
        left, right = np.searchsorted(wanted.of_window, hits[:, 1]), np.searchsorted(wanted.of_window, hits[:, 1], side="right")
        which = wanted.of_item[A.ranges(left, right - left)]
        for d, i in zip(np.repeat(hits[:, 0], right - left).tolist(), which.tolist(), strict=True):
            items[d].add(str(wanted.items[i]))
        if "spans" in shard.column_names:
            for d, (old, had) in enumerate(zip(shard["spans"].to_pylist(), shard["items"].to_pylist(), strict=True)):
                if old:
                    spans[d] = _merged([(x["start"], x["end"]) for x in old] + spans[d])
                items[d].update(had)
        columns = {"doc_id": shard["doc_id"].combine_chunks(), "n_words": pa.array(np.diff(first)), "spans": pa.array([[{"start": b, "end": e} for b, e in x] for x in spans], SPANS), "items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
        columns |= {name: shard[name].combine_chunks() for name in ("text", "row")}
        return pa.RecordBatch.from_pydict({k: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for k, v in columns.items()})

    return lambda batches: (scanned(shard) for shard in shards(batches, "text", SHARD_BYTES))


def _blocks(benchmark: DataFrame) -> list[list[tuple]]:
    """Test items in blocks of bounded text; a test set is small, and any number of blocks works."""
    blocks, size = [[]], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        if size > PHRASE_BYTES:
            blocks, size = [*blocks, []], 0
        blocks[-1].append((item, text))
        size += len(text or "")
    return blocks


def find_test_passages(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``doc_id, n_words, spans, items, text, row``: where documents hold windows of ``width`` item words.

    Words are runs of digits, letters and non-ASCII bytes after lower-casing A-Z. Each shard of a
    few megabytes gets an FM-index over its words; words of no phrase cannot be inside an
    occurrence and are gaps in it. Windows are searched backwards through wavelet ranks, rows are
    located by sampled positions, and occurrences are merged into spans of words.

    Null or empty texts have no words, items without words no windows; an item shorter than
    ``width`` is one window. Repeated rows are judged each on its own; a null doc_id stays null, a
    null item_id is listed as ``None``. Other columns are carried in ``row``, empty tables allowed. The test
    set is the query side: it is sent to every task, PHRASE_BYTES of text at a time, and each
    block is one more pass over the documents.
    """
    prepare(docs.sparkSession)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}, text string, row {carried_type(docs)}"
    out = docs.select("doc_id", "text", carried(docs))
    for block in _blocks(benchmark):
        out = out.mapInArrow(tidied(_scan(phrases(block, width))), schema)
    return out
