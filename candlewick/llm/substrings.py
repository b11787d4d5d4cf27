"""Substring de-duplication by level-wise doubling of repeated word windows."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import arrays as A
from candlewick.llm.common import Scratch, prepare, shards

#: Text bytes hashed at once, and rows a task sorts at once before it sends them on.
SHARD_BYTES = 4 << 20
FLUSH_ROWS = 2_000_000


def _pack(batches):
    """Texts travel through the shuffle compressed."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        packed = [squeeze.compress(x or b"") for x in texts]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(packed, pa.binary())], ["doc_id", "packed"])


def _unpack(packed: pa.Array) -> list[bytes]:
    loose = zstandard.ZstdDecompressor()
    return [loose.decompress(x) for x in packed.to_pylist()]


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by runs of doubling length."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def _anchors(values: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of twice ``length``: its text, start, and the least hash of a window inside.

    Equal windows have equal least hashes, so only those hashes need to be counted at the first
    level, about two in ``length + 2`` of all windows.
    """
    hashes = A.hash_spans(values, np.arange(max(0, len(values) - length + 1)), np.arange(length, len(values) + 1))
    text, start, _ = A.windows(first, 2 * length)
    return text, start, _minima(hashes, length + 1)[start] if len(start) else np.empty(0, np.uint64)


def _settled(keys: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """Rows of one task: distinct (window, document), each marked by what the task already knows.

    Only the smallest document of a window needs to be compared with other tasks (state 0, or 1
    if this task holds another one). The others are settled (2): they repeat an earlier document.
    A settled row gets a salt, so a window found everywhere sends one row a task to its partition.
    """
    order = np.lexsort((docs, checks, keys))
    keys, checks, docs = keys[order], checks[order], docs[order]
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[1:] == keys[:-1]) & (checks[1:] == checks[:-1])
    again = same.copy()
    again[1:] &= docs[1:] == docs[:-1]
    keys, checks, docs, same = keys[~again], checks[~again], docs[~again], same[~again]
    state = np.where(same, 2, 0).astype(np.int8)
    state[:-1][~same[:-1] & same[1:]] = 1
    salt = np.where(same, A.mix(keys + docs.view(np.uint64)).view(np.int64) | 1, 0)
    columns = [keys.view(np.int64), checks.astype(np.int32), docs, state, salt]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "check", "doc", "state", "salt"])


ROWS = "key long, check int, doc long, state byte, salt long"


def _found(parts):
    """Collect ``(keys, checks, docs)`` parts of a task and send them on sorted."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= FLUSH_ROWS:
            yield _settled(*map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield _settled(*map(np.concatenate, zip(*held, strict=True)))


def _ids(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def _first_level(length: int):
    def parts(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            values, first = A.hash_words(*A.flatten(shard["text"]), A.UNSPACED)
            text, _, least = _anchors(values, first, length)
            if len(text):
                kept = np.ones(len(text), bool)
                kept[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                least, text = least[kept], text[kept]
                yield least, np.zeros(len(least), np.int32), _ids(shard["doc_id"])[text]

    return lambda batches: _found(parts(batches))


def _member(values: np.ndarray, sets: pa.Array, text: np.ndarray) -> np.ndarray:
    """Whether each value is in the set of its text (texts ascend)."""
    out = np.zeros(len(values), bool)
    cuts = np.searchsorted(text, np.arange(len(sets) + 1))
    for row, have in enumerate(sets):
        if have.is_valid and cuts[row] < cuts[row + 1]:
            known = have.values.to_numpy(zero_copy_only=False).view(np.uint64)
            out[cuts[row] : cuts[row + 1]] = np.isin(values[cuts[row] : cuts[row + 1]], known)
    return out


def _next_level(length: int, sampled: bool):
    """Windows of ``length`` whose parts at half of it survived, for rows (doc_id, packed, known)."""

    def parts(batches):
        for batch in batches:
            for shard in _texts(batch):
                values, first = A.hash_words(*A.flatten(shard["text"]), A.UNSPACED)
                half = length // 2
                known = shard["known"].combine_chunks()
                if sampled:
                    text, start, least = _anchors(values, first, half)
                    alive = _member(least, known, text)
                else:
                    text, start, _ = A.windows(first, length)
                    halves = A.hash_spans(values, np.arange(max(0, len(values) - half + 1)), np.arange(half, len(values) + 1))
                    alive = _member(halves[start], known, text) & _member(halves[start + half], known, text)
                text, start = text[alive], start[alive]
                if len(text):
                    keys = A.hash_spans(values, start, start + length)
                    checks = A.hash_spans(values, start, start + length, 1) >> np.uint64(33)
                    yield keys, checks.astype(np.int32), _ids(shard["doc_id"])[text]

    return lambda batches: _found(parts(batches))


def _texts(batch):
    """Unpack a joined batch a few documents at a time."""
    for at in range(0, batch.num_rows, 32):
        part = batch.slice(at, 32)
        whole = pa.Table.from_batches([part]).drop_columns("packed")
        yield from shards(whole.append_column("text", pa.array(_unpack(part["packed"]), pa.binary())).combine_chunks().to_batches(), "text", SHARD_BYTES)


def _repeated(rows: DataFrame) -> DataFrame:
    """``doc, key, earlier`` of windows found in two documents; ``earlier``: one has a smaller id.

    A window's group holds one row a task at most, whatever the number of documents.
    """
    group = Window.partitionBy("key", "check", "salt")
    least, most, state = F.min("doc").over(group), F.max("doc").over(group), F.max("state").over(group)
    seen = rows.select("key", "doc", "state", least.alias("least"), most.alias("most"), state.alias("known"))
    earlier = (F.col("state") == 2) | (F.col("least") < F.col("doc"))
    return seen.where((F.col("known") > 0) | (F.col("least") < F.col("most"))).select("doc", "key", earlier.alias("earlier"))


def _with_lists(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    lists = rows.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list("key").alias("known"))
    return docs.mapInArrow(_pack, "doc_id long, packed binary").join(lists, "doc_id", how)


def _cut(length: int):
    def run(batches):
        for batch in batches:
            texts, known = _unpack(batch["packed"]), batch["known"]
            total, removed, kept = [], [], []
            for row, text in enumerate(texts):
                words = text.split()
                total.append(len(words))
                if known[row].is_valid and len(words) >= length:
                    data = np.frombuffer(text, np.uint8)
                    values, _ = A.hash_words(data, np.array([0, len(data)]), A.UNSPACED)
                    starts = np.arange(len(values) - length + 1)
                    hit = np.isin(A.hash_spans(values, starts, starts + length), known[row].values.to_numpy().view(np.uint64))
                    cover = np.zeros(len(values) + 1, np.int64)
                    cover[starts[hit]] += 1
                    cover[starts[hit] + length] -= 1
                    words = list(compress(words, (np.cumsum(cover[:-1]) == 0).tolist()))
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [batch["doc_id"], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return run


def _plain_ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")


def drop_repeated_windows(docs: DataFrame, length: int = 50, stop: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: texts without words of windows an earlier document has.

    Words are runs of bytes other than ASCII white space. Level by level, windows of half the
    length, the length, and twice, four times ... it, up to ``stop`` words: those repeated at one
    level alone are extended to the next. Without ``stop`` the last level is ``length``: those above
    it find the longest repeats (``repeat_levels``) and do not change what is removed.

    A null id counts as smaller than all others; rows of one id are one document for "earlier",
    and each is returned. A null or empty text, or one shorter than a window, loses nothing. Ties
    cannot occur: only smaller ids count. Other columns are ignored; an empty table stays empty.
    """
    levels = repeat_levels(docs, length, length if stop is None else stop, keep_all=True)
    marks = levels[length].where("earlier")
    done = _with_lists(_plain_ids(docs), marks, "left").mapInArrow(_cut(length), "doc_id long, n_words long, n_removed long, kept string")
    return done.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))


def repeat_levels(docs: DataFrame, length: int, stop: int | None = None, keep_all: bool = False) -> dict[int, DataFrame]:
    """Repeated windows ``doc, key, earlier`` by length: ``length``, twice it, ... until none is left."""
    if length % 2:
        raise ValueError("the window length must be even")
    prepare(docs.sparkSession)
    plain, scratch = _plain_ids(docs), Scratch(docs.sparkSession, "windows")
    known = _repeated(plain.mapInArrow(_first_level(length // 2), ROWS)).select("doc", "key").distinct()
    levels, at = {}, length
    while True:
        rows = _with_lists(plain, known, "inner").mapInArrow(_next_level(at, at == length), ROWS)
        found = _repeated(rows)
        if stop is not None and 2 * at > stop:
            levels[at] = found if keep_all and at == length and stop == length else scratch.keep(found, str(at))
            return levels
        levels[at] = scratch.keep(found, str(at))
        if levels[at].isEmpty():
            return levels
        known, at = levels[at].select("doc", "key"), 2 * at
