"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A fingerprint is a vector of LANES numbers modulo 2**32, the sum of one vector for each non-empty
paragraph (line). Sums do not depend on order, and a paragraph is inserted or deleted by adding or
subtracting its vector. The first DENSE lanes of a paragraph's vector are pseudo-random and make
equality reliable; the others count its word shingles, each in one lane with a random sign, so the
distance of two fingerprints estimates how many shingles differ.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm import arrays as A
from candlewick.llm.common import prepare, shards

DENSE, SKETCH = 32, 128
LANES = DENSE + SKETCH
SHINGLE = 3
SHARD_BYTES = 2 << 20

NEWLINE = np.ones(256, dtype=bool)
NEWLINE[0x0A] = False


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints of a batch of texts, one row each."""
    n = len(offsets) - 1
    starts, ends, first = A.spans(data, offsets, NEWLINE)
    out = np.zeros((n, LANES), np.uint32)
    if not len(starts):
        return out
    text = np.repeat(np.arange(n), np.diff(first))
    one, two = A.hash_spans(data, starts, ends), A.hash_spans(data, starts, ends, 1)
    for lane in range(DENSE):
        value = A.mix(one + two * np.uint64(2 * lane + 1)) >> np.uint64(32)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value)])
        out[:, lane] = (sums[first[1:]] - sums[first[:-1]]).astype(np.uint32)
    words, of_paragraph = A.hash_words(data, np.append(starts, len(data)), A.UNSPACED)
    paragraph, begin, end = A.windows(of_paragraph, SHINGLE, short=True)
    shingles = A.hash_spans(words, begin, end)
    slot = text[paragraph] * SKETCH + (shingles % np.uint64(SKETCH)).astype(np.int64)
    sign = np.where(shingles >> np.uint64(63), 1.0, -1.0)
    sums = np.bincount(slot, weights=sign, minlength=n * SKETCH).astype(np.int64)
    out[:, DENSE:] = sums.reshape(n, SKETCH).astype(np.uint32)
    return out


def fingerprint(paragraphs: list[str]) -> np.ndarray:
    data, offsets = A.flatten(pa.array(["\n".join(paragraphs)], pa.string()))
    return vectors(data, offsets)[0]


def insert(have: np.ndarray, paragraph: str) -> np.ndarray:
    return have + fingerprint([paragraph])


def delete(have: np.ndarray, paragraph: str) -> np.ndarray:
    return have - fingerprint([paragraph])


def to_text(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows.astype(">u4")]


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(value), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints; else an estimate of the share of shingles that agree, from 0 to 1."""
    same = (a == b).all(axis=1)
    x, y = a[:, DENSE:].view(np.int32).astype(float), b[:, DENSE:].view(np.int32).astype(float)
    apart = (a[:, DENSE:] - b[:, DENSE:]).view(np.int32).astype(float)
    whole = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    share = 1 - (apart * apart).sum(axis=1) / np.maximum(whole, 1)
    return np.where(same, 1.0, np.where(whole > 0, np.clip(share, 0, 1), 0.0))


def _cut_points(docs: DataFrame, key: Column) -> tuple[list[int], int | None]:
    """Ids that part the documents into ranges of about equal size, and the least id."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    least, cuts = docs.agg(F.min(key), F.percentile_approx(key, shares, max(10_000, 100 * n))).first()
    return sorted({int(c) for c in cuts or []} - {least}), least


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many cuts are not above the key, by binary search."""
    size = 1 << len(cuts).bit_length()
    padded = F.lit(cuts + [(1 << 63) - 1] * (size - len(cuts)))
    steps = F.lit([size >> i for i in range(1, size.bit_length())] or [0]).cast("array<int>")

    def step(at: Column, by: Column) -> Column:
        return F.when((by > 0) & (F.element_at(padded, F.greatest(at + by, F.lit(1))) <= key), at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _edited(batches):
    """Rows of one id range in order; the last ones are copies of the next range's first."""

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, each with its successor."""
        own, after = [t for _, t in rows[:-1]], [t for _, t in rows[1:]]
        edited = [a[: len(a) - len(a) // 4] + b[: len(a) // 4] for a, b in zip(own, after, strict=True)]
        prints = vectors(*A.flatten(pa.array([t for _, t in rows], pa.large_string())))
        changed = vectors(*A.flatten(pa.array(edited, pa.large_string())))
        columns = {
            "doc_id": pa.array([i for i, _ in rows[:-1]], pa.int64()),
            "n_chars": pa.array([len(t) for t in own], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            "fingerprint": pa.array(to_text(prints[:-1])),
            "edited_fingerprint": pa.array(to_text(changed)),
            "near_edited": pa.array(likeness(prints[:-1], changed)),
            "near_next": pa.array(likeness(prints[:-1], prints[1:])),
        }
        return pa.RecordBatch.from_pydict(columns)

    held: list[tuple] = []
    for shard in shards(batches, "text", SHARD_BYTES):
        for doc, text, copied in zip(*(shard[c].to_pylist() for c in ("doc_id", "text", "copied")), strict=True):
            if copied:
                held.append((doc, text or ""))
                if len(held) > 1:
                    yield finished(held)
                return
            held.append((doc, text or ""))
        if len(held) > 1:
            yield finished(held)
            held = held[-1:]


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text (its last quarter from the next document).

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The
    next document is the one with the next id, after the last the first. Documents are dealt out
    once, by ranges of the id whose cut points are ids themselves; a range's first document is
    copied into the range before it, so no task needs another one's rows.

    A null text is empty. A null id comes before all others; rows of one id follow each other in
    the order of their texts. A single document is its own next. Likeness is 1 for equal
    fingerprints, 0 against an empty text. Other columns are ignored; an empty table stays empty.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    cuts, least = _cut_points(docs, key)
    part, n = _range_of(key, cuts), len(cuts) + 1
    own = F.struct(part.alias("part"), F.lit(False).alias("copied"))
    copy = F.struct(F.pmod(part + n - 1, F.lit(n)).alias("part"), F.lit(True).alias("copied"))
    is_first = F.array_contains(F.lit([least, *cuts]).cast("array<long>"), key)
    places = F.when(is_first, F.array(own, copy)).otherwise(F.array(own))
    dealt = docs.withColumn("at", F.explode(places)).select("doc_id", "text", "at.*")
    ordered = dealt.repartitionById(n, F.col("part").cast("int")).sortWithinPartitions("copied", F.col("doc_id").asc_nulls_first(), "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("doc_id", "text", "copied").mapInArrow(_edited, schema)
