"""Hard negatives by Four-Russians scoring: subset sums of anchors, looked up by candidates' bit planes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch
from candlewick.llm.vectors import Arrays, best, dealt, facing, ids_of, pack, padded, scaled, unpack, usable, widened

#: Rows in a shard of candidates and in a block of anchors.
SHARD, BLOCK = 4096, 256
#: Candidates whose scores are summed at once; with a block of anchors, sums stay in a core's cache.
CHUNK = 256
#: Dimensions in a group: one byte of a bit plane.
GROUP = 8
#: Components are integers of fewer bits than this.
BITS = 62


def bit_planes(q: np.ndarray) -> np.ndarray:
    """Two's-complement bits ``[plane, group, row]``: one byte for eight dimensions, lowest plane first.

    There are as many planes as the largest component needs, and one for the sign.
    """
    q = widened(q, -(-q.shape[1] // GROUP) * GROUP)
    largest = max(int(q.max(initial=0)), ~int(q.min(initial=0)))
    bits = [np.packbits((q >> p & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(largest.bit_length() + 1)]
    return np.ascontiguousarray(np.stack(bits))


def subset_sums(q: np.ndarray, dtype: type) -> np.ndarray:
    """Tables ``[group, byte, anchor]``: the sum of an anchor's components where the byte has ones."""
    q = widened(q, -(-q.shape[1] // GROUP) * GROUP).astype(dtype)
    tables = np.zeros((q.shape[1] // GROUP, 1, len(q)), dtype)
    for bit in range(GROUP):
        tables = np.concatenate([tables, tables + q[:, bit::GROUP].T[:, None, :]], axis=1)
    return tables


def inner_products(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact scores ``[candidate, anchor]``: looked-up sums, doubled from plane to plane, the sign's first.

    32-bit sums where no score can exceed them, else 64-bit ones, which wrap.
    """
    largest = int(np.abs(anchors).sum(axis=1, dtype=np.float64).max(initial=0)) << len(planes)
    dtype = np.int32 if largest < 1 << 31 else np.int64
    width = min(planes.shape[1], -(-anchors.shape[1] // GROUP))  # groups beyond either side's are zero
    tables = subset_sums(anchors[:, : width * GROUP], dtype)
    out = np.zeros((planes.shape[2], len(anchors)), dtype)
    looked_up = np.empty((CHUNK, len(anchors)), dtype)
    for low in range(0, len(out), CHUNK):
        total = out[low : low + CHUNK]
        row = looked_up[: len(total)]
        for p in range(len(planes) - 1, -1, -1):
            if p == len(planes) - 1:
                for g in range(width):
                    total -= np.take(tables[g], planes[p, g, low : low + CHUNK], axis=0, out=row, mode="clip")
            else:
                total += total
                for g in range(width):
                    total += np.take(tables[g], planes[p, g, low : low + CHUNK], axis=0, out=row, mode="clip")
    return out


def _candidates(scale: int):
    def make(arrays: Arrays, rows: pa.Table) -> Arrays:
        q = scaled(padded(rows["vector"].combine_chunks()), scale, 2.0**BITS)
        return {"labels": rows["label"].to_numpy(), "planes": bit_planes(q)}

    return make


def _anchors(scale: int):
    def make(arrays: Arrays, rows: pa.Table) -> Arrays:
        return {"labels": rows["label"].to_numpy(), "q": scaled(padded(rows["vector"].combine_chunks()), scale, 2.0**BITS)}

    return make


def _scored(shard: Arrays, block: Arrays) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores ``[anchor, candidate]``, where labels agree, and where the ids differ."""
    scores = np.ascontiguousarray(inner_products(shard["planes"], block["q"]).T)
    other = ~shard["known"] | (block["ids"][:, None] != shard["ids"])
    return scores, block["labels"][:, None] == shard["labels"], other


POSITIVES = "block long, anchor int, anchor_id long, positive_id long, positive_score long"
NEGATIVES = "block long, anchor int, place int, negative_id long, negative_score long"


def _nearest_alike(k: int):
    def work(shard: Arrays, block: Arrays, number: int) -> pa.RecordBatch:
        scores, alike, other = _scored(shard, block)
        anchor, found = best(scores, alike & other, k)
        columns = [pa.array(np.full(len(anchor), number)), pa.array(anchor.astype(np.int32)), ids_of(block, anchor), ids_of(shard, found), pa.array(scores[anchor, found].astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in POSITIVES.split(", ")])

    return work


def _hard(k: int):
    def work(shard: Arrays, block: Arrays, number: int) -> pa.RecordBatch | None:
        scores, alike, _ = _scored(shard, block)
        parts = []
        for place in range(block["least"].shape[1]):
            least, most = block["least"][:, place, None], block["most"][:, place, None]
            anchor, found = best(scores, ~alike & (scores >= least) & (scores <= most), k)
            columns = [pa.array(np.full(len(anchor), number)), pa.array(anchor.astype(np.int32)), pa.array(np.full(len(anchor), place, np.int32)), ids_of(shard, found), pa.array(scores[anchor, found].astype(np.int64))]
            parts.append(pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NEGATIVES.split(", ")]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if any(p.num_rows for p in parts) else None

    return work


def _bounded(places: int, low: int, high: int):
    """Adds to each block the least and largest score that a negative may have, for each positive."""

    def run(batches):
        for batch in batches:
            bodies = []
            for body, found in zip(batch["body"].to_pylist(), batch["found"].to_pylist(), strict=True):
                block = unpack(body)
                least = np.full((len(block["ids"]), places), np.iinfo(np.int64).max)
                most = np.full(least.shape, np.iinfo(np.int64).min)
                for x in found or []:
                    at = x["anchor"], x["place"]
                    # 100 * score between low and high per cent of the positive's, without a product that could wrap
                    least[at], most[at] = -(-low * x["positive_score"] // 100), high * x["positive_score"] // 100
                bodies.append(pack(**block, least=least, most=most))
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array(bodies, pa.binary())], ["part", "body"])

    return run


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """Hard negatives of ``rows (vec_id, label, embedding)``, for those rows that are an ``anchor``.

    Components become ``floor(scale * x)``; a score is the integer inner product of two rows. An anchor's
    positives are its best ``positives`` rows of the same label and another id. For each of them, the
    best ``negatives`` rows of another label that score from ``low`` to ``high`` per cent of the positive:
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Higher scores come
    first, ties go to the smaller id, a null id comes last.

    Anchors are asked in blocks, each block in every shard of candidates; what leaves a task are the best
    of its shard. Each pair is scored twice, as a negative's bounds are known after the positives.

    Defined cases: rows with a null label, a null vector or a null or non-finite component take no part. A
    null id is never an anchor; rows of one id are separate rows, and none is a positive of another. Shorter
    vectors count as followed by zeros. Components stay within 2**62, sums wrap as longs do. A negative
    positive score admits no negatives. Other columns are ignored; an empty table gives no rows.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "negatives")
    known = rows.where(usable("embedding") & F.col("label").isNotNull())
    vector, label = F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label")
    columns = [F.col("vec_id").cast("long").alias("vec_id"), label, vector]
    asked, _ = dealt(known.where(F.coalesce(anchor, F.lit(False)) & F.col("vec_id").isNotNull()).select(*columns), BLOCK, _anchors(scale))
    blocks = scratch.keep(asked, "blocks")
    packed, n_shards = dealt(known.select(*columns), SHARD, _candidates(scale))
    shards = scratch.keep(packed, "shards")

    def first(found: DataFrame, k: int, key: list[str], kind: str) -> DataFrame:
        order = Window.partitionBy(*key).orderBy(F.col(f"{kind}_score").desc(), F.col(f"{kind}_id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    alike = first(facing(shards, blocks, n_shards, _nearest_alike(positives), POSITIVES), positives, ["block", "anchor"], "positive")
    alike = scratch.keep(alike.withColumn("place", F.col("rank") - 1).drop("rank"), "positives")
    # at most BLOCK * positives rows to a block
    found = alike.groupBy("block").agg(F.collect_list(F.struct("anchor", "place", "positive_score")).alias("found"))
    bounded = blocks.join(found, blocks.part == found.block).select("part", "body", "found")
    bounded = scratch.keep(bounded.mapInArrow(_bounded(positives, low, high), "part long, body binary"), "bounded")
    hard = first(facing(shards, bounded, n_shards, _hard(negatives), NEGATIVES), negatives, ["block", "anchor", "place"], "negative")
    out = scratch.keep(hard.join(alike, ["block", "anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "mined")
    scratch.drop("blocks", "shards", "positives", "bounded")
    return out
