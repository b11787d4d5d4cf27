"""Centroid clustering by Shallot search: exact k-means in integers, most distances skipped by bounds."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch
from candlewick.llm.vectors import PACKED, Arrays, dealt, ids_of, pack, padded, scaled, unpack, usable

#: Vectors in a packed row.
SHARD = 4096
#: Components beyond this stay there, so that squared distances of a few thousand dimensions fit a long.
MOST = 2.0**24
#: Bounds are doubles; they decide only where they differ by more than this share.
SLACK = 1e-9


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, along the last dimension."""
    difference = a - b
    return (difference * difference).sum(axis=-1)


@dataclass(frozen=True)
class Centres:
    """Integer centroids, and each one's neighbours in ascending distance."""

    at: np.ndarray

    def __post_init__(self):
        apart = np.sqrt(squared(self.at[:, None], self.at[None]).astype(np.float64))
        order = np.argsort(apart, axis=1, kind="stable")
        # a centroid is its own first neighbour, also among equal ones
        order = np.array([[i, *[j for j in row if j != i]] for i, row in enumerate(order.tolist())], np.int64).reshape(apart.shape)
        object.__setattr__(self, "apart", np.take_along_axis(apart, order, axis=1))
        object.__setattr__(self, "order", order)

    def moved(self, to: np.ndarray) -> np.ndarray:
        return np.sqrt(squared(self.at, to).astype(np.float64))


@dataclass
class Bounds:
    """For each vector: its centroid, the second nearest (as last seen), and bounds of both distances."""

    first: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    def drift(self, moved: np.ndarray) -> None:
        """Keep the bounds true after centroids moved: by the own one, and by the farthest of the others."""
        self.upper = self.upper + moved[self.first]
        most = np.argsort(moved)[::-1]
        other = np.where(self.first == most[0], moved[most[1]] if len(most) > 1 else 0.0, moved[most[0]])
        self.lower = self.lower - other


def scan(x: np.ndarray, centres: Centres) -> Bounds:
    """The two nearest centroids of every vector from all distances; ties go to the smaller number."""
    far = squared(x[:, None], centres.at[None])
    order = np.argsort(far, axis=1, kind="stable")
    first, second = order[:, 0], order[:, min(1, far.shape[1] - 1)]
    rows = np.arange(len(x))
    lower = np.sqrt(far[rows, second].astype(np.float64)) if far.shape[1] > 1 else np.full(len(x), np.inf)
    return Bounds(first, second, np.sqrt(far[rows, first].astype(np.float64)), lower)


def shallot(x: np.ndarray, centres: Centres, held: Bounds) -> int:
    """Move every vector to its nearest centroid (ties: the smaller number); returns distances computed.

    A vector whose upper bound lies below its lower one, or below half the way to the nearest other
    centroid, stays where it is. For the others the exact distances of the remembered two are computed.
    Neighbours of the nearer one, at distance ``d1`` from the vector, are visited from near to far while
    they lie within ``d1 + d2``, where ``d2`` is the distance of the second nearest found so far: beyond
    that ball nothing is nearer than the second. Distances are compared as integers.
    """
    if len(centres.at) < 2 or not len(x):
        return 0
    done = 0
    half = centres.apart[:, 1] / 2

    def unsure(rows: np.ndarray) -> np.ndarray:
        least = np.maximum(held.lower[rows], half[held.first[rows]])
        return rows[held.upper[rows] * (1 + SLACK) >= least * (1 - SLACK)]

    rows = unsure(np.arange(len(x)))
    exact = squared(x[rows], centres.at[held.first[rows]])
    held.upper[rows] = np.sqrt(exact.astype(np.float64))
    still = unsure(rows)
    done += len(rows)
    d1 = exact[np.searchsorted(rows, still)]
    rows, first, second = still, held.first[still], held.second[still]
    d2 = squared(x[rows], centres.at[second])
    done += len(rows)
    swap = (d2 < d1) | ((d2 == d1) & (second < first))
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, radius, remembered = first.copy(), np.sqrt(d1.astype(np.float64)), second.copy()
    inside = np.arange(len(rows))
    for step in range(1, len(centres.at)):
        ball = (radius[inside] + np.sqrt(d2[inside].astype(np.float64))) * (1 + SLACK)
        inside = inside[centres.apart[start[inside], step] * (1 - SLACK) <= ball]
        if not len(inside):
            break
        near = centres.order[start[inside], step]
        new = near != remembered[inside]  # that one is known
        at, near = inside[new], near[new]
        far = squared(x[rows[at]], centres.at[near])
        done += len(at)
        nearer = (far < d1[at]) | ((far == d1[at]) & (near < first[at]))
        middle = ~nearer & ((far < d2[at]) | ((far == d2[at]) & (near < second[at])))
        a = at[nearer]
        second[a], d2[a] = first[a], d1[a]
        first[a], d1[a] = near[nearer], far[nearer]
        b = at[middle]
        second[b], d2[b] = near[middle], far[middle]
    held.first[rows], held.second[rows] = first, second
    held.upper[rows], held.lower[rows] = np.sqrt(d1.astype(np.float64)), np.sqrt(d2.astype(np.float64))
    return done


def _packed(scale: int):
    def make(arrays: Arrays, rows: pa.Table) -> Arrays:
        return {"q": scaled(padded(rows["vector"].combine_chunks()), scale, MOST).astype(np.int32)}

    return make


def _assigned(centres: Centres, moved: np.ndarray | None):
    """One round on packed rows: bounds follow the centroids' moves, then the search."""

    def run(batches):
        for batch in batches:
            for part, body in zip(batch["part"], batch["body"], strict=True):
                arrays = unpack(body.as_py())
                x = arrays["q"].astype(np.int64)
                if moved is None:
                    held = scan(x, centres)
                else:
                    held = Bounds(*(arrays[n] for n in ("first", "second", "upper", "lower")))
                    held.drift(moved)
                    shallot(x, centres, held)
                arrays |= vars(held)
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int64()), pa.array([pack(**arrays)], pa.binary())], ["part", "body"])

    return run


def _summed(k: int):
    """Each task's sums of its vectors by cluster, with their number in front."""

    def run(batches):
        total = None
        for batch in batches:
            for body in batch["body"]:
                arrays = unpack(body.as_py())
                total = np.zeros((k, 1 + arrays["q"].shape[1]), np.int64) if total is None else total
                np.add.at(total, arrays["first"], np.pad(arrays["q"].astype(np.int64), ((0, 0), (1, 0)), constant_values=1))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

    return run


def _placed(centres: Centres):
    def run(batches):
        for batch in batches:
            for body in batch["body"]:
                arrays = unpack(body.as_py())
                x, first = arrays["q"].astype(np.int64), arrays["first"]
                far = squared(x, centres.at[first])
                yield pa.RecordBatch.from_arrays([ids_of(arrays, np.arange(len(x))), pa.array(first.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    return run


def _means(packed: DataFrame, centres: Centres) -> np.ndarray:
    """The floor of each cluster's mean; empty clusters keep their centroid. ``k`` rows reach the driver."""
    k = len(centres.at)
    parts = packed.mapInArrow(_summed(k), "cluster int, sums array<long>").select("cluster", F.posexplode("sums").alias("place", "value"))
    total = parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    rows = total.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("sums")).collect()
    out = centres.at.copy()
    for row in rows:
        count, *sums = (int(x["value"]) for x in row["sums"])
        if count:
            out[row["cluster"]] = [s // count for s in sums]
    return out


def cluster(rows: DataFrame, first: Column, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of ``rows (vec_id, embedding)``.

    Components become ``floor(scale * x)``. Centroids start as the ``k`` vectors with the smallest ``first``
    (ties: the smaller vector), in that order. Each round assigns every vector to its nearest centroid by
    squared Euclidean distance (ties: the smaller number) and replaces non-empty centroids by the floor of
    their mean; a last assignment follows. All results are exact: Shallot's bounds only tell which distances
    need not be computed. Vectors stay packed in shards with their bounds from round to round; between rounds
    the sums of ``k`` clusters are what is exchanged, so one large cluster is no hot key.

    Defined cases: vectors that are null, not of ``dims`` components, or hold a null or non-finite component
    take no part. Rows of one id are separate vectors; a null id, whose ``first`` is null, starts no centroid.
    Fewer vectors than ``k`` make fewer centroids. Components stay within 2**24. Other columns are ignored; an
    empty table, or one whose ids are all null, gives no rows.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "centroids")
    kept = rows.where(usable("embedding") & (F.size("embedding") == dims))
    vectors = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    least = kept.select(first.alias("first"), F.col("embedding").cast("array<double>").alias("vector")).where("first IS NOT NULL")
    starts = least.orderBy("first", "vector").limit(k).select("vector").collect()
    if not starts:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centres, moved = Centres(scaled(np.array([r["vector"] for r in starts], np.float64), scale, MOST)), None
    packed = scratch.keep(dealt(vectors, SHARD, _packed(scale))[0], "round-0")
    for turn in range(1, rounds + 2):
        packed = scratch.keep(packed.mapInArrow(_assigned(centres, moved), PACKED), f"round-{turn}")
        scratch.drop(f"round-{turn - 1}")
        if turn <= rounds:
            means = _means(packed, centres)
            moved, centres = centres.moved(means), Centres(means)
    placed = scratch.keep(packed.mapInArrow(_placed(centres), "vec_id long, cluster int, distance long"), "placed")
    scratch.drop(f"round-{rounds + 1}")
    sums = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    named = [(i, sums.get(i, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centres.at.tolist())]
    found = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(found), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
