"""Approximate nearest neighbours: a robust-pruned directed graph in every shard, searched by beams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch
from candlewick.llm.vectors import Arrays, best, dealt, facing, ids_of, padded, usable, widened

#: Rows in a shard, and queries in a block.
SHARD, BLOCK = 4096, 256
#: Vectors put into a graph at once, after it has as many.
BATCH = 256


@dataclass(frozen=True)
class Shape:
    """Edges of a node, width of the beam while building, and how much longer an edge may be to be kept."""

    edges: int = 32
    beam: int = 48
    relaxed: float = 1.2


class Graph:
    """Directed edges among unit vectors; searches start at the node nearest to their mean."""

    def __init__(self, points: np.ndarray, shape: Shape, edges: np.ndarray | None = None):
        self.points, self.shape = np.ascontiguousarray(points, np.float64), shape
        self.edges = np.full((len(points), shape.edges), -1, np.int32) if edges is None else edges.astype(np.int32)
        self.entry = int(np.argmax(self.points @ self.points.mean(axis=0, dtype=np.float64))) if len(points) else 0

    def search(self, asked: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes and distances of the final beams, nearest first, and the nodes expanded on the way.

        The nearest node not yet expanded puts its neighbours into the beam, which keeps the nearest
        ``beam``, until all of it is expanded. Missing nodes are -1. Distances are squared ones.
        """
        n, beam = len(asked), min(beam, len(self.points))
        asked = np.ascontiguousarray(asked, np.float64)
        node = np.full((n, beam), -1, np.int32)
        far = np.full((n, beam), np.inf)
        spent = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.points)), bool)
        node[:, 0], seen[:, self.entry] = self.entry, True
        far[:, 0] = 2 - 2 * (asked @ self.points[self.entry])
        path: list[np.ndarray] = []
        while True:
            ready = ~spent & (node >= 0)
            row = np.flatnonzero(ready.any(axis=1))
            if not len(row):
                break
            at = ready[row].argmax(axis=1)
            spent[row, at] = True
            chosen = np.full(n, -1, np.int32)
            chosen[row] = node[row, at]
            path.append(chosen)
            near = self.edges[chosen[row]]
            fresh = (near >= 0) & ~seen[row[:, None], near]
            of, place = np.nonzero(fresh)
            seen[row[of], near[of, place]] = True
            added = np.full(near.shape, np.inf)
            added[of, place] = 2 - 2 * np.einsum("ij,ij->i", self.points[near[of, place]], asked[row[of]])
            all_far = np.concatenate([far[row], added], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[row] = np.take_along_axis(all_far, order, axis=1)
            node[row] = np.take_along_axis(np.concatenate([node[row], np.where(fresh, near, -1)], axis=1), order, axis=1)
            spent[row] = np.take_along_axis(np.concatenate([spent[row], np.zeros(near.shape, bool)], axis=1), order, axis=1)
        return node, far, np.stack(path, axis=1) if path else np.empty((n, 0), np.int32)

    def prune(self, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Diverse neighbours of each node: the nearest candidate stays, and drops those that are nearer to
        it, by the relaxed factor, than to the node; then the nearest of the rest, and so on. Places left
        over go to the nearest of the dropped: else near copies of one vector would know that one alone."""
        places = self.points[candidates]
        far = 2 - 2 * np.einsum("ijk,ik->ij", places, self.points[of])
        far[(candidates < 0) | (candidates == of[:, None])] = np.inf
        out = np.full((len(of), self.shape.edges), -1, np.int32)
        rows, rest = np.arange(len(of)), far.copy()
        for place in range(self.shape.edges):
            nearest = far.argmin(axis=1)
            left = np.isfinite(far[rows, nearest])
            if not left.any():
                break
            out[left, place] = candidates[rows, nearest][left]
            rest[rows, nearest] = np.inf
            between = 2 - 2 * np.einsum("ijk,ik->ij", places, places[rows, nearest])
            far[self.shape.relaxed**2 * between <= far] = np.inf
            far[rows, nearest] = np.inf
        order = np.argsort(rest, axis=1, kind="stable")[:, : self.shape.edges]
        dropped = np.where(np.isfinite(np.take_along_axis(rest, order, axis=1)), np.take_along_axis(candidates, order, axis=1), -1)
        whole = np.concatenate([out, dropped], axis=1)
        return np.take_along_axis(whole, np.argsort(whole < 0, axis=1, kind="stable"), axis=1)[:, : self.shape.edges]

    def build(self) -> Graph:
        """Insert all nodes in batches that double up to ``BATCH``: each one searches the graph so far,
        keeps pruned edges to what it met, and is offered to those as a neighbour in turn."""
        order = np.random.default_rng(0).permutation(len(self.points))
        order = np.concatenate([[self.entry], order[order != self.entry]]).astype(np.int32)
        done = 1
        while done < len(order):
            batch = order[done : done + min(BATCH, done)]
            node, _, path = self.search(self.points[batch], self.shape.beam)
            met = np.concatenate([node, np.where((path[:, :, None] == node[:, None, :]).any(axis=2), -1, path)], axis=1)
            self.edges[batch] = self.prune(batch, met)
            self._answer(batch)
            done += len(batch)
        return self

    def _answer(self, batch: np.ndarray) -> None:
        """Edges back to a batch's nodes; where they are too many, all of a node's are pruned anew."""
        row, place = np.nonzero(self.edges[batch] >= 0)
        target, source = self.edges[batch][row, place], batch[row]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        node, first, count = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(node), BATCH):
            some, begin, many = node[low : low + BATCH], first[low : low + BATCH], count[low : low + BATCH]
            new = np.full((len(some), int(many.max())), -1, np.int32)
            inside = np.arange(new.shape[1]) < many[:, None]
            new[inside] = source[(begin[:, None] + np.arange(new.shape[1]))[inside]]
            whole = np.concatenate([self.edges[some], new], axis=1)
            fits = (whole >= 0).sum(axis=1) <= self.shape.edges
            packed = np.take_along_axis(whole, np.argsort(whole < 0, axis=1, kind="stable"), axis=1)
            self.edges[some[fits]] = packed[fits][:, : self.shape.edges]
            if not fits.all():
                self.edges[some[~fits]] = self.prune(some[~fits], whole[~fits])


def even(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which is exact, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    x = even(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _built(shape: Shape):
    def make(arrays: Arrays, rows: pa.Table) -> Arrays:
        x = padded(rows["vector"].combine_chunks())
        distinct, which = np.unique(x, axis=0, return_inverse=True)
        return {"x": distinct, "node": which.reshape(-1).astype(np.int32), "edges": Graph(unit(distinct), shape).build().edges}

    return make


def _asked(arrays: Arrays, rows: pa.Table) -> Arrays:
    return {"x": padded(rows["vector"].combine_chunks())}


FOUND = "block long, query int, query_id long, vec_id long, score double"


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, from the original vectors."""
    a, b = even(x), even(y)
    return np.clip((a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))), -1.0, 1.0)


def _searched(k: int, beam: int, shape: Shape):
    def work(shard: Arrays, block: Arrays, number: int) -> pa.RecordBatch | None:
        width = max(shard["x"].shape[1], block["x"].shape[1])
        x, asked = widened(shard["x"], width), widened(block["x"], width)
        # own row excluded below, so one more node than wanted; of equal vectors, the k + 1 smallest ids
        node, _, _ = Graph(unit(x), shape, shard["edges"]).search(unit(asked), beam)
        order = np.argsort(shard["node"], kind="stable")
        first = np.searchsorted(shard["node"][order], np.arange(len(x) + 1))
        copies = np.minimum(np.diff(first), k + 1)
        query, place = np.nonzero(node >= 0)
        at = node[query, place]
        score = cosines(asked[query], x[at])
        many = copies[at]
        row = np.repeat(np.arange(len(at)), many)
        member = order[np.repeat(first[at], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)]
        other = ~shard["known"][member] | (shard["ids"][member] != block["ids"][query[row]])
        row, member = row[other], member[other]
        by = np.lexsort((member, -score[row], query[row]))
        row, member = row[by], member[by]
        kept = np.arange(len(row)) - np.searchsorted(query[row], np.arange(len(asked)))[query[row]] < k
        row, member = row[kept], member[kept]
        columns = [pa.array(np.full(len(row), number)), pa.array(query[row].astype(np.int32)), ids_of(block, query[row]), ids_of(shard, member), pa.array(score[row])]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    return work


def nearest(rows: DataFrame, query: Column, k: int = 5, beam: int = 96, shape: Shape | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of the largest cosine found for each ``query`` row.

    ``rows (vec_id, embedding)`` are dealt into shards of about 4,096 and every row is put into its shard's
    graph: a search from the shard's centre proposes neighbours, of which robust pruning keeps few and diverse
    ones. Queries go through every shard in blocks, by a search that keeps a beam of the nearest nodes; the
    scores of what it finds are cosines of the original vectors in double precision. Results are approximate:
    a neighbour that no beam meets is missed (see the README for the recall measured).

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as
    query or found. Equal vectors of a shard are one node, of which the smallest ids are returned; ties go to
    the smaller id, a null id comes last. A null id is no query; rows of one id are separate queries, and none
    finds another. Shorter vectors count as followed by zeros. Fewer rows than ``k`` are all returned. Other
    columns are ignored; an empty table gives no rows.
    """
    shape = shape or Shape()
    scratch = Scratch(rows.sparkSession, "graphs")
    vector = F.col("embedding").cast("array<double>").alias("vector")
    known = rows.where(usable("embedding") & F.exists(F.col("embedding"), lambda v: v != 0))
    asked, _ = dealt(known.where(F.coalesce(query, F.lit(False)) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), vector), BLOCK, _asked)
    blocks = scratch.keep(asked, "blocks")
    built, n_shards = dealt(known.select(F.col("vec_id").cast("long").alias("vec_id"), vector), SHARD, _built(shape))
    shards = scratch.keep(built, "index")
    order = Window.partitionBy("block", "query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    found = facing(shards, blocks, n_shards, _searched(k, beam, shape), FOUND).withColumn("rank", F.row_number().over(order))
    out = scratch.keep(found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "found")
    scratch.drop("blocks", "index")
    return out
