"""SentencePiece encoding and decoding with the N best segmentations of a text.

A text is a lattice of pieces; a segmentation is a path, its score the sum of log-probabilities.
Pieces never hold a space behind another character, nor a newline beside one, so the lattice falls
apart into chunks at those places. Forward Viterbi scores of all distinct chunks are found at once;
they are the exact heuristic of a backward A* search over one chunk's lattice.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.llm import arrays as A
from candlewick.llm.common import prepare, shards, tidied
from candlewick.llm.pieces import Lattice, Pieces, read_model

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: A chunk of more bytes is segmented in parts of so many.
LONGEST = 4096
SHARD_BYTES = 1 << 19
#: Chunks whose N best segmentations a task keeps for the next texts.
KEPT = 50_000

SWAP = pa.struct([("start", pa.int32()), ("count", pa.int32()), ("ids", pa.list_(pa.int32()))])
SCHEMA = "ids array<int>, scores array<double>, swaps array<array<struct<start:int,count:int,ids:array<int>>>>"


class Encoder:
    """Pieces with log-probabilities that follow Zipf's law over the ranks of the vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        single = set(pieces.byte_ids.tolist())
        ids = [i for i, t in enumerate(pieces.texts) if t and i not in single] + pieces.byte_ids.tolist()
        chance = 1.0 / np.arange(2, len(ids) + 2)
        self.logs = np.full(len(pieces.texts), -np.inf)
        self.logs[ids] = np.log(chance / chance.sum())
        texts = [t or b"" for t in pieces.texts]
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.known = {t: i for i, t in enumerate(pieces.texts) if t and i not in single}
        self.kept: dict[tuple[bytes, int], list] = {}
        for text in self.known:
            if b" " in text.lstrip(b" ") or (b"\n" in text and len(text) > 1):
                raise ValueError("a piece spans chunks")

    def paths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Best piece ids of each chunk, where they begin, their score, and the loss of the next best.

        Seen from the end, the second-best path leaves the best one at some node by another edge;
        what that loses is known in the forward pass. Of equal paths, the one with the shorter
        last piece is the best.
        """
        lattice = Lattice(self.pieces, data, starts, ends)
        n = len(starts)
        best, second = np.full(lattice.nodes, -np.inf), np.full(lattice.nodes, -np.inf)
        came, length = np.zeros(lattice.nodes, np.int32), np.zeros(lattice.nodes, np.int16)
        best[:n] = 0.0
        for source, target, piece, size in lattice.steps():
            value, now = best[source] + self.logs[piece], best[target]
            better = value > now
            second[target] = np.where(better, now, np.maximum(second[target], value))
            won = target[better]
            best[won], came[won], length[won] = value[better], piece[better], size
        live, offset, loss = np.arange(n), lattice.sizes.copy(), np.full(n, np.inf)
        steps = []
        while len(live):
            node = lattice.base[offset[live]] + live
            loss[live] = np.minimum(loss[live], best[node] - second[node])
            steps.append((live, came[node]))
            offset[live] -= length[node]
            live = live[offset[live] > 0]
        count = np.zeros(n, np.int64)
        for who, _ in steps:
            count[who] += 1
        begin = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(int(begin[-1]), np.int32)
        for step, (who, piece) in enumerate(steps):
            ids[begin[who] + count[who] - 1 - step] = piece
        back = np.empty(n, np.int64)
        back[lattice.order] = np.arange(n)
        flat = ids[A.ranges(begin[:-1][back], count[back])]
        return flat, np.concatenate([[0], np.cumsum(count[back])]), best[lattice.last][back], loss[back]

    def nbest(self, chunk: bytes, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of one chunk, best first, by backward A*.

        A state is a node and the pieces behind it; its priority adds the exact best score of what
        lies before. So states come off the queue in the order of the finished paths they lead to.
        """
        if (chunk, n) in self.kept:
            return self.kept[chunk, n]
        lengths = self.pieces.lengths.tolist()
        edges: list[list[tuple[int, int]]] = [[]]
        ahead = [0.0]
        for end in range(1, len(chunk) + 1):
            into = [(end - 1, int(self.pieces.byte_ids[chunk[end - 1]]))]
            for size in lengths:
                if size > end:
                    break
                piece = self.known.get(chunk[end - size : end])
                if piece is not None:
                    into.append((end - size, piece))
            edges.append(into)
            ahead.append(max(ahead[s] + self.logs[p] for s, p in into))
        queue, made, found = [(-ahead[-1], 0, len(chunk), 0.0, ())], 0, []
        while queue and len(found) < n:
            cost, _, node, behind, path = heapq.heappop(queue)
            if node == 0:
                pieces = []
                while path:
                    piece, path = path
                    pieces.append(piece)
                found.append((-cost, tuple(pieces)))
                continue
            for start, piece in edges[node]:
                made += 1
                score = behind + self.logs[piece]
                heapq.heappush(queue, (-(score + ahead[start]), made, start, score, (piece, path)))
        if len(self.kept) >= KEPT:
            self.kept.clear()
        self.kept[chunk, n] = found
        return found

    def encode(self, column, n: int):
        """Per text: best ids (flat, with begins), the n best scores, and how the others differ."""
        raw, cuts = A.flatten(column)
        sizes = np.diff(cuts)
        offsets = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
        data = np.full(int(offsets[-1]), 0x20, np.uint8)  # a space before each text, as the vocabulary has it
        data[A.ranges(offsets[1:] - sizes, sizes)] = raw
        starts, ends = self._chunks(data, offsets)
        first = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64), [[0.0] for _ in sizes], [[[]] for _ in sizes]
        _, one, which = np.unique(A.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        which = which.reshape(-1)
        size = (ends - starts)[one]
        end = np.cumsum(size)
        body = data[A.ranges(starts[one], size)]
        flat, begin, best, loss = self.paths(body, end - size, end)
        count = np.diff(begin)
        ids = flat[A.ranges(begin[which], count[which])]
        at = np.concatenate([[0], np.cumsum(count[which])])
        total = np.concatenate([[0.0], np.cumsum(best[which])])
        scores, swaps = [], []
        for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            mine = which[low:high]
            top = float(total[high] - total[low])
            near = range(high - low) if high - low < n else np.sort(np.argpartition(loss[mine], n - 2)[: n - 1]) if n > 1 else []
            ranked = [(0.0, ())]
            for k in near:
                u = mine[k]
                other = self.nbest(body[end[u] - size[u] : end[u]].tobytes(), n)
                ways = [(d + other[0][0] - s, c + ((k, j),) if j else c) for d, c in ranked for j, (s, _) in enumerate(other)]
                ranked = heapq.nsmallest(n, ways)
            scores.append([top - d for d, _ in ranked])
            changed = []
            for _, choice in ranked:
                changed.append([{"start": int(at[low + k] - at[low]), "count": int(count[mine[k]]), "ids": list(self.nbest(body[end[mine[k]] - size[mine[k]] : end[mine[k]]].tobytes(), n)[j][1])} for k, j in choice])
            swaps.append(changed)
        return ids, at[first], scores, swaps

    @staticmethod
    def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space, newline = data == 0x20, data == 0x0A
        opens = newline.copy()
        opens[1:] |= newline[:-1] | (space[1:] & ~space[:-1])
        opens[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        parts = -(-(ends - starts) // LONGEST)
        starts = np.repeat(starts, parts) + A.ranges(np.zeros(len(parts), np.int64), parts) * LONGEST
        return starts, np.append(starts[1:], len(data))[: len(starts)]

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[str]:
        """Texts of flat ids; unreadable bytes become U+FFFD."""
        size = self.sizes[ids]
        body = self.blob[A.ranges(self.begins[ids], size)].tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[begins].tolist()
        return [body[a:b][1:].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


def read_encoder(path: str = VOCABULARY) -> Encoder:
    return Encoder(read_model(path)[1])


def _encoded(encoder: Encoder, n: int):
    def run(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            ids, begins, scores, swaps = encoder.encode(shard["text"], n)
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids))
            found = [lists, pa.array(scores, pa.list_(pa.float64())), pa.array(swaps, pa.list_(pa.list_(SWAP)))]
            rest = [c.combine_chunks() for c in shard.columns]
            rest = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rest]
            yield pa.RecordBatch.from_arrays([*rest, *found], [*shard.column_names, "ids", "scores", "swaps"])

    return run


def encode(docs: DataFrame, encoder: Encoder, n: int = 1) -> DataFrame:
    """``doc_id, text, ids, scores, swaps``: the n best segmentations of every whole text.

    ``ids`` is the best one. ``scores`` has up to n scores, best first; ``swaps`` tells for each of
    them which runs of ``ids`` (start, count) are replaced by which pieces. That needs the n best of
    the n - 1 chunks only where a second choice costs least: a change elsewhere costs more than
    each of those alone. Scores equal up to rounding may come in either order.

    A null or empty text has no pieces, score 0 and no other segmentation. Spaces are pieces like
    others and a literal U+2581 is written in bytes, so decoding gives the text back exactly. A
    chunk over LONGEST bytes is cut. Every row is encoded, also repeated ones or without id; other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidied(_encoded(encoder, n)), f"doc_id {id_type}, text string, {SCHEMA}")


def _decoded(encoder: Encoder):
    def run(batches):
        for batch in batches:
            lists = batch["ids"]
            begins = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            texts = encoder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), begins)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, encoder: Encoder) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; null or empty ids give an empty text."""
    prepare(encoded.sparkSession)
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    return encoded.mapInArrow(tidied(_decoded(encoder)), schema)


def _alike(encoder: Encoder, ids: list[list[int] | None], swaps: list[list]) -> list[bool]:
    """Whether the pieces that each swap puts in spell the bytes of those they replace."""
    texts = encoder.pieces.texts
    spelt = lambda some: b"".join(texts[i] for i in some)
    return [
        all(spelt(x["ids"]) == spelt(best[x["start"] : x["start"] + x["count"]]) for way in ways for x in way)
        for best, ways in zip(ids, swaps, strict=True)
    ]


def _checked(encoder: Encoder, n: int):
    encoded, decoded = _encoded(encoder, n), _decoded(encoder)

    def run(batches):
        for batch in decoded(encoded(batches)):
            alike = _alike(encoder, batch["ids"].to_pylist(), batch["swaps"].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alike, pa.bool_())], [*batch.schema.names, "alike"])

    return run


def encode_checked(docs: DataFrame, encoder: Encoder, n: int = 1) -> DataFrame:
    """``encode`` and ``decode`` in one Python process a task instead of two, so that texts and ids pass
    it once. Adds ``alike``: each of the n best segmentations spells the same text."""
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text string, {SCHEMA}, decoded string, alike boolean"
    return docs.select("doc_id", "text").mapInArrow(tidied(_checked(encoder, n)), schema)
