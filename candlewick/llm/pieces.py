"""A fixed public piece vocabulary, and every piece inside many words at once."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from candlewick.llm import arrays as A

#: The space marker of the vocabulary; inside this module it is an ordinary space byte.
MARK = "▁"
#: Bits of a hash that pick a slot of the piece table and of the filter before it.
SLOTS, FILTER = 19, 20


class Pieces:
    """Piece bytes by id. Single bytes have pieces of their own, so every text can be written."""

    def __init__(self, texts: list[bytes | None], byte_ids: list[int]):
        self.texts, self.byte_ids = texts, np.array(byte_ids, np.int64)

    @cached_property
    def _table(self) -> tuple:
        single = set(self.byte_ids.tolist())
        ids = np.array([i for i, t in enumerate(self.texts) if t and i not in single], np.int64)
        joined = np.frombuffer(b"".join(self.texts[i] for i in ids), np.uint8)
        ends = np.cumsum([len(self.texts[i]) for i in ids])
        starts = ends - np.diff(ends, prepend=0)
        hashes = A.hash_spans(joined, starts, ends)
        order = np.argsort(hashes)
        hashes, ids = hashes[order], ids[order]
        seen = np.zeros(1 << FILTER, bool)
        seen[hashes >> np.uint64(64 - FILTER)] = True
        slots = np.zeros(1 << SLOTS, np.int32)
        slots[hashes & np.uint64((1 << SLOTS) - 1)] = np.arange(len(hashes))
        return hashes, ids, seen, slots, np.unique(ends - starts)

    @property
    def lengths(self) -> np.ndarray:
        return self._table[4]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which span hashes are pieces, and their ids: a bit filter, a slot, and else a search."""
        known, ids, seen, slots, _ = self._table
        maybe = np.flatnonzero(seen[hashes >> np.uint64(64 - FILTER)])
        wanted = hashes[maybe]
        at = slots[wanted & np.uint64((1 << SLOTS) - 1)]
        other = np.flatnonzero(known[at] != wanted)
        at[other] = np.minimum(np.searchsorted(known, wanted[other]), len(known) - 1)
        hit = known[at] == wanted
        return maybe[hit], ids[at[hit]]


class Lattice:
    """All pieces inside many words. Nodes lie offset by offset, and in each by descending word length.

    ``node(offset)[i]`` belongs to the i-th longest word, ``order[i]``; a word of n bytes has nodes 0
    to n. The arrays of one step are therefore dense, and a forward pass needs no sorting.
    """

    def __init__(self, pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        self.pieces, self.data = pieces, data
        self.order = np.argsort(-sizes, kind="stable")
        self.starts, self.sizes = starts[self.order], sizes[self.order]
        longest = int(self.sizes[0]) if len(sizes) else 0
        self.alive = len(sizes) - np.searchsorted(self.sizes[::-1], np.arange(longest + 1))
        self.base = np.concatenate([[0], np.cumsum(self.alive)])
        self.last = self.base[self.sizes] + np.arange(len(sizes))

    @property
    def nodes(self) -> int:
        return int(self.base[-1])

    def steps(self):
        """``(from nodes, to nodes, piece ids, piece length)`` in the order of the end offset."""
        lengths, longest = self.pieces.lengths.tolist(), len(self.alive) - 1
        sums = A.prefix_sums(self.data)
        for offset in range(1, longest + 1):
            n = int(self.alive[offset])
            end = self.starts[:n] + offset
            every = np.arange(n)
            yield every + self.base[offset - 1], every + self.base[offset], self.pieces.byte_ids[self.data[end - 1]], 1
            for length in lengths:
                if length > offset:
                    break
                hit, piece = self.pieces.lookup(A.hash_from(sums, end - length, length))
                if len(hit):
                    yield hit + self.base[offset - length], hit + self.base[offset], piece, length


def read_model(path: str) -> tuple[bytes, Pieces]:
    """The model file's bytes and its pieces; called on the driver, executors get both shipped."""
    import sentencepiece

    with open(path, "rb") as file:
        proto = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts: list[bytes | None] = []
    byte_ids = [-1] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[1:-1], 16)
            byte_ids[value] = i
            texts.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(None)
        else:
            texts.append(model.id_to_piece(i).replace(MARK, " ").encode())
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary needs a piece for every byte")
    return proto, Pieces(texts, byte_ids)
