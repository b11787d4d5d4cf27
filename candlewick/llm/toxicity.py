"""Toxicity: subword-bag embeddings, averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import arrays as A
from candlewick.llm.common import bounded_sample, prepare, shards

#: Character n-grams of a word with its borders, hashed into rows of the embedding.
SHORTEST, LONGEST, ROWS, WIDTH = 3, 5, 1 << 16, 8
#: Training rows of labels 0 and 1 at most; size of a mini-batch, passes and step size.
SAMPLE, BATCH, PASSES, STEP = (6000, 2000), 64, 6, 0.01
#: Averages are small, as few n-grams of a text tell; they are scaled by this before the softmax.
SCALE = 16.0
#: A row met in this many training texts counts half; in more, nearly full.
RARE = 50
#: Neutral n-grams that every average counts besides its own, so that few words say little.
NEUTRAL = 30
SHARD_BYTES = 4 << 20


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def distinct_words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bordered distinct words (bytes, starts), the word at each place, and each text's first."""
    data, offsets = A.flatten(column)
    data = A.LOWER[data]
    starts, ends, first = A.spans(data, offsets, A.UNSPACED)
    _, one, which = np.unique(A.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    sizes = ends[one] - starts[one]
    begin = np.cumsum(sizes + 2) - sizes - 2
    bordered = np.full(int((sizes + 2).sum()), 0x20, np.uint8)
    bordered[A.ranges(begin + 1, sizes)] = data[A.ranges(starts[one], sizes)]
    return bordered, np.append(begin, len(bordered)), which.reshape(-1), first


def grams(bordered: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all n-grams, word by word, and where each word's begin."""
    chars = np.frombuffer(bordered.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((bordered & 0xC0) != 0x80)])
    begin = lead[begin]
    n = np.diff(begin)
    word, start, size = [], [], []
    for length in range(SHORTEST, LONGEST + 1):
        count = np.maximum(n - length + 1, 0)
        word.append(np.repeat(np.arange(len(n)), count))
        start.append(A.ranges(begin[:-1], count))
        size.append(np.full(len(start[-1]), length))
    word, start, size = np.concatenate(word), np.concatenate(start), np.concatenate(size)
    order = np.lexsort((size, start))
    word, start, size = word[order], start[order], size[order]
    row = A.hash_spans(chars, start, start + size) % np.uint64(ROWS)
    return row.astype(np.int64), np.searchsorted(word, np.arange(len(n) + 1))


def bags(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's embedding rows and their shares."""
    bordered, begin, which, first = distinct_words(column)
    row, cut = grams(bordered, begin)
    out = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        words = which[low:high]
        mine = row[A.ranges(cut[words], cut[words + 1] - cut[words])]
        rows, count = np.unique(mine, return_counts=True)
        out.append((rows.astype(np.int32), (count / (len(mine) + NEUTRAL)).astype(np.float32)))
    return out


def _bagged(batches):
    for batch in batches:
        rows, shares = zip(*bags(batch["text"]), strict=True) if batch.num_rows else ((), ())
        kinds = pa.list_(pa.int32()), pa.list_(pa.float32())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(rows, kinds[0]), pa.array(shares, kinds[1])], ["doc_id", "toxic", "rows", "shares"])


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """Fit embedding and softmax together with Adam; returns the weight of each row and the bias.

    A text's score is linear in its average, so the two layers fold into one weight for each row
    of the embedding, and scoring needs no matrix. Rows of rare n-grams are damped, and a row that
    training never meets stays neutral, so that unknown clean words do not add up to noise.
    """
    labels = np.array([label for _, _, label in examples], np.int64)
    if len(set(labels.tolist())) < 2:
        return np.zeros(ROWS, np.float32), 0.0
    random = np.random.default_rng(seed)
    met = np.bincount(np.concatenate([rows for rows, _, _ in examples]), minlength=ROWS)
    damped = (SCALE * met / (met + RARE)).astype(np.float32)
    table, head = np.zeros((ROWS, WIDTH), np.float32), random.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.log(np.bincount(labels) / len(labels)).astype(np.float32)
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, head, bias)]
    done, steps = 0, PASSES * len(examples) / BATCH

    def move(x, grad, at, which):
        mean, square = moments[which]
        mean[at] = 0.9 * mean[at] + 0.1 * grad
        square[at] = 0.99 * square[at] + 0.01 * grad * grad
        rate = STEP * max(0.0, 1 - done / steps)
        x[at] -= rate * (mean[at] / (1 - 0.9**done)) / (np.sqrt(square[at] / (1 - 0.99**done)) + 1e-8)

    for _ in range(PASSES):
        order = random.permutation(len(examples))
        for low in range(0, len(order), BATCH):
            done += 1
            batch = order[low : low + BATCH]
            text = np.repeat(np.arange(len(batch)), [len(examples[i][0]) for i in batch])
            rows = np.concatenate([examples[i][0] for i in batch])
            shares = np.concatenate([examples[i][1] for i in batch]) * damped[rows]
            hidden = np.stack([np.bincount(text, shares * table[rows, k], len(batch)) for k in range(WIDTH)], axis=1).astype(np.float32)
            logits = hidden @ head + bias
            back = np.exp(logits - logits.max(axis=1, keepdims=True))
            back /= back.sum(axis=1, keepdims=True)
            back[np.arange(len(batch)), labels[batch]] -= 1
            back /= len(batch)
            down = back @ head.T
            at, place = np.unique(rows, return_inverse=True)
            grad = np.stack([np.bincount(place.reshape(-1), shares * down[text, k], len(at)) for k in range(WIDTH)], axis=1).astype(np.float32)
            move(head, hidden.T @ back, slice(None), 1)
            move(bias, back.sum(axis=0), slice(None), 2)
            move(table, grad, at, 0)
    return (table @ (head[:, 1] - head[:, 0])) * damped, float(bias[1] - bias[0])


class Model:
    """One weight for each embedding row, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, column) -> np.ndarray:
        bordered, begin, which, first = distinct_words(column)
        row, cut = grams(bordered, begin)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[row], dtype=np.float64)])
        word = np.concatenate([[0.0], np.cumsum((sums[cut[1:]] - sums[cut[:-1]])[which])])
        size = np.concatenate([[0], np.cumsum(np.diff(cut)[which])])
        total, count = word[first[1:]] - word[first[:-1]], size[first[1:]] - size[first[:-1]]
        logit = np.clip(self.bias + total / (count + NEUTRAL), -500, 500)
        return 1 / (1 + np.exp(-logit))


def fit(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> Model:
    """Train on at most ``sample`` rows of labels 0 and 1, those with the least id hash.

    Only the text is an input. Rows without text, id or label are not learned from, nor rows that
    are held out. If one of the labels is missing, nothing is learned and every score is the same.
    """
    prepare(docs.sparkSession)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out())
    chosen = bounded_sample(known.distinct(), "toxic", F.when(F.col("toxic") == 0, sample[0]).otherwise(sample[1]))
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInArrow(_bagged, "doc_id long, toxic int, rows array<int>, shares array<float>").orderBy("doc_id").toArrow()
    examples = [(r.values.to_numpy(), s.values.to_numpy(), t) for r, s, t in zip(found["rows"], found["shares"], found["toxic"].to_pylist(), strict=True)]
    return Model(*train(examples))


def _scored(model: Model):
    def run(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            yield pa.RecordBatch.from_arrays([shard["doc_id"].combine_chunks(), pa.array(model.scores(shard["text"]))], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: how likely each text is toxic, from 0 to 1.

    A word's n-grams are those of its characters between two borders, so misspellings share most
    of them. A text's score is the logistic of the average weight of all its n-grams; a null or
    empty text has none and gets the bias alone. Rows are scored each on its own, whatever their
    ids; other columns are ignored.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scored(model), f"doc_id {id_type}, score double")
