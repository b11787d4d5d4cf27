"""Language identification: unigram pieces, summed over all segmentations of every word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import arrays as A
from candlewick.llm.common import bounded_sample, carried, carried_type, prepare, shards, tidied
from candlewick.llm.pieces import Lattice, Pieces, read_model

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents of each language whose pieces are counted, and what is added to each count.
SAMPLE, SMOOTHING = 400, 0.1
#: A longer word is scored in parts of so many bytes.
PART = 32
SHARD_BYTES = 2 << 20
NONE = "und"


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _counts(proto: bytes):
    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        for batch in batches:
            langs = batch["lang"].to_pylist()
            texts = [A.LOWER[np.frombuffer(t or b"", np.uint8)].tobytes().decode() for t in batch["text"].cast(pa.binary()).to_pylist()]
            rows: dict[str, np.ndarray] = {}
            for lang, ids in zip(langs, model.encode(texts, num_threads=1), strict=True):
                rows[lang] = rows.get(lang, 0) + np.bincount(ids, minlength=model.get_piece_size())
            for lang, n in rows.items():
                piece = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(piece), pa.string()), pa.array(piece), pa.array(n[piece])], ["lang", "piece", "n"])

    return run


class Model:
    """Piece probabilities of each language."""

    def __init__(self, pieces: Pieces, langs: list[str], chances: np.ndarray):
        self.pieces, self.langs, self.chances = pieces, langs, chances

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-probability of each word in each language: the forward algorithm."""
        lattice = Lattice(self.pieces, data, starts, ends)
        alpha = np.zeros((lattice.nodes, len(self.langs)))
        alpha[: len(starts)] = 1.0
        for source, target, piece, _ in lattice.steps():
            alpha[target] += alpha[source] * self.chances[piece]
        out = np.empty((len(starts), len(self.langs)))
        out[lattice.order] = np.log(alpha[lattice.last])
        return out

    def texts(self, column) -> np.ndarray:
        """Log-probability of every text in each language."""
        data, offsets = A.flatten(column)
        data = A.LOWER[data]
        starts, ends, first = A.spans(data, offsets, A.UNSPACED)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(starts):
            return out
        _, one, which = np.unique(A.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        # a space before each distinct word marks its begin, as in the vocabulary
        sizes = ends[one] - starts[one]
        marked = np.full(int(sizes.sum()) + len(one), 0x20, np.uint8)
        end = np.cumsum(sizes + 1)
        marked[A.ranges(end - sizes, sizes)] = data[A.ranges(starts[one], sizes)]
        parts = (sizes + PART) // PART
        begin = A.ranges(np.zeros(len(one), np.int64), parts) * PART + np.repeat(end - sizes - 1, parts)
        scores = self.words(marked, begin, np.append(begin[1:], len(marked)))
        of_word = np.add.reduceat(scores, np.cumsum(parts) - parts, axis=0)
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(of_word[which.reshape(-1)], axis=0)])
        return sums[first[1:]] - sums[first[:-1]]


def fit(docs: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE) -> Model:
    """Count pieces in at most ``sample`` documents of each language, those with the least id hash.

    Only rows with text, id and language are learned from, and none that is held out.
    """
    prepare(docs.sparkSession)
    proto, pieces = read_model(path)
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    chosen = bounded_sample(known.select("doc_id", "lang"), "lang", F.lit(sample)).select("doc_id").distinct()
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")
    counted = rows.mapInArrow(tidied(_counts(proto)), "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    langs = sorted(found["lang"].unique())
    chances = np.full((len(pieces.texts), len(langs)), SMOOTHING)
    np.add.at(chances, (found["piece"].to_numpy(np.int64), np.searchsorted(langs, found["lang"]) if langs else np.empty(0, np.int64)), found["n"].to_numpy())
    return Model(pieces, langs, chances / chances.sum(axis=0) if langs else chances)


def _predicted(model: Model):
    def run(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            scores = model.texts(shard["text"])
            if model.langs:
                scores = np.exp(scores - scores.max(axis=1, keepdims=True))
                scores /= scores.sum(axis=1, keepdims=True)
                best, sure = [model.langs[i] for i in scores.argmax(axis=1)], scores.max(axis=1)
            else:
                best, sure = [NONE] * shard.num_rows, np.zeros(shard.num_rows)
            read = shard["letters"].to_numpy()
            lang = [b if r else NONE for b, r in zip(best, read.tolist(), strict=True)]
            rest = [shard[c].combine_chunks() for c in shard.column_names if c != "letters"]
            names = [c for c in shard.column_names if c != "letters"]
            rest = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rest]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(lang, pa.string()), pa.array(np.where(read, sure, 0.0))], [*names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text, row, lang_pred, score``: the likeliest language and its posterior probability.

    A word's probability in a language is the sum over all its segmentations into pieces; a text's
    is the product over its words, all languages alike beforehand. A null text, or one without a
    letter, is ``und`` with score 0; so is every text if no language was learned. Equal
    probabilities go to the first language by name. Rows are scored each on its own, whatever
    their ids; other columns are carried in ``row``.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", carried(docs), letters.alias("letters"))
    return rows.mapInArrow(tidied(_predicted(model)), f"doc_id {id_type}, text string, row {carried_type(docs)}, lang_pred string, score double")
