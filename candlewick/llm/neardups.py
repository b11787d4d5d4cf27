"""Near-duplicates by SetSketch: mergeable registers, banded, estimated by likelihood, verified."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import arrays as A
from candlewick.llm.common import Scratch, components, prepare, shards, tidied

SHARD_BYTES = 2 << 20

#: SetSketch parameters: base of the register scale, rate of the exponentials, largest register.
BASE, RATE, LARGEST = 1.001, 20.0, (1 << 16) - 1
REGISTERS = 512
#: A pair at the threshold may share no band with this probability at most.
MISSED = 1e-7
#: Texts that meet others in a bucket are broadcast, as 24 bytes each, up to this many; else joined.
FEW = 1 << 19
#: Pairs whose estimate is this many standard deviations below the threshold are not verified.
DEVIATIONS = 5.0
FACTORS = (A.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; linked from ``percent`` per cent of intersection over union."""

    words: int = 5
    percent: int = 80

    @property
    def band(self) -> int:
        """Registers in a band: as many as leave a pair at the threshold a common band."""
        wide = [r for r in range(1, 33) if (1 - (self.percent / 100) ** r) ** (REGISTERS // r) <= MISSED]
        return max(wide, default=1)


def shingle_sets(texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, and where each text's begin."""
    data, offsets = A.flatten(texts)
    hashes, first = A.hash_words(A.LOWER[data], offsets, A.UNSPACED)
    text, start, end = A.windows(first, words, short=True)
    shingles = A.hash_spans(hashes, start, end)
    cuts = np.searchsorted(text, np.arange(len(offsets)))
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        shingles[low:high].sort()
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    return shingles[fresh], np.concatenate([[0], np.cumsum(fresh)])[cuts]


def registers(shingles: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One row of registers for each text; texts without shingles have zeros.

    A register is a truncated minimum of exponentials on a scale of powers of BASE, so registers
    of a union are the larger ones of both. Each one reads half of the shingle hash.
    """
    out = np.zeros((len(cuts) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(cuts))
    if not len(full):
        return out
    halves = [shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)]
    least = np.stack([np.minimum.reduceat(halves[j % 2] * factor, cuts[full]) for j, factor in enumerate(FACTORS)], axis=1)
    value = -np.log1p(-(least + 0.5) / 2.0**32)
    out[full] = np.clip(np.floor(1 - np.log(value / RATE) / np.log(BASE)), 0, LARGEST)
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of register rows, given the set sizes.

    The likelihood counts registers that are larger, smaller and equal; it has one maximum.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def share(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def value(j):
        up, down = share(np.maximum(u - v * j, 0)), share(np.maximum(v - u * j, 0))
        tiny = 1e-300
        return more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, 0) + tiny)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (5**0.5 - 1) / 2
    for _ in range(40):
        left, right = high - golden * (high - low), low + golden * (high - low)
        up = value(left) < value(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def _sketched(words: int):
    def run(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            shingles, cuts = shingle_sets(shard["text"], words)
            rows = registers(shingles, cuts)
            columns = [shard["id"].combine_chunks(), shard["mark"].combine_chunks(), pa.array(np.diff(cuts)), pa.array(_digests(shingles, cuts), pa.binary()), pa.array([x.tobytes() for x in rows.astype(">u2")], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "n", "same", "registers"])

    return run


def _digests(shingles: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """128 bits for each set, equal for equal sets."""
    same = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(A.mix(shingles ^ np.uint64(seed)))])
        same.append(sums[cuts[1:]] - sums[cuts[:-1]])
    return [x.tobytes() for x in np.stack(same, axis=1).astype(">u8")]


def _sets(words: int):
    def run(batches):
        for shard in shards(batches, "text", SHARD_BYTES):
            shingles, cuts = shingle_sets(shard["text"], words)
            rows = [shingles[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([shard["doc"].combine_chunks(), shard["many"].combine_chunks(), pa.array(rows, pa.binary())], ["doc", "many", "shingles"])

    return run


def _likely(percent: int):
    least = percent / 100 - DEVIATIONS * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.stack([np.frombuffer(x, ">u2") for x in batch[c].to_pylist()]) for c in ("ra", "rb"))
                found = estimate(a, b, batch["na"].to_numpy(), batch["nb"].to_numpy()) >= least
                yield batch.filter(pa.array(found)).select(["a", "b"])

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            found = []
            for x, y in zip(batch["sa"].to_pylist(), batch["sb"].to_pylist(), strict=True):
                one, two = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                shared = int((two[at] == one).sum())
                found.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield batch.filter(pa.array(found, pa.bool_())).select(["a", "b"])

    return run


def _difference(batches):
    """Shingles by which a member and its pivot differ, either way."""
    for batch in batches:
        lists = []
        for x, y in zip(batch["sa"].to_pylist(), batch["sb"].to_pylist(), strict=True):
            mine, pivot = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            lists.append(np.concatenate([mine[~np.isin(mine, pivot, assume_unique=True)], A.mix(pivot[~np.isin(pivot, mine, assume_unique=True)])]).view(np.int64))
        names = ["pivot", "n_pivot", "doc", "n", "label", "apart"]
        sizes = pa.array([len(x) for x in lists], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), sizes, pa.array(lists, pa.list_(pa.int64()))], [*names, "d", "shingles"])


class _Links:
    """Verified links among the representatives of equal sets."""

    def __init__(self, texts: DataFrame, classes: DataFrame, like: Likeness, scratch: Scratch):
        self.like, self.scratch = like, scratch
        bands, wide = REGISTERS // like.band, 2 * like.band
        keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.substring(F.col("registers"), i * wide + 1, F.lit(wide))))
        banded = classes.select("doc", "n", F.explode(keys).alias("key"))
        buckets = scratch.keep(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        score = F.sum("size").over(Window.partitionBy("doc"))
        members = scratch.keep(banded.join(buckets, "key").select("key", "doc", "n", score.alias("score")), "members")
        wanted = scratch.keep(members.select("doc").distinct().join(classes, "doc").select("doc", "mark", (F.col("times") > 1).alias("many")), "wanted")
        self.sketches = scratch.keep(classes.join(wanted.select("doc"), "doc", "left_semi"), "compared")
        # the texts that meet others are fewer than all: few of them are sent to the tasks that read texts
        few = F.broadcast(wanted) if wanted.count() <= FEW else wanted
        made = texts.join(few, "mark").select("doc", "many", "text").mapInArrow(tidied(_sets(like.words)), "doc long, many boolean, shingles binary")
        made = scratch.keep(made, "made")
        # a text with copies has its set made from each of them, and is kept once
        once = scratch.keep(made.where("many").groupBy("doc").agg(F.first("shingles").alias("shingles")), "once")
        self.sets = made.where("NOT many").select("doc", "shingles").union(once)
        pivots = scratch.keep(members.groupBy("key").agg(self._best()).select("key", *self._named("pivot")), "pivots")
        met = members.join(pivots, "key").where("doc <> pivot").select("pivot", "n_pivot", "doc", "n", "score")
        self.groups = scratch.keep(met.distinct(), "groups")
        scratch.drop("buckets", "members", "wanted", "pivots")

    @staticmethod
    def _best():
        """The member with the largest buckets, most likely the text that others were copied from."""
        return F.max(F.struct("score", F.bitwise_not("doc").alias("doc"), "n")).alias("best")

    @staticmethod
    def _named(name: str):
        return F.bitwise_not("best.doc").alias(name), F.col("best.n").alias(f"n_{name}")

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs ``(a, na, b, nb)`` that are linked: possible by size, likely by sketch, then exact."""
        possible = 100 * F.least("na", "nb") >= self.like.percent * F.greatest("na", "nb")
        pairs = pairs.where(possible).select("a", "b").distinct()
        sketch = self.sketches.select("doc", "n", "registers")
        a, b = (sketch.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}")) for x in "ab")
        likely = pairs.join(b, "b").join(a, "a").mapInArrow(tidied(_likely(self.like.percent)), "a long, b long").distinct()
        linked = self._with_sets(likely, "a", "b").mapInArrow(tidied(_linked(self.like.percent)), "a long, b long")
        return self.scratch.keep(linked.distinct(), f"links-{name}")

    def _with_sets(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        first, second = (self.sets.select(F.col("doc").alias(x), F.col("shingles").alias(s)) for x, s in ((a, "sa"), (b, "sb")))
        return pairs.join(first, a).join(second, b)

    def _joined(self, labels: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
        """Components after further links: only labels that the links join are worked on again."""
        if labels is None:
            return components(links, self.scratch, f"labels-{name}")
        a, b = (labels.select(F.col("id").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
        between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        between = self.scratch.keep(between.where("a <> b").distinct(), f"between-{name}")
        if between.isEmpty():
            return labels
        merged = components(between, self.scratch, f"labels-{name}")
        up = merged.select(F.col("id").alias("label"), F.col("label").alias("up"))
        old = labels.join(up, "label", "left").select("id", F.coalesce("up", "label").alias("label"))
        return self.scratch.keep(old.union(merged.join(labels, "id", "left_anti").select("id", "label")), f"joined-{name}")

    def _apart(self, labels: DataFrame, name: str) -> DataFrame:
        """The groups with each member's label and whether that differs from its pivot's."""
        mine = labels.select(F.col("id").alias("doc"), "label")
        main = labels.select(F.col("id").alias("pivot"), F.col("label").alias("main"))
        groups = self.groups.join(mine, "doc", "left").join(main, "pivot", "left")
        label, main = F.coalesce("label", "doc"), F.coalesce("main", "pivot")
        groups = groups.select("pivot", "n_pivot", "doc", "n", "score", label.alias("label"), (label != main).alias("apart"))
        return self.scratch.keep(groups, f"groups-{name}")

    def labels(self) -> DataFrame:
        """Compare each bucket's members with one pivot, then those still apart from it.

        Members linked to the pivot, by whatever way, are done. Of the rest, the best one is
        compared with those beside it; that joins groups inside a group. What is then still apart
        is compared with the members that share enough of its differences to the pivot: all others
        cannot be linked to it (``_by_differences``).
        """
        pair = [F.col("pivot").alias("a"), F.col("n_pivot").alias("na"), F.col("doc").alias("b"), F.col("n").alias("nb")]
        labels = self._joined(None, self.verify(self.groups.select(*pair), "0"), "0")
        groups = self._apart(labels, "0")
        apart = groups.where("apart")
        if apart.isEmpty():
            return labels
        best = apart.groupBy("pivot").agg(self._best(), F.max_by("label", F.struct("score", F.bitwise_not("doc"))).alias("chosen"))
        best = self.scratch.keep(best.select("pivot", *self._named("next"), "chosen"), "next")
        met = apart.join(best, "pivot").where("label <> chosen")
        met = met.select(F.col("next").alias("a"), F.col("n_next").alias("na"), F.col("doc").alias("b"), F.col("n").alias("nb"))
        labels = self._joined(labels, self.verify(met, "1"), "1")
        return self._joined(labels, self.verify(self._by_differences(self._apart(labels, "1")), "2"), "2")

    def _by_differences(self, groups: DataFrame) -> DataFrame:
        """Pairs of members with different labels, one of them apart, that may share enough differences.

        Two members differ by what exactly one of their differences to the pivot holds. So members with
        ``d`` and ``e`` differences are linked only if ``2 (1 + t) shared >= (1 + t) (d + e) - (1 - t) (n + m)``.
        A group's shingles are counted, and each member's are put in one order, the rarest of the group first;
        those of one member alone are shared with nobody. At the first shingle that two members share, both
        have at least ``shared`` left in that order (``rest``). So a pair is met only at a shingle from which
        both have enough left, and shingles that most of a group has, which come last, pair nobody.

        Before that, each side leaves out what can meet no partner at all. A member whose partner is apart
        from the pivot shares more than ``(d - (1 - t) / (1 + t) (n - n_pivot)) / 2``; any partner of a member
        has at most ``n / t`` shingles and no fewer differences than links allow, so ``d - n (1 - t) / t`` are shared.
        """
        p = self.like.percent
        open_ = groups.join(groups.where("apart").select("pivot").distinct(), "pivot", "left_semi")
        schema = "pivot long, n_pivot long, doc long, n long, label long, apart boolean, d long, shingles array<long>"
        found = self.scratch.keep(self._with_sets(open_, "doc", "pivot").mapInArrow(tidied(_difference), schema), "differences")
        single = found.select("pivot", "doc", F.explode("shingles").alias("shingle"))
        count = single.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
        count = self.scratch.keep(count, "held")
        common = single.join(count, ["pivot", "shingle"])
        ordered = common.groupBy("pivot", "doc").agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("common"))
        ordered = found.drop("shingles").join(ordered, ["pivot", "doc"])
        placed = ordered.select("*", F.posexplode("common").alias("place", "one")).withColumn("rest", F.size("common") - F.col("place"))
        placed = self.scratch.keep(placed.select("pivot", "n_pivot", "doc", "n", "label", "apart", "d", "rest", "one.shingle"), "placed")

        def side(name: str, rows: DataFrame) -> DataFrame:
            return rows.select("pivot", "shingle", F.col("doc").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "label", "d", "rest")])

        apart = side("a", placed.where(F.col("apart") & (p * F.col("rest") >= p * F.col("d") - (100 - p) * F.col("n"))))
        every = side("b", placed.where(2 * (100 + p) * F.col("rest") > (100 + p) * F.col("d") - (100 - p) * (F.col("n") - F.col("n_pivot"))))
        enough = 2 * (100 + p) * F.least("rest_a", "rest_b") >= (100 + p) * (F.col("d_a") + F.col("d_b")) - (100 - p) * (F.col("n_a") + F.col("n_b"))
        keys = [apart[c] == every[c] for c in ("pivot", "shingle")]
        met = apart.join(every, [*keys, F.col("label_a") != F.col("label_b"), enough])
        return met.select("a", F.col("n_a").alias("na"), "b", F.col("n_b").alias("nb"))


def _classes(docs: DataFrame, like: Likeness, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """One row of each text with words ``(id, mark, n, same)``, and its class with a label ``(same, n, least, label)``.

    Texts with equal sets are one class, told by 128 bits of the set and its size; classes are numbered
    as they are stored, so no two share a number. ``mark`` is a text's MD5 (128 bits): texts are found
    again by it, and repeated ones are read once for each comparison.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5("text")).alias("mark"), "text")
    sketched = texts.mapInArrow(tidied(_sketched(like.words)), "id long, mark binary, n long, same binary, registers binary")
    sketches = scratch.keep(sketched, "sketches")
    place = F.min(F.struct("id")).alias("least")  # in a struct, null is the smallest id
    each = sketches.where("n > 0").groupBy("same", "n").agg(place, F.min("mark").alias("mark"), F.first("registers").alias("registers"), F.count(F.lit(1)).alias("times"))
    classes = scratch.keep(each.withColumn("doc", F.monotonically_increasing_id()), "classes")
    labels = _Links(texts.select("mark", "text"), classes.select("doc", "n", "mark", "times", "registers"), like, scratch).labels()
    labelled = classes.join(labels, classes.doc == labels.id, "left").select("same", "n", "least", F.coalesce("label", "doc").alias("label"))
    return sketches.drop("registers"), scratch.keep(labelled, "labelled")


def near_duplicates(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id``: groups of documents linked by shingle similarity.

    Words are separated by ASCII white space, A-Z lower-cased. Documents with equal sets are one
    class; sketches of classes are banded, and pairs of a bucket are filtered by size and by
    the likelihood estimate of their registers, then confirmed on the full sets. ``component_id`` is
    the smallest id that links reach. A pair at the threshold meets in no bucket with probability
    under 1e-7 and is estimated too low with probability 3e-7.

    Null or empty texts have no shingles and stay alone; a text shorter than a shingle is one
    shingle. Texts of any length are worked whole. Every row is a document of its own, also where ids repeat;
    a null id sorts first and gives a null component. Other columns are ignored; an empty table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "neardups")
    rows, classes = _classes(docs, like or Likeness(), scratch)
    least = classes.groupBy("label").agg(F.min("least").alias("root"))
    roots = scratch.keep(classes.join(least, "label").select("same", "n", "root"), "roots")
    out = rows.join(roots, ["same", "n"], "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("root.id")).otherwise(F.col("id")).alias("component_id"))
    return scratch.only(out, "grouped")


def keep_first(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group linked as in ``near_duplicates``, one row.

    That with the smallest id stays, a null id being the smallest and equal ids ordered by the MD5 of the
    text; of repeated rows one stays. What decides are ids and digests; whole rows are then read once and
    those chosen are kept. Texts left without a word have no duplicates and all stay, as do null texts.
    """
    scratch = Scratch(docs.sparkSession, "firsts")
    some = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows, classes = _classes(docs.where(some), like or Likeness(), scratch)
    each = rows.groupBy("id", "mark", "same", "n").agg(F.count(F.lit(1)).alias("times"))
    grouped = each.join(classes.select("same", "n", "label"), ["same", "n"]).groupBy("label")
    first = scratch.keep(grouped.agg(F.min(F.struct(F.struct("id").alias("place"), "mark", "times")).alias("first")).select("first.*"), "first")
    chosen = first.select(F.col("place.id").alias("chosen_id"), F.col("mark").alias("chosen_mark"), "times")
    whole = docs.where(some).select(F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5("text")).alias("mark"), F.struct("*").alias("row"))
    kept = whole.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("mark") == F.col("chosen_mark")))
    again = kept.where("times > 1").groupBy("id", "mark").agg(F.first("row").alias("row"))
    return kept.where("times = 1").select("row.*").union(again.select("row.*")).union(docs.where(~some))
