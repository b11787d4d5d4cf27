"""Line de-duplication with levelled sorted runs of line hashes."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import Scratch, carried, carried_type, prepare, tidied

#: What is stripped from both ends of a line.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FANOUT = 3
BATCHES = 4


def line_keys(text: Column) -> Column:
    """The distinct 128-bit hashes of a text's non-empty line keys."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    keys = F.transform(lines, lambda line: F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER, LOWER))
    return F.transform(F.array_distinct(F.filter(keys, lambda key: key != "")), lambda key: F.unhex(F.md5(key)))


class LineRuns:
    """Sorted runs ``(key, docs)`` in levels, as tables in the shared folder.

    A batch first drops the keys that the runs already know to be common (a merge anti-join), so
    a line that a third of all documents share is not carried on; what remains becomes a run of
    level 0. ``FANOUT`` runs of a level are merged into one run of the next.
    """

    def __init__(self, scratch: Scratch, threshold: int):
        self.scratch, self.threshold, self.made = scratch, threshold, 0
        self.levels: list[list[tuple[str, DataFrame]]] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"run-{level}-{self.made}"
        self.made += 1
        run = self.scratch.keep(counts.sortWithinPartitions("key"), name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, run))
        if len(self.levels[level]) >= FANOUT:
            old, self.levels[level] = self.levels[level], []
            self._write(self._merged([df for _, df in old]), level + 1)
            self.scratch.drop(*[n for n, _ in old])

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"))

    def common(self) -> DataFrame | None:
        """Keys found in at least ``threshold`` documents so far."""
        runs = [df for level in self.levels for _, df in level]
        return self._merged(runs).where(F.col("docs") >= self.threshold).select("key") if runs else None

    def add(self, keys: DataFrame) -> None:
        """Add a batch with one row for each document and key."""
        counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
        settled = self.common()
        self._write(counts.join(settled, "key", "left_anti") if settled is not None else counts, 0)


def _kept(batches):
    def key(line: str) -> bytes:
        return hashlib.md5(line.strip(STRIPPED).translate(TABLE).encode()).digest()

    for batch in batches:
        total, dropped, kept = [], [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist(), strict=True):
            lines = (text or "").split("\n")
            total.append(len(lines))
            if gone:
                gone = set(gone)
                lines = [line for line in lines if key(line) not in gone]
            dropped.append(total[-1] - len(lines))
            kept.append("\n".join(lines))
        added = [pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())]
        rest = [batch[name] for name in batch.schema.names if name not in ("text", "gone")]
        names = [name for name in batch.schema.names if name not in ("text", "gone")]
        yield pa.RecordBatch.from_arrays([*rest, *added], [*names, "n_lines", "n_dropped", "kept"])


TABLE = str.maketrans(UPPER, LOWER)


def drop_common_lines(docs: DataFrame, threshold: int = 10, batches: int = BATCHES) -> DataFrame:
    """``doc_id, row, n_lines, n_dropped, kept``: texts without lines of ``threshold`` documents.

    A line's key is stripped of ASCII white space and lower-cased in A-Z; empty keys are always
    kept. Each row counts as one document, also where ids repeat; rows of one id lose the common
    lines of all of them, which are common anyway. A null id is an id. A null or empty text is one
    empty line. Other columns are carried in ``row``. An empty table gives an empty result.

    Documents arrive in ``batches`` by the hash of their id, as increments would.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "lines")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    found = docs.select("doc_id", batch.alias("batch"), F.explode(line_keys(F.col("text"))).alias("key"))
    found = scratch.keep(found, "found")
    runs = LineRuns(scratch, threshold)
    for b in range(batches):
        runs.add(found.where(F.col("batch") == b).select("key"))
    common = scratch.keep(runs.common(), "common")
    gone = found.join(common, "key").groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    gone = gone.withColumnRenamed("doc_id", "gone_id")
    joined = docs.select("doc_id", "text", carried(docs)).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row {carried_type(docs)}, n_lines long, n_dropped long, kept string"
    return joined.select("doc_id", "row", "text", "gone").mapInArrow(tidied(_kept), schema)
