"""Shared pieces: staged tables, shipped code, bounded Arrow batches, connected components."""

from __future__ import annotations

import ctypes
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.session import shared_dir

#: Rows in one Arrow batch. Texts differ a lot in length, so few rows keep a batch small.
BATCH_ROWS = 128

PACKAGE = Path(__file__).resolve().parents[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship this package to the executors once per application and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_candlewick_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    target = Path(tempfile.mkdtemp(prefix="candlewick-code-")) / "candlewick_code.zip"
    target.write_bytes(packed.getvalue())
    context.addPyFile(str(target))
    context._candlewick_shipped = True


def carried(docs: DataFrame) -> Column:
    """All columns but the text as one struct, so that no name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")


def carried_type(docs: DataFrame) -> str:
    return docs.select(carried(docs)).schema["row"].dataType.simpleString()


def restored(found: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The carried columns in their old order, with new values for some of them."""
    return found.select(*[(changed[c] if c in changed else F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in columns])


class Scratch:
    """Staged tables of one run in the cluster's shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._files().deleteOnExit(self._path(self.root))  # what a result is still read from goes with the session

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write once, read back: cuts lineage and survives lost executors."""
        df.write.mode("errorifexists").parquet(self.path(name))
        return self.read(df, name)

    def read(self, like: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def only(self, df: DataFrame, name: str) -> DataFrame:
        """Keep a result and remove everything it was made from."""
        kept = self.keep(df, name)
        files = self._files()
        for found in files.listStatus(self._path(self.root)):
            if found.getPath().getName() != name:
                files.delete(found.getPath(), True)
        return kept

    def drop(self, *names: str) -> None:
        """Remove staged tables that nothing reads any more; without names, the whole run."""
        files = self._files()
        for target in [self.path(n) for n in names] or [self.root]:
            files.delete(self._path(target), True)

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())


def release() -> None:
    """Give freed memory back to the system: a worker that waits for its next task counts like a busy one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def tidied(run: Callable) -> Callable:
    """The same function over batches, with what it freed given back when a task is through."""

    def whole(batches):
        yield from run(batches)
        release()

    return whole


def shards(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.Table]:
    """Regroup batches so that the text of each shard stays near ``max_bytes`` (one row at least)."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        for row, length in enumerate(lengths.tolist()):
            if size and size + length > max_bytes:
                held.append(batch.slice(at, row - at))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, at = [], 0, row
                release()
            size += length
        held.append(batch.slice(at))
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        held = []
        if whole.num_rows:
            yield whole
        del whole
    release()


def bounded_sample(rows: DataFrame, key: str, most: Column) -> DataFrame:
    """At most ``most`` rows of each key, those with the least hash of ``doc_id``.

    Keys are counted first, and only about four times the wanted share of each is ranked; so the
    ranking of a key has a few thousand rows at any size of the table.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("size")).withColumnRenamed(key, "sized")
    grain = 1 << 40
    share = F.pmod(F.xxhash64("doc_id"), F.lit(grain)).cast("double") * F.col("size") < 4 * most * F.lit(grain).cast("double")
    near = rows.join(F.broadcast(sizes), F.col(key) == F.col("sized")).where(share).drop("sized", "size")
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64("doc_id"), "doc_id"))
    return near.withColumn("place", place).where(F.col("place") <= most).drop("place")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(id, label)``: each id of the links ``(a, b)`` with the smallest id it can reach.

    Labels travel along links and then jump to their label's label, so a chain of n links takes
    about log n rounds. Messages are minima, combined before the shuffle; the label tables are
    staged, so that a hot id meets them in a join that can be split.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.keep(both, f"{name}-links")
    labels = scratch.keep(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    total, step = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0], 0
    while total is not None:
        step += 1
        sent = both.join(labels, both.a == labels.id).select(F.col("b").alias("id"), "label")
        near = scratch.keep(sent.union(labels).groupBy("id").agg(F.min("label").alias("label")), f"{name}-{step}n")
        far = near.select(F.col("id").alias("label"), F.col("label").alias("up"))
        labels = scratch.keep(near.join(far, "label").select("id", F.col("up").alias("label")), f"{name}-{step}")
        new = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        scratch.drop(f"{name}-{step}n", f"{name}-{step - 1}")
        if new == total:
            break
        total = new
    scratch.drop(f"{name}-links")
    return labels
