"""A training corpus from raw documents: five stages, each kept as Parquet before the next one.

Every stage sees all rows its predecessor kept and returns the columns it got, the last one the
encoded texts. Texts that a stage changes get a new ``n_chars``. No stage drops a row for its size,
and none but the documented bounded fit of language ID depends on a sample.

Defined cases: rows without a letter (null and empty texts too) go in the first stage. Near-duplicates
are found by text, whatever the ids: of each group the row with the smallest id stays, a row without
id counting as the smallest, equal ids ordered by a hash of the text; of repeated rows one stays. Texts
left without a word have no duplicates and all stay. Empty tables run through and stay empty; columns
beyond those of ``documents`` are carried along, except in the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import contamination, language, lines, neardups, tokens
from candlewick.llm.common import Scratch, restored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts in no language (``und``); of the others, a missing ``lang`` is filled in."""
    found = language.predict(docs, language.fit(docs)).where(F.col("lang_pred") != language.NONE)
    return restored(found, docs.columns, lang=F.coalesce("row.lang", "lang_pred"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that ten documents share; every document stays, with what is left of it."""
    found = lines.drop_common_lines(docs, 10)
    return restored(found, docs.columns, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of like texts (5 words, similarity 0.8), that with the smallest id."""
    return neardups.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item."""
    found = contamination.find_test_passages(docs, table(spark, sf_dir, "benchmark"))
    return restored(found.where(F.size("spans") == 0), docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text by the best of its three best paths, after checking that all decode to it."""
    coded = tokens.encode_checked(docs, tokens.read_encoder(), 3)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.get("scores", F.lit(0)).alias("score"),
        ((F.col("decoded") == F.coalesce("text", F.lit(""))) & F.col("alike")).alias("round_trip"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: The first and last stage rest on models that SQL cannot express; tests run a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
