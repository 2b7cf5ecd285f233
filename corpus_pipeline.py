"""The corpus pipeline: five operators in a row, each over all that the one before kept.

Every stage reads the Parquet files of its predecessor, so a lost executor repeats one
stage at most. All stages but the last return the columns of documents; the last adds
`size`, `target` and `taken` (words the mix takes of the document, repeats counted; columns
of these names are replaced) and leaves out documents that give nothing. Rows of one doc_id stay one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm import decontam, lines, mixing, near, toxicity
from wickwork.llm.common import read, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sources; n_chars follows the text.

    A text copied to many sources, as it is or nearly, shows its lines on one of them: that
    of its first copy. Else all its lines would go as boilerplate, from every copy.
    """
    firsts = near.keep_one(docs.where("source IS NOT NULL"))
    nameless = firsts.where("doc_id IS NULL").groupBy("text").agg(F.min("source").alias("source"))
    seen = firsts.where("doc_id IS NOT NULL").select("doc_id", "text", "source").unionByName(nameless, allowMissingColumns=True)
    cleaned = lines.dedupe_lines(docs, seen=seen)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark phrases."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with how many."""
    mixed = mixing.mix(docs).groupBy(F.col("doc_id").alias("_id")).agg(
        *[F.max(c).alias(c) for c in ("size", "target", "taken")]
    ).where("taken > 0")
    added = ("size", "target", "taken")
    kept = [docs[c] for c in docs.columns if c not in added]
    return docs.join(mixed, docs["doc_id"].eqNullSafe(mixed["_id"])).select(*kept, *[mixed[c] for c in added])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: The classifier, MinHash components and the seeded mix are beyond SQL; tests hold run() against planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
