"""Corpus pipeline over the ``documents`` table: five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet in the shared checkpoint folder and reads back as the
next stage's ``docs``. All but the last stage return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.llm import decontam, jaccard, packing, quality, secret_scan
from valuora.llm.shared import cut_lineage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier scores under 0.7."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    machine = quality.train(docs, table(spark, sf_dir, "labels"), "quality", ~held_out, metadata=("n_chars",))
    return quality.keep_good(docs, machine, metadata=("n_chars",), threshold=0.7)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps exactly one row of each near-duplicate group: the one with the smallest id, null ids last.

    Rows are written with a number of their own and compared by it, so rows that
    repeat an id, or have none, are documents like others.
    """
    rows = cut_lineage(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")),
                       "rows")
    classes = jaccard.jaccard_classes(rows.select("row", F.col("doc.text").alias("text")), id_col="row")
    groups = cut_lineage(
        classes.select(F.col("id").alias("row"), F.col("component_id").alias("group"))
        .join(rows.select("row", F.col("doc.doc_id").alias("doc_id")), "row"), "groups")
    first = (groups.groupBy("group")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
             .select("first.row"))
    gone = groups.join(first, "row", "left_anti").select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which an item of the benchmark occurs."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the texts; ``n_chars`` follows. No document goes."""
    return secret_scan.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]

# A trained model, approximate matching and packing: SQL cannot express the
# rows, so tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
