"""Spark helpers shared by the operators of this package."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.session import cut_lineage

from . import textops as T

__all__ = ["components", "cut_lineage", "examples", "small_batches", "spread_join", "table", "texts_of"]

BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark):
    """Smaller Arrow batches for what is written inside: less buffer memory beside the heap."""
    old = {k: spark.conf.get(k) for k in BATCH}
    for k, v in BATCH.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def spread_join(rows: DataFrame, values: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``rows`` joined to ``values``, which holds a row per key; no key is a hot one.

    The rows of a key are dealt over as many parts as the session has shuffle
    partitions, by the hash of column ``by``. First the distinct (key, part)
    pairs, at most a row per key and part, meet the key's value; then the rows
    meet the pairs on key and part, so a key that holds a third of all rows is
    spread over all tasks. ``rows`` is read twice.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(by), F.lit(parts)))
    told = rows.select(*keys, "part").distinct().join(values, keys)
    return rows.join(told, [*keys, "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, component)``.

    ``component`` is the smallest id reachable. Every round takes the smallest
    label among a node's neighbours and then follows the label's own label,
    which halves path lengths. A node with very many edges, and a label that
    very many nodes carry, are spread over all tasks (:func:`spread_join`); the
    minimum is a partial aggregate before its shuffle. Each round's labels are
    a table in the shared folder, so a lost executor replays one round only.
    """
    a, b = F.col("a"), F.col("b")
    both = cut_lineage(edges.select("a", "b").where(a != b)
                       .select(F.explode(F.array(F.struct(a.alias("id"), b.alias("to")),
                                                 F.struct(b.alias("id"), a.alias("to")))).alias("e"))
                       .select("e.*").distinct(), "edges")
    labels = cut_lineage(both.groupBy("id").agg(F.min("to").alias("m"))
                         .select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = (spread_join(both, labels.select(F.col("id").alias("to"), "component"), ["to"], "id")
                .groupBy("id").agg(F.min("component").alias("near")))
        step = cut_lineage(labels.join(near, "id").select("id", F.col("component").alias("old"),
                                                          F.least("component", "near").alias("new")), "steps")
        if step.where("old <> new").isEmpty():
            return labels
        # every label is a node, so it has a label of its own
        labels = cut_lineage(spread_join(step, labels.select(F.col("id").alias("new"), F.col("component").alias("far")),
                                         ["new"], "id")
                             .select("id", F.least("new", "far").alias("component")), "labels")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows ``(id, text)`` of ``docs(id, text)``: all whose id is in ``ids(id)``, and a few others.

    A fixed-size bit table drops most other rows before their texts are
    shuffled; the caller's join on ``id`` drops the rest.
    """
    keep = T.BitFilter.of(ids, "id")

    def some(batches):
        for b in batches:
            hit = keep.has(pc.fill_null(b.column(0), 0).to_numpy(zero_copy_only=False))
            if hit.any():
                yield b.filter(pa.array(hit))

    return docs.select("id", "text").where(F.col("id").isNotNull()).mapInArrow(some, "id long, text string")


def examples(docs: DataFrame, labels: DataFrame, target: str, train, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled documents of each class, as rows of ``docs`` plus ``y``.

    The bounded sample a classifier is fitted on: the ids with the smallest
    hashes, so it is the same on every run. ``train`` is a condition on
    ``doc_id``. A document labelled more than once takes the majority; null
    labels and labels without a document are left out.
    """
    lab = (labels.select("doc_id", F.col(target).cast("double").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & train)
           .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = None
    for y in (0, 1):
        part = lab.where(F.col("y") == y).orderBy(*order).limit(per_class)
        pick = part if pick is None else pick.unionByName(part)
    # 2 * per_class rows of 12 bytes: a bounded broadcast
    return docs.drop("y").join(F.broadcast(pick), "doc_id")
