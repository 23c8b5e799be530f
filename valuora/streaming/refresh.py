"""Daily refresh as a file stream.

New price files land in a drop folder. Each micro-batch keeps, per ticker,
the rows of its latest date (ties kept) among the batch and the stored latest
table, writes that table back, and writes the screener from the static growth
table. As in the reference, where a download replaces a symbol's file, a
(ticker, date) that comes again replaces what is stored for it, so a file that
is delivered twice changes nothing. State is one small row set per ticker held
in a table (not in the streaming state store), so no watermark is needed and a
restarted query resumes from its checkpoint.

Both tables are versioned by epoch (``v=<epoch>``): a version is complete once
its ``_SUCCESS`` file exists, readers take the newest complete one
(``read_version``), and versions older than the one before are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora import schemas as SC
from valuora.operators.prices import latest_rows
from valuora.operators.screen import VALUATION_COLUMNS
from valuora.session import remove_folder

LATEST = "ticker string, date date, low double"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions under ``path``, oldest first (a folder listing: two or three entries)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    found = []
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version (older than epoch ``before``), None if there is none."""
    found = [v for v in _versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path.rstrip('/')}/v={found[-1]}") if found else None


def _write_version(df: DataFrame, path: str, epoch: int) -> DataFrame:
    """Write version ``epoch`` whole, then drop versions older than the one before it."""
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v={epoch}"
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(version)
    for old in [v for v in _versions(spark, path) if v < epoch][:-1]:
        remove_folder(spark, f"{path.rstrip('/')}/v={old}")
    return spark.read.parquet(version)


def refresh_batch(batch: DataFrame, epoch: int, growth: DataFrame, latest_path: str,
                  screener_path: str) -> None:
    """Merge one batch of price rows into the latest table and write the screener.

    A replayed batch rewrites its own version from the version before it.
    """
    spark = batch.sparkSession
    valued = growth.select(*VALUATION_COLUMNS).where(F.col("mos").isNotNull())
    new = (batch.select("ticker", "date", "low").join(valued.select("ticker"), "ticker", "left_semi")
           .dropDuplicates())
    new = latest_rows(new)
    stored = read_version(spark, latest_path, epoch)
    if stored is not None:
        kept = stored.join(new.select("ticker", "date").distinct(), ["ticker", "date"], "left_anti")
        new = latest_rows(kept.unionByName(new))
    latest = _write_version(new, latest_path, epoch)
    screen = (latest.join(valued, "ticker")
              .where(F.col("low") <= F.col("mos"))
              .select("ticker", F.col("date").alias("last_date"),
                      F.col("low").alias("last_low_price"), "price_future", "sticker_price", "mos")
              .na.drop())
    _write_version(screen, screener_path, epoch)


def start_refresh_stream(spark: SparkSession, drop_dir: str, growth: DataFrame,
                         latest_path: str, screener_path: str, checkpoint: str,
                         fmt: str = "csv", available_now: bool = True):
    """Start the stream over ``drop_dir``; returns the StreamingQuery."""
    reader = spark.readStream.schema(SC.RAW_PRICE).option("header", True)
    src = reader.format(fmt).load(drop_dir)
    src = src.select(*[F.col(f"`{c}`").alias(SC.PRICE_RENAMES[c]) for c in SC.RAW_PRICE.fieldNames()])
    w = (src.writeStream.foreachBatch(
            lambda df, epoch: refresh_batch(df, epoch, growth, latest_path, screener_path))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
