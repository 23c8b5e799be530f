"""Ingest of per-symbol vendor files by manifest.

The manifest has a row per file: its symbol, size and time, and what reading it
gave (rows, date range, status). Files that hold no rows or cannot be read are
counted, not dropped, so a delivery's accounts add up. The next delivery is
compared with the stored manifest, and only files that are new or whose size or
time differ are read; their symbols replace what is stored of them, symbols
whose file is gone are removed, and all others stay as they are.

The table is laid out in buckets of symbols, and a change rewrites the buckets of
changed symbols only. A bucket is ranged by (ticker, date) when it is written, so
a symbol that holds a third of all rows is spread over tasks and files. Each
bucket is replaced whole and the manifest is written last: an ingest that breaks
off is repeated by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora import schemas as SC
from valuora.session import cut_lineage, remove_folder
from valuora.sources import folders

BUCKETS = 64  # of symbols in a table; a table of many TB takes more
FILE_NAME = r"([^/]*?)(?:\.[^./]*)?$"    # a file is named after its symbol
FOLDER = r"symbol=([^/]+)/[^/]*$"        # a folder is, and may hold several files
CORRUPT = "_unreadable"
HEADER = ",".join(f.name for f in SC.RAW_PRICE.fields if f.name != "Ticker")


def _plain(path: Column, encoded: bool = False) -> Column:
    """A path as every reader writes it: ``file:///a%20b`` and ``file:/a b`` are one."""
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    return F.regexp_replace(path, "^([a-z0-9]+):/+(?=[^/])", "$1:/")


def list_files(spark: SparkSession, path: str, pattern: str = FILE_NAME) -> DataFrame:
    """(file, ticker, size, modified) of all files below ``path``; no file is opened.

    Spark's scans pass over files without a byte; they are those of its file
    index that the scan does not list, and stand with size 0 and no time. So do
    those that tasks list.
    """
    folder = folders.local(spark, path)
    if folder is not None:
        time = F.timestamp_millis(F.when(F.col("size") > 0, F.col("ms")).otherwise(0))
        file = F.concat(F.lit("file:"), F.col("path"))
        return folders.files_below(spark, folder).select(file.alias("file"), "size", time.alias("modified"),
                                                         F.regexp_extract(file, pattern, 1).alias("ticker"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = found.select(_plain(F.col("path")).alias("file"), F.col("length").alias("size"),
                          F.col("modificationTime").alias("modified"))
    every = spark.createDataFrame([(f,) for f in found.inputFiles()], "f string").select(_plain(F.col("f"), True).alias("file"))
    none = every.join(listed, "file", "left_anti").select(
        "file", F.lit(0).cast("long").alias("size"), F.lit("1970-01-01").cast("timestamp").alias("modified"))
    return listed.unionByName(none).withColumn("ticker", F.regexp_extract("file", pattern, 1))


def _vendor_schema() -> T.StructType:
    return T.StructType([f for f in SC.RAW_PRICE.fields if f.name != "Ticker"]).add(CORRUPT, T.StringType())


def read_listed(files: DataFrame, pattern: str = FILE_NAME) -> DataFrame:
    """``read_files`` of local ``files`` (file, size): only they are opened."""
    lines = folders.read_lines(files.select(F.substring("file", len("file:") + 1, 2 ** 31 - 1).alias("path"), "size"))
    schema = _vendor_schema()
    row = F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields),
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    file = F.concat(F.lit("file:"), F.col("path"))
    return lines.select("path", row.alias("r")).select(
        *[F.col(f"r.`{f.name}`").alias(SC.PRICE_RENAMES.get(f.name, f.name)) for f in schema.fields],
        file.alias("file"), F.regexp_extract(file, pattern, 1).alias("ticker"))


def read_files(spark: SparkSession, path: str, pattern: str = FILE_NAME, since=None) -> DataFrame:
    """Rows of vendor files with their file, symbol and, if a line is no price row, that line.

    ``since``: leave out files that are older (they are not opened).
    """
    schema = _vendor_schema()
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("recursiveFileLookup", True).schema(schema))
    if since is not None:
        reader = reader.option("modifiedAfter", (since - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")).option(
            "timeZone", "UTC")
    raw = reader.csv(path)
    file = _plain(F.col("_metadata.file_path"), True)
    return raw.select(*[F.col(f"`{f.name}`").alias(SC.PRICE_RENAMES[f.name]) for f in schema.fields if f.name != CORRUPT],
                      F.col(CORRUPT), file.alias("file"), F.regexp_extract(file, pattern, 1).alias("ticker"))


def account(files: DataFrame, rows: DataFrame) -> DataFrame:
    """The manifest of ``files`` from their ``rows``.

    ``empty``: no rows. ``unreadable``: no line is a price row. ``partial``: some
    lines are none. ``loaded``: all are.
    """
    fine = F.col(CORRUPT).isNull() & F.col("date").isNotNull()
    read = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(F.when(fine, 1)).alias("n_rows"),
        F.min(F.when(fine, F.col("date"))).alias("first_date"), F.max(F.when(fine, F.col("date"))).alias("last_date"))
    n, good = F.coalesce("n_lines", F.lit(0)), F.coalesce("n_rows", F.lit(0))
    status = (F.when(n == 0, "empty").when(good == 0, "unreadable").when(good < n, "partial").otherwise("loaded"))
    return (files.join(read, "file", "left")
            .select("file", "ticker", "size", "modified", status.alias("status"), good.alias("n_rows"),
                    (n - good).alias("n_rejected"), "first_date", "last_date"))


def delivery_report(manifest: DataFrame) -> DataFrame:
    """(status, n_files, n_symbols, n_rows): the accounts of a delivery; ``valid`` counts files with rows."""
    per = manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct("ticker").alias("n_symbols"),
                                         F.sum("n_rows").alias("n_rows"))
    valid = manifest.where("n_rows > 0").agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct("ticker").alias("n_symbols"),
                                             F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return per.unionByName(valid.select(F.lit("valid").alias("status"), "*"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def read_manifest(spark: SparkSession, table: str) -> DataFrame | None:
    """The manifest stored with a table; None if the table was never ingested."""
    from valuora.streaming.refresh import read_version
    return read_version(spark, f"{table.rstrip('/')}_manifest")


def read_ingested(spark: SparkSession, table: str) -> DataFrame:
    """All price rows of the table."""
    return spark.read.parquet(table).select(*SC.PRICE.fieldNames())


def _price_ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SC.PRICE.fields)


def _read_since(spark: SparkSession, path: str, pattern: str, to_read: DataFrame) -> DataFrame:
    """Rows of all files as new as any of ``to_read``: files older than that are not listed."""
    since = to_read.where("size > 0").agg(F.min(F.date_format(F.to_utc_timestamp("modified", F.current_timezone()), "yyyy-MM-dd HH:mm:ss"))).first()[0]
    if since is None:
        return spark.createDataFrame([], f"{_price_ddl()}, {CORRUPT} string, file string")
    return read_files(spark, path, pattern, dt.datetime.fromisoformat(since))


def ingest(spark: SparkSession, path: str, table: str, pattern: str = FILE_NAME, buckets: int = BUCKETS) -> DataFrame:
    """Bring ``table`` up to the files below ``path``; returns the new manifest.

    ``replaced`` says whether a file's symbol was read anew. A symbol of several
    files is read whole when one of them changes. ``buckets`` belongs to the table:
    it must be the same for all of its ingests.
    """
    from valuora.streaming.refresh import _versions, _write_version
    files = cut_lineage(list_files(spark, path, pattern), "files")
    stored = read_manifest(spark, table)
    touched = files.select("ticker")
    if stored is not None:
        mark = ["file", "size", "modified"]
        new = files.join(stored.select(*mark), mark, "left_anti").select("ticker")
        gone = stored.join(files.select("file"), "file", "left_anti").select("ticker")
        touched = new.union(gone)
    touched = cut_lineage(touched.distinct().withColumn("bucket", _bucket(F.col("ticker"), buckets)), "touched")
    symbols = touched.select("ticker")
    to_read = files.join(symbols, "ticker", "left_semi")
    if folders.local(spark, path) is not None:
        rows = read_listed(to_read, pattern)
    else:
        rows = _read_since(spark, path, pattern, to_read).join(symbols, "ticker", "left_semi")
    rows = cut_lineage(rows, "ingested")
    manifest = account(to_read, rows).withColumn("replaced", F.lit(True))
    if stored is not None:
        kept = stored.join(symbols, "ticker", "left_anti").withColumn("replaced", F.lit(False))
        manifest = manifest.unionByName(kept)
    manifest = cut_lineage(manifest, "manifest")
    _replace(spark, table, rows, touched, buckets)
    done = _versions(spark, f"{table.rstrip('/')}_manifest")
    return _write_version(manifest, f"{table.rstrip('/')}_manifest", done[-1] + 1 if done else 0)


def _bucket(ticker: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(buckets)).cast("int")


def _replace(spark: SparkSession, table: str, rows: DataFrame, touched: DataFrame, n: int) -> None:
    """Rewrite the buckets of the touched symbols: their new rows, and the stored rows of all others."""
    buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # n at most
    content = rows.where(F.col(CORRUPT).isNull() & F.col("date").isNotNull()).select(*SC.PRICE.fieldNames())
    if _exists(spark, table):
        old = spark.read.parquet(table).where(F.col("bucket").isin(buckets))
        content = content.unionByName(old.join(touched.select("ticker"), "ticker", "left_anti").select(*content.columns))
    content = cut_lineage(content.withColumn("bucket", _bucket(F.col("ticker"), n)), "buckets")
    (content.repartitionByRange("bucket", "ticker", "date").sortWithinPartitions("bucket", "ticker", "date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table))
    left = {r["bucket"] for r in content.select("bucket").distinct().collect()}
    for b in buckets:
        if b not in left:  # its last symbol is gone
            remove_folder(spark, f"{table.rstrip('/')}/bucket={b}")
