"""File sources: staged vendor files, dimension CSVs, result tables, file inventory.

All readers declare their schema (no inference pass) and normalise column
names to snake_case at the boundary. Directory reads are distributed: Spark
lists and splits the files; no driver-side file lists or loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora import schemas as SC
from valuora.sources import folders


def _normalise(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    renames = renames or {}
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, SC.snake(c))) for c in df.columns])


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Staged daily price CSVs (header, declared schema), e.g. a folder of one file per symbol."""
    df = spark.read.option("header", True).schema(SC.RAW_PRICE).csv(path)
    return _normalise(df, SC.PRICE_RENAMES)


def read_per_symbol_csv(spark: SparkSession, path: str) -> DataFrame:
    """Prices written by ``sinks.write_per_symbol_csv``: folders ``ticker=<symbol>`` of CSV files.

    Tasks list and read a local folder; the driver holds none of its files.
    """
    folder = folders.local(spark, path)
    if folder is None:
        return spark.read.option("header", True).schema(SC.PRICE).csv(path).select(*SC.PRICE.fieldNames())
    lines = folders.read_lines(folders.files_below(spark, folder))
    row = F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SC.PRICE.fields if f.name != "ticker"))
    return (lines.select(folders.folder_value(F.col("path"), "ticker").alias("ticker"), row.alias("r"))
            .select("ticker", "r.*").select(*SC.PRICE.fieldNames()))


def read_price_table(spark: SparkSession, path: str) -> DataFrame:
    """Price table written by ``sinks.write_price_table`` (Parquet, one folder per date)."""
    return spark.read.parquet(path).select(*SC.PRICE.fieldNames())


def ingest_price_files(spark: SparkSession, path: str) -> DataFrame:
    """Vendor files without a Ticker column: tag each row with its file's symbol.

    The symbol is the file name without extension (``_metadata.file_name``);
    empty files simply contribute no rows.
    """
    raw = (spark.read.option("header", True)
           .schema(_no_ticker_schema())
           .csv(path)
           .select("*", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
                   .alias("Ticker")))
    return _normalise(raw.select(*SC.RAW_PRICE.fieldNames()), SC.PRICE_RENAMES)


def _no_ticker_schema():
    from pyspark.sql import types as T
    return T.StructType([f for f in SC.RAW_PRICE.fields if f.name != "Ticker"])


def ingest_audit(price: DataFrame) -> DataFrame:
    """Per-symbol row count and date range of an ingest (symbols with rows are the valid ones)."""
    return price.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.min("date").alias("first_date"),
                                       F.max("date").alias("last_date"))


def valid_symbol_count(audit: DataFrame) -> DataFrame:
    return audit.agg(F.count(F.lit(1)).alias("n_valid_symbols"))


def read_symbol_directory(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated symbol directory; a trailing footer line has no symbol and falls out
    of every equality filter."""
    df = (spark.read.option("header", True).option("sep", "|")
          .schema(SC.RAW_SYMBOL_DIRECTORY).csv(path))
    return _normalise(df, {"Test Issue": "test_issue", "Financial Status": "financial_status",
                           "ETF": "etf", "NASDAQ Symbol": "nasdaq_symbol"})


def read_company_info(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .schema(SC.RAW_COMPANY_INFO).csv(path))
    return _normalise(df)


def read_peers(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).schema(SC.RAW_PEERS).csv(path)
    return df.withColumn("peer_list", F.split(F.col("peer_string"), ","))


def read_statement(spark: SparkSession, base: str, statement: str, market: str | None = None,
                   variant: str = "annual", fmt: str = "parquet", markets: DataFrame | None = None) -> DataFrame:
    """One statement from ``base/statement=<s>/variant=<v>/market=<m>/``.

    ``market`` and ``variant`` are partition columns, so the filters prune
    folders instead of reading them. ``markets(market_id)`` chooses markets by a
    table: a semi join on the partition column, which Spark turns into dynamic
    partition pruning, so files of other markets are never opened.
    """
    df = spark.read.format(fmt).option("header", True).load(base)
    df = df.where((F.col("statement") == statement) & (F.col("variant") == variant))
    if market is not None:
        df = df.where(F.col("market") == market)
    if markets is not None:
        df = df.join(markets.select(F.col("market_id").alias("market")), "market", "left_semi")
    return _normalise(df.drop("statement", "variant"))


def read_data_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("header", True).option("sep", "\t")
            .schema(SC.RAW_DATA_DICTIONARY).csv(path))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, file_name, size_bytes, modified) of every file under ``path``.

    ``binaryFile`` lists and stats the files in a distributed way; the content
    column is never selected, so no file body is read.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.select(F.col("path"),
                     F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     F.col("length").alias("size_bytes"),
                     F.col("modificationTime").alias("modified"))


def read_result_tables(spark: SparkSession, base: str,
                       names=("company_info", "fundamental", "growth", "screener")) -> dict[str, DataFrame]:
    """Stored result tables by name (Parquet folders under ``base``)."""
    return {n: spark.read.parquet(f"{base.rstrip('/')}/{n}") for n in names}


def read_snapshot(spark: SparkSession, base: str, table: str, date: str | None = None) -> DataFrame:
    """A dated snapshot of ``table`` from ``base/<table>/snapshot_date=.../``.

    ``date=None`` picks the latest snapshot: a metadata-only max over the
    partition column (answered from the folder names), then a pruned read.
    """
    df = spark.read.parquet(f"{base.rstrip('/')}/{table}")
    if date is None:
        latest = df.agg(F.max("snapshot_date").alias("d"))
        return df.join(F.broadcast(latest), df.snapshot_date == latest.d, "left_semi")
    return df.where(F.col("snapshot_date") == F.lit(date).cast("date"))
