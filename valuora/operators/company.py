"""Company side: symbol universe, company info, peers and enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuora.operators.quality import one_row_per_key


def symbol_universe(directory: DataFrame) -> DataFrame:
    """Tradable symbols: no test issue, financial status missing or 'N', no ETF."""
    fs = F.col("financial_status")
    return (directory.where((F.col("test_issue") == "N")
                            & (fs.isNull() | (fs == "N"))
                            & (F.col("etf") == "N"))
            .select(F.col("nasdaq_symbol").alias("ticker")))


def symbol_funnel(directory: DataFrame) -> DataFrame:
    """Symbol counts before and after each directory filter, in one scan."""
    fs = F.col("financial_status")
    s1 = F.col("test_issue") == "N"
    s2 = s1 & (fs.isNull() | (fs == "N"))
    s3 = s2 & (F.col("etf") == "N")
    return directory.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(s1, 1)).alias("n_not_test"),
        F.count(F.when(s2, 1)).alias("n_not_bankrupt"),
        F.count(F.when(s3, 1)).alias("n_not_etf"))


def company_info_for(company: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """Company info, optionally narrowed to a symbol frame (None = all, the '_all' case)."""
    if symbols is None:
        return company
    s = symbols.select(F.col(symbols.columns[0]).alias("ticker"))
    return company.join(s, "ticker", "left_semi")


def peer_string_agg(pairs: DataFrame) -> DataFrame:
    """(ticker_key, peer_key) pairs -> (ticker, peer_string) ordered by peer key.

    Lists are built as sets, in part before the only shuffle, so a list holds each
    peer once however often a pair comes: it is as long as the string it becomes.
    """
    g = pairs.groupBy("ticker_key").agg(F.array_sort(F.collect_set("peer_key")).alias("p"))
    return g.select(F.col("ticker_key").cast("string").alias("ticker"),
                    F.array_join(F.transform("p", lambda x: x.cast("string")), ",")
                    .alias("peer_string"))


def with_peer_list(peers: DataFrame) -> DataFrame:
    """Adds ``peer_list = split(peer_string, ',')`` (NULL in, NULL out)."""
    return peers.withColumn("peer_list", F.split(F.col("peer_string"), ","))


def company_with_peers(company: DataFrame, peers: DataFrame) -> DataFrame:
    """company LEFT JOIN peers on ticker; a repeated ticker on either side fails the query."""
    return one_row_per_key(company, ["ticker"], "company_info").join(
        with_peer_list(one_row_per_key(peers, ["ticker"], "peers")), "ticker", "left")


def enrich(df: DataFrame, company: DataFrame) -> DataFrame:
    """Left join company attributes onto a result table by ticker (m:1, else the query fails)."""
    return df.join(one_row_per_key(company, ["ticker"], "company_info"), "ticker", "left")
