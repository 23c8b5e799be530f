"""The data dictionary of the result tables, as a file that earlier releases delivered.

Tab-separated like the dictionary that users keep beside their results: table,
column, type, source, description. It is checked against stored tables
(``quality.schema_drift``), which have moved on since: a column was dropped, one
was added, a count became a whole number, and one entry was split at its comma.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

KPI_SOURCE = "statements"
GROWTH = [f"{k}_{n}yr" for n in (5, 10) for k in
          ("roic_gr", "revenue_gr", "eps_gr", "bvps_gr", "fcf_gr", "pe", "yrs_in", "rule1_gr", "pe_default")]

ENTRIES = [
    *[("company_info", c, t, "company file") for c, t in (
        ("ticker", "object"), ("company_name", "object"), ("industry", "object"), ("sector", "object"),
        ("market", "object"), ("market_cap", "float64"), ("website", "object"), ("peer_string", "object"))],
    *[("fundamental", c, t, KPI_SOURCE) for c, t in (
        ("ticker", "object"), ("simfin_id", "int64"), ("currency", "object"), ("fiscal_year", "int64"),
        ("fiscal_period_is", "object"), ("report_date_is", "datetime64[ns]"), ("shares_basic_is", "float64"),
        ("revenue", "float64"), ("net_income", "float64"), ("fiscal_period_cf", "object"),
        ("report_date_cf", "datetime64[ns]"), ("shares_basic_cf", "float64"), ("net_cash_ops", "float64"),
        ("net_cash_inv", "float64"), ("dividends_paid", "float64"), ("fiscal_period", "object"),
        ("report_date", "datetime64[ns]"), ("shares_basic", "float64"), ("total_equity", "float64"),
        ("total_liab_equity", "float64"), ("dividends_paid_clean", "float64"), ("roic", "float64"),
        ("eps", "float64"), ("bvps", "float64"), ("fcf", "float64"), ("mean_low_price", "float64"), ("pe", "float64"),
        ("dividends paid", " cleaned"))],
    *[("growth", c, "object" if c == "ticker" else "float64", "growth") for c in (
        "ticker", "revenue_gr_curr", "eps_curr", *GROWTH, "pe_future", "eps_future", "price_future", "sticker_price", "mos")],
    *[("screener", c, t, "screener") for c, t in (
        ("ticker", "object"), ("last_date", "datetime64[ns]"), ("last_low_price", "float64"),
        ("price_future", "float64"), ("sticker_price", "float64"), ("mos", "float64"))],
]


def write_dictionary(spark: SparkSession, folder: str) -> str:
    """Write the dictionary file below ``folder``; returns its path."""
    path = f"{folder.rstrip('/')}/dictionary-{uuid.uuid4().hex}"
    rows = [(t, c, d, s, c.replace("_", " ")) for t, c, d, s in ENTRIES]
    names = ["table", "column", "dtype", "source", "description"]
    (spark.createDataFrame(rows, names).coalesce(1).write.option("header", True).option("sep", "\t")
        .option("ignoreLeadingWhiteSpace", False).csv(path))
    return path


def stored_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary, written as a file and read as one."""
    from valuora.sources.files import read_data_dictionary
    return read_data_dictionary(spark, write_dictionary(spark, folder))
