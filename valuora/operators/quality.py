"""Data-quality checks as Spark queries (key uniqueness, symbol counts, coverage,
freshness, stage shapes, data-dictionary conformance)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count (map-side combined)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> None:
    """Raise when ``keys`` is not unique -- the merge-validation of the reference.

    Runs one aggregation job and fetches at most five offending keys.
    """
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise DuplicateKeyError(f"{name}: duplicate keys {keys}: {[r.asDict() for r in bad]}")


def one_row_per_key(df: DataFrame, keys: list[str], name: str = "table") -> DataFrame:
    """``df`` unchanged if ``keys`` are unique in it; else the query fails.

    The merge validation of the reference as part of the plan: the rows of a key
    are counted in a window over the very keys the following join needs, whose
    partitioning and order a sort-merge join reuses, and no extra job runs.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    said = F.concat(F.lit(f"{name}: duplicate keys {keys}: "), F.to_json(F.struct(*keys)))
    ok = F.when(F.col("_n") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_n", n).where(ok).drop("_n")


def cardinality_report(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(check_name, key, n) for every duplicated key of every named input."""
    parts = []
    for name, (df, keys) in checks.items():
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        parts.append(duplicate_keys(df, keys)
                     .select(F.lit(name).alias("check_name"), key.alias("key"), "n"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def symbol_counts(tables: dict[str, DataFrame], col: str = "ticker") -> DataFrame:
    """(table_name, n_symbols): distinct tickers per table."""
    parts = [df.agg(F.count_distinct(col).alias("n_symbols"))
             .select(F.lit(name).alias("table_name"), "n_symbols")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def coverage(wanted: DataFrame, tables: dict[str, DataFrame], col: str = "ticker") -> DataFrame:
    """(table_name, n_symbols): wanted symbols present in each table (semi join)."""
    w = wanted.select(F.col(wanted.columns[0]).alias(col))
    return symbol_counts({n: df.select(col).join(w, col, "left_semi") for n, df in tables.items()},
                         col)


def freshness(price: DataFrame, fundamental: DataFrame) -> DataFrame:
    """One row per table: the price date range and the fundamental fiscal-year range."""
    p = price.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")) \
        .select(F.lit("price").alias("table_name"), "*")
    f = fundamental.agg(F.min("fiscal_year").alias("min_fiscal_year"),
                        F.max("fiscal_year").alias("max_fiscal_year")) \
        .select(F.lit("fundamental").alias("table_name"), "*")
    return p.unionByName(f, allowMissingColumns=True)


def stage_shapes(stages: dict[str, DataFrame], col: str = "ticker") -> DataFrame:
    """(stage, n_rows, n_tickers) for each named step."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(col).alias("n_tickers"))
             .select(F.lit(name).alias("stage"), "n_rows", "n_tickers")
             for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


# type names a dictionary may hold: those of the files and those of written tables
KNOWN_DTYPES = ("object", "int64", "float64", "datetime64[ns]", "date", "string", "double",
                "bool", "int32", "int", "bigint", "boolean", "timestamp", "array<string>")


def dictionary_check(dictionary: DataFrame, schemas: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows of the data dictionary with their status.

    ``malformed``: the dtype field is not a type name -- a column name that
    contained a comma was split on it; the original name is rebuilt.
    ``missing``: a well-formed entry whose column is absent from the given schema.
    """
    ok_type = F.col("dtype").isin(*KNOWN_DTYPES)
    name = F.when(ok_type, F.col("column")).otherwise(F.concat_ws(",", "column", "dtype"))
    out = dictionary.select("table", name.alias("column"),
                            F.when(ok_type, F.col("dtype")).alias("dtype"),
                            F.when(ok_type, F.lit("ok")).otherwise(F.lit("malformed"))
                            .alias("status"))
    if schemas:
        known = [(t, c) for t, cols in schemas.items() for c in cols]
        spark = dictionary.sparkSession
        kdf = spark.createDataFrame(known, "table string, column string").withColumn("_k", F.lit(1))
        out = (out.join(kdf, ["table", "column"], "left")
               .withColumn("status", F.when((F.col("status") == "ok") & F.col("_k").isNull()
                                            & F.col("table").isin(list(schemas)), F.lit("missing"))
                           .otherwise(F.col("status")))
               .drop("_k"))
    return out


# type names of a dictionary file, and the types of written tables that they stand for
DICTIONARY_TYPES = {
    "object": ("string", "array<string>"), "string": ("string",), "int64": ("bigint", "int"), "float64": ("double",),
    "datetime64[ns]": ("date", "timestamp"), "date": ("date",), "bool": ("boolean",)}


def schema_drift(dictionary: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """A declared dictionary against stored tables, both ways.

    (table, column, declared, stored, status, n_filled), a row for every column
    that one side knows. ``missing``: declared, but not stored; ``extra``: stored,
    but not declared; ``changed_type``: stored under a type that the declared one
    does not stand for; ``malformed``: the entry has no type name (its column
    name held a separator; the name is put together again); ``ok`` otherwise.
    ``n_filled`` counts the rows that fill a stored column: one aggregate over
    each table. Only the given tables are compared; repeated entries count once.
    """
    spark = dictionary.sparkSession
    entries = (dictionary_check(dictionary).where(F.col("table").isin(list(tables)))
               .select("table", "column", F.col("dtype").alias("declared"), F.col("status").alias("entry")).distinct())
    filled = None
    for name, df in tables.items():
        part = (df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "n_filled")
                .withColumn("table", F.lit(name)))
        filled = part if filled is None else filled.unionByName(part)
    types = [(name, f.name, f.dataType.simpleString()) for name, df in tables.items() for f in df.schema.fields]
    stored = spark.createDataFrame(types, "table string, column string, stored string").join(filled, ["table", "column"])
    fits = F.lit(False)
    for declared, kinds in DICTIONARY_TYPES.items():
        fits = fits | ((F.col("declared") == declared) & F.col("stored").isin(list(kinds)))
    fits = fits | (F.col("declared") == F.col("stored"))
    status = (F.when(F.col("entry") == "malformed", "malformed").when(F.col("stored").isNull(), "missing")
              .when(F.col("entry").isNull(), "extra").when(fits, "ok").otherwise("changed_type"))
    return (entries.join(stored, ["table", "column"], "full")
            .select("table", "column", "declared", "stored", status.alias("status"), "n_filled"))


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, dtype) of each result table, from the schemas (no data read).

    The same shape as the dictionary file ``dictionary_check`` validates, so a
    written dictionary can be checked against the tables it describes.
    """
    rows = [(name, f.name, f.dataType.simpleString())
            for name, df in tables.items() for f in df.schema.fields]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table string, column string, dtype string")
