"""Dashboard filters: the per-column filter kinds, as lazy predicates.

A spec is (column, kind, arg): ``categorical`` keeps listed values,
``numeric`` and ``date`` keep an inclusive range, ``text`` keeps rows whose
value contains a regular expression match. NULLs never pass. ``choose_kind``
reproduces the automatic choice (fewer than 10 distinct values ->
categorical, then numeric, date, text) without a distinct count of a large column.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def coerce_datetimes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text columns that parse as timestamps become timezone-free timestamps."""
    return df.select(*[F.try_to_timestamp(F.col(c)).cast("timestamp_ntz").alias(c)
                       if c in cols else F.col(c) for c in df.columns])


FEW = 10   # a column with fewer distinct values is filtered by its values


def few_values(df: DataFrame, columns: list[str]) -> dict[str, bool]:
    """Whether each column has fewer than ``FEW`` distinct values, nulls aside.

    One aggregate sketches all columns, with a state of fixed size for each. Nine
    values fill nine registers of a sketch at most, for which its estimate (linear
    counting) is under ten, so a larger one decides. Columns left, whose values
    fill a handful of registers, are counted exactly in one aggregate of small sets.
    """
    if not columns:
        return {}
    col = lambda c: F.col(f"`{c}`")
    rough = df.agg(*[F.approx_count_distinct(col(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    open_ = [c for i, c in enumerate(columns) if rough[f"n{i}"] <= FEW]
    if not open_:
        return dict.fromkeys(columns, False)
    exact = df.agg(*[F.size(F.collect_set(col(c))).alias(f"n{i}") for i, c in enumerate(open_)]).first()
    found = {c: exact[f"n{i}"] < FEW for i, c in enumerate(open_)}
    return {c: found.get(c, False) for c in columns}


def choose_kind(df: DataFrame, column: str, few: bool | None = None) -> str:
    dtype = dict(df.dtypes)[column]
    if few_values(df, [column])[column] if few is None else few:
        return "categorical"
    if dtype in NUMERIC or dtype.startswith("decimal"):
        return "numeric"
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return "date"
    return "text"


def _bound(v) -> Column:
    """Literal bound; timestamps become timezone-free, independent of session and
    Python process time zones (dates are time-zone free already)."""
    if isinstance(v, _dt.datetime):
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(v)


def predicate(column: str, kind: str, arg) -> Column:
    c = F.col(column)
    if kind == "categorical":
        return c.isin(list(arg))
    if kind in ("numeric", "date"):
        lo, hi = arg
        return c.between(_bound(lo), _bound(hi))
    if kind == "text":
        return c.rlike(arg)
    raise ValueError(f"unknown filter kind {kind!r}")


def apply_filters(df: DataFrame, specs) -> DataFrame:
    for column, kind, arg in specs:
        df = df.where(predicate(column, kind, arg))
    return df


def auto_filters(df: DataFrame, args: dict) -> DataFrame:
    """Filter each column of ``args`` (column -> argument) by the kind ``choose_kind`` picks for it."""
    few = few_values(df, list(args))
    return apply_filters(df, [(c, choose_kind(df, c, few[c]), arg) for c, arg in args.items()])
