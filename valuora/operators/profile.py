"""Column statistics: ``describe`` with percentiles and a per-column profile.

Quantiles and most frequent values come from one (column, value, count)
aggregate, which combines map-side, so a value that fills a third of a column
is one row. Percentiles are exact with pandas' linear interpolation and fully
distributed (``exact_quantiles``): no task ever holds a whole column.
``exact=False`` uses ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from valuora.session import cut_lineage, together


def value_counts(long: DataFrame, key: str = "column_name", value: str = "value") -> DataFrame:
    """(k, v, c): how often each non-NULL value of each key occurs."""
    return (long.where(F.col(value).isNotNull())
            .groupBy(F.col(key).alias("k"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c")))


def exact_quantiles(long: DataFrame, qs, key: str = "column_name",
                    value: str = "value") -> DataFrame:
    """Exact quantiles per ``key`` with linear interpolation: (key, q, quantile)."""
    return quantiles_of_counts(value_counts(long, key, value), qs).withColumnRenamed("k", key)


def quantiles_of_counts(counts: DataFrame, qs) -> DataFrame:
    """Exact quantiles of weighted values ``counts(k, v, c)``: (k, q, quantile).

    For n values of a key, quantile q lies at rank h = (n - 1) q between the
    values of ranks floor(h) and ceil(h). The distinct values are sorted into
    ranges and written once *with the range they fell into*, so every later use
    sees the same ranges whatever the planner does: the running count inside a
    range plus the counts of the ranges before it gives the ranks each value
    holds, and the values that hold a wanted rank are picked out.
    """
    qs = sorted(set(float(q) for q in qs))
    s = cut_lineage(counts.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id()), "ranges")
    per = s.groupBy("k", "part").agg(F.sum("c").alias("c"))   # one row per key and range
    wk = Window.partitionBy("k").orderBy("part")
    per = (per.withColumn("base", F.coalesce(F.sum("c").over(
                wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("n", F.sum("c").over(Window.partitionBy("k"))))
    inside = (Window.partitionBy("k", "part").orderBy("v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (s.withColumn("upto", F.sum("c").over(inside)).join(per.select("k", "part", "base", "n"), ["k", "part"])
              .select("k", "v", "n", (F.col("base") + F.col("upto") - F.col("c")).alias("low"),
                      (F.col("base") + F.col("upto") - 1).alias("high")))
    # a value holds the ranks low..high: keep, per wanted rank, whether it is among them
    wants = F.array(*[F.struct(F.lit(q).alias("q"), ((F.col("n") - 1) * F.lit(q)).alias("h")) for q in qs])
    hit = (ranked.withColumn("w", F.explode(wants))
           .select("k", "v", "w.q", "w.h",
                   F.floor("w.h").between(F.col("low"), F.col("high")).alias("is_lo"),
                   F.ceil("w.h").between(F.col("low"), F.col("high")).alias("is_hi"))
           .where("is_lo or is_hi"))
    g = hit.groupBy("k", "q").agg(F.max("h").alias("h"), F.max(F.when(F.col("is_lo"), F.col("v"))).alias("lo"),
                                 F.max(F.when(F.col("is_hi"), F.col("v"))).alias("hi"))
    d = F.col("h") - F.floor("h")
    return g.select("k", "q", F.when(d == 0, F.col("lo"))
                    .otherwise(F.col("lo") + d * (F.col("hi") - F.col("lo"))).alias("quantile"))


DEFAULT_PERCENTILES = (0.25, 0.5, 0.75)


def pct_label(p: float) -> str:
    """0.03 -> '3%', 0.5 -> '50%' (pandas describe labels)."""
    v = round(p * 100, 6)
    return f"{int(v)}%" if v == int(v) else f"{v:g}%"


def _percentiles(ps) -> list[float]:
    ps = sorted(set(list(ps) + [0.5]))
    return ps


def describe(df: DataFrame, col: str, percentiles=DEFAULT_PERCENTILES,
             exact: bool = True) -> DataFrame:
    """(pos, stat, value) rows: count, mean, std (sample), min, percentiles, max; NULLs ignored."""
    ps = _percentiles(percentiles)
    # the one column is read by the moments, the range sample and the quantile
    # shuffle: write it once instead of replaying its plan three times
    long = cut_lineage(df.select(F.lit(col).alias("column_name"),
                                 F.col(col).cast("double").alias("value")), "describe")
    c = F.col("value")
    moments = long.agg(F.count(c).cast("double").alias("count"), F.avg(c).alias("mean"),
                       F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    head = [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min")]
    arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("stat"),
                             F.col(c_).cast("double").alias("value"))
                    for i, (n, c_) in enumerate(head + [("max", "max")])])
    rows = moments.select(F.explode(arr).alias("s")).select("s.pos", "s.stat", "s.value")
    rows = rows.withColumn("pos", F.when(F.col("stat") == "max", F.lit(len(head) + len(ps)))
                           .otherwise(F.col("pos")))
    labels = F.create_map(*[x for i, p in enumerate(ps)
                            for x in (F.lit(float(p)), F.lit(pct_label(p)))])
    order = F.create_map(*[x for i, p in enumerate(ps)
                           for x in (F.lit(float(p)), F.lit(len(head) + i))])
    if exact:
        q = exact_quantiles(long, ps)
    else:
        q = (long.agg(F.percentile_approx(c, [float(p) for p in ps], 100000).alias("a"))
             .select(F.posexplode("a").alias("i", "quantile"))
             .select(F.element_at(F.array(*[F.lit(float(p)) for p in ps]), F.col("i") + 1)
                     .alias("q"), "quantile"))
    # every requested percentile gets a row, NULL when the column has no values
    wanted = moments.select(F.explode(F.array(*[F.lit(float(p)) for p in ps])).alias("q"))
    q = wanted.join(q.select("q", "quantile"), "q", "left")
    qrows = q.select(order[F.col("q")].alias("pos"), labels[F.col("q")].alias("stat"),
                     F.col("quantile").alias("value"))
    return rows.unionByName(qrows)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (schema scan, no data read)."""
    num = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [n for n, t in df.dtypes if t in num or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in ("string", "date", "timestamp", "timestamp_ntz", "boolean")]


def column_profile(df: DataFrame, cols: list[str] | None = None, stored: bool = False) -> DataFrame:
    """One row per column, numeric and other.

    Numeric columns: n, missing, missing %, distinct, zeros, min, max, mean,
    std, quartiles and the most frequent value (ties -> smallest value). Text,
    date and boolean columns: n, missing, missing %, distinct, smallest, largest
    and most frequent value as text (``*_text``). The moments are one wide
    aggregate over the source; everything else comes from one written
    (column, value, count) aggregate, so the source is never blown up to a row
    per cell on disk. Several aggregates read the source, so a computed one is
    written first; ``stored`` says that ``df`` reads a written table already.
    """
    wanted = cols or df.columns
    num = [c for c in numeric_columns(df) if c in wanted]
    txt = [c for c in text_columns(df) if c in wanted]
    if not num and not txt:
        raise ValueError("no column to profile")
    if not stored:
        df = cut_lineage(df.select(*[F.col(f"`{c}`") for c in [*num, *txt]]), "profiled")
    parts = together(*[lambda f=f, c=c: f(df, c) for f, c in ((_numeric_profile, num), (_text_profile, txt)) if c])
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    for c, t in [(c, "double") for c in _NUMERIC] + [(c, "string") for c in _TEXT]:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return out.select("column_name", "n", "n_missing", "missing_pct", "n_distinct", "n_zeros", *_NUMERIC,
                      *_TEXT, "top_freq")


_NUMERIC = ("min", "max", "mean", "std", "p25", "p50", "p75", "top_value")
_TEXT = ("min_text", "max_text", "top_text")


def _counted(df: DataFrame, cols: list[str], kind: str) -> DataFrame:
    long = df.select(*[F.col(c).cast(kind).alias(c) for c in cols]).unpivot([], cols, "column_name", "value")
    return cut_lineage(value_counts(long), "profile")


def _from_counts(counts: DataFrame) -> DataFrame:
    """Distinct values and the most frequent one of each column."""
    return counts.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_distinct"), F.sum("c").alias("n_filled"),
        F.max("c").alias("top_freq"))


def _top(counts: DataFrame, per: DataFrame) -> DataFrame:
    """The smallest of the most frequent values of each column."""
    return (counts.join(per.select("k", F.col("top_freq").alias("c")), ["k", "c"])
            .groupBy("k").agg(F.min("v").alias("top")))


def _rows(df: DataFrame, exprs: dict[str, list]) -> DataFrame:
    """One wide aggregate over ``df``, turned into a row per column."""
    flat = [e.alias(f"{c}|{n}") for c, es in exprs.items() for n, e in es]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *flat)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n"),
                              *[F.col(f"`{c}|{n}`").alias(n) for n, _ in es]) for c, es in exprs.items()])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def _missing(out: DataFrame) -> DataFrame:
    return (out.withColumn("n_missing", F.col("n") - F.coalesce("n_filled", F.lit(0)))
            .withColumn("missing_pct", F.try_divide(F.col("n_missing") * 100.0, F.col("n")))
            .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0))).drop("n_filled"))


def _numeric_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    d = {c: F.col(f"`{c}`").cast("double") for c in cols}
    base = _rows(df, {c: [("n_zeros", F.count(F.when(x == 0, 1))), ("min", F.min(x)), ("max", F.max(x)),
                          ("mean", F.avg(x)), ("std", F.stddev_samp(x))] for c, x in d.items()})
    counts = _counted(df, cols, "double")
    per = _from_counts(counts)
    quart = (quantiles_of_counts(counts, (0.25, 0.5, 0.75)).groupBy("k")
             .agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name)
                    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]))
    side = per.join(quart, "k", "left").join(_top(counts, per), "k", "left")
    return _missing(base.join(side.withColumnRenamed("k", "column_name"), "column_name", "left")
                    .withColumnRenamed("top", "top_value"))


def _text_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    base = _rows(df, {c: [("min_text", F.min(F.col(f"`{c}`").cast("string"))),
                          ("max_text", F.max(F.col(f"`{c}`").cast("string")))] for c in cols})
    counts = _counted(df, cols, "string")
    per = _from_counts(counts)
    side = per.join(_top(counts, per), "k", "left")
    return _missing(base.join(side.withColumnRenamed("k", "column_name"), "column_name", "left")
                    .withColumnRenamed("top", "top_text").withColumn("n_zeros", F.lit(None).cast("long")))
