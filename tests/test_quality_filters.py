import datetime as dt

import pytest

from valuora.operators import filters as FL
from valuora.operators import quality as Q
from valuora.operators.profile import column_profile, describe


def test_assert_unique_and_report(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "ticker string, fy int")
    with pytest.raises(Q.DuplicateKeyError):
        Q.assert_unique(df, ["ticker", "fy"])
    Q.assert_unique(df.distinct(), ["ticker", "fy"])
    rep = Q.cardinality_report({"t": (df, ["ticker", "fy"])}).collect()
    assert [(r.check_name, r.key, r.n) for r in rep] == [("t", "A|1", 2)]


def test_dictionary_check_flags_split_names(spark, tmp):
    lines = ["table\tcolumn\tdtype\tsource\tdescription",
             "fundamental\tTicker\tobject\tvendor\tkey",
             "fundamental\tSelling\t General & Administrative\tvendor\tsee title",
             "fundamental\tRevenue\tfloat64\tvendor\tsee title",
             "fundamental\tGhost\tfloat64\tvendor\tnot in schema"]
    with open(f"{tmp}/dd.tsv", "w") as f:
        f.write("\n".join(lines) + "\n")
    from valuora.sources.files import read_data_dictionary
    dd = read_data_dictionary(spark, f"{tmp}/dd.tsv")
    out = {r.column: r.status for r in Q.dictionary_check(
        dd, {"fundamental": ["Ticker", "Revenue", "Selling, General & Administrative"]}).collect()}
    assert out == {"Ticker": "ok", "Selling, General & Administrative": "malformed",
                   "Revenue": "ok", "Ghost": "missing"}


def test_filters_each_kind(spark):
    df = spark.createDataFrame(
        [("AMERICA", 5.0, dt.date(2020, 1, 1), "Alpha Corp"), ("ASIA", 50.0, dt.date(2021, 1, 1), "Beta"),
         (None, None, None, None)],
        "market string, mos double, d date, name string")
    assert FL.apply_filters(df, [("market", "categorical", ["ASIA"])]).count() == 1
    assert FL.apply_filters(df, [("mos", "numeric", (1.0, 10.0))]).count() == 1
    assert FL.apply_filters(df, [("d", "date", (dt.date(2020, 6, 1), dt.date(2021, 6, 1)))]).count() == 1
    assert FL.apply_filters(df, [("name", "text", "^Al")]).count() == 1
    assert FL.choose_kind(df, "market") == "categorical"


def test_describe_matches_pandas_interpolation(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "mos double")
    out = {r.stat: r.value for r in describe(df, "mos", (0.1, 0.9)).collect()}
    import pandas as pd
    ref = pd.Series(vals).describe(percentiles=[0.1, 0.9])
    for k, v in ref.items():
        assert out[k] == pytest.approx(v), k


def test_column_profile(spark):
    df = spark.createDataFrame([(0.0, 1), (2.0, 1), (None, 3)], "a double, b int")
    p = {r.column_name: r for r in column_profile(df).collect()}
    assert p["a"].n == 3 and p["a"].n_missing == 1 and p["a"].n_zeros == 1
    assert p["b"].top_value == 1.0 and p["b"].top_freq == 2 and p["b"].p50 == 1.0


def test_data_dictionary_round_trip(spark):
    a = spark.createDataFrame([("A", 1.0)], "ticker string, mos double")
    dd = Q.data_dictionary({"growth": a})
    assert sorted((r.column, r.dtype) for r in dd.collect()) == [("mos", "double"), ("ticker", "string")]
    # an entry whose column is gone is reported as missing
    extra = dd.unionByName(spark.createDataFrame([("growth", "old_col", "double")], dd.schema))
    dd2 = extra.withColumn("dtype", Q.F.lit("float64")).withColumn("source", Q.F.lit("x")) \
        .withColumn("description", Q.F.lit("x"))
    st = {r.column: r.status for r in Q.dictionary_check(dd2, {"growth": a.columns}).collect()}
    assert st == {"ticker": "ok", "mos": "ok", "old_col": "missing"}


def test_describe_all_null_column_keeps_percentile_rows(spark):
    df = spark.createDataFrame([(None,), (None,)], "mos double")
    out = {r.stat: r.value for r in describe(df, "mos", (0.1,)).collect()}
    assert out["count"] == 0.0 and out["10%"] is None and out["50%"] is None and out["max"] is None


def test_cluster_conf_sizes():
    from valuora.session import cluster_conf
    c = cluster_conf(int(1e14), 1000, 4, 16)
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 ** 2
    assert int(c["spark.sql.shuffle.partitions"]) == 8000
    c = cluster_conf(int(1e14), 1000, 4, 16, shuffle_bytes=int(1e14))   # ingest: 256 MB a partition, no cap
    assert int(c["spark.sql.shuffle.partitions"]) == -(-int(1e14) // (256 * 1024 ** 2))
    small = cluster_conf(10 ** 9, 2, 4, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from valuora.session import NoSharedFolder, ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(NoSharedFolder):
        ensure_checkpoint_dir(Session())


def test_written_tables_can_be_dropped(spark):
    import os
    from valuora.session import _tables_folder, cut_lineage, remove_folder
    df = cut_lineage(spark.range(3), "probe")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and path.startswith(_tables_folder(spark).removeprefix("file:"))
    assert remove_folder(spark, path) and not os.path.exists(path)


def test_automatic_filters(spark):
    from valuora.operators.filters import auto_filters
    rows = [(f"name{i}", "ab"[i % 2], float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "name string, kind string, x double")
    out = auto_filters(df, {"kind": ["a"], "x": (3.0, 11.0), "name": "[02468]$"}).collect()
    assert sorted(r.x for r in out) == [4.0, 6.0, 8.0, 10.0]


def test_profile_of_text_and_empty_columns(spark):
    from valuora.operators.profile import column_profile
    df = spark.createDataFrame([("a", None, 1), ("b", None, 0), ("b", None, None)], "t string, u string, n int")
    out = {r.column_name: r for r in column_profile(df).collect()}
    assert (out["t"].top_text, out["t"].top_freq, out["t"].n_distinct, out["t"].min_text) == ("b", 2, 2, "a")
    assert (out["u"].n_missing, out["u"].n_distinct, out["u"].top_text) == (3, 0, None)
    assert (out["n"].n_zeros, out["n"].n_missing, out["n"].p50, out["n"].top_value) == (1, 1, 0.5, 0.0)


def test_schema_drift_shows_every_status(spark):
    from valuora.operators.quality import schema_drift
    dictionary = spark.createDataFrame(
        [("t", "a", "object"), ("t", "b", "int64"), ("t", "gone", "float64"), ("t", "split", " name"), ("other", "x", "object"),
         ("t", "a", "object"), ("t", "d", "datetime64[ns]"), ("t", "e", "double")], "table string, column string, dtype string")
    table = spark.createDataFrame([("x", 1.5, None, None, 2.0), ("y", None, None, 3, 1.0)],
                                  "a string, b double, d date, more int, e double")
    got = {(r.column, r.status): (r.declared, r.stored, r.n_filled) for r in schema_drift(dictionary, {"t": table}).collect()}
    assert got == {("a", "ok"): ("object", "string", 2), ("b", "changed_type"): ("int64", "double", 1),
                   ("gone", "missing"): ("float64", None, None), ("split, name", "malformed"): (None, None, None),
                   ("d", "ok"): ("datetime64[ns]", "date", 0), ("more", "extra"): (None, "int", 1),
                   ("e", "ok"): ("double", "double", 2)}


def test_few_values_is_exact_around_the_limit(spark):
    """Nine values are few, ten are not, whatever the type and beside nulls; a large column is not counted out."""
    from valuora.operators.filters import FEW, choose_kind, few_values
    rows = [(i % 9, str(i % 10), i, None if i % 2 else "x", i % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "nine int, ten string, all int, one string, eleven int")
    assert few_values(df, df.columns) == {"nine": True, "ten": False, "all": False, "one": True, "eleven": False}
    assert FEW == 10 and choose_kind(df, "ten") == "text" and choose_kind(df, "nine") == "categorical"
    assert few_values(df.limit(0), ["nine"]) == {"nine": True} and few_values(df, []) == {}
    for n in range(1, 10):  # the sketch's estimate of up to nine values never passes for ten or more
        for seed in range(5):
            some = spark.range(n).selectExpr(f"xxhash64(id, {seed}) AS v")
            assert few_values(some, ["v"]) == {"v": True}
