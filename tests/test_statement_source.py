"""Statements stored by statement, variant and market: only the folders that are wanted are opened."""
import glob

from pyspark.sql import functions as F

from valuora.operators.multimarket import kept_markets
from valuora.plans.model import TestdataModel
from valuora.plans.registry import _stored_statements
from valuora.sources.files import read_statement

SF = "/root/testdata/sf0.001"


def test_other_markets_and_variants_are_never_opened(spark):
    out, columns = _stored_statements(spark, SF)
    m = TestdataModel(spark, SF)
    kept = kept_markets(m.markets, ("MIDDLE EAST",))
    # files of what is left out cannot be read at all
    for f in glob.glob(f"{out.removeprefix('file:')}/*/*/*/part-*"):
        if "market=MIDDLE" in f or "variant=restated" in f:
            with open(f, "wb") as broken:
                broken.write(b"no parquet file")
    # markets named by a table: its own filter on another column prunes at run time
    chosen = f"{out}-chosen"
    m.markets.withColumn("active", F.when(F.col("market_id") != "MIDDLE EAST", 1).otherwise(0)).write.parquet(chosen)
    active = spark.read.parquet(chosen).where("active = 1")
    for name, cols in columns.items():
        df = read_statement(spark, out, name, markets=active)
        assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == read_statement(spark, out, name, markets=kept).count()
        # markets named by a rule on their name
        df = read_statement(spark, out, name, markets=kept)
        got = sorted(map(tuple, df.select(*cols, "market").collect()), key=repr)
        want = getattr(m, name).join(m.ticker_market, "ticker").where("market <> 'MIDDLE EAST'")
        assert got == sorted(map(tuple, want.select(*cols, "market").collect()), key=repr) and got
