"""Final (adaptive) physical plans of the headline queries, summarised -> PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Each query, and each table it writes on the way, is executed JVM-side (no rows
to Python) so the adaptive plan is final.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["price_stats", "annual_price_mean", "latest_price", "growth_rates_mean", "screener",
           "multi_market_growth", "dq_symbol_counts", "peer_string_agg", "column_profile", "daily_refresh"]

COUNT = [("shuffle exchanges", r"(?<![A-Za-z])Exchange \(\d+\)"),
         ("broadcast exchanges", r"BroadcastExchange \("), ("reused exchanges", r"ReusedExchange \("),
         ("sort-merge joins", r"SortMergeJoin"), ("broadcast hash joins", r"BroadcastHashJoin"),
         ("hash aggregates", r"HashAggregate"), ("windows", r"\bWindow\b"),
         ("cartesian / nested-loop", r"CartesianProduct|BroadcastNestedLoopJoin"),
         ("python UDF nodes", r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas")]


# where cut_lineage is called: the report sees every written table
MODULES = ["valuora.plans.jobs", "valuora.operators.screen", "valuora.operators.prices",
           "valuora.operators.multimarket", "valuora.operators.profile"]


def summarise(spark, df, title: str) -> None:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                      # execute JVM-side so the adaptive plan is final
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(qe, "formatted")
    tree, _, details = text.partition("\n\n\n")
    tree = tree.split("== Initial Plan ==")[0]
    print(f"### {title}\n")
    found = [(label, len(re.findall(pat, tree))) for label, pat in COUNT]
    print("- " + ", ".join(f"{label} {n}" for label, n in found if n))
    seen: dict[tuple, None] = {}
    for block in details.split("\n\n"):
        block = block.strip()
        if "Scan parquet" not in block.split("\n")[0]:
            continue
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        schema = re.search(r"ReadSchema: (\S+)", block)
        table = re.sub(r"-[0-9a-f]{32}$", "", loc.group(1).rstrip("/").split("/")[-1]) if loc else "?"
        key = (table, pushed and pushed.group(1), schema and schema.group(1))
        seen[key] = None
    for table, pushed, schema in seen:
        print(f"- scan `{table}`: read {schema}; pushed [{pushed or ''}]")
    print()


def main() -> None:
    import importlib

    import valuora.session as S
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from valuora.plans.registry import queries
    spark = S.get_spark("local[8]", shuffle_partitions=16)
    qs = queries()
    print(f"# Physical plans of the headline queries ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Generated by `python tools/plan_report.py`. Every query is shown with each small table it writes on "
          "the way (`session.cut_lineage`), in the order they run, so all scans of the given tables and all "
          "joins behind them appear.\n")
    print("How to read it: prices are `lineitem` joined to `orders` on the order key (a sort-merge join when "
          "neither side is under the broadcast threshold); the given data have no price table, `ingest` writes "
          "one. Scans of `fundamental`, `latest_dates`, `valued`, `mm_*`, `profile` and `ranges` read the "
          "written tables. Cartesian products and Python UDF nodes never appear.\n")
    written = []
    cut = S.cut_lineage

    def spy(df, name="table"):
        written.append(name)
        summarise(spark, df, f"writes `{name}`")
        return cut(df, name)
    for m in MODULES:
        importlib.import_module(m).cut_lineage = spy
    for name in QUERIES:
        print(f"## {name}\n")
        summarise(spark, qs[name](spark, sf_dir), "result")
    S.drop_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
