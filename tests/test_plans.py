"""Plan-shape checks: the physical plans we rely on at scale."""
from valuora.plans.registry import queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(spark, monkeypatch, name):
    """Plans of a query: of every table it writes on the way, and its own."""
    import valuora.session as S
    plans, cut = [], S.cut_lineage

    def spy(df, label="table"):
        df.write.format("noop").mode("overwrite").save()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, label)
    for module in ("valuora.plans.jobs", "valuora.operators.screen", "valuora.plans.model",
                   "valuora.operators.multimarket", "valuora.operators.profile"):
        monkeypatch.setattr(f"{module}.cut_lineage", spy)
    df = queries()[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return [*plans, plan(df)]


def test_scans_are_pruned(spark, monkeypatch):
    import re
    plans = written(spark, monkeypatch, "screener")
    reads = [s for p in plans for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "l_orderkey" in s]
    assert reads
    # the price scans read the order key, the date and at most the price -- nothing else of lineitem
    for s in reads:
        assert not any(c in s for c in ("l_quantity", "l_discount", "l_tax", "l_comment", "l_partkey")), s


def test_written_tables_have_sane_plans(spark, monkeypatch):
    for name in ("screener", "multi_market_growth", "column_profile", "latest_price"):
        for p in written(spark, monkeypatch, name):
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_nothing_forces_a_broadcast_of_data():
    """Only the fixed-size dimensions and single-row tables carry a hint."""
    import pathlib
    import re
    import valuora
    root = pathlib.Path(valuora.__file__).parent
    hints = {}
    for f in root.rglob("*.py"):
        if "llm" in f.relative_to(root).parts:
            continue
        n = len(re.findall(r"F\.broadcast\(", f.read_text()))
        if n:
            hints[str(f.relative_to(root))] = n
    assert hints == {"sources/adapters.py": 2, "sources/files.py": 1}


def test_fixed_dimensions_are_broadcast(spark):
    # the company adapter joins the fixed-size nation and region tables: always broadcast
    from valuora.sources import adapters as A
    p = plan(A.company_info(spark, SF))
    assert "BroadcastExchange" in p and "SortMergeJoin" not in p
