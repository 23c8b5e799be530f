"""valuora: fundamental-valuation analytics as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns); no table is
collected to the driver inside the library. Most functions are lazy. Those that
reuse a small derived table write it once when the plan is built
(``session.cut_lineage``), and ``materialize=False`` avoids that.

Main entry points (see README, "API")::

    from valuora import get_spark, FileModel, TestdataModel, single_market, multi_market
"""

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "valuora.session",
    "cluster_conf": "valuora.session",
    "TestdataModel": "valuora.plans.model",
    "FileModel": "valuora.plans.model",
    "single_market": "valuora.plans.jobs",
    "run_and_store": "valuora.plans.stored",
    "apply_day": "valuora.plans.stored",
    "daily_refresh": "valuora.plans.jobs",
    "multi_market": "valuora.operators.multimarket",
    "screener": "valuora.operators.screen",
    "sticker_price": "valuora.operators.valuation",
    "growth_rates": "valuora.operators.growth",
    "annual_price": "valuora.operators.prices",
    "latest_price": "valuora.operators.prices",
    "describe": "valuora.operators.profile",
    "column_profile": "valuora.operators.profile",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    """Lazy re-exports, so importing the package does not import PySpark modules."""
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'valuora' has no attribute {name!r}")
