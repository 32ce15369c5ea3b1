"""Registered queries over the test tables and their SQL counterparts."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load_all() -> None:
    """Import the modules that register queries."""
    import importlib

    for name in ("relational", "indicators", "ranking", "fields", "quality", "series", "external", "storage", "jobs", "basics"):
        importlib.import_module(f"registry.{name}")
