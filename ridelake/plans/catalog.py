"""All registered queries and oracle statements, by key."""

from __future__ import annotations

import importlib

_MODULES = ["models", "adhoc", "quality", "io", "loads", "incremental", "streams"]


def _load():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(f"ridelake.plans.{name}")
        for key, fn in mod.QUERIES.items():
            if key in queries:
                raise ValueError(f"duplicate query key {key}")
            queries[key] = fn
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
