"""All registered queries."""

from importlib import import_module

MODULES = ["statement_queries", "kpi_queries", "projection_queries", "source_queries", "join_queries", "dq_queries", "governance_queries",
           "detection_queries", "stream_queries"]


def _load():
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")


def queries():
    registry = _load()
    return {key: registry.as_callable(fn) for key, fn in registry.QUERIES.items()}


def oracle_sql():
    return dict(_load().ORACLES)
