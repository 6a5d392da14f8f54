"""All registered queries of the package."""

from importlib import import_module

MODULES = ["native_queries", "dedup_queries", "vector_queries", "corpus_queries"]


def _load():
    for name in MODULES:
        import_module(f"{__package__}.{name}")
    return import_module(f"{__package__}.registry")


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLES)
