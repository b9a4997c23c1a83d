"""End-to-end batch plan and the registered queries."""


def load_queries():
    """All registered queries and their SQL: ``(queries, oracles)``."""
    import importlib

    from changeflow.plans.registry import ORACLES, QUERIES

    for module in ("net_queries", "wire_queries", "log_queries", "stream_queries"):
        importlib.import_module(f"changeflow.plans.{module}")
    return dict(QUERIES), dict(ORACLES)
