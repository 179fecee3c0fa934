"""Registered queries on the driver tables (composed outputs C1-C12 and operator checks)."""

from __future__ import annotations


def load_all():
    """Import every query module and return ``(queries, oracle_sql)``."""
    from . import catalog  # noqa: F401  (registers on import)
    from . import composed_queries, econ_queries, io_queries, network_queries, panel_queries  # noqa: F401

    return catalog.QUERIES, catalog.ORACLE
