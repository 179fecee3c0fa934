"""paneljet: region x period panels, lifecycle status, network coverage and panel regressions
as plain Spark DataFrame jobs.

Modules: ``functions.clean`` (P1-P20 column expressions), ``sources.io`` (S1-S7),
``operators.reshape`` / ``joins`` / ``agg`` / ``windows`` / ``lifecycle`` (R, J, A, W),
``operators.spatial`` / ``network`` / ``coverage`` (N1-N10, J13-J14), ``operators.econ``
(E1-E10), ``plans`` (registered queries on the driver tables).
"""

__version__ = "0.1.0"

__all__ = ["agg", "clean", "coverage", "econ", "io", "joins", "lifecycle", "network", "reshape",
           "spatial", "windows"]


def __getattr__(name):
    """Lazy access to the main modules: ``from paneljet import joins``."""
    import importlib

    places = {"clean": "paneljet.functions.clean", "io": "paneljet.sources.io"}
    if name in __all__:
        return importlib.import_module(places.get(name, f"paneljet.operators.{name}"))
    raise AttributeError(name)
