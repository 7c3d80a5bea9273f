"""Training-data operators: each module holds one operator and the query that applies it."""

import sys

from pyspark import cloudpickle

# Task functions of this subpackage travel whole, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load_queries():
    """``(queries, oracles)`` with every query module of this subpackage registered."""
    from importlib import import_module
    from pkgutil import iter_modules

    from regweave.llm import catalog

    for module in iter_modules(__path__):
        import_module(f"{__name__}.{module.name}")
    return catalog.QUERIES, catalog.ORACLES
