"""End-to-end builds and the queries over the synthetic tables."""


def load_queries():
    """``(queries, oracles)`` with every query module registered."""
    from importlib import import_module
    from pkgutil import iter_modules

    from regweave.plans import catalog

    for module in iter_modules(__path__):
        if module.name.startswith("queries_"):
            import_module(f"{__name__}.{module.name}")
    return catalog.QUERIES, catalog.ORACLES
