"""Query catalogue: each operator run on the given tables, with independent SQL for the same answer."""

from importlib import import_module

MODULES = ("scalars", "warehouse", "changes", "checks", "feeds", "runs")


def load() -> None:
    """Import the query modules, which register their queries."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
