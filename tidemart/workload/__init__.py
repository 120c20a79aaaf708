"""The operators applied to the provided tables, each with an independent SQL statement of the same result."""

from importlib import import_module

MODULES = (
    "semantics", "relational", "loading", "merging", "increments", "checking", "surface",
    "members", "credits", "traffic", "experiments", "stock", "money", "logistics", "facts", "mechanisms",
)


def registry():
    for name in MODULES:
        import_module(f"tidemart.workload.{name}")
    from tidemart.workload.base import REGISTRY

    return REGISTRY
