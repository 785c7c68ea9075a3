"""Registered queries over the test tables."""

import importlib
import pkgutil


def load_all() -> None:
    """Import every plan module so its queries are registered."""
    for mod in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if mod != "registry":
            importlib.import_module(f"{__name__}.{mod}")
