"""Named queries: each binds an operator or a plan to the tables, with its reference SQL."""

from __future__ import annotations

import importlib
import pkgutil

from millrace.catalog.registry import ENTRIES, Entry


def load() -> dict[str, Entry]:
    """Import every query module and return the registered entries by name."""
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
    return ENTRIES
