"""Where sources plug in: protocols and the tables of what there is."""

from __future__ import annotations

import importlib
import pkgutil
import sys
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame

from lotline.operators.importers import SOURCES as CATALOG_SOURCES
from lotline.sources import listings, records


class ListingFeed(Protocol):
    """Landed pages to listing fields."""

    def __call__(self, pages: DataFrame, *args: object) -> DataFrame: ...


class RecordFeed(Protocol):
    """Landed rows to events or building fields."""

    def __call__(self, rows: DataFrame, *args: object) -> DataFrame: ...


class Enricher(Protocol):
    """Buildings to (bbl, own columns). ``join_key`` is bbl, point or area."""

    join_key: str
    columns: tuple[str, ...]

    def enrich(self, buildings: DataFrame) -> DataFrame: ...


LISTING_FEEDS: dict[str, Callable[..., DataFrame]] = listings.FEEDS
RECORD_FEEDS: dict[str, Callable[..., DataFrame]] = records.FEEDS
IMPORTERS = CATALOG_SOURCES


def discover(package: str, kind: str = "enrich") -> dict[str, object]:
    """Enrichers of all modules of a package; a module that fails to load is reported and passed over."""
    found: dict[str, object] = {}
    root = importlib.import_module(package)
    for m in pkgutil.iter_modules(root.__path__):
        try:
            module = importlib.import_module(f"{package}.{m.name}")
        except Exception as e:  # noqa: BLE001  one broken plug-in must not stop the others
            print(f"{m.name} is left out: {e}", file=sys.stderr)
            continue
        found |= {x.__name__: x for x in vars(module).values() if isinstance(x, type) and hasattr(x, kind) and x.__module__ == module.__name__}
    return found
