"""User-supplied sources and sinks, by registered name or import path."""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable
from typing import Any

from pyspark.sql.datasource import DataSource

# Names that select the built-in reader or writer.
BUILT_IN = ("", "default")

_registry: dict[str, Any] = {}


def register(name: str, plugin: Any = None) -> Any:
    """Register a callable or class; usable as ``@register("name")``."""
    if plugin is None:
        return lambda item: register(name, item)
    if name.strip() in BUILT_IN:
        raise ValueError(f"{name!r} selects the built-in and cannot be registered")
    _registry[name] = plugin
    return plugin


def is_built_in(name: str | None) -> bool:
    return name is None or name.strip() in BUILT_IN


def data_source(name: str) -> type[DataSource] | None:
    """The class behind a plug-in name if it is one of Spark's Python data sources, else None."""
    plugin = _registry[name] if name in _registry else _import(name)
    return plugin if inspect.isclass(plugin) and issubclass(plugin, DataSource) else None


def resolve(name: str, method: str) -> Callable:
    """The callable behind a plug-in name.

    A class is instantiated, and an object with the wanted method (``transform`` for sources,
    ``save`` for sinks) contributes that method; anything else must be callable itself.
    """
    plugin = _registry[name] if name in _registry else _import(name)
    if inspect.isclass(plugin):
        plugin = plugin()
    plugin = getattr(plugin, method, plugin)
    if not callable(plugin):
        raise LookupError(f"plug-in {name!r} has no callable {method!r}")
    return plugin


def _import(path: str) -> Any:
    module, _, attribute = path.replace(":", ".").rpartition(".")
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError, ValueError) as error:
        raise LookupError(f"plug-in {path!r} is neither registered nor importable") from error
