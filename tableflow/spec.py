"""Typed description of one job: session settings, sources, shaping and one target.

A spec comes from a plain dict (or its JSON text) of this shape; every key except
``source.mapping`` may be missing::

    {"spark-config": {"spark.sql.shuffle.partitions": "2000"},
     "source": {"mapping": [{"index": 1, "id": "o", "source": "hdfs", "format": "orc",
                             "location": "/data/orders", "columns": ["k", "v"],
                             "where": "v > 0", "join": "o"}],
                "where.clause": "k is not null",
                "add.columns": [["src_ind", "'N'"]],
                "select": ["k", "v"]},
     "target": {"place": "hdfs", "options": {"location": "/out", "format": "orc",
                                             "compression": "snappy", "mode": "overwrite"}},
     "metrics": {"location": "/runs"}}

Expression text stays text until the job runs. It is executed as Spark SQL, so a spec is trusted
code and must not come from an untrusted place.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

# Fixed value: the index of a source that states none, or states something that is no integer.
NO_INDEX = -9

_INT = re.compile(r"[+-]?[0-9]+")
_MISSING = object()


def lookup(tree: Any, path: str, default: Any = None) -> Any:
    """Value at a dotted path, whether its dots are nesting or part of a key."""
    value = _find(tree, path)
    return default if value is _MISSING or value is None else value


def _find(tree: Any, path: str) -> Any:
    if not isinstance(tree, Mapping):
        return _MISSING
    if path in tree:
        return tree[path]
    parts = path.split(".")
    for cut in range(len(parts) - 1, 0, -1):
        head = ".".join(parts[:cut])
        if head in tree:
            value = _find(tree[head], ".".join(parts[cut:]))
            if value is not _MISSING:
                return value
    return _MISSING


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _index(value: Any) -> int:
    text = _text(value)
    number = int(text) if _INT.fullmatch(text) else NO_INDEX
    return number if -(2**31) <= number < 2**31 else NO_INDEX


def _names(value: Any, what: str) -> list[str] | None:
    if value is None:
        return None
    if isinstance(value, str) or not isinstance(value, Sequence) or not value:
        raise ValueError(f"{what} must be a non-empty list, got {value!r}")
    return [str(item) for item in value]


def _settings(value: Any, what: str) -> dict[str, Any]:
    """A JSON object, given as a mapping or as JSON text; blank means empty."""
    if value is None or value == "":
        return {}
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except json.JSONDecodeError as error:
            raise ValueError(f"{what} is not valid JSON: {error}") from error
    if not isinstance(value, Mapping):
        raise ValueError(f"{what} must be a JSON object, got {value!r}")
    return dict(value)


@dataclass(frozen=True)
class SourceSpec:
    """One input relation and the text that joins it."""

    id: str
    source: str
    location: str = ""
    index: int = NO_INDEX
    join: str = ""
    format: str = ""
    where: str = ""
    column_family: str = ""
    transform: str = ""
    columns: list[str] | None = None
    custom: dict[str, Any] = field(default_factory=dict)
    schema: str = ""
    options: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, entry: Mapping[str, Any]) -> SourceSpec:
        name = _text(entry.get("id"))
        if not name.strip():
            raise ValueError(f"source without an id: {dict(entry)!r}")
        return cls(
            id=name,
            source=_text(entry.get("source")),
            location=_text(entry.get("location")),
            index=_index(entry.get("index")),
            join=_text(entry.get("join")),
            format=_text(entry.get("format")),
            where=_text(entry.get("where")),
            column_family=_text(lookup(entry, "column.family")),
            transform=_text(entry.get("transform")),
            columns=_names(entry.get("columns"), f"columns of source {name!r}"),
            custom=_settings(entry.get("custom"), f"custom of source {name!r}"),
            schema=_text(entry.get("schema")),
            options=_settings(entry.get("options"), f"options of source {name!r}"),
        )


@dataclass(frozen=True)
class TargetSpec:
    """The one place the result goes."""

    place: str
    plugin: str = ""
    options: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, entry: Mapping[str, Any]) -> TargetSpec:
        return cls(
            place=_text(entry.get("place")),
            plugin=_text(entry.get("class")),
            options=_settings(entry.get("options"), "target options"),
        )

    def require(self, *names: str) -> list[Any]:
        """Values of the named options; all of them must be there."""
        missing = [name for name in names if self.option(name) is None]
        if missing:
            raise ValueError(f"target {self.place!r} needs option(s): {', '.join(missing)}")
        return [self.option(name) for name in names]

    def option(self, name: str, default: Any = None) -> Any:
        return lookup(self.options, name, default)

    def flag(self, name: str) -> bool:
        """A boolean option, given as a boolean or as text; false when missing."""
        return as_flag(self.option(name, False))


def as_flag(value: Any) -> bool:
    """A boolean, given as a boolean or as text."""
    return str(value).strip().lower() in ("true", "yes", "on")


def _derived(value: Any) -> list[tuple[str, str]]:
    pairs = []
    for entry in value or []:
        if isinstance(entry, str) or not isinstance(entry, Sequence) or len(entry) != 2:
            raise ValueError(f"add.columns entries are [name, expression], got {entry!r}")
        pairs.append((str(entry[0]), str(entry[1])))
    return pairs


@dataclass(frozen=True)
class PipelineSpec:
    """A whole job."""

    sources: list[SourceSpec]
    where: str = ""
    add_columns: list[tuple[str, str]] = field(default_factory=list)
    select: list[str] | None = None
    target: TargetSpec | None = None
    settings: dict[str, str] = field(default_factory=dict)
    metrics: str = ""  # table or path that the counts of each run are added to

    @classmethod
    def from_dict(cls, tree: Mapping[str, Any]) -> PipelineSpec:
        mapping = lookup(tree, "source.mapping")
        if isinstance(mapping, str) or not isinstance(mapping, Sequence) or not mapping:
            raise ValueError("source.mapping must list at least one source")
        target = lookup(tree, "target")
        settings = _settings(lookup(tree, "spark-config"), "spark-config")
        return cls(
            sources=[SourceSpec.from_dict(entry) for entry in mapping],
            where=_text(lookup(tree, "source.where.clause")),
            add_columns=_derived(lookup(tree, "source.add.columns")),
            select=_names(lookup(tree, "source.select"), "source.select"),
            target=None if target is None else TargetSpec.from_dict(target),
            settings={key: _conf_text(value) for key, value in settings.items()},
            metrics=_text(lookup(tree, "metrics.location")),
        )

    @classmethod
    def from_json(cls, text: str) -> PipelineSpec:
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_file(cls, path: str) -> PipelineSpec:
        with open(path, encoding="utf-8") as handle:
            return cls.from_json(handle.read())


def _conf_text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)
