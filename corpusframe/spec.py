"""Load specs: driver-side configuration, validated before any Spark job starts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

PATH_STRATEGIES = ("direct", "exact", "contains")


class SpecError(ValueError):
    """A load spec that cannot be used."""


@dataclass(frozen=True)
class ColumnSpec:
    """How one output column is made from one source column."""

    source_column: str | int
    dtype: str = "string"
    optional: bool = False
    path_match_strategy: str = "direct"
    file_extension: str | None = None
    path_template: str | None = None

    def __post_init__(self) -> None:
        if self.path_match_strategy not in PATH_STRATEGIES:
            raise SpecError(
                f"path_match_strategy must be one of {PATH_STRATEGIES}, "
                f"got {self.path_match_strategy!r}"
            )

    @property
    def is_path(self) -> bool:
        return self.dtype in ("file_path", "file_content")


@dataclass(frozen=True)
class LoadSpec:
    """Where a corpus keeps its index, sidecars and media, and what its columns mean."""

    dataset_id: str
    task: str
    format: str | None = None
    index_file: str | None = None
    base_audio_path: str | list[str] | None = None
    columns: Mapping[str, ColumnSpec] = field(default_factory=dict)
    separator: str | None = None
    has_header: bool = True
    encoding: str = "utf-8"
    root_strategy: str | None = None
    file_pattern: str | None = None
    audio_extension: str | None = None
    content_mapping: Mapping[str, Any] | None = None
    record_path: str | None = None
    splits: list[str] | None = None
    splits_file_pattern: str | None = None
    sections: list[str] | None = None
    section_root: str | None = None
    extract_files: list[str] | None = None
    checksum: str | None = None
    extra: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> LoadSpec:
        if not isinstance(raw, Mapping):
            raise SpecError(f"a load spec must be a mapping, got {type(raw).__name__}")
        missing = [k for k in ("dataset_id", "task") if not raw.get(k)]
        if missing:
            raise SpecError(f"load spec lacks {missing}")
        known = {f.name for f in fields(cls)} - {"extra"}
        values = {k: v for k, v in raw.items() if k in known}
        values["dataset_id"] = str(raw["dataset_id"])
        values["task"] = str(raw["task"]).upper()
        values["columns"] = _column_specs(raw.get("columns"))
        if not isinstance(values.get("content_mapping"), Mapping):
            values["content_mapping"] = None
        return cls(**values, extra={k: v for k, v in raw.items() if k not in known})

    @classmethod
    def from_yaml(cls, source: str | Path) -> LoadSpec:
        import yaml  # optional dependency: only YAML specs need it

        text = source.read_text(encoding="utf-8") if isinstance(source, Path) else source
        return cls.from_dict(yaml.safe_load(text))

    @property
    def media_roots(self) -> list[str]:
        """Declared media roots; "" stands for the dataset root."""
        declared = self.base_audio_path
        if declared is None:
            return [""]
        listed = list(declared) if isinstance(declared, (list, tuple)) else [declared]
        return [root or "" for root in listed] or [""]

    def require(self, *names: str) -> None:
        absent = [name for name in names if not getattr(self, name)]
        if absent:
            raise SpecError(
                f"{self.task} spec '{self.dataset_id}' with root_strategy="
                f"{self.root_strategy!r} must specify {absent}"
            )


def _column_specs(raw: Any) -> dict[str, ColumnSpec]:
    if not isinstance(raw, Mapping):
        return {}
    allowed = {f.name for f in fields(ColumnSpec)}
    specs = {}
    for name, entry in raw.items():
        if isinstance(entry, ColumnSpec):
            specs[name] = entry
        elif isinstance(entry, Mapping):
            if "source_column" not in entry:
                raise SpecError(f"column '{name}' has no source_column")
            specs[name] = ColumnSpec(**{k: v for k, v in entry.items() if k in allowed})
    return specs
