"""Path templates: ${column} and ${value} compiled once to a concat expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from corpusframe.functions.text import strip
from corpusframe.sources.delimited import IndexFrame, find_source

_HOLE = re.compile(r"\$\{([^}]+)\}")


def has_holes(template: str) -> bool:
    return "${" in template


def tidy_template(template: str) -> str:
    """Driver side: a path template without doubled or trailing slashes."""
    return re.sub(r"(?<=.)/$", "", re.sub("/+", "/", template)) if "://" not in template else template


def render(template: str, value: Column, frame: IndexFrame, label: str = "path_template") -> Column:
    """Template with its holes filled per row; a missing cell is empty text."""
    pieces: list[Column] = []
    position = 0
    for hole in _HOLE.finditer(template):
        if hole.start() > position:
            pieces.append(F.lit(template[position : hole.start()]))
        pieces.append(_filled(hole.group(1).strip(), value, frame, label))
        position = hole.end()
    if position < len(template) or not pieces:
        pieces.append(F.lit(template[position:]))
    return F.concat(*pieces)


def _filled(name: str, value: Column, frame: IndexFrame, label: str) -> Column:
    if name == "value":
        return F.coalesce(value, F.lit(""))
    position = find_source(frame.names, name)
    if position is None:
        raise KeyError(f"{label} placeholder '{name}' is not a column; available: {frame.names}")
    return F.coalesce(strip(frame.cell(position)), F.lit(""))
