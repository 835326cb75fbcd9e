"""Column mapping: raw index rows to the columns a load spec declares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions import casts as C, paths as P
from corpusframe.functions.text import decode, strip
from corpusframe.operators.resolve import VALUE, PathRule, resolve_values
from corpusframe.operators.skew import key_counts, lookup
from corpusframe.operators.templates import has_holes, render, tidy_template
from corpusframe.sources.delimited import IndexFrame, find_source
from corpusframe.sources.files import read_contents
from corpusframe.spec import ColumnSpec, LoadSpec

ON_ERROR = ("fail", "null", "quarantine")
PROBLEMS = "_problems"


@dataclass(frozen=True)
class Corpus:
    """Where files are looked up. ``files`` is the manifest, or a function that lists it.

    ``outside`` lists the media roots that are not below the corpus root; only lookups see their files.
    """

    dataset_root: str
    extract_root: str
    files: object
    on_error: str = "fail"
    outside: object = None

    @property
    def media(self) -> DataFrame:
        return self.manifest if self.outside is None else self.outside(self.manifest)

    @property
    def manifest(self) -> DataFrame:
        return self.files() if callable(self.files) else self.files


def planned_columns(spec: LoadSpec, names: list[str | int]) -> list[tuple[str, ColumnSpec, int]]:
    """Output name, spec and source position; absent optional columns are left out."""
    planned = []
    for name, column in spec.columns.items():
        position = find_source(names, column.source_column)
        if position is not None:
            planned.append((name, column, position))
        elif not column.optional:
            raise KeyError(
                f"Required column '{column.source_column}' not found; available: {names}"
            )
    return planned


def map_columns(
    frame: IndexFrame, spec: LoadSpec, corpus: Corpus, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Select, rename, cast and resolve, in spec order; ``carry`` columns are kept behind them."""
    if corpus.on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    planned = planned_columns(spec, frame.names)
    tags = list(carry)

    staged: dict[str, Column] = {}
    problems: list[Column] = []
    first = _first_alike(planned)
    for i, (name, column, position) in enumerate(planned):
        cell = frame.cell(position)
        if first[i] != i:
            continue
        if column.is_path:
            staged[f"_value_{i}"] = _lookup_value(frame, column, cell)
            for j, root in enumerate(spec.media_roots):
                if has_holes(root):
                    filled = render(tidy_template(root), strip(cell), frame, "base_audio_path")
                    staged[f"_root_{j}_{i}"] = filled
        else:
            staged[f"_out_{i}"] = C.cast(cell, column.dtype)
            if column.dtype == "int":
                staged[f"_bad_{i}"] = C.is_unfit_int(cell)
                problems.append(F.when(F.col(f"_bad_{i}"), F.lit(f"{name}:not_whole")))
    ragged = ["_ragged"] if "_ragged" in frame.rows.columns else []
    if ragged:
        problems.insert(0, F.when(F.col("_ragged"), F.lit("record:too_long")))
    df = frame.rows.select(*[c.alias(n) for n, c in staged.items()], *tags, *ragged)

    # keys are counted on the staged rows, not on rows already joined for the columns before:
    # each path column adds one scan to the plan instead of multiplying it
    staged_rows = df
    for i, (name, column, _) in enumerate(planned):
        if column.is_path:
            if first[i] == i:
                df = _resolve_column(df, staged_rows, i, column, spec, corpus)
            else:
                df = df.withColumns({f"{c}_{i}": F.col(f"{c}_{first[i]}") for c in ("_value", "_out", "_status", "_matches")})
            bad = F.col(f"_status_{i}").isin("missing", "ambiguous", "unreadable")
            problems.append(F.when(bad, F.concat(F.lit(f"{name}:"), F.col(f"_status_{i}"))))
    return _finish(df, planned, tags, problems, corpus.on_error)


def _first_alike(planned) -> list[int]:
    """For each column the first one that looks up the same cell by the same rule: such columns are resolved once."""
    seen: dict[tuple, int] = {}
    first = []
    for i, (_, column, position) in enumerate(planned):
        rule = (position, column.dtype, column.path_template, column.path_match_strategy, column.file_extension)
        first.append(seen.setdefault(rule, i) if column.is_path else i)
    return first


def _finish(df, planned, tags, problems, on_error) -> DataFrame:
    outputs = [F.col(f"_out_{i}").alias(name) for i, (name, _, _) in enumerate(planned)]
    if not problems:
        extra = [F.array().cast("array<string>").alias(PROBLEMS)] if on_error == "quarantine" else []
        return df.select(*outputs, *tags, *extra)
    found = F.array_compact(F.array(*problems))
    if on_error == "fail":
        details = [
            F.coalesce(F.array_join(F.col(f"_matches_{i}"), ", "), F.col(f"_value_{i}"))
            for i, (_, column, _) in enumerate(planned)
            if column.is_path
        ]
        message = F.concat_ws(" ", F.array_join(found, ", "), *details)
        # a filter, not a column: it is evaluated whichever columns the caller selects
        df = df.filter(F.when(F.size(found) > 0, F.raise_error(message).cast("boolean")).otherwise(True))
        return df.select(*outputs, *tags)
    if on_error == "quarantine":
        return df.select(*outputs, *tags, found.alias(PROBLEMS))
    return df.select(*outputs, *tags)


def _lookup_value(frame: IndexFrame, column: ColumnSpec, cell: Column) -> Column:
    """The text that is looked up: the trimmed cell, or the template filled from the row."""
    source = strip(cell) if column.dtype == "file_path" else P.strip_parts(cell)
    if not column.path_template:
        return source
    return F.when(cell.isNotNull(), render(column.path_template, source, frame))


def path_rule(spec: LoadSpec, corpus: Corpus, column: ColumnSpec) -> PathRule:
    texts = [f"_root_{j}" if has_holes(r) else None for j, r in enumerate(spec.media_roots)]
    roots = [
        "" if text else P.resolve_under(corpus.dataset_root, root)
        for root, text in zip(spec.media_roots, texts)
    ]
    return PathRule(
        dataset_root=corpus.dataset_root,
        extract_root=corpus.extract_root,
        roots=tuple(roots),
        strategy=column.path_match_strategy,
        extension=column.file_extension,
        root_texts=tuple(texts),
    )


def _resolve_column(df, staged_rows, i, column, spec, corpus) -> DataFrame:
    rule = path_rule(spec, corpus, column)
    own = {f"_value_{i}": VALUE, **{f"{t}_{i}": t for t in rule.row_roots}}
    df = df.withColumnsRenamed(own)
    counts = key_counts(staged_rows.withColumnsRenamed(own), rule.keys)
    manifest = corpus.media
    if column.dtype == "file_content":
        df = resolve_values(df, manifest, rule, lambda r: attach_content(r, manifest, spec.encoding), counts)
    else:
        df = resolve_values(df, manifest, rule, counts=counts)
    return df.drop(*rule.row_roots).withColumnsRenamed(
        {VALUE: f"_value_{i}", "path": f"_out_{i}", "status": f"_status_{i}", "matches": f"_matches_{i}"}
    )


def attach_content(resolved: DataFrame, manifest: DataFrame, encoding: str) -> DataFrame:
    """Replace each resolved path by the stripped text of that file.

    Only files that some value resolves to are read, each once. A path that is no listed file
    stays as it is, with status 'unreadable'.
    """
    counts = key_counts(resolved, ["path"])
    wanted = manifest.join(counts.select("path"), "path", "left_semi")
    texts = read_contents(wanted).select("path", strip(decode(F.col("content"), encoding)).alias("_text"))
    joined = lookup(resolved, texts, ["path"], counts, wide=True)
    unread = F.col("path").isNotNull() & F.col("_text").isNull()
    return joined.withColumns(
        {
            "status": F.when(unread, F.lit("unreadable")).otherwise(F.col("status")),
            "path": F.coalesce("_text", "path"),
        }
    ).drop("_text")
