"""``load``: a load spec and a corpus root to one DataFrame.

The driver reads the spec, the first record of each index and one row that says where an
index lies. Everything else is one lazy plan. With ``on_error='fail'`` a bad row raises when
the plan runs; 'null' keeps such rows with null cells; 'quarantine' adds ``_problems``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusframe.functions import paths as P
from corpusframe.operators import locate, sidecars
from corpusframe.operators.mapping import Corpus, map_columns
from corpusframe.operators.templates import has_holes
from corpusframe.sources import storage
from corpusframe.sources.archives import with_inner_archives
from corpusframe.sources.delimited import IndexFrame, read_index
from corpusframe.sources.files import matches_glob, scan_manifest, union_all, visible, write_files
from corpusframe.sources.scratch import fresh_folder
from corpusframe.spec import LoadSpec, SpecError

Layout = Callable[[SparkSession, LoadSpec, Corpus], DataFrame]

TASKS = ("ASR", "OTH", "TTS")
_LAYOUTS: dict[str, Layout] = {}


def register_layout(name: str, layout: Layout) -> None:
    """Add or replace the layout that ``root_strategy: name`` selects."""
    _LAYOUTS[name] = layout


def load(
    spark: SparkSession,
    spec: LoadSpec | dict,
    root: str,
    manifest: DataFrame | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Load a corpus. Pass ``manifest`` when a listing already exists as a table."""
    spec = spec if isinstance(spec, LoadSpec) else LoadSpec.from_dict(spec)
    check_spec(spec)
    root = P.clean_root(root)
    listed: list[DataFrame] = [] if manifest is None else [manifest]

    def files() -> DataFrame:
        if not listed:
            listed.append(scan_manifest(spark, root))
        return listed[0]

    if spec.extract_files:
        listed[:] = [with_inner_archives(files(), spec, root)]
    corpus = Corpus(root, root, files, on_error, outside_roots(spark, spec, root))
    return _LAYOUTS.get(spec.root_strategy or "index", index_layout)(spark, spec, corpus)


def outside_roots(spark: SparkSession, spec: LoadSpec, root: str):
    """A function that adds the files of declared media roots outside the corpus root to its manifest."""
    fixed = [P.real(P.resolve_under(root, r)) for r in spec.media_roots if not has_holes(r)]
    extra = sorted({r for r in fixed if r != root and not r.startswith(f"{root}/")})
    if not extra:
        return None
    listed: list[DataFrame] = []

    def add(manifest: DataFrame) -> DataFrame:
        if not listed:
            # a root below another one is listed with it
            tops = [r for r in extra if not any(r.startswith(f"{o}/") for o in extra)]
            listed.append(union_all([scan_manifest(spark, r) for r in tops]))
        return manifest.unionByName(listed[0].join(manifest.select("path"), "path", "left_anti"), allowMissingColumns=True)

    return add


def check_spec(spec: LoadSpec) -> None:
    """Per task and layout, the fields a spec must have."""
    if spec.task not in TASKS and spec.root_strategy not in _LAYOUTS:
        raise SpecError(f"no layout for task '{spec.task}'; supported tasks: {', '.join(TASKS)}")
    strategy = spec.root_strategy
    if strategy == "multi_split":
        spec.require("splits")
    elif strategy == "multi_sections":
        spec.require("sections", "section_root", "index_file")
    elif strategy == "glob":
        spec.require("file_pattern")
    elif strategy == "paired_glob":
        spec.require("file_pattern")
        if is_json(spec):
            spec.require("columns")
        elif spec.task == "ASR":
            raise SpecError("ASR paired_glob spec only supports 'format: json'")
        else:
            spec.require("audio_extension")
    elif strategy not in _LAYOUTS or strategy == "index":
        spec.require("index_file")
        if spec.task == "ASR":
            spec.require("columns")


def is_json(spec: LoadSpec) -> bool:
    return (spec.format or "").casefold() == "json"


def _mapped(frame: IndexFrame, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    return map_columns(frame, spec, corpus) if spec.columns else frame.named()


def index_layout(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    """One index file, the shallowest of its name."""
    at_root = P.resolve_under(corpus.extract_root, spec.index_file)
    if storage.is_file(at_root) or storage.is_dir(at_root):
        path = at_root
    else:
        path = locate.locate_index(corpus.manifest, spec.index_file)
    root = locate.dataset_root(path, spec.index_file)
    frame = read_index(spark, on_storage(corpus, path), spec, corpus.on_error)
    return _mapped(frame, spec, Corpus(root, corpus.extract_root, corpus.files, corpus.on_error, corpus.outside))


def on_storage(corpus: Corpus, path: str) -> str:
    """Where Spark can read an index: its own path, or a scratch copy of an archive member."""
    if storage.is_file(path) or storage.is_dir(path) or "archived" not in corpus.manifest.columns:
        return path
    member = corpus.manifest.filter((F.col("path") == path) & F.col("archived").isNotNull())
    target = f"{fresh_folder(member.sparkSession, 'index')}/{path.rsplit('/', 1)[-1]}"
    write_files(member.select(F.lit(target).alias("path"), F.col("archived").alias("content")))
    return target


def tagged(frame: IndexFrame, tag: str, value: str, as_cell: bool) -> IndexFrame:
    """Add a constant ``_tag`` column, which replaces a source column called ``tag``.

    With ``as_cell`` it is an ordinary source column as well, for specs that map it.
    """
    keep = [i for i, n in enumerate(frame.names) if n != tag]
    cells = [frame.cell(i) for i in keep] + ([F.lit(value)] if as_cell else [])
    rows = frame.rows.select(
        *[c.alias(f"_c{k}") for k, c in enumerate(cells)],
        *[c for c in frame.rows.columns if c == "_ragged"],
        F.lit(value).alias("_tag"),
    )
    return IndexFrame(rows, [frame.names[i] for i in keep] + ([tag] if as_cell else []))


def _tagged_frames(
    spark: SparkSession, spec: LoadSpec, corpus: Corpus, files: list[tuple[str, str]], tag: str, as_cell: bool
) -> list[IndexFrame]:
    """One frame per distinct header: files with the same columns become one scan of rows."""
    by_header: dict[tuple, list[DataFrame]] = {}
    for value, path in files:
        frame = tagged(read_index(spark, path, spec, corpus.on_error), tag, value, as_cell)
        by_header.setdefault(tuple(frame.names), []).append(frame.rows)
    return [IndexFrame(union_all(rows), list(names)) for names, rows in by_header.items()]


def multi_split_layout(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    """One index per split, found by file stem; listed splits may be absent, not all of them."""
    pattern = spec.splits_file_pattern or "**/*.tsv"
    found = locate.split_indexes(corpus.manifest, pattern, list(spec.splits)).orderBy("stem")
    # at most one row per listed split
    files = [(r["stem"], on_storage(corpus, r["path"])) for r in found.collect()]
    if not files:
        raise FileNotFoundError(f"no split files match '{pattern}' for {sorted(spec.splits)}")
    frames = _tagged_frames(spark, spec, corpus, files, "split", as_cell=bool(spec.columns))
    if not spec.columns:
        return union_all([f.named(F.col("_tag").alias("split")) for f in frames])
    mapped = union_all([map_columns(f, spec, corpus, carry=("_tag",)) for f in frames])
    return mapped.withColumn("split", F.col("_tag")).drop("_tag")


def multi_sections_layout(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    """One index per section folder; raw columns plus ``section``."""
    base = P.resolve_under(corpus.extract_root, spec.section_root)
    paths = [P.resolve_under(P.resolve_under(base, s), spec.index_file) for s in spec.sections]
    stored = {p: on_storage(corpus, p) for p in paths}
    absent = [p for p, at in stored.items() if not (storage.is_file(at) or storage.is_dir(at))]
    if absent:
        raise FileNotFoundError(f"section index files not found: {absent}")
    files = [(p.split("/")[-2], stored[p]) for p in paths]
    frames = _tagged_frames(spark, spec, corpus, files, "section", as_cell=False)
    return union_all([f.named(F.col("_tag").alias("section")) for f in frames])


def _not_empty(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise FileNotFoundError(message)
    return df


def paired_layout(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    return _paired_json(spark, spec, corpus) if is_json(spec) else _paired_text(spec, corpus)


def _paired_text(spec: LoadSpec, corpus: Corpus) -> DataFrame:
    pairs = sidecars.paired_files(corpus.manifest, spec.file_pattern, spec.audio_extension)
    _not_empty(pairs, f"no '{spec.file_pattern}' + {spec.audio_extension} pairs found")
    return sidecars.pair_text(pairs, spec.encoding)


def _paired_json(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    _not_empty(
        corpus.manifest.filter(matches_glob(spec.file_pattern) & visible()),
        f"no files match '{spec.file_pattern}'",
    )
    documents = sidecars.json_documents(
        corpus.manifest, spec.file_pattern, spec.encoding, corpus.on_error
    )
    records = sidecars.explode_records(documents, spec.record_path, corpus.on_error)
    return map_columns(json_frame(records, spec), spec, corpus)


def json_frame(records: DataFrame, spec: LoadSpec, check: bool = True) -> IndexFrame:
    """Records as index rows whose columns are the dotted sources the spec uses."""
    from corpusframe.operators.templates import _HOLE

    sources = list(dict.fromkeys(c.source_column for c in spec.columns.values()))
    templates = [c.path_template or "" for c in spec.columns.values()] + spec.media_roots
    holes = {h.strip() for t in templates for h in _HOLE.findall(t)} - {"value"}
    sources += sorted(h for h in holes if h not in sources)
    if check:
        present = sidecars.sources_present(records, sources, spec.record_path)
        sources = [s for s in sources if s in present]
    cells = [
        sidecars.flattened(s, spec.record_path)[0].alias(f"_c{i}") for i, s in enumerate(sources)
    ]
    return IndexFrame(records.select(*cells), sources)


def glob_layout(spark: SparkSession, spec: LoadSpec, corpus: Corpus) -> DataFrame:
    """One row per matching file, metadata from its folder names."""
    manifest = corpus.manifest
    if spec.splits:
        return split_glob(manifest, spec.file_pattern, list(spec.splits))
    return _not_empty(glob_rows(manifest, spec.file_pattern), f"no files match '{spec.file_pattern}'")


def glob_rows(manifest: DataFrame, pattern: str, *extra) -> DataFrame:
    return manifest.filter(matches_glob(pattern) & visible()).select(
        F.col("path").alias("audio_path"),
        F.col("parent").alias("language"),
        F.col("grandparent").alias("speaker_id"),
        *extra,
    )


def split_glob(manifest: DataFrame, pattern: str, splits: list[str], *extra) -> DataFrame:
    """As ``glob_rows`` below each listed split folder; every one must hold a match."""
    listed = F.array(*[F.lit(s) for s in splits])
    above = F.filter(listed, lambda s: F.col("rel_path").startswith(F.concat(s, F.lit("/"))))
    inside = manifest.withColumn("split", F.explode(above))
    inside = inside.withColumn("rel_path", F.expr("substr(rel_path, length(split) + 2)"))
    rows = glob_rows(inside, pattern, "split", *extra)
    found = {r["split"] for r in rows.select("split").distinct().collect()}  # ⊆ listed splits
    absent = [s for s in splits if s not in found]
    if absent:
        raise FileNotFoundError(f"split folders without files that match '{pattern}': {absent}")
    return rows


register_layout("index", index_layout)
register_layout("multi_split", multi_split_layout)
register_layout("multi_sections", multi_sections_layout)
register_layout("paired_glob", paired_layout)
register_layout("glob", glob_layout)
