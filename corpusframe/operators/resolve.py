"""Locating the file a cell names: row-to-file resolution as joins against the manifest.

Every lookup runs on the distinct cell values, and the answer is joined back to the rows.
A resolution is one row per value: ``path``, ``status`` and, when several files match, the
first five ``matches``. Status is 'ok', 'unverified' (direct lookup without a hit: the first
candidate), 'missing', 'ambiguous' or 'null'.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusframe.functions import paths as P
from corpusframe.functions.text import bind, fold
from corpusframe.operators.skew import HOT_ROWS, key_counts, lookup
from corpusframe.sources.files import has_extension, visible

# The arrays exploded here are never empty. The outer form is used all the same: for the plain
# form Spark adds a size filter and pushes the whole array expression down to the scan.
LISTED = 5
ANCHOR_SIZES = (8, 4, 2, 1)
FOLDER_BUCKETS = 1 << 16  # the list of folders that is broadcast has no more rows than this

VALUE, ROOTS = "_value", "_roots"
_CLEAN, _BASES, _LONGER, _ABSOLUTE = "_clean", "_bases", "_longer", "_absolute"


@dataclass(frozen=True)
class PathRule:
    """How values of one column are looked up.

    ``roots`` are absolute media roots in search order. Where ``root_texts`` names a column,
    that root differs by row: the column holds its text, absolute or below the dataset root.
    """

    dataset_root: str
    extract_root: str
    roots: tuple[str, ...] = ()
    strategy: str = "direct"
    extension: str | None = None
    root_texts: tuple[str | None, ...] = ()

    @property
    def row_roots(self) -> list[str]:
        return [t for t in self.root_texts if t]

    @property
    def keys(self) -> list[str]:
        return [VALUE, *self.row_roots]

    def with_roots(self, values: DataFrame) -> DataFrame:
        """Add the array ``_roots`` of each distinct value."""
        if not self.row_roots:
            fixed = dict.fromkeys(self.roots or (self.dataset_root,))
            return values.withColumn(ROOTS, F.array(*[F.lit(r) for r in fixed]))
        clean = {f"{t}_clean": P.normalise(F.col(t)) for t in self.row_roots}
        roots = []
        for fixed, text in zip(self.roots, self.root_texts):
            below = F.col(f"{text}_clean")
            roots.append(
                F.when(P.is_absolute(below), below).otherwise(P.join(self.dataset_root, below))
                if text
                else F.lit(fixed)
            )
        return values.withColumns(clean).withColumn(ROOTS, F.array(*roots)).drop(*clean)

    def bases_column(self) -> Column:
        """Folders a relative value is tried under: media roots, dataset root, extract root."""
        fallback = dict.fromkeys([self.dataset_root, self.extract_root])
        return F.concat(F.col(ROOTS), F.array(*[F.lit(r) for r in fallback]))

    def real_bases_column(self) -> Column:
        """The same folders; those that are one for all values come without '..' parts."""
        if self.row_roots:
            return self.bases_column()
        fixed = dict.fromkeys(self.roots or (self.dataset_root,))
        fallback = dict.fromkeys([self.dataset_root, self.extract_root])
        return F.array(*[F.lit(P.real(r) if "/.." in r else r) for r in (*fixed, *fallback)])


def _prepared(values: DataFrame, rule: PathRule) -> DataFrame:
    """Parts of the candidates as columns of their own, so each is computed once per value."""
    clean = F.col(_CLEAN)
    extension = P.clean_extension(rule.extension)
    longer = F.lit(None).cast("string")
    if extension is not None:
        longer = F.when(P.suffix(clean) == "", F.concat(clean, F.lit(extension)))
    staged = values.withColumns({_CLEAN: P.normalise(F.col(VALUE)), _BASES: rule.bases_column()})
    return staged.withColumns({_LONGER: longer, _ABSOLUTE: P.is_absolute(clean)})


def _placed(base: Column, relative: Column) -> Column:
    return F.when(F.col(_ABSOLUTE), relative).otherwise(P.join(base, relative))


def direct_candidates(values: DataFrame, rule: PathRule) -> DataFrame:
    """(values, ord, path): paths a value may stand for; a smaller ``ord`` is the better one.

    The value itself under each base comes first, then the value with its extension.
    """
    clean, longer = F.col(_CLEAN), F.col(_LONGER)
    spellings = F.when(longer.isNull(), F.array(clean)).otherwise(F.array(clean, longer))
    staged = _prepared(values, rule)
    # an absolute value stands for itself, whatever the base
    bases = F.when(F.col(_ABSOLUTE), F.slice(_BASES, 1, 1)).otherwise(F.col(_BASES))
    based = staged.select(
        *values.columns, _ABSOLUTE, _BASES, bases.alias("_used"), F.posexplode_outer(spellings).alias("_spelling", "_rel")
    ).select(
        *values.columns, _ABSOLUTE, "_spelling", "_rel", F.size(_BASES).alias("_n_bases"),
        F.posexplode_outer("_used").alias("_pos", "_base"),
    )
    return based.select(
        *values.columns,
        (F.col("_spelling") * F.col("_n_bases") + F.col("_pos")).alias("_ord"),
        _placed(F.col("_base"), F.col("_rel")).alias("path"),
    )


def candidate_at(values: DataFrame, rule: PathRule, order: str) -> DataFrame:
    """Add ``path``: the candidate of a value with the given ``ord``."""
    size = F.size(_BASES)
    base = F.element_at(F.col(_BASES), F.pmod(F.col(order), size) + 1)
    relative = F.when(F.col(order) < size, F.col(_CLEAN)).otherwise(F.col(_LONGER))
    staged = _prepared(values, rule).withColumns({"_base": base, "_rel": relative})
    return staged.select(*values.columns, _placed(F.col("_base"), F.col("_rel")).alias("path"))


def _never_null(path: Column) -> Column:
    """A join on what is made from this column needs no filter for nulls, for which Spark would compute it once more."""
    return F.coalesce(path, F.lit(""))


def _bare(path: Column, extension: str | None) -> dict[str, Column]:
    """``_bare``: the path without the extension that is tried; ``_has``: whether it ends in it."""
    if extension is None:
        return {"_bare": path, "_has": F.lit(False)}
    has = F.endswith(path, F.lit(extension))
    return {"_bare": F.when(has, F.left(path, F.length(path) - F.lit(len(extension)))).otherwise(path), "_has": has}


def _folder_bucket(path: Column) -> Column:
    """A number below ``FOLDER_BUCKETS`` for the folder of a path."""
    folder = F.left(path, F.length(path) - F.length(P.basename(path)))
    return F.pmod(F.xxhash64(folder), F.lit(FOLDER_BUCKETS)).alias("_bucket")


def _asked(values: DataFrame, rule: PathRule) -> DataFrame:
    """The candidates of ``direct_candidates``, where one row stands for both spellings under a base.

    (values, _n_bases, _pos, _spelling, _both, path): with ``_both`` the path is the value itself, and
    stands for the path with the extension added too.
    """
    clean, longer = F.col(_CLEAN), F.col(_LONGER)
    extension = P.clean_extension(rule.extension)
    staged = _prepared(values, rule).withColumn("_real", rule.real_bases_column())
    both = F.lit(False)
    if extension is not None and "/" not in extension:
        # a last part '.' or '..' changes when something is added; one that ends in the extension is bare already
        both = longer.isNotNull() & ~F.endswith(clean, F.lit(extension)) & ~F.endswith(clean, F.lit("."))
    own, other = (F.struct(F.lit(i).alias("spelling"), c.alias("rel")) for i, c in enumerate((clean, longer)))
    spellings = F.when(longer.isNull() | F.col("_both"), F.array(own)).otherwise(F.array(own, other))
    bases = F.when(F.col(_ABSOLUTE), F.slice("_real", 1, 1)).otherwise(F.col("_real"))
    based = staged.withColumn("_both", both).select(
        *values.columns, _ABSOLUTE, "_both", F.size("_real").alias("_n_bases"), bases.alias("_used"), F.explode_outer(spellings).alias("_s")
    ).select(*values.columns, _ABSOLUTE, "_both", "_n_bases", "_s", F.posexplode_outer("_used").alias("_pos", "_base"))
    path = _placed(F.col("_base"), F.col("_s.rel")).alias("path")
    spelled = based.select(*values.columns, "_both", "_n_bases", "_pos", F.col("_s.spelling").alias("_spelling"), path)
    # files are listed under their real paths; a candidate keeps the way it is spelled
    return spelled.withColumn("path", _never_null(P.collapse(F.col("path"))))


def resolve_direct(values: DataFrame, manifest: DataFrame, rule: PathRule) -> DataFrame:
    """(keys, ord, _n): which candidate of each distinct value is the first to exist, if any.

    Candidates meet files by the path without the extension, so both spellings of a value are one row. Those in
    folders without a file go before the shuffle: the list of folders is broadcast as numbers of hash buckets,
    which are few however many folders there are.
    """
    extension = P.clean_extension(rule.extension)
    path = F.col("path")
    folders = manifest.select(_folder_bucket(path)).distinct()
    asked = _asked(values, rule).withColumn("_bucket", _folder_bucket(path))
    asked = asked.join(F.broadcast(folders), "_bucket", "left_semi").drop("_bucket")
    asked = asked.withColumns(_bare(path, extension)).drop("path")
    files = manifest.select(_never_null(path).alias("path")).withColumns(_bare(path, extension))
    files = files.select("_bare", F.col("_has").alias("_file_has"))
    met = asked.join(files, "_bare").filter(F.col("_both") | (F.col("_has") == F.col("_file_has")))
    spelling = F.when(F.col("_both"), F.col("_file_has").cast("int")).otherwise(F.col("_spelling"))
    hits = met.select(*rule.keys, "_n", (spelling * F.col("_n_bases") + F.col("_pos")).alias("_ord"))
    return hits.groupBy(*rule.keys).agg(F.min("_ord").alias("_ord"), F.max("_n").alias("_n"))


def _searched(manifest: DataFrame, rule: PathRule, values: DataFrame) -> DataFrame:
    """(root, rel, path, name, stem, depth, _first) of media files, once per search root above them.

    ``_first`` numbers the first root above a file. First matches are kept for each number, so files
    that an earlier root lists too leave no gap among the first ones of a later root.
    """
    media = manifest.filter(visible() & has_extension(rule.extension)).select(
        "path", "name", "stem", "depth"
    )
    if rule.row_roots:
        parts = F.split("path", "/")
        above = F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"),
        )
        wanted = values.select(F.explode(ROOTS).alias("root")).distinct().withColumn("real", P.collapse(F.col("root")))
        placed = media.withColumn("real", F.explode(above)).join(wanted, "real").withColumn("_first", F.lit(1).cast("bigint"))
    else:
        known = {r: P.real(r) for r in dict.fromkeys(rule.roots or (rule.dataset_root,))}
        inside = [P.is_under(F.col("path"), real) for real in known.values()]
        each = [F.struct(F.lit(r).alias("root"), F.lit(real).alias("real")) for r, real in known.items()]
        under = F.array_compact(F.array(*[F.when(i, e) for i, e in zip(inside, each)]))
        first = F.coalesce(*[F.when(i, F.lit(n).cast("bigint")) for n, i in enumerate(inside, 1)])
        staged = media.select("*", first.alias("_first"), F.explode(under).alias("_under"))
        placed = staged.select("*", "_under.root", "_under.real").drop("_under")
    rel = P.relative_to(F.col("path"), F.col("real"))
    # a root that is spelled with '..' gives paths spelled the same way
    spelled = F.when(F.col("root") == F.col("real"), F.col("path")).otherwise(P.join(F.col("root"), rel))
    return placed.withColumns({"rel": fold(rel), "path": spelled}).drop("real")


def _first_matches(pairs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first few paths per key; the limit is applied before the shuffle as well."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        pairs.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= LISTED)
        .drop("_rank")
    )


def _with_status(matches: DataFrame, rule: PathRule) -> DataFrame:
    """One row per value from its few (_roots, depth, path) matches."""
    keys = [*rule.keys, "_n"]
    # a file is listed under the first root above it, whichever root it matched under
    above = F.transform(ROOTS, lambda root: P.is_under(F.col("path"), root))
    placed = matches.select(*keys, "depth", "path", F.array_position(above, True).alias("_ord"))

    def paths(found: Column) -> Column:
        return F.slice(F.array_distinct(F.transform(F.array_sort(found), lambda m: m["path"])), 1, LISTED)

    listed = placed.groupBy(*keys).agg(
        paths(F.collect_list(F.struct("_ord", "depth", "path"))).alias("matches")
    )
    one = F.size("matches") == 1
    return listed.select(
        *keys,
        F.when(one, F.col("matches")[0]).alias("path"),
        F.when(one, F.lit("ok")).otherwise(F.lit("ambiguous")).alias("status"),
        F.when(~one, F.col("matches")).alias("matches"),
    )


def resolve_exact(
    values: DataFrame, manifest: DataFrame, rule: PathRule, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Match by file name, stem, or path below a root; values without a match give no row."""
    files = _searched(manifest, rule, values).select(
        "root",
        "path",
        "depth",
        "_first",
        F.explode_outer(
            F.array(
                F.struct(F.lit("name").alias("kind"), F.col("name").alias("key")),
                F.struct(F.lit("stem").alias("kind"), F.col("stem").alias("key")),
                F.struct(F.lit("rel").alias("kind"), F.col("rel").alias("key")),
            )
        ).alias("k"),
    ).select("root", "path", "depth", "_first", "k.kind", "k.key")
    on = ["root", "kind", "key"]
    by_key = (
        _first_matches(files, [*on, "_first"], ["depth", "path"])
        .groupBy(*on)
        .agg(F.collect_list(F.struct("depth", "path")).alias("found"))
    )

    def key(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("key"))

    clean, longer = F.col(_CLEAN), F.col(_LONGER)
    keyed = [key("name", P.basename(clean)), key("rel", F.col("_folded"))]
    keyed.append(key("stem", F.when(P.suffix(clean) == "", P.basename(clean))))
    if rule.extension:
        keyed += [key("name", P.basename(longer)), key("rel", F.col("_folded_longer"))]
    wanted = (
        _prepared(values, rule)
        .withColumns({"_folded": fold(clean), "_folded_longer": fold(longer)})
        .select(*rule.keys, "_n", ROOTS, F.explode_outer(ROOTS).alias("root"), F.array(*keyed).alias("_k"))
        .select(*rule.keys, "_n", ROOTS, "root", F.explode_outer("_k").alias("k"))
        .select(*rule.keys, F.col("_n").alias("_rows"), ROOTS, "root", "k.kind", "k.key")
        .filter(F.col("key").isNotNull())
    )
    # many values can share one file name, so this lookup is guarded against hot keys too
    found = lookup(wanted, by_key, on, hot_rows=hot_rows).filter(F.col("found").isNotNull())
    matches = found.select(
        *rule.keys, F.col("_rows").alias("_n"), ROOTS, F.explode_outer("found").alias("f")
    ).select(*rule.keys, "_n", ROOTS, "f.depth", "f.path")
    return _with_status(matches, rule)


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of one length; none if the text is shorter."""
    def cut(whole: Column) -> Column:
        last = F.length(whole) - size + 1
        each = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: whole.substr(i, F.lit(size)))
        return F.when(last >= 1, F.array_distinct(each)).otherwise(F.array().cast("array<string>"))

    return bind(text, cut)


def resolve_contains(values: DataFrame, manifest: DataFrame, rule: PathRule) -> DataFrame:
    """Match a value that occurs anywhere in a path below a root, case-insensitively.

    The substring test is an equi-join on an anchor: the value's substring, of the largest anchor size
    that fits, which the fewest paths have. Paths give their substrings of those few sizes only, as far
    as some value has them, and a joined pair is checked with ``contains``.
    """
    needle = F.col("_needle")
    wanted = values.select(*rule.keys, "_n", ROOTS, fold(F.col(VALUE)).alias("_needle"), F.explode_outer(ROOTS).alias("root"))
    needles = wanted.filter(F.length(needle) > 0).select("root", "_needle").distinct()
    sized = F.coalesce(*[F.when(F.length(needle) >= n, _grams(needle, n)) for n in ANCHOR_SIZES])
    asked = needles.select("root", "_needle", F.explode(sized).alias("gram"))
    text = F.when(F.col("path") == F.col("root"), fold(F.col("name"))).otherwise(F.col("rel"))
    searched = _searched(manifest, rule, values).select("root", "path", "depth", "_first", text.alias("_text"))
    cut = searched.select("*", F.explode(F.concat(*[_grams(F.col("_text"), n) for n in ANCHOR_SIZES])).alias("gram"))
    cut = cut.join(asked.select("root", "gram").distinct(), ["root", "gram"], "left_semi")
    counted = cut.groupBy("root", "gram").agg(F.count(F.lit(1)).alias("_paths"))
    ranked = asked.join(counted, ["root", "gram"], "left").groupBy("root", "_needle").agg(
        F.min_by("gram", F.struct("_paths", "gram")).alias("gram"), F.count_if(F.col("_paths").isNull()).alias("_absent")
    )
    anchors = ranked.filter("_absent = 0").select("root", "_needle", "gram")
    pairs = cut.join(anchors, ["root", "gram"]).filter(F.contains("_text", needle))
    on = ["root", "_needle"]
    first = _first_matches(pairs.select(*on, "path", "depth", "_first"), [*on, "_first"], ["depth", "path"])
    few = first.groupBy(*on).agg(F.collect_list(F.struct("depth", "path")).alias("found"))
    # one needle can stand under many per-row roots, so this lookup is guarded against hot keys
    found = lookup(wanted.withColumnRenamed("_n", "_rows"), few, on).filter(F.col("found").isNotNull())
    matches = found.select(*rule.keys, F.col("_rows").alias("_n"), ROOTS, F.explode_outer("found").alias("f"))
    return _with_status(matches.select(*rule.keys, "_n", ROOTS, "f.depth", "f.path"), rule)


def resolutions(counts: DataFrame, manifest: DataFrame, rule: PathRule) -> DataFrame:
    """(keys, _n, path, status, matches) of every distinct value.

    ``_n`` is the number of rows that hold the value; it travels along so that the join back
    to the rows knows the frequent values.
    """
    values = rule.with_roots(counts)
    direct = resolve_direct(values, manifest, rule).withColumnRenamed("_n", "_hit_n")
    # both branches read _n, so Spark sees one and the same shuffle of the counted values
    known = values.join(direct, rule.keys, "left").withColumn("_n", F.coalesce("_hit_n", "_n"))
    known = known.drop("_hit_n")
    nothing = F.lit(None).cast("array<string>").alias("matches")
    if rule.strategy == "direct":
        first = candidate_at(known.withColumn("_at", F.coalesce("_ord", F.lit(0))), rule, "_at")
        status = F.when(F.col("_ord").isNull(), "unverified").otherwise("ok").alias("status")
        return first.select(*rule.keys, "_n", "path", status, nothing)
    hits = candidate_at(known.filter(F.col("_ord").isNotNull()), rule, "_ord")
    hits = hits.select(*rule.keys, "_n", "path", F.lit("ok").alias("status"), nothing)
    rest = known.filter(F.col("_ord").isNull()).drop("_ord")
    search = resolve_exact if rule.strategy == "exact" else resolve_contains
    return hits.unionByName(search(rest, manifest, rule))


def resolve_values(
    df: DataFrame,
    manifest: DataFrame,
    rule: PathRule,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``path``, ``status`` and ``matches`` for the value column ``_value`` of each row.

    ``finish`` may change the resolutions before they are joined to the rows; it sees every
    distinct value once, and may make them wide. ``counts`` are the key counts of ``df``, where they are known from a
    simpler plan of the same rows.
    """
    counts = key_counts(df, rule.keys) if counts is None else counts
    resolved = resolutions(counts, manifest, rule)
    resolved = finish(resolved) if finish else resolved
    found = lookup(df, resolved, rule.keys, counts, wide=finish is not None)
    value = F.col(VALUE)
    status = F.when(value.isNull(), F.lit("null")).when(value == "", F.lit("ok"))
    return found.withColumns({
        "path": F.when(value == "", value).otherwise(F.col("path")),
        "status": status.otherwise(F.coalesce("status", F.lit("missing"))),
    })
