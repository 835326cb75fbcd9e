"""POSIX path expressions on string columns, with the meaning of pure paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ABSOLUTE = r"^(/|[A-Za-z][A-Za-z0-9+.-]*:/)"
_URI = r"^[A-Za-z][A-Za-z0-9+.-]*:/"
_STEP_BACK = r"/(?!\.\.(?:/|$))[^/]*/\.\.(?=/|$)"  # a part and the '..' behind it


def normalise(path: Column) -> Column:
    """Collapse slashes, drop '.' parts and a trailing slash; '..' stays as it is."""
    plain = F.regexp_replace(path, "/+", "/")
    plain = F.regexp_replace(plain, r"(?:(?<=/)|^)\.(?:/|$)", "")
    plain = F.regexp_replace(plain, "(?<=.)/$", "")
    plain = F.regexp_replace(plain, "^$", ".")
    untidy = (
        path.contains("//")
        | path.contains("/./")
        | path.startswith("./")
        | path.endswith("/")
        | path.endswith("/.")
        | path.isin("", ".")
    )
    return F.when(untidy & ~is_uri(path), plain).otherwise(path)


def collapse(path: Column) -> Column:
    """The path without '..' parts: each takes the part before it away, none goes above the root.

    Up to two levels of them go by pattern; what is left then is walked part by part, which is slow.
    """
    from corpusframe.functions.text import bind

    empty = F.array().cast("array<string>")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    def walked(text: Column) -> Column:
        return F.when(text.contains("/.."), F.array_join(F.aggregate(F.split(text, "/"), empty, step), "/")).otherwise(text)

    shorter = F.regexp_replace(F.regexp_replace(path, _STEP_BACK, ""), _STEP_BACK, "")
    shorter = F.when(path.startswith(".."), path).otherwise(shorter)
    return F.when(path.contains("/.."), bind(shorter, walked)).otherwise(path)


def real(path: str) -> str:
    """As ``collapse``, for one absolute path of a spec."""
    kept: list[str] = []
    for part in path.split("/"):
        if part == "..":
            kept = kept[: max(len(kept) - 1, 1)]
        else:
            kept.append(part)
    return "/".join(kept)


def is_uri(path: Column) -> Column:
    return path.contains(":/") & path.rlike(_URI)


def is_absolute(path: Column) -> Column:
    return path.startswith("/") | is_uri(path)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_dir(path: Column) -> Column:
    """Everything before the last slash."""
    return F.regexp_replace(path, "/[^/]*$", "")


def part_from_end(path: Column, n: int) -> Column:
    """The n-th part counted from the end, '' when there is none."""
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-n)), F.lit(""))


def stem(path: Column) -> Column:
    return F.regexp_extract(basename(path), r"^(.+?)(\.[^.]+)?$", 1)


def suffix(path: Column) -> Column:
    """Last extension with its dot; '' for none and for dot files."""
    return F.regexp_extract(basename(path), r"^.+(\.[^.]+)$", 1)


def with_suffix(path: Column, extension: str) -> Column:
    """Replace the last extension, or append when there is none."""
    return F.concat(F.regexp_extract(path, "^(.*/)?", 0), stem(path), F.lit(extension))


def join(root: Column | str, relative: Column) -> Column:
    base = F.lit(root) if isinstance(root, str) else root
    slash = F.when(base.endswith("/"), "").otherwise("/")
    return F.when(relative == ".", base).otherwise(F.concat(base, slash, relative))


def is_under(path: Column, root: Column | str) -> Column:
    base = F.lit(root) if isinstance(root, str) else root
    return (path == base) | path.startswith(F.concat(base, F.lit("/")))


def relative_to(path: Column, root: Column | str) -> Column:
    """Path below root; '.' for the root itself; null when not below it."""
    base = F.lit(root) if isinstance(root, str) else root
    below = path.substr(F.length(base) + 2, F.length(path))
    return F.when(path == base, F.lit(".")).when(is_under(path, base), below)


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def strip_parts(path: Column) -> Column:
    """Trim white space around every part of a path."""
    from corpusframe.functions.text import strip

    return F.array_join(F.transform(F.split(strip(path), "/"), strip), "/")


def strip_archive_suffix(path: Column) -> Column:
    """Drop .tar.gz, .tgz or .zip, else the last extension."""
    return (
        F.when(path.rlike(r"\.(tar\.gz|tgz|zip)$"), F.regexp_replace(path, r"\.(tar\.gz|tgz|zip)$", ""))
        .when(suffix(path) != "", F.regexp_replace(path, r"\.[^./]+$", ""))
        .otherwise(path)
    )


def clean_extension(extension: str | None) -> str | None:
    """Driver side: extension with a leading dot, or None."""
    if not extension:
        return None
    return extension if extension.startswith(".") else "." + extension


def clean_root(root: str) -> str:
    """Driver side: a root without scheme 'file:', doubled or trailing slashes."""
    import posixpath
    import re

    text = str(root)
    if re.match(r"^file:/", text):
        text = "/" + text[len("file:"):].lstrip("/")
    if re.match(_URI, text):
        return text.rstrip("/")
    return posixpath.normpath(text) if text.startswith("/") else text


def resolve_under(root: str, relative: str) -> str:
    """Driver side: join a spec path to a root; an absolute path stays itself."""
    import re

    if re.match(_ABSOLUTE, relative):
        return clean_root(relative)
    parts = [p for p in relative.split("/") if p not in ("", ".")]
    return "/".join([root.rstrip("/"), *parts]) if parts else root
