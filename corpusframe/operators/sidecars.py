"""Text and JSON sidecars: pairing, record explode, dotted sources."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions import paths as P
from corpusframe.functions.text import decode, strip
from corpusframe.sources.files import matches_glob, read_contents, visible


def paired_files(manifest: DataFrame, pattern: str, extension: str) -> DataFrame:
    """Text files whose media file, same folder and stem, exists."""
    texts = manifest.filter(matches_glob(pattern)).withColumn(
        "audio_path", P.with_suffix(F.col("path"), P.clean_extension(extension))
    )
    media = manifest.select(F.col("path").alias("audio_path"))
    return texts.join(media, "audio_path", "left_semi")


def pair_text(pairs: DataFrame, encoding: str) -> DataFrame:
    """One row per pair: media path, stripped text, name of the folder."""
    return read_contents(pairs, "audio_path", "parent").select(
        "audio_path",
        strip(decode(F.col("content"), encoding)).alias("transcription"),
        F.col("parent").alias("split"),
    )


def json_documents(manifest: DataFrame, pattern: str, encoding: str, on_error: str = "fail") -> DataFrame:
    """(path, doc): every matching sidecar as a variant."""
    files = manifest.filter(matches_glob(pattern) & visible())
    text = decode(F.col("content"), encoding)
    parsed = F.parse_json(text) if on_error == "fail" else F.try_parse_json(text)
    return read_contents(files).select("path", parsed.alias("doc"))


def _key(name: str) -> str:
    return f'["{name}"]' if "'" in name else f"['{name}']"


def json_paths(source: str) -> list[tuple[str, str]]:
    """(first key, variant path) for every way a dotted source can be read.

    'a.b' is key b inside object a, or one key that itself holds a dot: flattening makes the
    two alike, so both are tried, nesting first.
    """
    parts = source.split(".")
    found = []
    for joints in product((True, False), repeat=len(parts) - 1):
        keys = [parts[0]]
        for nested, part in zip(joints, parts[1:]):
            if nested:
                keys.append(part)
            else:
                keys[-1] += "." + part
        found.append((keys[0], "$" + "".join(_key(k) for k in keys)))
    return found


def explode_records(documents: DataFrame, record_path: str | None, on_error: str = "fail") -> DataFrame:
    """(path, doc, record, position): one row per record; without record_path, per document.

    A document that lacks the record key is an error; an empty list gives no rows.
    """
    if not record_path:
        whole = F.coalesce(
            F.try_variant_get("doc", "$", "array<variant>"), F.array(F.col("doc"))
        )
        return documents.select(
            "path", F.posexplode(whole).alias("position", "doc")
        ).select("path", "doc", F.lit(None).cast("variant").alias("record"), "position")
    where = "$" + _key(record_path)
    if on_error == "fail":
        lacking = F.raise_error(
            F.concat(F.lit(f"record_path '{record_path}' not found in "), F.col("path"))
        )
        present = F.try_variant_get("doc", where, "variant").isNotNull()
        documents = documents.filter(F.when(present, True).otherwise(lacking.cast("boolean")))
    records = F.try_variant_get("doc", where, "array<variant>")
    return documents.select("path", "doc", F.posexplode(records).alias("position", "record")).select(
        "path", "doc", "record", "position"
    )


def flattened(source: str | int, record_path: str | None) -> tuple[Column, Column]:
    """(text, present) of a dotted source; document keys win over record keys."""
    nothing = F.lit(None).cast("string")
    if isinstance(source, int):
        scalar = F.col("record") if source == 0 else F.lit(None).cast("variant")
        return F.try_variant_get(scalar, "$", "string"), scalar.isNotNull()
    text, present = None, F.lit(False)
    reads = [("doc", p) for first, p in json_paths(source) if first != record_path]
    if record_path:
        reads += [("record", p) for _, p in json_paths(source)]
    for column, where in reads:
        there = F.try_variant_get(column, where, "variant").isNotNull()
        value = F.try_variant_get(column, where, "string")
        text = F.when(there, value) if text is None else text.when(there, value)
        present = present | there
    return (nothing if text is None else text.otherwise(nothing)), present


def sources_present(records: DataFrame, sources: list[str | int], record_path: str | None) -> set:
    """Sources that occur in at least one record; a look at one row settles most of them."""
    if not sources:
        return set()
    flags = [flattened(s, record_path)[1].alias(f"s{i}") for i, s in enumerate(sources)]
    first = records.select(*flags).limit(1).first()
    seen = {s for i, s in enumerate(sources) if first is not None and first[i]}
    unseen = [s for s in sources if s not in seen]
    if unseen:
        rest = [
            F.max(flattened(s, record_path)[1]).alias(f"s{i}") for i, s in enumerate(unseen)
        ]
        row = records.agg(*rest).first()
        seen |= {s for i, s in enumerate(unseen) if row[i]}
    return seen
