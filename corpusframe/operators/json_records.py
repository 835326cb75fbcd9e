"""JSON record tables: redaction of sensitive values, tolerant detail records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions.text import bind

# What marks a key as sensitive, and what its value becomes.
SENSITIVE = ("url", "token")
REDACTED = "***REDACTED***"
_NESTING = 500  # of a value under a sensitive key; a deeper one is an error, never left in

# every repetition is possessive: it never gives back, so long values take no stack
_INNER = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_STRING = rf'"{_INNER}"'


def _sensitive_key() -> str:
    word = rf'(?iu:{"|".join(SENSITIVE)})'
    starts = "".join(sorted({c for w in SENSITIVE for c in (w[0].lower(), w[0].upper())}))
    # an opening quote never follows a backslash; starting at escaped ones would reread long texts
    # only where a word may start is it looked for, so runs of other letters are passed at once
    return rf'"(?<!\\")(?:[^"\\{starts}]++|\\.|(?!{word})[{starts}])*+{word}{_INNER}"\s*+:\s*+'


def _value(nesting: int) -> str:
    """A JSON value; text is known to be well formed, so bracket kinds need no check."""
    scalar = rf'(?:{_STRING}|[^\s,\[\]{{}}"]++)'
    container = r"(?!)"
    for _ in range(nesting):
        container = rf'[\[{{](?:{_STRING}|[^\[\]{{}}"]++|{container})*+[\]}}]'
    return f"(?:{scalar}|{container})"


def redact_json(text: Column) -> Column:
    """JSON text with the value of every key that contains 'url' or 'token' replaced.

    A whole object or list under such a key is replaced. Text that is no JSON becomes null,
    so nothing leaks; nesting past the supported depth under a sensitive key is an error.
    """
    # escaped letters could hide a key, so such documents are rewritten without escapes first
    document = F.try_parse_json(text)
    plain = F.when(text.contains("\\u"), F.to_json(document)).otherwise(text)
    key = _sensitive_key()
    masked = F.regexp_replace(plain, f"({key}){_value(_NESTING)}", f'$1"{REDACTED}"')
    left = F.raise_error(F.lit("sensitive value nested too deeply to redact")).cast("string")
    # bound, as Spark would mask once for the check and once more for the result
    safe = bind(masked, lambda m: F.when(m.rlike(key + r"[\[{]"), left).otherwise(m))
    return F.when(document.isNotNull(), safe)


def tolerant_records(df: DataFrame, text: str, declared: tuple[str, ...], required: str = "id") -> DataFrame:
    """Declared fields as text columns, unknown ones kept with their types in the map ``extras``.

    ``present`` lists the keys a record really had, null values included. ``problem`` names
    a required key that is absent or not text.
    """
    fields = F.from_json(F.col(text), "map<string,string>")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{required}", "variant"))
    typed = F.from_json(F.col(text), "map<string,variant>")
    parsed = df.withColumns({"_fields": fields, "_typed": typed, "_kind": kind})
    known = F.array(*[F.lit(d) for d in declared])
    return parsed.select(
        *[c for c in df.columns if c != text],
        *[F.try_element_at("_fields", F.lit(d)).alias(d) for d in declared],
        F.array_sort(F.map_keys("_fields")).alias("present"),
        F.map_filter("_typed", lambda k, _: ~F.array_contains(known, k)).alias("extras"),
        F.when(F.coalesce(F.col("_kind"), F.lit("")) != "STRING", F.lit(f"{required}:required")).alias("problem"),
    )
