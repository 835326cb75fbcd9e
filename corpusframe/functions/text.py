"""Text expressions: trimming, folding, missing-value tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cells that count as missing in a delimited file.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


# every character Python's str.strip removes
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: inside a lambda, an outer expression is computed again
    for every element."""
    return F.transform(F.array(value), use)[0]


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


# characters whose case fold is not their lower case, by the rule of the Unicode tables Python carries
FOLDS = {c: c.casefold() for c in map(chr, range(0x20000)) if c.casefold() != c.lower()}
# the capital sigma is there because the JVM's lower case of it depends on its place in a word
_SINGLE = {c: f for c, f in FOLDS.items() if len(f) == 1} | {"Σ": "σ"}
_SEVERAL = {c: f for c, f in FOLDS.items() if len(f) > 1}


def fold(text: Column) -> Column:
    """Case-insensitive key by full case folding: 'ß' equals 'ss', 'ſ' equals 's'."""
    def folds(other: Column) -> Column:
        folded = F.translate(other, "".join(_SINGLE), "".join(_SINGLE.values()))
        longer = folded
        for char, several in _SEVERAL.items():
            longer = F.replace(longer, F.lit(char), F.lit(several))
        return F.when(~other.rlike(f"[{''.join(_SEVERAL)}]"), folded).otherwise(longer)

    # the hundred replacements stay out of the code that Spark generates for a row: with them
    # its methods are too long for the JVM to compile, so plain text would be slow as well
    return F.lower(F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(bind(text, folds)))


def squeeze(text: Column) -> Column:
    """Collapse inner runs of white space to one blank and trim the ends."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def drop_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^\ufeff", "")


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)


def unify_newlines(text: Column) -> Column:
    return F.when(text.contains("\r"), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


# Charsets the JVM decoder takes without a legacy setting.
JVM_CHARSETS = {
    "ascii": "US-ASCII",
    "iso-8859-1": "ISO-8859-1",
    "latin-1": "ISO-8859-1",
    "latin1": "ISO-8859-1",
    "us-ascii": "US-ASCII",
    "utf-16": "UTF-16",
    "utf-16be": "UTF-16BE",
    "utf-16le": "UTF-16LE",
    "utf-32": "UTF-32",
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "utf8": "UTF-8",
}


def jvm_charset(encoding: str) -> str | None:
    """The JVM name of a Python codec, or None when Spark cannot decode it natively."""
    return JVM_CHARSETS.get(encoding.strip().lower().replace("_", "-"))


def decode(content: Column, encoding: str) -> Column:
    """Bytes to text as a text-mode read gives it, newlines unified."""
    charset = jvm_charset(encoding)
    if charset is not None:
        text = F.decode(content, charset)
    else:
        text = _codec_udf(encoding)(content)
    if encoding.lower().replace("_", "-") == "utf-8-sig":
        text = drop_bom(text)
    return unify_newlines(text)


def _codec_udf(encoding: str):
    import pandas as pd

    @F.pandas_udf("string")
    def decode_series(content: pd.Series) -> pd.Series:
        return content.map(lambda raw: None if raw is None else bytes(raw).decode(encoding))

    return decode_series
