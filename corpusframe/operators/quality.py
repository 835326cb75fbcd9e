"""Data-quality rules over a table of dataset submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions.text import strip

# Accepted tasks, licences and visibilities.
TASKS = (
    "N/A", "NLP", "ASR", "LID", "TTS", "MT", "LM", "LLM", "NLU", "NLG", "CALL", "RAG", "CV",
    "ML", "OTH",
)
LICENSES = (
    "Apache-2.0", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-ND-4.0", "CC-BY-NC-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-SA-4.0", "CC-SA-1.0", "CC0-1.0", "EUPL-1.2", "AGPL-3.0",
    "GFDL-1.3", "GPL-3.0", "LGPLLR", "MIT", "MPL-2.0", "NLOD-2.0", "NOODL-1.0", "ODC-By-1.0",
    "ODbL-1.0", "OGL-Canada-2.0", "OGL-UK-3.0", "OPUBL-1.0", "OGDL-Taiwan-1.0", "Unlicense",
)
VISIBILITIES = ("public", "private", "restricted")

# Submission fields by type.
TEXT_FIELDS = (
    "name", "shortDescription", "longDescription", "locale", "task", "format",
    "licenseAbbreviation", "license", "licenseUrl", "other", "restrictions", "forbiddenUsage",
    "additionalConditions", "pointOfContactFullName", "pointOfContactEmail", "fundedByFullName",
    "fundedByEmail", "legalContactFullName", "legalContactEmail", "intendedUsage",
    "ethicalReviewProcess", "visibility", "id", "organizationId", "slug", "createdAt",
    "updatedAt", "createdByFullName", "createdByEmail", "createdBy", "status", "fileUploadId",
    "sampleFileReferenceId", "exclusivityOptOutAt", "submittedAt",
)
FLAG_FIELDS = ("showContactInfo", "isPaid", "exclusivityOptOut", "agreeToSubmit")
NUMBER_FIELDS = ("basePriceCents",)
MAY_BE_EMPTY = ("licenseAbbreviation",)

# Fields a final submission needs, in report order, and fields per request.
REQUIRED_FIELDS = (
    "name", "longDescription", "task", "locale", "format", "restrictions", "forbiddenUsage",
    "pointOfContactFullName", "pointOfContactEmail", "showContactInfo", "visibility",
)
UPDATE_FIELDS = (
    "name", "shortDescription", "longDescription", "locale", "task", "format",
    "licenseAbbreviation", "license", "licenseUrl", "other", "restrictions", "forbiddenUsage",
    "additionalConditions", "pointOfContactFullName", "pointOfContactEmail", "fundedByFullName",
    "fundedByEmail", "legalContactFullName", "legalContactEmail", "createdByFullName",
    "createdByEmail", "intendedUsage", "ethicalReviewProcess", "showContactInfo", "visibility",
    "exclusivityOptOut", "isPaid", "basePriceCents", "currency",
)


def field_type(name: str) -> str:
    return "boolean" if name in FLAG_FIELDS else "long" if name in NUMBER_FIELDS else "string"


def all_fields() -> tuple[str, ...]:
    return (*TEXT_FIELDS, *FLAG_FIELDS, *NUMBER_FIELDS)


def field(df: DataFrame, name: str) -> Column:
    """A submission field, trimmed when it is text; null when the table lacks it."""
    if name not in df.columns:
        return F.lit(None).cast(field_type(name))
    value = F.col(name).cast(field_type(name))
    return strip(value) if name in TEXT_FIELDS else value


def predefined_license(df: DataFrame) -> Column:
    return F.coalesce(field(df, "licenseAbbreviation").isin(*LICENSES), F.lit(False))


def violations(df: DataFrame, key_columns: tuple[str, ...] = ()) -> Column:
    """Array of rule codes a row breaks; empty for a valid submission.

    Columns that are neither submission fields nor ``key_columns`` are unknown fields, and a
    row that fills one breaks the 'unknown' rule.
    """
    rules = []
    for name in TEXT_FIELDS:
        if name in df.columns and name not in MAY_BE_EMPTY:
            rules.append(F.when(field(df, name) == "", F.lit(f"{name}:empty")))
    for name, allowed in (("task", TASKS), ("visibility", VISIBILITIES)):
        value = field(df, name)
        rules.append(F.when((value != "") & ~value.isin(*allowed), F.lit(f"{name}:not_listed")))
    abbreviation = field(df, "licenseAbbreviation")
    custom = abbreviation.isNotNull() & ~predefined_license(df)
    named = custom | field(df, "licenseUrl").isNotNull()
    rules.append(F.when(named & field(df, "license").isNull(), F.lit("license:required")))
    paid = F.coalesce(field(df, "isPaid"), F.lit(False))
    priced = field(df, "basePriceCents").isNotNull()
    rules.append(F.when(paid & ~priced, F.lit("basePriceCents:required")))
    rules.append(F.when(priced & ~paid, F.lit("isPaid:required")))
    known = {*all_fields(), *key_columns}
    for name in df.columns:
        if name not in known:
            rules.append(F.when(F.col(name).isNotNull(), F.lit(f"{name}:unknown")))
    return F.array_compact(F.array(*rules))


def validate_submissions(df: DataFrame, key_columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows with text fields trimmed and their ``violations``."""
    found = violations(df, key_columns)
    trimmed = [field(df, c).alias(c) if c in TEXT_FIELDS else F.col(c) for c in df.columns]
    return df.select(*trimmed, found.alias("violations"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) rows of ``validate_submissions``."""
    bad = F.size("violations") > 0
    return validated.filter(~bad).drop("violations"), validated.filter(bad)


def missing_fields(df: DataFrame, require_file_upload_id: bool = False) -> Column:
    """Array of what a row still lacks for final submission, in report order."""
    checks = [F.when(field(df, n).isNull(), F.lit(n)) for n in REQUIRED_FIELDS]
    abbreviation, named = field(df, "licenseAbbreviation"), field(df, "license")
    unlicensed = (F.coalesce(abbreviation, F.lit("")) == "") & (F.coalesce(named, F.lit("")) == "")
    checks.append(F.when(unlicensed, F.lit("licenseAbbreviation|license")))
    agreed = F.coalesce(field(df, "agreeToSubmit"), F.lit(False))
    checks.append(F.when(~agreed, F.lit("agreeToSubmit")))
    if require_file_upload_id:
        checks.append(F.when(field(df, "fileUploadId").isNull(), F.lit("fileUploadId")))
    return F.array_compact(F.array(*checks))


def completeness_report(df: DataFrame, require_file_upload_id: bool = False) -> DataFrame:
    """How many rows lack each item."""
    lacking = df.select(F.explode(missing_fields(df, require_file_upload_id)).alias("field"))
    return lacking.groupBy("field").agg(F.count(F.lit(1)).alias("n_rows"))


def submission_payload(df: DataFrame, allowed: tuple[str, ...]) -> Column:
    """JSON of the allowed, non-null fields; a predefined licence drops its custom details."""
    predefined = predefined_license(df)
    cells = []
    for name in (*all_fields(), "currency"):
        if name not in allowed:
            continue
        if name == "currency":
            value = F.when(field(df, "isPaid"), F.lit("usd"))
        else:
            value = field(df, name)
        if name in ("license", "licenseUrl") and "licenseAbbreviation" in allowed:
            value = F.when(~predefined, value)
        cells.append(value.alias(name))
    return F.to_json(F.struct(*cells))
