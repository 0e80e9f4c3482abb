"""Reading scalar fields out of JSON text without ever failing a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.text import trim_unicode

# Output column and the JSON key it is read from.
TRIAGE_KEYS = {"theme": "theme", "severity": "severity", "action": "suggested_action"}


def with_scalars(df: DataFrame, json_col: str, keys: Mapping[str, str]) -> DataFrame:
    """Add top-level JSON values as text; null if malformed, missing or not scalar.

    The text is parsed once for all keys.  Only a value that looks like an
    object or array pays for a second, typed parse.
    """
    parsed = df.withColumn(
        "_parsed", F.from_json(json_col, ", ".join(f"`{key}` string" for key in keys.values()))
    )
    return parsed.withColumns(
        {name: _scalar(F.col("_parsed")[key], json_col, key) for name, key in keys.items()}
    ).drop("_parsed")


def _scalar(value: Column, json_col: str, key: str) -> Column:
    kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(json_col), f"$.{key}", "variant")
    )
    nested = F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))
    return F.when(value.rlike(r"\A[{\[]") & nested, F.lit(None)).otherwise(value)


def with_triage_fields(df: DataFrame, json_col: str = "triage_result") -> DataFrame:
    """Add ``theme``, ``severity`` and ``action``, trimmed; severity in lower case."""
    return with_scalars(df, json_col, TRIAGE_KEYS).withColumns(
        {
            "theme": trim_unicode(F.col("theme")),
            "severity": F.lower(trim_unicode(F.col("severity"))),
            "action": trim_unicode(F.col("action")),
        }
    )


def is_malformed(json_text: Column) -> Column:
    """True for text that is there but does not parse."""
    return json_text.isNotNull() & F.try_parse_json(json_text).isNull()


def normal_severity(
    severity: Column, known=fv.SEVERITIES, default: str = fv.DEFAULT_SEVERITY
) -> Column:
    """Known severities pass, everything else (null too) becomes the default."""
    return F.when(severity.isin(*known), severity).otherwise(F.lit(default))
