"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.schema import FIELDS

# (?U) makes \s cover all Unicode white space, which trim() does not. The four separators U+001C to U+001F are
# white space of no Unicode property, but str.strip() takes them as such.
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(column: Column | str) -> Column:
    return F.regexp_replace(F.col(column) if isinstance(column, str) else column, _EDGES, "")


def clean(column: str) -> Column:
    """Stripped text, with ``""`` for a missing value."""
    return F.coalesce(strip(F.col(column).cast("string")), F.lit("")).alias(column)


def clean_records(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    return df.select(*[clean(c) for c in columns or df.columns])


def normalise_email(column: Column | str) -> Column:
    return F.lower(strip(column))


def blank_to_null(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(strip(c) != "", c)


def linkage_view(records: DataFrame) -> DataFrame:
    """Records as the matcher sees them: folded email and null for every blank.

    Survivorship keeps voting on the unfolded records.
    """
    view = records.withColumn("email", normalise_email("email")) if "email" in records.columns else records
    return view.withColumns({c: blank_to_null(c) for c in FIELDS if c in records.columns})
