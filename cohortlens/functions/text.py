"""Cleaning and fallback rules for text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value" in the source files.
NULL_TOKENS = ("", "NULL", "*")


def null_if_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Trim every text column and turn the null tokens into nulls, in one projection."""
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)

    def cleaned(field: T.StructField) -> str:
        name = "`" + field.name.replace("`", "``") + "`"
        if not isinstance(field.dataType, T.StringType):
            return name
        return f"case when trim({name}) not in ({listed}) then trim({name}) end as {name}"

    return df.selectExpr(*[cleaned(f) for f in df.schema.fields])


def nonblank(c: Column) -> Column:
    """The trimmed text, or null when nothing is left of it."""
    return F.nullif(F.trim(c), F.lit(""))


def first_nonblank(*cols: Column) -> Column:
    """First column that holds more than blanks."""
    return F.coalesce(*[nonblank(c) for c in cols])


def full_name(first: Column, last: Column, key: Column) -> Column:
    """"first last", skipping missing parts; the entity's key when both are blank."""
    return F.coalesce(nonblank(F.concat_ws(" ", first, last)), key)
