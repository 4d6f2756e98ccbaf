"""Reading the raw text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import null_if_tokens
from cohortlens.sources.quoted import BrokenQuotes, ends_inside, read_lines, records
from cohortlens.sources.schemas import INDIVIDUAL, REGISTRY_HEADERS, all_text

_QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def check_quotes(spark: SparkSession, path: str | list[str], *, exclude: str | None = None) -> None:
    """Raises ``BrokenQuotes`` where a quoted field does not end in the line it begins in.

    A reader of single lines would take the line break for the end of a row. One more scan of the text, without a shuffle.
    """
    lines = read_lines(spark, path, exclude)
    broken = lines.filter(ends_inside(F.col("line"), False)).select(F.substring("line", 1, 80).alias("line")).first()
    if broken is not None:
        hint = "if fields contain line breaks, load with multi_line=True"
        raise BrokenQuotes(f"unbalanced quotes in {broken['line']!r}; {hint}")


def _rows(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None,
    multi_line: bool,
    exclude: str | None = None,
    header: bool = True,
) -> DataFrame:
    if schema is None:
        schema = all_text(spark.read.options(**_QUOTING).csv(path).columns)
    if multi_line:
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
        parsed = F.from_csv("record", F.lit(columns), {**_QUOTING, "mode": "PERMISSIVE"})
        return records(spark, path, header=header, exclude=exclude).select(parsed.alias("_row")).select("_row.*")
    check_quotes(spark, path, exclude=exclude)
    rows = spark.read.options(**{**_QUOTING, "header": str(header).lower()}, mode="PERMISSIVE").schema(schema).csv(path)
    return rows if exclude is None else rows.filter(~F.col("_metadata.file_name").contains(exclude))


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    *,
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV with a header, every column as text, quotes doubled inside quotes.

    Without ``header`` the first row is data and ``schema`` has to be given.
    Short rows are filled with nulls and surplus fields dropped. A quote opens a field only where one starts, so that
    ``5" pipe`` is a plain value; a field that is never closed raises ``BrokenQuotes``. A line is a row, unless
    ``multi_line`` admits line breaks inside quoted fields, at the price of a shuffle of the text. Files are split in either case.
    """
    return _rows(spark, path, schema, multi_line, header=header)


def schema_from_header(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """All-text schema named after the file's header, in lower case. Reads the header only."""
    return all_text(name.lower() for name in spark.read.options(**_QUOTING).csv(path).columns)


def with_loaded_at(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp())


def load_raw(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options: bool
) -> DataFrame:
    """A raw file as a landing table: text columns without null tokens, plus the load time."""
    schema = schema or schema_from_header(spark, path)
    return with_loaded_at(null_if_tokens(read_raw_csv(spark, path, schema, **options)))


def read_glob(
    spark: SparkSession,
    pattern: str,
    exclude: str = "fileheader",
    schema: T.StructType | None = None,
    *,
    multi_line: bool = False,
) -> DataFrame:
    """All files matching the pattern except companions whose name contains ``exclude``.

    The filter on the file name is applied while listing, so excluded files are never opened. Rows are read as by
    ``read_raw_csv``.
    """
    return _rows(spark, pattern, schema, multi_line, exclude)


def prefilter_registry(wide: DataFrame) -> DataFrame:
    """The needed columns of active individuals, out of a file several hundred columns wide."""
    deactivated = F.col(f"`{REGISTRY_HEADERS['deactivation_date']}`")
    return wide.filter(
        (F.col(f"`{REGISTRY_HEADERS['entity_type_code']}`") == INDIVIDUAL)
        & (deactivated.isNull() | (deactivated == ""))
    ).select(*[F.col(f"`{header}`").alias(short) for short, header in REGISTRY_HEADERS.items()])


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small reference table with pinned types."""
    return spark.read.options(**_QUOTING, mode="FAILFAST").schema(schema).csv(path)
