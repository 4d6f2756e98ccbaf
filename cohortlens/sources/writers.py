"""Views, tables and extracts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators.relational import union_all

# Folder of the files that name a table's complete versions, hidden from readers of the data.
VERSIONS = "_versions"


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def resolve_namespace(layer: str | None, default: str) -> str:
    """A layer's own name as it stands; the default for models without a layer."""
    return default.strip() if layer is None else layer.strip()


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, Callable[[str], JavaObject]]:
    """The file system of ``path`` and what makes a path of a text."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def table_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions of a table, oldest first."""
    files, make = _files(spark, path)
    marks = make(f"{path}/{VERSIONS}")
    names = sorted(mark.getPath().getName() for mark in files.listStatus(marks)) if files.exists(marks) else []
    return [f"{path}/data-{name.split('-', 1)[1]}" for name in names]


def write_table(
    df: DataFrame, root: str, layer: str | None, name: str, default: str = "dev", *, keep: int = 2
) -> DataFrame:
    """Replace the table ``name`` in the layer's folder and return a scan of it.

    Every write goes to a folder of its own. Only when it is complete, an empty file named after it, created in one
    step, makes it the current version; a write that fails leaves the old one in place. The last ``keep``
    versions stay, so that whoever reads the previous one can finish.
    """
    spark, path = df.sparkSession, f"{root}/{resolve_namespace(layer, default)}/{name}"
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/data-{version}")
    files, make = _files(spark, path)
    marks = make(f"{path}/{VERSIONS}")
    files.mkdirs(marks)
    held = sorted(mark.getPath().getName() for mark in files.listStatus(marks))
    number = int(held[-1].split("-", 1)[0]) + 1 if held else 0
    files.createNewFile(make(f"{path}/{VERSIONS}/{number:012d}-{version}"))
    for old in held[: len(held) + 1 - keep]:
        # The mark goes first: a version without data must not look complete.
        files.delete(make(f"{path}/{VERSIONS}/{old}"), False)
        files.delete(make(f"{path}/data-{old.split('-', 1)[1]}"), True)
    return read_table(spark, root, layer, name, default, schema=df.schema)


def read_table(
    spark: SparkSession,
    root: str,
    layer: str | None,
    name: str,
    default: str = "dev",
    *,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The newest complete version of a table."""
    versions = table_versions(spark, f"{root}/{resolve_namespace(layer, default)}/{name}")
    if not versions:
        raise LookupError(f"no complete version of table {name!r}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(versions[-1])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, doubled quotes, and blanks at the ends of a field kept."""
    df.write.mode("overwrite").options(
        header="true",
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def write_extract(
    df: DataFrame, path: str, *, order: Sequence[Column | str] | None = None, files: int | None = None
) -> None:
    """Serving copy: lower-case header, true/false, plain decimals, nothing for null.

    With ``order`` the rows are dealt to ``files`` ranges (the session's number of shuffle partitions), each written
    sorted by a task of its own: the files' names have the order of the ranges, and no task sees all rows. The
    copy is written beside the old one, which it replaces when it is complete.
    """

    def served(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("string")
        return column.alias(field.name.lower())

    spark = df.sparkSession
    if order is not None:
        files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    aside = f"{path}-{uuid.uuid4().hex}"
    df.select(*[served(f) for f in df.schema.fields]).write.options(
        header="true", quote='"', escape='"', nullValue="", emptyValue=""
    ).csv(aside)
    system, make = _files(spark, path)
    system.delete(make(path), True)
    if not system.rename(make(aside), make(path)):
        raise OSError(f"could not put {aside!r} in place of {path!r}")


def read_extract(spark: SparkSession, path: str, schema: T.StructType | str, position: str = "position") -> DataFrame:
    """An extract's rows with their place, from 1, in the order of the files' names and the rows in them.

    Places are counted per split of a file, and splits, few, are added up in order: rows are not sorted in one task.
    """
    rows = spark.read.options(header="true", quote='"', escape='"').schema(schema).csv(path)
    split = ["_file", "_start"]
    marked = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )
    # The generator of places reads files in splits of one task; an aggregate over the same scan sees the same ones.
    counts = marked.groupBy(*split).agg(F.count("*").alias("_rows"))
    before = W.orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*split, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(*split).orderBy("_place"))
    placed = marked.withColumn("_inside", inside).join(offsets, split)
    return placed.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(position))


def extract_manifest(extracts: dict[str, DataFrame]) -> DataFrame:
    """Name and row count of every extract."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("extract"), "row_count")
            for name, df in extracts.items()
        ]
    )
