"""Choosing the newest file of a dataset from a published catalog document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = """
    dataset array<struct<
        title: string,
        modified: string,
        distribution: array<struct<
            title: string, downloadURL: string, accessURL: string, mediaType: string, description: string
        >>
    >>
"""

# Fixed value: how the data year is written in a distribution title.
YEAR_PATTERN = r"\b(\d{4})-\d{2}\b"

# Year of the candidate that stands for a dataset without files.
ABSENT = -1


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per dataset of a catalog file."""
    document = spark.read.schema(CATALOG_SCHEMA).json(path, multiLine=True)
    return document.select(F.inline("dataset"))


def latest_distribution(datasets: DataFrame, titles: dict[str, str] | None = None) -> DataFrame:
    """The newest CSV distribution of every dataset, by the year in its title.

    ``titles`` (key -> dataset title) restricts the result to known datasets and adds their key.

    ``datasets`` has ``title``, ``modified`` and the nested ``distribution``. Ties go to the greater
    title, then the greater address. Datasets without any CSV are left out, but a dataset that
    ``titles`` asks for has to be there: the query fails when it runs, not here.
    """
    entry = F.col("entry")
    link = F.coalesce(F.nullif(entry["downloadURL"], F.lit("")), entry["accessURL"], F.lit(""))
    candidates = (
        datasets.select(F.trim("title").alias("dataset_title"), "modified", F.explode("distribution").alias("entry"))
        .select(
            "dataset_title",
            "modified",
            F.trim(link).alias("csv_url"),
            F.trim(F.coalesce(entry["title"], F.lit(""))).alias("distribution_title"),
            entry["mediaType"].alias("media_type"),
            F.left(F.coalesce(entry["description"], F.lit("")), F.lit(200)).alias("description"),
        )
        .filter(F.col("csv_url").endswith(".csv"))
    )
    year = F.regexp_extract("distribution_title", YEAR_PATTERN, 1).try_cast("int")
    dated = candidates.select(
        "dataset_title",
        F.coalesce(year, F.lit(0)).alias("year"),
        "distribution_title",
        "csv_url",
        F.coalesce("media_type", F.lit("")).alias("media_type"),
        "description",
        F.col("modified").alias("dataset_modified"),
    )
    if titles is not None:
        # Every requested title has one candidate older than any file: where it is chosen, there is no file.
        wanted = datasets.sparkSession.createDataFrame([(title,) for title in titles.values()], "dataset_title string")
        absent = wanted.withColumn("year", F.lit(ABSENT))
        dated = dated.filter(F.col("dataset_title").isin(*titles.values())).unionByName(absent, allowMissingColumns=True)
    # The greatest row of each dataset, combined on the map side: one pass, however many files a dataset has.
    order = ["year", "distribution_title", "csv_url", "media_type", "description", "dataset_modified"]
    newest = dated.groupBy("dataset_title").agg(F.max(F.struct(*order)).alias("newest")).select("dataset_title", "newest.*")
    chosen = newest.select(
        "dataset_title",
        F.nullif("year", F.lit(0)).alias("data_year"),
        "csv_url",
        "distribution_title",
        F.nullif("media_type", F.lit("")).alias("media_type"),
        "description",
        "dataset_modified",
    )
    if titles is None:
        return chosen
    keys = F.create_map(*[F.lit(x) for key, title in titles.items() for x in (title, key)])
    found = chosen.select(keys[F.col("dataset_title")].alias("key"), "*")
    missing = F.raise_error(F.concat(F.lit("no CSV distribution for "), F.col("key")))
    return found.filter(F.when(F.col("data_year") == ABSENT, missing).otherwise(F.lit(True)))
