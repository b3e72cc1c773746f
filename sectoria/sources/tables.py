"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

# Rows of a file when years are written: some hundred MB of records.
ROWS_PER_FILE = 2_000_000


def read_table(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.table(name).select(*columns)


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    driver: str,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Columns of a database table; ``split`` = (column, lower, upper, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, driver=driver)
    if split is not None:
        column, lower, upper, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load().select(*columns)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace the catalog table ``name`` by the rows of ``df``, which may be read from the table itself.

    Every version is written to a folder of its own; then the name is pointed to it in one step. A run that fails leaves the
    version before, and readers that have begun keep theirs. Folders of earlier versions stay in the shared folder.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name.replace(".", "_"))
    df.write.parquet(path)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path}`")


def replace_folder(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_database_table(df: DataFrame, url: str, table: str, driver: str) -> None:
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=table, driver=driver).save()


def replace_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, encoding="UTF-8", **options)


def replace_years(df: DataFrame, path: str, year: str = "annee", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace only the years present in ``df``; other years of the folder stay.

    The rows of every year are counted first; a year is then written by as many tasks as it takes at ``rows_per_file`` rows
    each, so that small years have one file and no task holds a large year. ``df`` is read twice: store it before if it is
    costly to form.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != year]
    files = F.ceil(F.count(F.lit(1)) / rows_per_file)
    # One entry for every year; a missing year has the key of an empty text.
    key = F.coalesce(F.col(f"`{year}`").cast("string"), F.lit(""))
    counts = df.groupBy(key.alias("y")).agg(files.cast("long").alias("n"))
    shares = counts.agg(F.map_from_entries(F.collect_list(F.struct("y", "n")))).scalar()
    share = F.pmod(F.xxhash64(*others), F.try_element_at(F.col("_shares"), key)) if others else F.lit(0)
    spread = df.withColumn("_shares", shares).withColumn("_share", share).drop("_shares")
    years = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    grouped = spread.repartition(int(years), F.col(f"`{year}`"), "_share").drop("_share")
    writer = grouped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year)
    writer.option("maxRecordsPerFile", 2 * rows_per_file).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
