"""Fixed-position lines, delimited files, archives and file families."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_WIDTH = 200
# Files whose headers are read at the same time.
HEADERS_AT_ONCE = 16


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "ISO-8859-1",
    width: int = LINE_WIDTH,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fixed-position lines as one trimmed column ``value``; files stay splittable.

    ``keep`` names columns taken from folder names, such as ``annee=2024``.
    """
    lines = spark.read.schema("value string").options(encoding=encoding, sep="\u0001", quote="").csv(path)
    return lines.select(
        *[F.col(c).cast("string").alias(c) for c in keep], F.trim(F.substring("value", 1, width)).alias("value")
    )


def parse_death_lines(lines: DataFrame, line: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split death lines into their nine text fields.

    Name up to ``*``, first name up to ``/``, then sex, birth date, birth code
    and birth city (up to three spaces). Country, death date and death code
    stand at fixed positions; without letters at its position the country is
    FRANCE.
    """
    text = F.col(line)
    star, slash = F.instr(text, "*"), F.instr(text, "/")
    gap = "   "
    cut = lines.select(
        *keep,
        text.alias("_text"),
        F.trim(text.substr(slash + 1, F.length(text))).alias("_rest"),
        F.substring(text, 125, 76).alias("_abroad"),
        star.alias("_star"),
        slash.alias("_slash"),
    )
    text = F.col("_text")
    country = F.substring(F.substring_index("_abroad", gap, 1), 1, 30)
    fields = {
        "nom": F.substring_index(text, "*", 1),
        "prenom": text.substr(F.col("_star") + 1, F.col("_slash") - F.col("_star") - 1),
        "sex": F.substring("_rest", 1, 1),
        "date_naissance": F.substring("_rest", 2, 8),
        "num_insee_naissance": F.substring("_rest", 10, 5),
        "ville_naissance": F.substring_index(F.substring("_rest", 15, LINE_WIDTH), gap, 1),
        "pays_naissance": F.when(F.col("_abroad").rlike(r"^\p{L}"), country).otherwise("FRANCE"),
        "date_deces": F.substring(text, 155, 8),
        "num_insee_deces": F.substring(text, 163, 5),
    }
    # One-element inline: later filters see finished fields and do not repeat the parse for each check.
    return cut.select(*keep, F.inline(F.array(F.struct(*[value.alias(name) for name, value in fields.items()]))))


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = ",", **options: str
) -> DataFrame:
    """UTF-8 file with a header and a declared schema."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep, encoding="UTF-8", **options)


def read_zipped(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """First member of each zip archive of a folder as a delimited file with header."""
    return unzip_rows(spark.read.format("binaryFile").load(path).select("content"), schema)


def unzip_rows(archives: DataFrame, schema: str | T.StructType, chunk: int = 50_000) -> DataFrame:
    """Rows of the first member of each archive in the column ``content``.

    An archive cannot be split, so one task reads it, in chunks; the casts to
    the schema happen in Spark.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    with archive.open(archive.namelist()[0]) as member:
                        for part in pd.read_csv(member, dtype=str, chunksize=chunk):
                            yield part.reindex(columns=texts.names).astype(object).where(part.notna(), None)

    rows = archives.mapInPandas(unpack, texts)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by their header line; files without one are left out.

    One line of every file is read, several files at a time; only paths and headers come to the driver.
    """
    listed = spark.read.format("binaryFile").load(path).select("path").collect()
    paths = sorted(row.path for row in listed)

    def header(file: str) -> tuple[str, ...]:
        first = spark.read.text(file).first()
        return tuple(next(csv.reader([first.value.removeprefix("\ufeff")]), ())) if first else ()

    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        headers = list(pool.map(header, paths))
    found: dict[tuple[str, ...], list[str]] = {}
    for names, file in zip(headers, paths, strict=True):
        if names:
            found.setdefault(names, []).append(file)
    return found


def read_family(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, pattern: str, key: str
) -> DataFrame:
    """Union of the files of a family by column names; ``key`` is the part of the file path that ``pattern`` captures.

    Files of one header are read together. Columns may stand in any order; a declared column that a file lacks is null there, other
    columns are left out. Of columns of one name the first counts.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    found = F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit("")).alias(key)
    parts = []
    for names, files in sorted(file_headers(spark, path).items()):
        # Columns are read by their place in this header, under the name that stands there for the first time.
        layout = T.StructType()
        for place, name in enumerate(names):
            first = name in target.names and names.index(name) == place
            layout.add(name if first else f"_other_{place}", target[name].dataType if first else T.StringType())
        rows = spark.read.schema(layout).csv(files, header=True, encoding="UTF-8")
        columns = [
            F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields
        ]
        parts.append(rows.select(*columns, found))
    if not parts:
        return spark.createDataFrame([], T.StructType([*target.fields, T.StructField(key, T.StringType())]))
    return reduce(DataFrame.unionByName, parts)
