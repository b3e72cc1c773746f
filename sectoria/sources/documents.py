"""JSON catalogues, lookups with a default, HTML tables and GeoJSON features."""

from __future__ import annotations

from collections.abc import Mapping
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TITLE = r"deces-(\d{4})\.txt"


def yearly_files(documents: DataFrame, json: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Yearly files listed in catalogue documents: first entry per year.

    A resource counts when its whole title matches; its address is the first
    non-empty one of ``latest`` and ``url``.
    """
    schema = "resources array<struct<title:string,latest:string,url:string>>"
    listed = documents.select(*by, F.posexplode(F.from_json(json, schema)["resources"]).alias("place", "r"))
    address = F.coalesce(F.nullif("r.latest", F.lit("")), F.nullif("r.url", F.lit("")), F.lit(""))
    found = listed.where(F.col("r.title").rlike(f"^{TITLE}$")).select(
        *by,
        F.regexp_extract("r.title", TITLE, 1).cast("int").alias("annee_file"),
        F.col("r.title").alias("nom_fichier"),
        address.alias("url_file"),
        "place",
    )
    first = F.min_by(F.struct("nom_fichier", "url_file"), F.struct("place", "url_file")).alias("f")
    return found.groupBy(*by, "annee_file").agg(first).select(*by, "annee_file", "f.nom_fichier", "f.url_file")


def with_default_file(requests: DataFrame, files: DataFrame, default: int = 2024) -> DataFrame:
    """File of each requested year (``annee``), or that of the default year; unknown texts use the default.

    Of several files of one year the first by name and address counts, so every request has one row.
    """
    fields = ["annee_file", "nom_fichier", "url_file"]
    one = F.min(F.struct("nom_fichier", "url_file")).alias("f")
    files = files.groupBy("annee_file").agg(one).select("annee_file", "f.*")
    fallback = files.where(F.col("annee_file") == default).agg(F.first(F.struct(*fields))).scalar()
    asked = requests.withColumn("_year", F.col("annee").try_cast("int"))
    joined = asked.join(files.select(F.col("annee_file").alias("_year"), F.struct(*fields).alias("_f")), "_year", "left")
    return (
        joined.withColumn("used_default", F.col("_f").isNull())
        .withColumn("_f", F.coalesce("_f", fallback))
        .select(*requests.columns, "_f.*", "used_default")
    )


def html_rows(
    pages: DataFrame,
    html: str,
    fields: Mapping[str, int],
    keep: tuple[str, ...] = (),
    table: str = r"(?s)<table[^>]*wikitable[^>]*>(.*?)</table>",
    row: str = r"(?s)<tr[^>]*>(.*?)</tr>",
    cell: str = r"(?s)<t[hd][^>]*>(.*?)</t[hd]>",
    skip: int = 1,
    min_cells: int = 2,
) -> DataFrame:
    """Table rows of HTML pages as records; ``fields`` maps a column name to a cell number from 0.

    The first table of a page is read, its first ``skip`` rows and rows with
    fewer than ``min_cells`` cells are left out. An empty ``table`` pattern
    reads the whole page.
    """
    body = F.regexp_extract(html, table, 1) if table else F.col(html)
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(body, F.lit(row), F.lit(1))).alias("ligne", "_row"))
    cells = F.regexp_extract_all("_row", F.lit(cell), F.lit(1))
    split = rows.where(F.col("ligne") >= skip).withColumn("_cells", cells).where(F.size("_cells") >= min_cells)

    def clean(index: int):
        return F.trim(F.regexp_replace(F.get("_cells", F.lit(index)), r"(?s)<[^>]*>", ""))

    return split.select(*keep, "ligne", *[clean(i).alias(name) for name, i in fields.items()])


# A comment, a tag, a character reference, a run of text, or a stray sign.
TOKEN = r"(?s)(<!--.*?-->|</?[A-Za-z][^>]*>|&#?[0-9A-Za-z]+;|[^<&]+|[<&])"
# Tags that part words; others stand inside of them.
APART = [f"{end}{t}" for t in ("table", "tr", "td", "th", "p", "div", "li", "br") for end in ("", "/")]
CELLS, PARTS = ("td", "th"), ("tr", "thead", "tbody", "tfoot", "caption")


def decoded_reference(token: Column) -> Column:
    """Character of a decimal, hexadecimal or named reference; what names none stays as it is."""
    names = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
    table = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    digits = F.regexp_extract(token, r"^&#([0-9]{1,7});$", 1)
    hexadecimal = F.regexp_extract(token, r"^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
    code = F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10).cast("int"))
    known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
    named = F.try_element_at(table, F.regexp_extract(token, "^&([0-9A-Za-z]+);$", 1))
    return F.coalesce(F.when(known, character), named, token)


def html_table_rows(
    pages: DataFrame,
    html: str,
    fields: Mapping[str, int],
    keep: tuple[str, ...] = (),
    word: str = "wikitable",
    skip: int = 1,
    min_cells: int = 2,
) -> DataFrame:
    """Rows of a table of each HTML page as records; ``fields`` maps a column name to a cell number from 0.

    The first table whose tag holds ``word`` is read, its first ``skip`` rows and rows with fewer than ``min_cells`` cells are
    left out. Rows and cells end where their tag closes or the next one opens. A table inside a cell is text of that cell.
    Character references are decoded and white space becomes one space; cells that a row lacks are null. Pages
    without such a table, null and empty ones have no rows.

    The tokens of a page are rows; the depth of tables and the numbers of rows and cells are running sums over them.
    """
    numbered = pages.select(*keep, F.monotonically_increasing_id().alias("_page"), F.col(html).alias("_html"))
    tokens = numbered.select(
        *keep, "_page", F.posexplode(F.regexp_extract_all("_html", F.lit(TOKEN), F.lit(1))).alias("_at", "_token")
    )
    tag = F.lower(F.regexp_extract("_token", "^<(/?[A-Za-z][A-Za-z0-9]*)", 1))
    inside_tag = F.col("_token").startswith("<!--") | (tag != "")
    step = F.when(F.col("_tag") == "table", 1).when(F.col("_tag") == "/table", -1).otherwise(0)
    page = Window.partitionBy("_page").orderBy("_at")
    so_far = page.rowsBetween(Window.unboundedPreceding, 0)
    # A closing tag without an open table does not count.
    tagged = tokens.withColumns({"_tag": tag, "_is_tag": inside_tag}).withColumn("_sum", F.sum(step).over(so_far))
    deep = tagged.withColumn("_depth", F.col("_sum") - F.least(F.min("_sum").over(so_far), F.lit(0)))
    opens = (F.col("_tag") == "table") & F.contains("_token", F.lit(word))
    start = F.struct(F.col("_at").alias("at"), F.col("_depth").alias("depth"))
    begun = deep.withColumn("_start", F.first(F.when(opens, start), ignorenulls=True).over(so_far)).where(
        F.col("_start").isNotNull()
    )
    ended = F.max((F.col("_depth") < F.col("_start.depth")).cast("int")).over(so_far) == 1
    table = begun.withColumn("_ended", ended).where(~F.col("_ended"))
    own = F.col("_depth") == F.col("_start.depth")
    closes = [f"/{t}" for t in (*CELLS, *PARTS)]
    mark = F.when(own & F.col("_tag").isin(*CELLS), 1).when(own & F.col("_tag").isin(*PARTS, *closes), 0)
    counted = table.withColumns(
        {
            "_row": F.sum((own & (F.col("_tag") == "tr")).cast("int")).over(so_far),
            "_cell": F.sum((own & F.col("_tag").isin(*CELLS)).cast("int")).over(so_far),
            "_open": F.last(mark, ignorenulls=True).over(so_far),
        }
    ).where(F.col("_open") == 1)
    shown = F.when(F.col("_is_tag"), F.when(F.col("_tag").isin(*APART), " ").otherwise(""))
    text = shown.when(F.col("_token").rlike("^&.+;$"), decoded_reference(F.col("_token"))).otherwise(F.col("_token"))
    pieces = F.array_sort(F.collect_list(F.struct("_at", text.alias("text"))))
    joined = F.array_join(F.transform(pieces, lambda p: p["text"]), "")
    cells = counted.groupBy(*keep, "_page", "_row", "_cell").agg(joined.alias("_text"))
    clean = F.trim(F.regexp_replace("_text", r"[\s\u00a0]+", " "))
    rows = cells.groupBy(*keep, "_page", "_row").agg(F.array_sort(F.collect_list(F.struct("_cell", clean.alias("text")))).alias("_cells"))
    line = (F.greatest(F.col("_row"), F.lit(1)) - 1).cast("int").alias("ligne")
    values = [F.get("_cells", F.lit(i))["text"].alias(name) for name, i in fields.items()]
    return rows.where(F.size("_cells") >= min_cells).select(*keep, line, *values).where(F.col("ligne") >= skip)


def geojson_features(documents: DataFrame, json: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features of GeoJSON documents: name, code and geometry text."""
    schema = "features array<struct<properties:struct<nom:string,code:string>,geometry:string>>"
    return documents.select(*keep, F.explode(F.from_json(json, schema)["features"]).alias("f")).select(
        *keep, "f.properties.nom", "f.properties.code", "f.geometry"
    )


def features_named(features: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Features whose name occurs in a column of another table."""
    return features.join(names.select(F.col(column).alias("nom")), "nom", "left_semi")
