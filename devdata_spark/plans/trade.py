"""Bilateral trade flows by product, one classification version at a time.

Landed files, extracted or as the publisher's zip archive:

    <root>/hs_version=HS22/BACI_HS22_Y2020.csv ... or BACI_HS22.zip
    <root>/hs_version=HS22/product_codes_HS22.csv
    <root>/hs_version=HS22/country_codes.csv
    <root>/hs_version=HS22/Readme.txt
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas
from devdata_spark.errors import DataExtractionError
from devdata_spark.functions import text
from devdata_spark.operators import columns, filters, joins
from devdata_spark.sources import archives, documents, files

# Publisher columns and file names, and the harmonised names.
FLOW_COLUMNS = {
    "t": fields.YEAR,
    "i": fields.EXPORTER_CODE,
    "j": fields.IMPORTER_CODE,
    "k": fields.PRODUCT_CODE,
    "v": fields.VALUE,
    "q": fields.QUANTITY,
}
PRODUCT_COLUMNS = {"code": fields.PRODUCT_CODE, "description": fields.PRODUCT_DESCRIPTION}
COUNTRY_COLUMNS = {
    "country_code": fields.COUNTRY_CODE,
    "country_name": fields.COUNTRY_NAME,
    "country_iso3": fields.ISO3_CODE,
}
DROPPED_COUNTRY_COLUMN = "country_iso2"
DEFAULT_VERSION = "HS22"
FLOW_FILES, PRODUCT_FILES, COUNTRY_FILES, README = (
    "BACI_", "product_codes", "country_codes", "Readme.txt",
)
LINK_SECTION, LINK_PREFIX = "download-links", "HS"


# --- readers -----------------------------------------------------------------


def flows(
    spark: SparkSession,
    root: str,
    hs_version: str = DEFAULT_VERSION,
    *,
    product_labels: bool = False,
    country_labels: bool = False,
) -> DataFrame:
    """Trade flows of one version, with labels on request."""
    landed = _landed(spark, root, hs_version)
    raw = _csv(landed, FLOW_FILES + landed.version, schemas.TRADE_RAW)
    df = quality.validate(shape_flows(raw), list(FLOW_COLUMNS.values()), schema=schemas.TRADE_FLOWS)
    if product_labels:
        df = with_product_labels(df, _products(landed))
    if country_labels:
        df = with_country_labels(df, _countries(landed))
    return df


def products(spark: SparkSession, root: str, hs_version: str = DEFAULT_VERSION) -> DataFrame:
    """Product codes and descriptions of one version."""
    return _products(_landed(spark, root, hs_version))


def countries(spark: SparkSession, root: str, hs_version: str = DEFAULT_VERSION) -> DataFrame:
    """Country codes, names and ISO3 codes of one version."""
    return _countries(_landed(spark, root, hs_version))


def metadata(spark: SparkSession, root: str, hs_version: str = DEFAULT_VERSION) -> DataFrame:
    """The facts of the readme, as `key` and `value`."""
    landed = _landed(spark, root, hs_version)
    if landed.zipped:
        raw = archives.member_text(spark, landed.folder, prefix=README).select("text")
    else:
        files.require_files(spark, landed.folder, README)
        whole = spark.read.option("pathGlobFilter", README).text(landed.folder, wholetext=True)
        raw = whole.withColumnRenamed("value", "text")
    facts = documents.key_values(raw, "text", [])
    if facts.isEmpty():
        raise DataExtractionError("No metadata found")
    return facts


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The landed versions, from the folder names."""
    found = files.list_files(spark, f"{root}/hs_version=*")
    version = F.regexp_extract("path", "/hs_version=([^/]+)/", 1)
    return found.select(version.alias("hs_version")).distinct()


def download_links(pages: DataFrame, column: str, by: list[str]) -> DataFrame:
    """The versions offered on the publisher's pages, and where to fetch each.

    It is an error if no page has the download section, or none has a link in it.
    """
    found = documents.links(pages, column, by, section=LINK_SECTION, prefix=LINK_PREFIX)
    if found.isEmpty():
        with_section = pages.where(documents.has_section(F.col(column), LINK_SECTION))
        if with_section.isEmpty():
            raise DataExtractionError(f"No section {LINK_SECTION} found")
        raise DataExtractionError(f"No {LINK_PREFIX} links found in section {LINK_SECTION}")
    return found.withColumnsRenamed({"link_text": "hs_version", "href": "url"})


# --- tables ------------------------------------------------------------------


def shape_flows(raw: DataFrame) -> DataFrame:
    """Harmonised names and types. A cell that is not a number stops the job."""
    as_text = dict(raw.dtypes)

    def cell(name: str) -> Column:
        c = F.col(name)
        return text.missing_to_null(F.trim(c)) if as_text[name] == "string" else c

    types = {"t": "int", "i": "bigint", "j": "bigint", "v": "double", "q": "double"}
    typed = {c: text.strict(cell(c), t) for c, t in types.items()}
    typed["k"] = text.product_code(cell("k").cast("string"))
    return columns.rename(raw.withColumns(typed), FLOW_COLUMNS)


def shape_products(raw: DataFrame) -> DataFrame:
    """Product codes in the same form as in the flows."""
    coded = raw.withColumn("code", text.product_code(F.col("code").cast("string")))
    return columns.rename(coded, PRODUCT_COLUMNS)


def shape_countries(raw: DataFrame) -> DataFrame:
    """Country codes without the two-letter code."""
    coded = raw.drop(DROPPED_COUNTRY_COLUMN).withColumn(
        "country_code", text.strict(F.col("country_code"), "bigint")
    )
    return columns.rename(coded, COUNTRY_COLUMNS)


def with_product_number(df: DataFrame, into: str = "product_code_num") -> DataFrame:
    """Add the product code as a number, NULL for a code with letters."""
    return df.withColumn(into, text.to_integer(F.col(fields.PRODUCT_CODE), "bigint"))


def with_product_labels(df: DataFrame, products: DataFrame) -> DataFrame:
    """Add product descriptions; each product code may occur once in `products`."""
    return joins.attach(df, products, [fields.PRODUCT_CODE])


def with_country_labels(df: DataFrame, countries: DataFrame) -> DataFrame:
    """Add names and ISO3 codes of both trade partners."""
    measured = joins.profile(countries, [fields.COUNTRY_CODE])
    sides = {
        fields.EXPORTER_CODE: (fields.EXPORTER_NAME, fields.EXPORTER_ISO3_CODE),
        fields.IMPORTER_CODE: (fields.IMPORTER_NAME, fields.IMPORTER_ISO3_CODE),
    }
    for code, (name, iso3) in sides.items():
        partner = countries.withColumnsRenamed(
            {fields.COUNTRY_CODE: code, fields.COUNTRY_NAME: name, fields.ISO3_CODE: iso3}
        )
        df = joins.attach(df, partner, [code], measured=measured)
    return df


# --- landed files ------------------------------------------------------------


@dataclass(frozen=True)
class _Landed:
    """Where one version lies, and the names of its files or of its archives' members.

    A version has a file for each year and a few for the codes, so the names are listed
    once, on the driver.
    """

    spark: SparkSession
    version: str
    folder: str
    zipped: bool
    names: list[str]


def _landed(spark: SparkSession, root: str, hs_version: str) -> _Landed:
    listed = files.list_files(spark, f"{root}/hs_version=*").select("path", "name").collect()
    names: dict[str, list[str]] = {}
    for row in listed:
        names.setdefault(row.path.split("/hs_version=")[-1].split("/")[0], []).append(row.name)
    wanted = hs_version.strip().upper()
    version = filters.check_choice(wanted, sorted(names), "HS version")
    folder = f"{root}/hs_version={version}"
    zipped = any(name.endswith(".zip") for name in names[version])
    if zipped:
        members = archives.members(spark, folder).where("member IS NOT NULL")
        names[version] = [row.member for row in members.select("member").collect()]
    return _Landed(spark, version, folder, zipped, names[version])


def _products(landed: _Landed) -> DataFrame:
    raw = _csv(landed, PRODUCT_FILES, "code STRING, description STRING", one=True)
    return quality.validate(shape_products(raw), schemas.names(schemas.TRADE_PRODUCTS))


def _countries(landed: _Landed) -> DataFrame:
    cells = "country_code STRING, country_name STRING, country_iso2 STRING, country_iso3 STRING"
    raw = _csv(landed, COUNTRY_FILES, cells, one=True)
    return quality.validate(shape_countries(raw), schemas.names(schemas.TRADE_COUNTRIES))


def _csv(landed: _Landed, prefix: str, schema: str, one: bool = False) -> DataFrame:
    """The text cells of the CSV files whose name starts with `prefix`.

    With `one` only the first such file is read.
    """
    found = sorted(n for n in landed.names if n.startswith(prefix) and n.endswith(".csv"))
    if not found:
        raise DataExtractionError(f"No {prefix}*.csv files found in {landed.folder}")
    if landed.zipped:
        cells = schemas.names(schema)
        which = found[0] if one else prefix
        rows = archives.csv_rows(landed.spark, landed.folder, cells, prefix=which, suffix=".csv")
        return rows.select(*cells)
    pattern = found[0] if one else f"{prefix}*.csv"
    return files.read_csv(landed.spark, landed.folder, schema, pattern=pattern)
