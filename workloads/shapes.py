"""The test tables in the shapes that publishers use.

Every table here is derived by Spark from the given tables, so that it grows with
them. Joins between given tables carry no hint: Spark decides by their size, and
splits skewed partitions where it has to shuffle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE_YEARS = list(range(1995, 2002))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def country_code(nation: Column) -> Column:
    """A three-letter code of a nation number: 7 -> `N07`."""
    return F.concat(F.lit("N"), F.lpad(nation.cast("string"), 2, "0"))


def orders_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation of their customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade flows: the supplier's nation exports to the customer's nation."""
    buyers = orders_by_country(spark, sf_dir).select("o_orderkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.year("l_shipdate").alias("t"),
            F.col("s_nationkey").alias("i"),
            F.col("c_nationkey").alias("j"),
            F.col("l_partkey").alias("k"),
            F.col("l_extendedprice").alias("v"),
            F.col("l_quantity").alias("q"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("code"), F.col("p_name").alias("description")
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.substring("n_name", 1, 2).alias("country_iso2"),
        country_code(F.col("n_nationkey")).alias("country_iso3"),
    )


def country_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, short names and name patterns of the nations."""
    nation = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        country_code(nation).alias("iso3_code"),
        F.concat(F.lit("K"), F.char(nation + 65)).alias("iso2_code"),
        F.col("n_name").alias("name_short"),
        F.concat(F.lit("republic of nation "), nation, F.lit("$")).alias("regex"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each customer of a country bought, per order priority and year.

    One row per entity (country), counterpart (customer), indicator (priority) and
    year. The value of low-priority orders in 2001 is not known.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = (
        table(spark, sf_dir, "orders")
        .groupBy(
            "o_custkey",
            F.col("o_orderpriority").alias("indicator_code"),
            F.year("o_orderdate").alias("year"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    )
    unknown = (F.col("indicator_code") == "5-LOW") & (F.col("year") == 2001)
    return sums.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "year",
        country_code(F.col("c_nationkey")).alias("entity_code"),
        F.col("o_custkey").alias("counterpart_code"),
        "indicator_code",
        F.when(~unknown, F.col("value")).alias("value"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries, and regions as aggregates of them."""
    nation = table(spark, sf_dir, "nation").select(
        country_code(F.col("n_nationkey")).alias("entity_code"),
        F.col("n_name").alias("entity_name"),
        F.lit(False).alias("is_aggregate"),
    )
    region = table(spark, sf_dir, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey")).alias("entity_code"),
        F.col("r_name").alias("entity_name"),
        F.lit(True).alias("is_aggregate"),
    )
    return nation.unionByName(region)


def price_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide: one row per customer, one column per year of purchases."""
    sums = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    wide = (
        table(spark, sf_dir, "orders")
        .withColumn("_year", F.year("o_orderdate"))
        .groupBy("o_custkey")
        .pivot("_year", PRICE_YEARS)
        .agg(sums)
    )
    return wide.withColumnsRenamed({str(y): f"price_{y}" for y in PRICE_YEARS})


def outlook_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as outlook records, two releases a year."""
    code = F.col("c_nationkey")
    return orders_by_country(spark, sf_dir).select(
        F.lit("USD").alias("UNIT_CODE"),
        F.col("o_orderpriority").alias("CONCEPT_CODE"),
        country_code(code).alias("REF_AREA_CODE"),
        F.nullif(code, F.lit(0)).alias("REF_AREA_IMF_CODE"),
        F.col("o_orderkey").alias("NOTES"),
        F.year("o_orderdate").alias("TIME_PERIOD"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("OBS_VALUE"),
        F.concat(F.lit("Area "), code).alias("REF_AREA_LABEL"),
        F.lower("o_orderpriority").alias("CONCEPT_LABEL"),
        F.lit("US dollars").alias("UNIT_LABEL"),
        F.lit(2023).alias("LASTACTUALDATE"),
        F.year("o_orderdate").alias("vintage_year"),
        F.when(F.month("o_orderdate") <= 6, "April").otherwise("October").alias("vintage_month"),
    )


def series_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a country's reply: a series of two points."""
    return orders_by_country(spark, sf_dir).select(
        country_code(F.col("c_nationkey")).alias("iso3_code"),
        F.to_json(F.struct(_points(F.lit(0)).alias("fcsGraph"))).alias("reply"),
    )


def region_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a country's reply: two regions with two points each."""

    def region(name: str, shift: int) -> Column:
        return F.struct(
            F.struct(F.col(name).alias("Name"), _points(F.lit(shift)).alias("fcsGraph")).alias(
                "properties"
            )
        )

    features = F.array(region("o_orderpriority", 0), region("o_orderstatus", 10))
    return orders_by_country(spark, sf_dir).select(
        country_code(F.col("c_nationkey")).alias("iso3_code"),
        F.to_json(F.struct(features.alias("features"))).alias("reply"),
    )


def registry_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a registry reply of one feature; furniture has no data."""
    has_data = F.col("c_mktsegment") != "FURNITURE"
    feature = F.struct(
        F.struct(
            country_code(F.col("c_nationkey")).alias("iso3"),
            F.col("c_custkey").alias("adm0_id"),
            F.when(has_data, F.col("c_mktsegment")).alias("dataType"),
        ).alias("properties")
    )
    body = F.struct(F.array(feature).alias("features"))
    return table(spark, sf_dir, "customer").select(
        F.to_json(F.struct(body.alias("body"))).alias("reply")
    )


def inflation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as inflation rows, for each indicator id and country."""
    priority = F.col("o_orderpriority")
    return orders_by_country(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("IndicatorName"),
        F.lit("ignored").alias("CountryName"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Date"),
        F.col("o_totalprice").cast("string").alias("Value"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("SourceOfTheData"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), 116)
        .when(priority == "3-MEDIUM", 117)
        .otherwise(71)
        .alias("indicator_id"),
        country_code(F.col("c_nationkey")).alias("iso3_code"),
    )


def _points(shift: Column) -> Column:
    def point(days: int) -> Column:
        value = F.floor("o_totalprice") + shift + days
        day = F.date_add(F.col("o_orderdate").cast("date"), days)
        return F.struct(
            F.date_format(day, "yyyy-MM-dd").alias("x"),
            value.alias("fcs"),
            (value + 5).alias("fcsHigh"),
            (value - 5).alias("fcsLow"),
        )

    return F.array(point(0), point(1))
