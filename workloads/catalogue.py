"""Every operator and dataset as a named query, next to the SQL that checks it.

Each query reads whole tables. The SQL is written for DuckDB with the given
tables as views. Queries named `*_files` first write the derived table in the
publisher's layout to the cluster's shared folder, then read it as landed files.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devdata_spark import fields, quality, schemas, snapshots
from devdata_spark.functions import dates, text
from devdata_spark.operators import (
    analysis,
    columns,
    combine,
    coverage,
    date_forms,
    filters,
    joins,
    latest,
    records,
    reshape,
    resolve,
    types,
)
from devdata_spark.plans import debt, food, hdi, health, hiv, indicators, outlook, trade
from devdata_spark.sources import archives, documents, files, gated
from workloads import landing, shapes, sql
from workloads.shapes import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(check: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its checking SQL."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = check
        return function

    return register


# --- trade -------------------------------------------------------------------


@query(sql.FLOWS)
def trade_flows(spark, sf):
    return trade.shape_flows(shapes.raw_flows(spark, sf))


@query(f"select f.*, product_description from ({sql.FLOWS}) f left join ({sql.PRODUCTS}) p using (product_code)")
def trade_product_labels(spark, sf):
    products = trade.shape_products(shapes.raw_products(spark, sf))
    return trade.with_product_labels(trade_flows(spark, sf), products)


_COUNTRY_LABELS = f"""
select {{}}, e.country_name as exporter_name, e.iso3_code as exporter_iso3_code,
  i.country_name as importer_name, i.iso3_code as importer_iso3_code
from ({{}}) f left join ({sql.COUNTRIES}) e on exporter_code = e.country_code
  left join ({sql.COUNTRIES}) i on importer_code = i.country_code
"""


@query(_COUNTRY_LABELS.format("f.*", sql.FLOWS))
def trade_country_labels(spark, sf):
    countries = trade.shape_countries(shapes.raw_countries(spark, sf))
    return trade.with_country_labels(trade_flows(spark, sf), countries)


@query(
    _COUNTRY_LABELS.format("f.*, product_description", sql.FLOWS)
    + f" left join ({sql.PRODUCTS}) p on f.product_code = p.product_code"
)
def trade_labelled(spark, sf):
    countries = trade.shape_countries(shapes.raw_countries(spark, sf))
    return trade.with_country_labels(trade_product_labels(spark, sf), countries)


@query(
    _COUNTRY_LABELS.format("f.*, product_description", sql.FLOWS)
    + f" left join ({sql.PRODUCTS}) p on f.product_code = p.product_code"
)
def trade_files(spark, sf):
    """Flows, products and countries as landed files of one version."""
    root = landing.new_folder(spark, "trade")
    folder = f"{root}/hs_version=HS22"
    landing.named_csv(shapes.raw_flows(spark, sf), folder, "BACI_HS22_Y")
    landing.named_csv(shapes.raw_products(spark, sf).coalesce(1), folder, "product_codes_HS22_")
    landing.named_csv(shapes.raw_countries(spark, sf).coalesce(1), folder, "country_codes_")
    return trade.flows(spark, root, "hs22", product_labels=True, country_labels=True)


@query(
    _COUNTRY_LABELS.format("f.*, product_description", sql.FLOWS)
    + f" left join ({sql.PRODUCTS}) p on f.product_code = p.product_code"
)
def trade_archive_files(spark, sf):
    """As trade_files, from zip archives."""
    root = landing.new_folder(spark, "trade")
    folder = f"{root}/hs_version=HS22"
    landing.zipped_csv(shapes.raw_flows(spark, sf), folder, "BACI_HS22_Y")
    landing.zipped_csv(shapes.raw_products(spark, sf).coalesce(1), folder, "product_codes_HS22_")
    landing.zipped_csv(shapes.raw_countries(spark, sf).coalesce(1), folder, "country_codes_")
    return trade.flows(spark, root, "hs22", product_labels=True, country_labels=True)


@query(sql.FLOWS)
def archive_members(spark, sf):
    """Flows packed as zip archives of one CSV member, and read back by byte ranges."""
    folder = landing.new_folder(spark, "archives")
    landing.zipped_csv(shapes.raw_flows(spark, sf), folder, "BACI_HS22_")
    cells = schemas.names(schemas.TRADE_RAW)
    read = archives.csv_rows(spark, folder, cells, prefix="BACI_HS22", suffix=".csv")
    return trade.shape_flows(read.select(*cells))


@query("select doc_id, length(text) as n_chars, md5(text) as digest from documents")
def archive_texts(spark, sf):
    """Documents as text members of zip archives, and read back whole."""
    folder = landing.new_folder(spark, "archives")
    name = F.concat("doc_id", F.lit(".txt")).alias("name")
    landing.zipped_texts(table(spark, sf, "documents").select(name, "text"), folder)
    read = archives.member_text(spark, folder, suffix=".txt")
    return read.select(
        F.regexp_extract("member", r"^(\d+)", 1).cast("bigint").alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("digest"),
    )


@query("select regexp_extract(name, '^[0-9]+') as doc_id, n_bytes from (select doc_id || '.txt' as name,"
       " cast(octet_length(encode(text)) as bigint) as n_bytes from documents)")  # fmt: skip
def archive_listing(spark, sf):
    """The members of archives and their sizes, from the archives' ends alone."""
    folder = landing.new_folder(spark, "archives")
    name = F.concat("doc_id", F.lit(".txt")).alias("name")
    landing.zipped_texts(table(spark, sf, "documents").select(name, "text"), folder)
    return archives.members(spark, folder).select(
        F.regexp_extract("member", r"^(\d+)", 1).alias("doc_id"), F.col("size").alias("n_bytes")
    )


@query("select page_id, u as href, t as link_text from ("
       "select page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)) as u,"
       " unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2)) as t,"
       " unnest(range(len(regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1)))) as n"
       " from pages) qualify row_number() over (partition by page_id, t order by n desc) = 1")  # fmt: skip
def html_links(spark, sf):
    return documents.links(table(spark, sf, "pages"), "html", ["page_id"])


# of two links with one text, as on page 92, the last one counts
@query("select page_id, 'HS92' as hs_version, '/inner?a=1&b=' || page_id as url from pages where page_id <> 92"
       " union all select page_id, 'HS' || page_id, '/' || page_id || '?q=ô&é' from pages")  # fmt: skip
def download_links(spark, sf):
    """Each page inside the download section, between an inner section and a link."""
    page = F.concat(
        F.lit("<section id='other'><a href='/no'>HS17</a></section><SECTION class=x id=\"download-links\">"),
        F.lit("<section><a href='/inner?a=1&amp;b="), "page_id", F.lit("'>HS<b>92</b></a></section>"),
        "html",
        F.lit("<a href='/"), "page_id", F.lit("?q=&ocirc;&#38;&#xE9;'>H&#83;"), "page_id",
        F.lit("</a></section><a href='/out'>HS96</a>"),
    )
    pages = table(spark, sf, "pages").select("page_id", page.alias("html"))
    return trade.download_links(pages, "html", ["page_id"])


@query("select p_partkey, k as key, v as value from ("
       "select p_partkey, 'Title' as k, p_name || ' second line' as v from part union all "
       "select p_partkey, 'Brand', p_brand from part)")  # fmt: skip
def text_key_values(spark, sf):
    readme = F.concat(
        F.lit("Brand: an earlier one\r\n\r\nTitle: "), "p_name",
        F.lit("\r\n second line \r\n\r\nList of Variables:\r\nt: Year\r\n\r\nno colon here\r\n\r\nBrand : "),
        "p_brand", F.lit("\r\n"),
    )
    part = table(spark, sf, "part").select("p_partkey", readme.alias("readme"))
    return documents.key_values(part, "readme", ["p_partkey"])


@query("select distinct regexp_extract(name, '^BACI_([A-Z0-9]+)_', 1) as hs_version from ("
       "select 'BACI_HS' || replace(p_brand, 'Brand#', '') || '_' || p_partkey || '.csv' as name"
       " from part where p_type <> 'PROMO')")  # fmt: skip
def name_prefix_files(spark, sf):
    ending = F.when(F.col("p_type") == "PROMO", ".txt").otherwise(".csv")
    version = F.regexp_replace("p_brand", "Brand#", "BACI_HS")
    names = table(spark, sf, "part").select(
        F.concat_ws("_", version, F.col("p_partkey")).alias("stem"), ending.alias("ending")
    )
    landed = names.select(F.concat("stem", "ending").alias("name"))
    found = files.names_between(landed, "BACI_HS", ".csv")
    return found.select(
        F.regexp_extract("name", "^BACI_([A-Z0-9]+)_", 1).alias("hs_version")
    ).distinct()


@query(f"select *, cast(product_code as bigint) as product_code_num from ({sql.FLOWS})")
def trade_product_numbers(spark, sf):
    return trade.with_product_number(trade_flows(spark, sf))


@query("select c_custkey as country_code, c_name as country_name, c_mktsegment as iso3_code from customer")
def dim_drop_rename(spark, sf):
    return trade.shape_countries(
        table(spark, sf, "customer").select(
            F.col("c_custkey").alias("country_code"),
            F.col("c_name").alias("country_name"),
            F.lit("XX").alias("country_iso2"),
            F.col("c_mktsegment").alias("country_iso3"),
        )
    )


# --- quality -----------------------------------------------------------------


@query("select l_orderkey, count(*) as n from lineitem group by 1 having count(*) > 1")
def dim_key_violations(spark, sf):
    return quality.key_violations(table(spark, sf, "lineitem"), ["l_orderkey"])


@query("select count(*) as n_rows, count(o_orderkey) as n_o_orderkey,"
       " count(nullif(o_orderstatus, 'P')) as n_o_orderstatus from orders")  # fmt: skip
def required_column_report(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    checked = quality.validate(orders, ["o_orderkey"], schema="o_orderkey BIGINT")
    marked = columns.marker_to_null(checked, "P")
    return quality.column_report(marked, ["o_orderkey", "o_orderstatus"])


@query("select c as missing_code from (values ('ECONOMY'), ('LARGE'), ('NOPE')) r(c)"
       " where c not in (select p_type from part)")  # fmt: skip
def metadata_completeness(spark, sf):
    return quality.missing_codes(table(spark, sf, "part"), "p_type", ["NOPE", "LARGE", "ECONOMY"])


@query(f"""
select r.* from (
  select distinct entity_code, counterpart_code, cast(unnest(range(1995, 2002)) as int) as year
  from ({sql.OBSERVATIONS})) r
where not exists (select 1 from ({sql.OBSERVATIONS}) o
  where o.counterpart_code = r.counterpart_code and o.year = r.year)
""")
def missing_series_report(spark, sf):
    keys = ["entity_code", "counterpart_code"]
    covered = coverage.bitmaps(shapes.observations(spark, sf), keys, "year", 1995, 2001)
    return coverage.gaps(covered, keys, "year", 1995, 2001)


@query(f"""
select entity_code, indicator_code, cast(count(distinct y) as int) as n_periods,
  min(y) as first_period, max(y) as last_period,
  coalesce(cast(max(y) - min(y) + 1 - count(distinct y) as int), 0) as n_gaps
from (select *, case when value is not null and year >= 1995 then year end as y from ({sql.OBSERVATIONS}))
group by all
""")
def series_coverage(spark, sf):
    """Coverage of the series of countries, merged from that of each customer."""
    keys, years = ["entity_code", "indicator_code"], (1995, 2060)
    observed = shapes.observations(spark, sf)
    parts = coverage.bitmaps(observed, [*keys, "counterpart_code"], "year", *years, value="value")
    return coverage.report(coverage.merge(parts, keys, *years), keys, *years)


@query("select distinct c_name as entity_name from customer where c_nationkey = 0")
def legacy_code_gaps(spark, sf):
    coded = outlook.with_legacy_codes(_customers_with_legacy_code(spark, sf))
    return quality.entities_without_code(coded)


# --- wide to long, codes, labels ---------------------------------------------


@query("select p_partkey, p_name, 'p_size' as indicator_code, cast(p_size as double) as value from part"
       " union all select p_partkey, p_name, 'p_retailprice', p_retailprice from part")  # fmt: skip
def melt_long(spark, sf):
    return reshape.to_long(
        table(spark, sf, "part"), ["p_partkey", "p_name"], ["p_size", "p_retailprice"]
    )


@query(sql.PRICES)
def melt_split_year(spark, sf):
    wide = shapes.price_columns(spark, sf).withColumnRenamed("o_custkey", "entity_code")
    return reshape.split_code_year(reshape.to_long(wide, ["entity_code"]))


@query("select p_partkey, m.indicator_code, m.value, cb.indicator_name, cb.unit from ("
       "select p_partkey, 'p_size' as indicator_code, cast(p_size as double) as value from part"
       " union all select p_partkey, 'p_retailprice', p_retailprice from part) m left join ("
       "values ('p_size', 'Part size', 'count'), ('p_retailprice', 'Retail price', 'usd'),"
       " ('p_retailprice', 'Price', 'dollar')) cb(indicator_code, indicator_name, unit)"
       " on m.indicator_code = cb.indicator_code")  # fmt: skip
def melt_codebook_join(spark, sf):
    codebook = spark.createDataFrame(
        [
            ("p_size", "Part size", "count"),
            ("p_retailprice", "Retail price", "usd"),
            ("p_retailprice", "Price", "dollar"),
        ],
        "indicator_code STRING, indicator_name STRING, unit STRING",
    )
    long = reshape.to_long(table(spark, sf, "part"), ["p_partkey"], ["p_size", "p_retailprice"])
    return joins.attach(long, codebook, ["indicator_code"], validate=False)


@query("select p_partkey, p_type as indicator_code, nm as indicator_name from part left join ("
       "select case when p_type in ('ECONOMY', 'LARGE') then p_type else p_type || ' other' end as c,"
       " arg_max(p_name, p_partkey) as nm from part group by 1) on p_type = c")  # fmt: skip
def code_to_name_map(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_type", "indicator_code")
    code = F.col("indicator_code")
    names = part.select(
        F.when(code.isin("ECONOMY", "LARGE"), code)
        .otherwise(F.concat(code, F.lit(" other")))
        .alias("indicator_code"),
        F.col("p_name").alias("indicator_name"),
        "p_partkey",
    )
    codes = part.select("p_partkey", "indicator_code")
    return joins.map_codes(codes, names, "indicator_code", "indicator_name", "p_partkey")


@query("select o_orderkey, nullif(o_orderstatus, 'P') as status from orders where o_orderstatus <> 'P'")
def sentinel_to_null_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return filters.drop_missing(columns.marker_to_null(orders, "P"), "status")


@query(f"""
select c_custkey, lower(c_mktsegment) as name, {sql.NATION_CODE.format("c_nationkey")} as iso3_code
from customer where c_mktsegment <> 'FURNITURE'
union all select c_custkey, lower(c_mktsegment), null from customer where c_mktsegment = 'FURNITURE'
""")
def entity_resolver(spark, sf):
    nation = F.col("c_nationkey")
    segment = F.lower("c_mktsegment")
    written = (
        F.when(segment == "household", F.concat(F.lit(" nation_"), nation))
        .when(segment == "machinery", F.lower(shapes.country_code(nation)))
        .when(segment == "furniture", F.lit("Atlantis"))
        .otherwise(F.concat(F.lit("The REPUBLIC of Nation "), nation))
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", segment.alias("name"), written.alias("written")
    )
    resolved = resolve.add_code(customers, "written", shapes.country_table(spark, sf))
    return resolved.drop("written")


@query("select o_orderkey, 'C' || o_custkey as iso3_code from orders")
def resolve_many_patterns(spark, sf):
    """The customer named in a text, each customer with a pattern of its own."""
    number = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    patterns = table(spark, sf, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("iso3_code"),
        F.lit(None).cast("string").alias("iso2_code"),
        F.lit(None).cast("string").alias("name_short"),
        F.concat(F.lit(r"\b(customer|client)\W*"), number, F.lit(r"(?!\d)")).alias("regex"),
    )
    written = F.concat(
        F.when(F.col("o_orderkey") % 2 == 0, "To CUSTOMER #").otherwise("for client "),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(", with thanks"),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", written.alias("written"))
    return resolve.add_code(orders, "written", patterns).drop("written")


# --- cleaning ----------------------------------------------------------------


@query(r"""
select c_custkey, trim(c_name) as country_name,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as risk_of_debt_distress,
  case when c_nationkey < 5 then null else upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) end
    as debt_sustainability_assessment,
  c_nationkey < 10 as joint_with_world_bank,
  date '2024-01-01' + cast(c_nationkey as int) as latest_publication
from customer
""")
def clean_labels(spark, sf):
    nation = F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    day = F.date_add(F.lit("2024-01-01").cast("date"), nation)
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit(" 1/  ")).alias("country_name"),
        F.concat(F.lit("\t"), segment, F.lit(" 5/ ")).alias("risk_of_debt_distress"),
        F.when(nation < 5, F.lit(" 2/")).otherwise(segment).alias("debt_sustainability_assessment"),
        F.when(nation < 5, "YES").when(nation < 10, "Yes").when(nation < 20, "No")
        .alias("joint_with_world_bank"),
        F.date_format(day, "dd/MM/yyyy").alias("latest_publication"),
    )
    return debt.clean(date_forms.parse(raw, ["latest_publication"]))


@query("select o_orderkey, case when o_orderpriority = '5-LOW' then null"
       " else cast(o_orderdate as date) end as date from orders")  # fmt: skip
def coerce_dates(spark, sf):
    priority = F.col("o_orderpriority")
    written = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "d-MMM-yy"))
        .when(priority == "5-LOW", "not yet")
        .otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", written.alias("date"))
    return date_forms.parse(orders, ["date"])


# files 1 and 2 have the day or the month first, 3 contradicts itself, 4 has two forms, 5 none
_DATES_BY_FILE = """
select o_orderkey, left(o_orderpriority, 1) as file, cast(o_orderdate as date) as day,
  case left(o_orderpriority, 1)
    when '3' then case when o_orderkey % 2 = 0 or day(o_orderdate) > 12
      then cast(o_orderdate as date)
      else make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) end
    when '5' then null else cast(o_orderdate as date) end as date
from orders"""


@query(f"select o_orderkey, file, date from ({_DATES_BY_FILE})")
def dates_by_file(spark, sf):
    """Dates as each file writes them."""
    return date_forms.parse(_dates_by_file(spark, sf), ["date"], ["file"])


@query(f"""
select file, case file when '1' then 'd/M/yyyy' when '2' then 'M/d/yyyy' end as form,
  case when file in ('1', '4') then 'd/M/yyyy' when file = '2' then 'M/d/yyyy' end as ambiguous_form,
  file = '3' as mixed, count(date) as n_dates,
  count(*) filter (where file = '5' and o_orderkey % 2 = 0) as n_unparsed,
  count(*) filter (where file = '5' and o_orderkey % 2 = 1) as n_empty
from ({_DATES_BY_FILE}) group by file""")
def date_form_per_file(spark, sf):
    """How the files write their dates, and which contradict themselves."""
    return date_forms.forms(_dates_by_file(spark, sf), "date", ["file"]).drop("allowed")


@query("select count(*) filter (where o_orderpriority not in ('4-NOT SPECIFIED', '5-LOW')) as n_dates,"
       " count(*) filter (where o_orderpriority = '5-LOW') as n_empty,"
       " count(*) filter (where o_orderpriority = '4-NOT SPECIFIED') as n_unparsed from orders")  # fmt: skip
def date_parse_report(spark, sf):
    priority = F.col("o_orderpriority")
    written = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "d MMM yyyy"))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "MMM d, yyyy"))
        .when(priority == "4-NOT SPECIFIED", "soon")
    )
    return dates.parse_report(table(spark, sf, "orders").select(written.alias("date")), "date")


@query("select value, cast(year(ts) as int) as year, cast(user_id as varchar) as entity_code,"
       " event_type as indicator_code, 'A' as freq_code, props as notes, event_id"
       " from events where event_type <> 'error'")  # fmt: skip
def rename_lower_drop_blank(spark, sf):
    raw = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("value")).alias("OBS_VALUE"),
        F.year("ts").alias("TIME_PERIOD"),
        F.col("user_id").cast("string").alias("REF_AREA_CODE"),
        F.col("event_type").alias("CONCEPT_CODE"),
        F.lit("A").alias("FREQ_CODE"),
        F.col("props").alias("NOTES"),
        F.col("event_id").alias("EVENT_ID"),
    )
    return outlook.shape(raw)


@query("select c_name as entity_name, nullif(c_nationkey, 0) as imf_code,"
       " nullif(c_nationkey, 0) as entity_code from customer")  # fmt: skip
def legacy_code_override(spark, sf):
    return outlook.with_legacy_codes(_customers_with_legacy_code(spark, sf))


@query("select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as int) as priority,"
       " try_cast(o_orderpriority as int) as bad, o_totalprice as total,"
       " lower(o_orderpriority) as label,"
       " o_orderpriority like '1%' or o_orderpriority like '%LOW' as extreme from orders")  # fmt: skip
def safe_casts(spark, sf):
    label = F.lower("o_orderpriority")
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.col("o_orderpriority").alias("bad"),
        F.col("o_totalprice").cast("string").alias("total"),
        label.alias("label"),
        (label.startswith("1") | label.endswith("low")).alias("extreme"),
    )
    return types.cast(types.safe_cast(raw, {"priority": "int", "bad": "int"}), {"total": "double"})


_DOUBLE_OR_WHOLE = (
    "select '{0}' as column_name, count(*) as rows_with_value, case when"
    " bool_and(try_cast({0} as bigint) = {0}) then 'bigint' else 'double' end as inferred_type"
    " from lineitem"
)


@query(" union all ".join(
    [_DOUBLE_OR_WHOLE.format(c) for c in ("l_quantity", "l_extendedprice", "l_discount")]
    + ["select 'l_linenumber', count(*), 'bigint' from lineitem",
       "select 'l_tax', count(*), 'double' from lineitem",
       "select 'l_returnflag', count(*), 'string' from lineitem",
       "select 'l_shipped', count(*), 'boolean' from lineitem",
       "select 'l_orderkey', count(*), 'bigint' from lineitem"]
))
def type_profile(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return types.infer_types(
        lineitem.select(
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            F.col("l_linenumber").cast("string").alias("l_linenumber"),
            F.col("l_tax").cast("string").alias("l_tax"),
            "l_returnflag",
            (F.col("l_linestatus") == "F").cast("string").alias("l_shipped"),
            "l_orderkey",
        )
    )


@query("select event_id, event_type from (select event_id, event_type, row_number() over ("
       "partition by event_type order by event_id) as rn from events where event_type <> '') where rn > 1")  # fmt: skip
def header_row_drop(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    kept = filters.drop_missing(events, "event_type", blank=True)
    return filters.drop_first_row(kept, "event_id", "event_type")


@query("select p_name as country_name, p_type as risk, p_size as rank from part")
def positional_select(spark, sf):
    return columns.by_position(
        table(spark, sf, "part"), {1: "country_name", 3: "risk", 4: "rank"}
    )


# --- filters and latest ------------------------------------------------------


@query(f"select * from ({sql.OBSERVATIONS}) where indicator_code in ('1-URGENT', '2-HIGH')"
       " and entity_code in ('N01', 'N02', 'N03') and year between 1996 and 1999")  # fmt: skip
def indicator_query(spark, sf):
    return indicators.select(
        shapes.observations(spark, sf), ["2-HIGH", "1-URGENT"], ["N03", "N02", "N01"], 1996, 1999
    )


@query("select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_discount as value from lineitem"
       " where nullif(l_discount, 0) is not null")  # fmt: skip
def skip_blanks(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    return filters.skip_blanks(table(spark, sf, "lineitem").select(*keys, discount.alias("value")))


@query(sql.OBSERVATIONS)
def skip_aggregates(spark, sf):
    countries = shapes.observations(spark, sf)
    region = table(spark, sf, "nation").select(
        shapes.country_code(F.col("n_nationkey")).alias("entity_code"),
        F.concat(F.lit("R"), F.col("n_regionkey")).alias("_region"),
    )
    keys = ["year", "_region", "counterpart_code", "indicator_code"]
    regions = (
        joins.attach(countries, region, ["entity_code"])
        .groupBy(*keys)
        .agg(F.max("value").alias("value"))
        .withColumnRenamed("_region", "entity_code")
    )
    both = combine.stack([countries, regions])
    return filters.skip_aggregates(both, shapes.entities(spark, sf))


@query(f"""
select * from ({sql.OBSERVATIONS}) o where exists (
  select 1 from (select distinct indicator_code, year, dense_rank() over (
    partition by indicator_code order by year desc) as r from ({sql.OBSERVATIONS})) p
  where p.r <= 2 and p.indicator_code = o.indicator_code and p.year = o.year)
""")
def most_recent_periods(spark, sf):
    return latest.most_recent_periods(
        shapes.observations(spark, sf), 2, series=["indicator_code"]
    )


@query(f"select year, entity_code, counterpart_code, indicator_code, value from ("
       "select *, row_number() over (partition by entity_code, counterpart_code, indicator_code"
       f" order by year desc) as rn from ({sql.OBSERVATIONS}) where value is not null) where rn <= 2")  # fmt: skip
def most_recent_nonempty(spark, sf):
    return latest.most_recent_values(
        shapes.observations(spark, sf), 2, by=["entity_code", "counterpart_code", "indicator_code"]
    )


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = upper(trim(' f '))")
def select_partition(spark, sf):
    status = filters.check_choice(" f ".strip().upper(), ["F", "O", "P"], "status")
    orders = table(spark, sf, "orders")
    return filters.select_values(orders, "o_orderstatus", status).select(
        "o_orderkey", "o_totalprice"
    )


@query("select p_partkey, ['DT.DOD.BLAT.CD', 'DT.DOD.MLAT.CD', 'DT.DOD.PBND.CD', 'DT.DOD.PCBK.CD',"
       " 'DT.DOD.PROP.CD'][cast(replace(p_brand, 'Brand#', '') as int)] as indicator_code from part"
       " where cast(replace(p_brand, 'Brand#', '') as int) <= 5")  # fmt: skip
def indicator_group(spark, sf):
    codes = indicators.DEBT_STOCK_CODES + indicators.DEBT_SERVICE_CODES
    brand = F.regexp_replace("p_brand", "Brand#", "").cast("int")
    code = F.coalesce(F.get(F.array(*[F.lit(c) for c in codes]), brand - 1), F.lit("SP.POP.TOTL"))
    described = table(spark, sf, "part").select("p_partkey", code.alias("indicator_code"))
    return indicators.in_indicator_group(described, indicators.DEBT_STOCK_CODES)


@query("select user_id, arg_max(event_id, ts) as event_id, max(ts) as ts from events"
       " where ts >= (select max(ts) from events) - interval 48 hour group by 1")  # fmt: skip
def snapshot_within_ttl(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return snapshots.fresh_rows(events, ["user_id"], "ts")


@query("select o_custkey, count(*) as n from orders group by 1")
def snapshot_reuse(spark, sf):
    """A result that is written once and read again within its lifetime."""
    root = landing.new_folder(spark, "snapshots")

    def build() -> DataFrame:
        return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))

    snapshots.reuse(spark, root, build)
    return snapshots.reuse(spark, root, build)


@query(sql.FLOWS)
def gated_write(spark, sf):
    """Flows written with their quality counted on the way, and read back."""
    path = landing.new_folder(spark, "gated") + "/flows"
    rules = {"positive value": F.col("value") > 0}
    flows = trade_flows(spark, sf)
    gated.write_checked(
        flows, path, schema=schemas.TRADE_FLOWS, not_null=[fields.YEAR, fields.PRODUCT_CODE], rules=rules
    )
    return files.read_parquet(spark, path)


# --- nested records ----------------------------------------------------------


@query("select event_id, event_type, cast(json_extract_string(props, '$.k') as int) as props_k from events")
def json_flatten(spark, sf):
    event = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    props = F.from_json("props", "k INT")
    replies = table(spark, sf, "events").select(
        F.to_json(F.struct(event.alias("event"), props.alias("props"))).alias("reply")
    )
    return columns.flatten(
        _parsed(replies, "event STRUCT<id: BIGINT, type: STRING>, props STRUCT<k: INT>")
    )


@query(sql.SERIES)
def nested_series_explode(spark, sf):
    replies = shapes.series_replies(spark, sf)
    raw = _parsed(replies, schemas.FOOD_NATIONAL_RAW, "iso3_code")
    return food.shape_national(raw, shapes.country_table(spark, sf))


@query(sql.REGION_SERIES)
def nested_regions_explode(spark, sf):
    replies = shapes.region_replies(spark, sf)
    raw = _parsed(replies, schemas.FOOD_SUBNATIONAL_RAW, "iso3_code")
    return food.shape_subnational(raw, shapes.country_table(spark, sf))


@query(f"select {sql.NATION_CODE.format('c_nationkey')} as iso3_code, c_custkey as entity_code,"
       " c_mktsegment as data_type, 'NATION_' || c_nationkey as country_name"
       " from customer where c_mktsegment <> 'FURNITURE'")  # fmt: skip
def registry_with_data(spark, sf):
    raw = _parsed(shapes.registry_replies(spark, sf), schemas.FOOD_REGISTRY_RAW)
    return food.shape_registry(raw, shapes.country_table(spark, sf))


@query("select c_name as iso3_code, c_custkey as entity_code, c_mktsegment as data_type from customer"
       " union all select c_name || '/2', cast(c_nationkey as bigint), 'NATION' from customer")  # fmt: skip
def map_to_rows(spark, sf):
    def entry(code, kind):
        return F.struct(code.cast("bigint").alias("entity_code"), kind.alias("data_type"))

    registry = F.create_map(
        "c_name",
        entry(F.col("c_custkey"), F.col("c_mktsegment")),
        F.concat("c_name", F.lit("/2")),
        entry(F.col("c_nationkey"), F.lit("NATION")),
    )
    replies = table(spark, sf, "customer").select(registry.alias("registry"))
    return reshape.map_to_rows(replies, "registry", "iso3_code")


@query("select cast(year(ts) as int) as year, cast(user_id as varchar) as entity_code,"
       " 'User ' || user_id as entity_name, event_type = 'error' as is_aggregate,"
       " event_type as indicator_code, upper(event_type) as indicator_name, value from events")  # fmt: skip
def record_json(spark, sf):
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    year = F.year("ts").cast("string")
    record = F.struct(
        F.struct(F.concat(F.lit("YR"), year).alias("id"), year.alias("value")).alias("time"),
        F.struct(
            user.alias("id"),
            F.concat(F.lit("User "), user).alias("value"),
            (kind == "error").alias("aggregate"),
        ).alias("economy"),
        F.struct(kind.alias("id"), F.upper(kind).alias("value")).alias("series"),
        F.col("value"),
    )
    replies = table(spark, sf, "events").select(F.to_json(record).alias("reply"))
    return indicators.shape_records(_parsed(replies, indicators.RAW_LABELLED_RECORDS))


@query("""
select cast(year(ts) as int) as year, cast(user_id as varchar) as entity_code,
  case when event_type <> 'view' then 'User ' || user_id end as entity_name,
  event_type as indicator_code, value, cast(event_id as bigint) as event_id,
  cast(json_extract(props, '$.k') as bigint) as props_k,
  case when event_type = 'error' then 'E' end as status,
  cast(case when event_id % 2 = 0 then 1 else 0.5 end as double) as unit_scale,
  case event_type when 'signup' then 'new' when 'purchase' then cast(user_id as varchar) end as note
from events
""")
def record_variant(spark, sf):
    """Records whose fields differ from one kind of event to the next."""
    found = indicators.shape_found_records(_undeclared_replies(spark, sf), "reply")
    return found.withColumn("unit_scale", F.col("unit_scale").cast("double"))


@query("""
select 'event_id' as field, 'BIGINT' as type, count(*) as n_records, count(*) as n_values from events
union all select 'note', 'VARIANT', count(*), count(*) from events where event_type in ('signup', 'purchase')
union all select 'status', 'STRING', count(*), count(*) from events where event_type = 'error'
union all select 'series', 'STRING', count(*), count(event_type) from events
union all select 'unit', 'OBJECT<scale: DECIMAL(21,1)>', count(*), count(*) from events
""")
def record_fields(spark, sf):
    report = records.field_report(records.parse(_undeclared_replies(spark, sf), "reply"))
    return report.where(F.col("field").isin("event_id", "note", "status", "series", "unit"))


@query("""
select cast(c_custkey as varchar) as entity_code, c_name as entity_name, false as is_aggregate,
  null::varchar as longitude, c_nationkey || '.5' as latitude, n_name as capital_city,
  cast(r_regionkey as varchar) as region_code, r_name as region_name,
  null::varchar as admin_region_code, null::varchar as admin_region_name,
  'IBD' as lending_type_code, 'IBRD' as lending_type_name,
  substr(c_mktsegment, 1, 3) as income_level_code, c_mktsegment as income_level_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def entity_dimension(spark, sf):
    def pair(code, name):
        return F.struct(code.cast("string").alias("id"), name.alias("value"))

    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = joins.attach(table(spark, sf, "nation"), region, ["n_regionkey"])
    nation = nation.withColumnRenamed("n_nationkey", "c_nationkey")
    customers = joins.attach(table(spark, sf, "customer"), nation, ["c_nationkey"])
    reply = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("value"),
        F.lit(False).alias("aggregate"),
        F.lit("").alias("longitude"),
        F.concat("c_nationkey", F.lit(".5")).alias("latitude"),
        F.col("n_name").alias("capitalCity"),
        pair(F.col("n_regionkey"), F.col("r_name")).alias("region"),
        pair(F.lit(""), F.lit("")).alias("adminregion"),
        pair(F.lit("IBD"), F.lit("IBRD")).alias("lendingType"),
        pair(F.substring("c_mktsegment", 1, 3), F.col("c_mktsegment")).alias("incomeLevel"),
    )
    replies = customers.select(F.to_json(reply).alias("reply"))
    return indicators.shape_entities(_parsed(replies, indicators.RAW_ENTITIES))


@query("select distinct p_type as indicator_code, p_brand from part")
def distinct_codes(spark, sf):
    part = table(spark, sf, "part")
    return part.select(F.col("p_type").alias("indicator_code"), "p_brand").distinct()


@query("select event_id, user_id, case when event_type = 'click' then value end as value,"
       " case when event_type <> 'click' then props end as props from events")  # fmt: skip
def union_missing_columns(spark, sf):
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "value")
    others = events.where("event_type <> 'click'").select("props", "user_id", "event_id")
    return combine.stack([clicks, others])


# --- landed files ------------------------------------------------------------


@query("select o_orderkey, o_orderstatus, o_totalprice, cast(year(o_orderdate) as int) as year from orders")
def csv_roundtrip(spark, sf):
    path = landing.new_folder(spark, "orders-csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    files.write_table(orders, path, format="csv", partition_by=["year"], header=True)
    cells = "o_orderkey STRING, o_orderstatus STRING, o_totalprice STRING"
    landed = files.read_csv(spark, path, cells, partitions="year INT")
    return types.cast(landed, {"o_orderkey": "bigint", "o_totalprice": "double"})


@query(f"select o.* from ({sql.OUTLOOK}) o join orders on notes = o_orderkey where year = ("
       "select max(year(o_orderdate)) from orders) and (month(o_orderdate) > 6) = ("
       "select max(month(o_orderdate)) > 6 from orders where year(o_orderdate) = ("
       "select max(year(o_orderdate)) from orders))")  # fmt: skip
def latest_vintage(spark, sf):
    return outlook.data(spark, _outlook_files(spark, sf))


@query(f"select o.* replace (imf_code as entity_code) from ({sql.OUTLOOK}) o"
       " join orders on notes = o_orderkey where year = 1998 and month(o_orderdate) <= 6")  # fmt: skip
def pinned_vintage(spark, sf):
    root = _outlook_files(spark, sf)
    return outlook.data(spark, root, ("April", 1998), legacy_entity_codes=True)


@query(r"""
select c_name as country_name, date '2024-01-15' as latest_publication,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as risk_of_debt_distress,
  'Unsustainable' as debt_sustainability_assessment, c_nationkey < 10 as joint_with_world_bank,
  null::date as latest_dsa_discussed
from customer
""")
def debt_files(spark, sf):
    """The title row is the header line that each file starts with."""
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("#"),
        F.concat("c_name", F.lit(" 1/ ")).alias("Country"),
        F.lit("2024-01-15").alias("Latest publication"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" 5/ ")).alias("Risk"),
        F.lit("ignored").alias("Ignored"),
        F.lit("unsustainable 2/").alias("Debt sustainability"),
        F.when(F.col("c_nationkey") < 10, "Yes").otherwise("No").alias("Joint"),
        F.lit("").alias("Latest DSA discussed"),
    )
    path = _write_csv(customers, "debt")
    return debt.assessments(spark, path)


@query(f"""
select 'C' || entity_code as entity_code, 'Customér ' || entity_code as entity_name, 'R' as region_code,
  'High' as hdi_group, indicator_code, value,
  year, 'Price of orders' as indicator_name
from ({sql.PRICES})
""")
def hdi_files(spark, sf):
    wide = shapes.price_columns(spark, sf)
    key = F.col("o_custkey")
    data = wide.select(
        F.concat(F.lit("C"), key).alias("iso3"),
        F.concat(F.lit("Customér "), key).alias("country"),
        F.lit("R").alias("region"),
        F.lit("High").alias("hdicode"),
        *[c for c in wide.columns if c != "o_custkey"],
    )
    sheet = spark.createDataFrame(
        [
            ("Prices", "price", "1995-2001", "first"),
            ("Price of orders", "price", "1995-2001", "last wins"),
            ("A remark", "price", None, None),
        ],
        "`Full name` STRING, `Short name` STRING, `Time series` STRING, Note STRING",
    )
    return hdi.data(
        spark,
        _write_csv(data, "hdi", encoding=hdi.ENCODING),
        _write_csv(sheet.coalesce(1), "hdi-sheet"),
    )


@query(f"""
select 'Customer ' || entity_code as country_name, 'C' || entity_code as iso3_code,
  2020 as year, 'price_' || year as indicator_code, value, l.name as indicator_name,
  l.unit as unit, null::varchar as currency
from ({sql.PRICES}) left join (values (1995, 'First year', 'usd'), (1996, 'Second year', null),
  (1996, 'Second year again', 'usd')) l(y, name, unit) on year = l.y
""")
def health_files(spark, sf):
    root = landing.new_folder(spark, "health")
    wide = shapes.price_columns(spark, sf)
    key = F.col("o_custkey")
    data = wide.select(
        F.concat(F.lit("Customer "), key).alias("location"),
        F.concat(F.lit("C"), key).alias("code"),
        F.lit("R").alias("region"),
        F.lit("H").alias("income"),
        F.lit(2020).alias("year"),
        *[c for c in wide.columns if c != "o_custkey"],
    )
    book = spark.createDataFrame(
        [
            ("price_1995", "First year", "Price 1995", "a", "b", "c", "usd", "-"),
            ("price_1996", "Second year", "Price 1996", "a", "b", "c", "-", "-"),
            ("price_1996", "Second year again", "Price 1996", "a", "b", "c", "usd", "-"),
            ("price_1997", "A heading", "-", "a", "b", "c", "usd", "usd"),
        ],
        "`variable code` STRING, `variable name` STRING, `long code (GHED data explorer)` STRING, "
        "`category 1` STRING, `category 2` STRING, "
        "`Method of measurement (INDICATORS category1)` STRING, unit STRING, currency STRING",
    )
    for sheet, rows in (("data", data), ("codebook", book)):
        files.write_table(rows, f"{root}/{sheet}", format="csv", header=True, escape='"')
    return health.data(spark, root)


_HIV = """
select 'Orders' as indicator_name, 'Number' as unit, o_orderstatus as subgroup,
  'Area, of ' || o_custkey as entity_name, 'A' || o_custkey as entity_code,
  cast(year(o_orderdate) as int) as year, null::varchar as source,
  case when o_orderstatus = 'P' then 'Yes' else cast(o_orderkey as varchar) end as value,
  o_orderpriority as value_formatted, null::varchar as footnote,
  case when o_orderstatus = 'P' then null else cast(o_orderkey as double) end as value_numeric
from orders
"""


@query(_HIV)
def hiv_files(spark, sf):
    root = landing.new_folder(spark, "hiv")
    files.write_table(
        _hiv_rows(spark, sf), f"{root}/dataset=GAM", format="csv", header=True, escape='"'
    )
    return hiv.data(spark, root, "GAM")


@query(_HIV)
def hiv_archive_files(spark, sf):
    """As hiv_files, from zip archives of one member each."""
    root = landing.new_folder(spark, "hiv")
    landing.zipped_csv(_hiv_rows(spark, sf), f"{root}/dataset=GAM", "gam")
    return hiv.data(spark, root, "GAM")


@query(sql.INFLATION)
def multi_series_constants(spark, sf):
    root = landing.new_folder(spark, "inflation")
    _write_inflation(spark, sf, root)
    return food.inflation(spark, root, shapes.country_table(spark, sf))


@query(f"select * from ({sql.INFLATION}) where indicator_name = 'Food inflation'"
       " and country_name in ('NATION_3', 'NATION_7')")  # fmt: skip
def inflation_of_countries(spark, sf):
    root = landing.new_folder(spark, "inflation")
    _write_inflation(spark, sf, root)
    countries = ["The Republic of Nation 7", "n03", "Atlantis"]
    return food.inflation(
        spark, root, shapes.country_table(spark, sf), "Food inflation", countries
    )


@query(f"select * from ({sql.SERIES}) where iso3_code in ("
       f"select {sql.NATION_CODE.format('c_nationkey')} from customer where c_mktsegment <> 'FURNITURE')")  # fmt: skip
def food_files(spark, sf):
    root = landing.new_folder(spark, "food")
    replies = shapes.series_replies(spark, sf)
    files.write_table(replies, f"{root}/national", format="text", partition_by=["iso3_code"])
    files.write_table(shapes.registry_replies(spark, sf), f"{root}/registry", format="text")
    return food.security(spark, root, shapes.country_table(spark, sf), multi_line=False)


@query(f"""
select year, o.entity_code, o.indicator_code, value, n_name as entity_name,
  false as is_aggregate, 'Orders ' || indicator_code as indicator_name,
  cast(counterpart_code as varchar) as counterpart_code, null::varchar as counterpart_name
from ({sql.OBSERVATIONS}) o
  join nation on o.entity_code = {sql.NATION_CODE.format("n_nationkey")}
where value is not null and indicator_code in ('1-URGENT', '5-LOW') and year >= 1997
""")
def indicator_files(spark, sf):
    root = landing.new_folder(spark, "indicators")
    observed = shapes.observations(spark, sf)
    observed.select(
        F.col("year").cast("string").alias("time"),
        F.col("entity_code").alias("economy"),
        F.lit(False).alias("aggregate"),
        F.col("indicator_code").alias("series"),
        F.col("counterpart_code").cast("string").alias("counterpart_area"),
        "value",
    ).write.json(f"{root}/data/db=6", ignoreNullFields=False)
    shapes.entities(spark, sf).select(
        F.col("entity_code").alias("id"),
        F.col("entity_name").alias("value"),
        F.col("is_aggregate").alias("aggregate"),
    ).write.json(f"{root}/entities/db=6")
    priority = F.col("o_orderpriority")
    table(spark, sf, "orders").select(
        priority.alias("id"), F.concat(F.lit("Orders "), priority).alias("value")
    ).distinct().write.json(f"{root}/series/db=6")
    spark.createDataFrame(
        [("6", "Debt", "IDS", "2024-01-15")], indicators.RAW_DATABASES
    ).write.json(f"{root}/databases")
    return indicators.data(
        spark, root, ["5-LOW", "1-URGENT"], start_year=1997, db=6, skip_blanks=True,
        skip_aggs=True, include_labels=True, counterparts=True,
    )


@query("select distinct o_orderpriority as indicator_code, 'Orders ' || o_orderpriority as indicator_name,"
       " 'Sum' as aggregation_method, '{\"Generalcomments\":\"' || lower(o_orderpriority) || '\"}' as other_fields"
       " from orders")  # fmt: skip
def indicator_metadata(spark, sf):
    """The description of every indicator; fields that were only written are left out."""
    root = landing.new_folder(spark, "indicators")
    priority = F.col("o_orderpriority")
    described = F.create_map(
        F.lit("IndicatorName"), F.concat(F.lit("Orders "), priority),
        F.lit("Aggregationmethod"), F.lit("Sum"),
        F.lit("Generalcomments"), F.lower(priority),
    )
    table(spark, sf, "orders").select(priority).distinct().select(
        priority.alias("id"), described.alias("metadata")
    ).write.json(f"{root}/metadata/db=2")
    codes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    found = indicators.metadata(spark, root, codes)
    return found.select("indicator_code", "indicator_name", "aggregation_method", "other_fields")


@query("select n_nationkey as id, n_name as name, cast(n_regionkey as varchar) as code,"
       " date '2024-01-15' + cast(n_nationkey as int) as last_updated from nation")  # fmt: skip
def indicator_databases(spark, sf):
    root = landing.new_folder(spark, "indicators")
    day = F.date_add(F.lit("2024-01-15").cast("date"), F.col("n_nationkey").cast("int"))
    table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("code"),
        F.date_format(day, "yyyy-MM-dd").alias("lastupdated"),
    ).write.json(f"{root}/databases")
    return indicators.databases(spark, root)


@query(f"select * from ({sql.REGION_SERIES}) where iso3_code in ("
       f"select {sql.NATION_CODE.format('c_nationkey')} from customer where c_mktsegment <> 'FURNITURE')")  # fmt: skip
def food_subnational_files(spark, sf):
    root = landing.new_folder(spark, "food")
    replies = shapes.region_replies(spark, sf)
    files.write_table(replies, f"{root}/subnational", format="text", partition_by=["iso3_code"])
    files.write_table(shapes.registry_replies(spark, sf), f"{root}/registry", format="text")
    return food.security(
        spark, root, shapes.country_table(spark, sf), level="subnational", multi_line=False
    )


@query("select o_orderkey, o_totalprice from orders")
def snapshot_keep_release(spark, sf):
    """A kept table written as snapshot, forgotten, and written anew."""
    root = landing.new_folder(spark, "snapshots")
    kept = snapshots.keep(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    snapshots.write(kept, root)
    snapshots.clear(spark, root)
    again = snapshots.reuse(spark, root, lambda: kept)
    snapshots.release(kept)
    return again


# --- analysis helpers --------------------------------------------------------


@query("select o_custkey, max(o_orderdate) as o_orderdate,"
       " max_by(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by 1")  # fmt: skip
def opt_latest_by_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return analysis.filter_latest_by(orders, ["o_custkey"], "o_orderdate")


@query("select l_returnflag, l_suppkey,"
       " round(cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*), 4) as value"
       " from lineitem where year(l_shipdate) between 1996 and 1998 group by 1, 2")  # fmt: skip
def opt_period_average(spark, sf):
    lineitem = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_suppkey", F.year("l_shipdate").alias("year"),
        F.col("l_quantity").alias("value"),
    )
    means = analysis.period_average(lineitem, 1996, 1998, by=["l_returnflag", "l_suppkey"])
    return means.withColumn("value", F.round("value", 4))


@query(f"""
select entity_code, counterpart_code, indicator_code,
  round(max(value) filter (year = 2000) - max(value) filter (year = 1996), 2) as change
from ({sql.OBSERVATIONS}) where year in (1996, 2000) group by 1, 2, 3
""")
def opt_change_from_date(spark, sf):
    keys = ["entity_code", "counterpart_code", "indicator_code"]
    changes = analysis.change_from_date(shapes.observations(spark, sf), 1996, 2000, by=keys)
    return changes.withColumn("change", F.round("change", 2))


@query("select c_custkey, c_nationkey, n_name from customer left join nation on c_nationkey = n_nationkey")
def opt_add_dim_column(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return analysis.add_dimension(customers, nation, ["c_nationkey"], ["n_name"])


@query("select c_custkey, c_nationkey from customer where c_nationkey in ("
       "select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name = 'AFRICA')")  # fmt: skip
def opt_filter_group(spark, sf):
    region = table(spark, sf, "region").where("r_name = 'AFRICA'")
    african = region.withColumnRenamed("r_regionkey", "n_regionkey")
    members = filters.in_group(table(spark, sf, "nation"), african, "n_regionkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return filters.in_group(
        customers, members.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    )


@query("select o_orderkey, o_totalprice as n, format('{:,}', o_orderkey * 1000) as written,"
       " strftime(o_orderdate, '%-d %B %Y') as date_text,"
       " make_date(cast(year(o_orderdate) as int), 1, 1) as year_start from orders")  # fmt: skip
def opt_number_text(spark, sf):
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" USD"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.number(price).alias("n"),
        text.format_number(F.col("o_orderkey") * 1000).alias("written"),
        dates.written_out(F.col("o_orderdate")).alias("date_text"),
        dates.from_year_or_text(F.year("o_orderdate")).alias("year_start"),
    )


@query("select user_id, max(ts) as ts, arg_max(event_id, ts) as event_id from events group by 1")
def opt_append_dedup(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id")
    middle = F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return analysis.append_new(
        events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle),
        keys=["user_id"], date="ts",
    )


@query(f"""
select o.*, round(value / t, 6) as share from ({sql.OBSERVATIONS}) o join (
  select entity_code, year, cast(sum(cast(value as decimal(18,2))) as double) as t
  from ({sql.OBSERVATIONS}) group by 1, 2) using (entity_code, year)
""")
def opt_value_share(spark, sf):
    shares = analysis.share_of_group(
        shapes.observations(spark, sf), ["entity_code", "year"], exact="decimal(18,2)"
    )
    return shares.withColumn("share", F.round("share", 6))


@query("select l_returnflag, median(l_extendedprice) as median from lineitem group by 1")
def opt_group_median(spark, sf):
    return analysis.group_median(
        table(spark, sf, "lineitem"), ["l_returnflag"], value="l_extendedprice"
    )


@query("select o_orderkey, o_orderpriority, o_totalprice, median(o_totalprice) over ("
       "partition by o_orderpriority) as median from orders")  # fmt: skip
def opt_median_column(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return analysis.add_median(orders, ["o_orderpriority"], value="o_totalprice")


@query(f"""
select c_custkey, written, case when c_nationkey < 25 then 'NATION_' || c_nationkey end as name_short
from (select c_custkey, c_nationkey, {sql.NATION_CODE.format("c_nationkey")} as written from customer)
""")
def opt_convert_id(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", shapes.country_code(F.col("c_nationkey")).alias("written")
    )
    return resolve.add_code(
        customers, "written", shapes.country_table(spark, sf), to=resolve.NAME_SHORT
    )


# --- helpers -----------------------------------------------------------------


def _parsed(replies: DataFrame, schema: str, *keep: str) -> DataFrame:
    """The fields of JSON replies as columns."""
    return replies.select(*keep, F.from_json("reply", schema).alias("_r")).select(*keep, "_r.*")


def _undeclared_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON: some fields in some records only, or of several kinds."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    known = F.struct(
        F.struct(F.year("ts").alias("value")).alias("time"),
        F.struct(
            user.alias("id"),
            F.when(kind != "view", F.concat(F.lit("User "), user)).alias("value"),
        ).alias("economy"),
        kind.alias("series"),
        "value",
        "event_id",
        F.when(kind == "error", "E").alias("status"),
        F.when(kind == "signup", "new").alias("note"),
    )
    # what the other kinds of event write there is a number, as text has no kinds
    scale = F.when(F.col("event_id") % 2 == 0, "1").otherwise("0.5")
    note = F.when(kind == "purchase", F.concat(F.lit('"note":'), user))
    added = F.concat_ws(
        ",",
        F.concat(F.lit('"unit":{"scale":'), scale, F.lit("}")),
        F.concat(F.lit('"props":'), "props"),
        note,
    )
    written = F.regexp_replace(F.to_json(known), r"\}$", "")
    return table(spark, sf, "events").select(
        F.concat(written, F.lit(","), added, F.lit("}")).alias("reply")
    )


def _customers_with_legacy_code(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_name").alias(fields.ENTITY_NAME),
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias(fields.IMF_CODE),
    )


def _dates_by_file(spark: SparkSession, sf: str) -> DataFrame:
    file, even = F.left("o_orderpriority", F.lit(1)), F.col("o_orderkey") % 2 == 0
    day_first = F.date_format("o_orderdate", "dd/MM/yyyy")
    month_first = F.date_format("o_orderdate", "MM/dd/yyyy")
    written = (
        F.when(file == "1", day_first)
        .when(file == "2", month_first)
        .when(file == "3", F.when(even, day_first).otherwise(month_first))
        .when(file == "4", F.when(even, day_first).otherwise(F.date_format("o_orderdate", "d MMM yyyy")))
        .when(even, "not yet")
    )
    return table(spark, sf, "orders").select("o_orderkey", file.alias("file"), written.alias("date"))


def _hiv_rows(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.lit("Orders").alias("Indicator"),
        F.lit("Number").alias("Unit"),
        status.alias("Subgroup"),
        F.concat(F.lit("Area, of "), "o_custkey").alias("Area"),
        F.concat(F.lit("A"), "o_custkey").alias("Area ID"),
        F.year("o_orderdate").alias("Time Period"),
        F.lit("NA").alias("Source"),
        F.when(status == "P", "Yes").otherwise(F.col("o_orderkey").cast("string"))
        .alias("Data value"),
        F.col("o_orderpriority").alias("Formatted"),
        F.lit("").alias("Footnote"),
    )


def _write_csv(df: DataFrame, name: str, **options) -> str:
    path = landing.new_folder(df.sparkSession, name)
    files.write_table(df, path, format="csv", header=True, escape='"', **options)
    return path


def _write_inflation(spark: SparkSession, sf: str, root: str) -> None:
    files.write_table(
        shapes.inflation_cells(spark, sf), f"{root}/inflation", format="csv",
        partition_by=["indicator_id", "iso3_code"], header=True, escape='"',
    )


def _outlook_files(spark: SparkSession, sf: str) -> str:
    path = landing.new_folder(spark, "outlook")
    files.write_table(
        shapes.outlook_records(spark, sf), path, partition_by=["vintage_year", "vintage_month"]
    )
    return path
