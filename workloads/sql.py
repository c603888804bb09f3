"""SQL fragments that the checks of several queries share."""

FLOWS = """
select cast(year(l_shipdate) as int) as year, cast(s_nationkey as bigint) as exporter_code,
  cast(c_nationkey as bigint) as importer_code,
  case when length(cast(l_partkey as varchar)) < 6 then lpad(cast(l_partkey as varchar), 6, '0')
    else cast(l_partkey as varchar) end as product_code,
  l_extendedprice as value, l_quantity as quantity
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
"""

PRODUCTS = """
select case when length(cast(p_partkey as varchar)) < 6 then lpad(cast(p_partkey as varchar), 6, '0')
  else cast(p_partkey as varchar) end as product_code, p_name as product_description from part
"""

NATION_CODE = "'N' || lpad(cast({} as varchar), 2, '0')"

COUNTRIES = f"""
select cast(n_nationkey as bigint) as country_code, n_name as country_name,
  {NATION_CODE.format("n_nationkey")} as iso3_code from nation
"""

OBSERVATIONS = f"""
select year, {NATION_CODE.format("c_nationkey")} as entity_code, o_custkey as counterpart_code,
  indicator_code, case when indicator_code = '5-LOW' and year = 2001 then null else value end as value
from (
  select o_custkey, o_orderpriority as indicator_code, cast(year(o_orderdate) as int) as year,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
  from orders group by all
) join customer on o_custkey = c_custkey
"""

OUTLOOK = f"""
select 'USD' as unit_code, o_orderpriority as indicator_code,
  {NATION_CODE.format("c_nationkey")} as entity_code, nullif(c_nationkey, 0) as imf_code,
  o_orderkey as notes, cast(year(o_orderdate) as int) as year, o_totalprice as value,
  'Area ' || c_nationkey as entity_name, lower(o_orderpriority) as indicator_name,
  'US dollars' as unit, 2023 as last_actual_date
from orders join customer on o_custkey = c_custkey where o_orderstatus <> 'P'
"""

# Two points per order: the order date and the day after.
SERIES = f"""
select cast(o_orderdate as date) + d as date, floor(o_totalprice) + d as value,
  floor(o_totalprice) + d + 5 as value_upper, floor(o_totalprice) + d - 5 as value_lower,
  {NATION_CODE.format("c_nationkey")} as iso3_code, 'NATION_' || c_nationkey as country_name,
  'people with insufficient food consumption' as indicator_name,
  'World Food Programme' as source
from (select *, unnest([0, 1]) as d from orders) join customer on o_custkey = c_custkey
"""

REGION_SERIES = f"""
select cast(o_orderdate as date) + d as date, floor(o_totalprice) + d + s as value,
  floor(o_totalprice) + d + s + 5 as value_upper, floor(o_totalprice) + d + s - 5 as value_lower,
  case when s = 0 then o_orderpriority else o_orderstatus end as region_name,
  {NATION_CODE.format("c_nationkey")} as iso3_code, 'NATION_' || c_nationkey as country_name,
  'people with insufficient food consumption' as indicator_name,
  'World Food Programme' as source
from (select *, unnest([0, 1]) as d from (select *, unnest([0, 10]) as s from orders))
  join customer on o_custkey = c_custkey
"""

INFLATION = f"""
select cast(o_orderdate as date) as date, o_totalprice as value, 'Order ' || o_orderkey as source,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Headline inflation (YoY)'
    when o_orderpriority = '3-MEDIUM' then 'Headline inflation (MoM)'
    else 'Food inflation' end as indicator_name,
  {NATION_CODE.format("c_nationkey")} as iso3_code,
  'NATION_' || c_nationkey as country_name, 'percent' as unit
from orders join customer on o_custkey = c_custkey
"""

PRICES = """
select e.entity_code, 'price' as indicator_code, y.value, e.year from (
  select entity_code, cast(unnest(range(1995, 2002)) as int) as year
  from (select distinct o_custkey as entity_code from orders)) e
left join (
  select o_custkey, cast(year(o_orderdate) as int) as yr,
    cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
  from orders group by all) y on y.o_custkey = e.entity_code and y.yr = e.year
"""
