"""Harmonised column names shared by every dataset.

The strings are fixed values: they are the public column names of the tidy
tables, so that tables from different publishers line up.
"""

# observations
VALUE = "value"
VALUE_UPPER = "value_upper"
VALUE_LOWER = "value_lower"
QUANTITY = "quantity"

# places
COUNTRY_NAME = "country_name"
COUNTRY_CODE = "country_code"
REGION_NAME = "region_name"
REGION_CODE = "region_code"
ENTITY_NAME = "entity_name"
ENTITY_CODE = "entity_code"
ISO2_CODE = "iso2_code"
ISO3_CODE = "iso3_code"
IMF_CODE = "imf_code"
COUNTERPART_CODE = "counterpart_code"
COUNTERPART_NAME = "counterpart_name"
INCOME_LEVEL_CODE = "income_level_code"
INCOME_LEVEL_NAME = "income_level_name"

# time
YEAR = "year"
DATE = "date"
TIME_RANGE = "time_range"

# indicators
INDICATOR_CODE = "indicator_code"
INDICATOR_NAME = "indicator_name"
UNIT = "unit"
CURRENCY = "currency"
SOURCE = "source"
DATA_TYPE = "data_type"
NOTES = "notes"
FOOTNOTE = "footnote"

# trade
EXPORTER_CODE = "exporter_code"
IMPORTER_CODE = "importer_code"
EXPORTER_NAME = "exporter_name"
IMPORTER_NAME = "importer_name"
EXPORTER_ISO3_CODE = "exporter_iso3_code"
IMPORTER_ISO3_CODE = "importer_iso3_code"
PRODUCT_CODE = "product_code"
PRODUCT_NAME = "product_name"
PRODUCT_DESCRIPTION = "product_description"

# units of measurement
PERCENT = "percent"
