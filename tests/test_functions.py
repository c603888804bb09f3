import datetime

import pytest
from pyspark.sql import functions as F

from devdata_spark.functions import dates, text


def values(spark, fn, inputs, type_="STRING"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"n INT, c {type_}")
    return [r[0] for r in df.orderBy("n").select(fn(F.col("c"))).collect()]


@pytest.mark.parametrize(
    ("fn", "inputs", "expected"),
    [
        (
            text.strip_footnote,
            ["Country One 1/ ", "Example 3/  ", "X 1/ 2/", "no note", "a 12/b", " pad\t", None],
            ["Country One", "Example", "X 1/", "no note", "a 12/b", "pad", None],
        ),
        (
            text.label,
            [" in debt distress 5/ ", "SUSTAINABLE", "unsustainable 2/", " 4/ ", "", None],
            ["In debt distress", "Sustainable", "Unsustainable", None, None, None],
        ),
        (text.is_yes, ["Yes", "YES", "no", " yes", "", None], [True, True, False, False, False, False]),
        (
            text.product_code,
            ["100", "010121", "1", "9999999", "AB1", None],
            ["000100", "010121", "000001", "9999999", "AB1", None],
        ),
        (
            text.before_last_underscore,
            ["HDI_2000", "INEQUALITY_INDEX_2000", "plain", "end_", None],
            ["HDI", "INEQUALITY_INDEX", "plain", "end", None],
        ),
        (
            text.after_last_underscore,
            ["HDI_2000", "INEQUALITY_INDEX_2000", "plain", "end_", None],
            ["2000", "2000", None, "", None],
        ),
        (text.missing_to_null, ["NA", "", "nan", "NAM", "0", None], [None, None, None, "NAM", "0", None]),
        (text.number, ["$1,234.50", "-3 %", "none", "", None], [1234.5, -3.0, None, None, None]),
        (
            dates.parse_free_form,
            ["2024-01-15", "31/10/2024", "5-Jan-24", "5-Jan-95", "March 3, 2021", "n/a", "", None],
            [
                datetime.date(2024, 1, 15), datetime.date(2024, 10, 31), datetime.date(2024, 1, 5),
                datetime.date(1995, 1, 5), datetime.date(2021, 3, 3), None, None, None,
            ],
        ),
        (
            dates.from_year_or_text,
            ["2020", "2021-02-03", "x"],
            [datetime.date(2020, 1, 1), datetime.date(2021, 2, 3), None],
        ),
    ],
)
def test_text_and_dates(spark, fn, inputs, expected):
    assert values(spark, fn, inputs) == expected


def test_strict_dates_stop_on_another_format(spark):
    def parse(c):
        return dates.parse_strict(c, "dd/MM/yyyy")

    assert values(spark, parse, ["31/10/2024", None]) == [datetime.date(2024, 10, 31), None]
    with pytest.raises(Exception, match="Not a date in the format dd/MM/yyyy: 2024-10-31"):
        values(spark, parse, ["2024-10-31"])


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [(None, None, None), (2000, 2005, (2000, 2005)), (None, 1900, (1800, 1900)), (2010, None, (2010, 2099))],
)
def test_open_year_ranges(start, end, expected):
    assert dates.year_bounds(start, end) == expected


def test_number_formats(spark):
    def written(**options):
        return values(spark, lambda c: text.format_number(c, **options), [1234567.891], "DOUBLE")[0]

    assert written(decimals=2) == "1,234,567.89"
    assert written(decimals=1, millions=True) == "1.2"
    assert written(decimals=3, billions=True) == "0.001"
    assert values(spark, lambda c: text.format_number(c, 1, percent=True), [0.256], "DOUBLE") == ["25.6%"]
    with pytest.raises(ValueError):
        text.format_number(F.lit(1), percent=True, millions=True)


def test_date_written_out(spark):
    assert values(spark, dates.written_out, [datetime.date(2022, 5, 11)], "DATE") == ["11 May 2022"]


def test_numbers_in_text(spark):
    cells = ["1", " 2.5 ", "-3e2", ".5", "1d", "..", "12345678901234567890", "", None]
    assert values(spark, text.to_double, cells) == [1.0, 2.5, -300.0, 0.5, None, None, 1.2345678901234567e19, None, None]
    assert values(spark, text.to_integer, ["7", " -8", "9.0", "3000000000", "x", None]) == [7, -8, None, None, None, None]
    big = values(spark, lambda c: text.to_integer(c, "bigint"), ["3000000000", "9999999999999999999"])
    assert big == [3000000000, None]


def test_free_form_dates_and_their_count(spark):
    written = {
        "2024/01/15": "2024-01-15", "15 Jan 2024": "2024-01-15", "Jan 5, 2024": "2024-01-05",
        "15-Jan-2024": "2024-01-15", "January 2024": "2024-01-01", "01/15/2024": "2024-01-15",
        "2024-01-15T00:00:00": "2024-01-15", "5/4/2024": "2024-04-05", "31 March 1999": "1999-03-31",
        "soon": None, "45/45/2024": None, None: None,
    }
    df = spark.createDataFrame([(w,) for w in written], "w STRING")
    found = {r.w: r.d and str(r.d) for r in df.select("w", dates.parse_free_form(F.col("w")).alias("d")).collect()}
    assert found == written
    assert tuple(dates.parse_report(df, "w").first()) == (9, 1, 2)
