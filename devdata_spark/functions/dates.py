"""Date expressions."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day-grain formats that free-form dates may have. Each is tried
# only on texts of its form: a parse that fails costs far more than a match.
# The first pattern that gives a date counts, so 05/04/2024 alone is the fifth of April.
FREE_FORM_PATTERNS = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy/M/d": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-MMM-yy": r"^\d{1,2}-[A-Za-z]{3}-\d{2}$",
    "d-MMM-yyyy": r"^\d{1,2}-[A-Za-z]{3}-\d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "d MMMM yyyy": r"^\d{1,2} [A-Za-z]{3,} \d{4}$",
    "MMM d, yyyy": r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    "MMMM d, yyyy": r"^[A-Za-z]{3,} \d{1,2}, \d{4}$",
    "MMM yyyy": r"^[A-Za-z]{3} \d{4}$",
    "MMMM yyyy": r"^[A-Za-z]{3,} \d{4}$",
}

# Two-digit years 69 to 99 mean 1969 to 1999, as strptime reads them.
_LAST_YEAR_OF_TWO_DIGITS = 2068

# The years that stand for an open start and an open end.
FIRST_YEAR, LAST_YEAR = 1800, 2099


# Forms that read one text as different dates: which one is meant shows in a whole column.
AMBIGUOUS = ["d/M/yyyy", "M/d/yyyy"]


def form_bit(pattern: str) -> int:
    """The bit that stands for a form in a mask of forms."""
    return 1 << list(FREE_FORM_PATTERNS).index(pattern)


AMBIGUOUS_BITS = sum(form_bit(p) for p in AMBIGUOUS)


def parse_free_form(c: Column, allowed: Column | None = None) -> Column:
    """The date of a free-form text, NULL where no known format fits.

    Ambiguous forms that are not in the mask `allowed` are not tried, unless it has none.
    """
    dates = _parsed(c)
    if allowed is not None:
        some = F.coalesce(allowed, F.lit(0)).bitwiseAND(F.lit(AMBIGUOUS_BITS))
        for pattern in AMBIGUOUS:
            tried = (some == 0) | (some.bitwiseAND(F.lit(form_bit(pattern))) != 0)
            dates[pattern] = F.when(tried, dates[pattern])
    return F.coalesce(*dates.values())


def form_mask(c: Column, patterns: Iterable[str] = FREE_FORM_PATTERNS) -> Column:
    """The forms, of the given ones, in which a text is a date, as a mask; 0 if none."""
    parsed = _parsed(c)
    bits = [
        F.when(parsed[pattern].isNotNull(), F.lit(form_bit(pattern))).otherwise(F.lit(0))
        for pattern in patterns
    ]
    return reduce(Column.bitwiseOR, bits).cast("bigint")


def _parsed(c: Column) -> dict[str, Column]:
    """The date of a text in each form."""
    parsed = {}
    for pattern, form in FREE_FORM_PATTERNS.items():
        date = F.when(c.rlike(form), F.try_to_date(c, pattern))
        if pattern.endswith("-yy"):
            last_century = F.year(date) > _LAST_YEAR_OF_TWO_DIGITS
            date = F.when(last_century, F.add_months(date, -1200)).otherwise(date)
        parsed[pattern] = date
    return parsed


def parse_report(df: DataFrame, column: str) -> DataFrame:
    """One row: how many cells are a date, how many are empty, and how many neither."""
    parsed = parse_free_form(F.col(column))
    empty = F.col(column).isNull()
    return df.agg(
        F.count_if(parsed.isNotNull()).alias("n_dates"),
        F.count_if(empty).alias("n_empty"),
        F.count_if(~empty & parsed.isNull()).alias("n_unparsed"),
    )


def parse_strict(c: Column, pattern: str) -> Column:
    """The date of a text in one known format; any other text stops the job."""
    parsed = F.try_to_date(c, pattern)
    problem = F.concat(F.lit(f"Not a date in the format {pattern}: "), c)
    return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(problem).cast("date")).otherwise(
        parsed
    )


def year_bounds(start: int | None, end: int | None) -> tuple[int, int] | None:
    """Inclusive year bounds with open ends filled in; None when both are open."""
    if start is None and end is None:
        return None
    return (FIRST_YEAR if start is None else start, LAST_YEAR if end is None else end)


def written_out(c: Column) -> Column:
    """A date as English text: 2022-05-11 -> `11 May 2022`."""
    return F.date_format(c, "d MMMM yyyy")


def from_year_or_text(c: Column) -> Column:
    """A date from a year number (first of January) or from a free-form text."""
    as_text = c.cast("string")
    from_year = F.try_to_date(F.concat(as_text, F.lit("-01-01")), "yyyy-MM-dd")
    return F.when(as_text.rlike(r"^\d{4}$"), from_year).otherwise(parse_free_form(as_text))
