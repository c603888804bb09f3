"""Text cleaning expressions. All of them pass NULL through unless they say so."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker of a footnote at the end of a cell, such as " 1/",
# and the cells that publishers' CSV files use for "no value".
FOOTNOTE_MARKER = r"(?U)\s*\d+/\s*$"
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

PRODUCT_CODE_DIGITS = 6

_WHOLE_NUMBER = r"^\s*[+-]?\d{1,19}\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip(c: Column) -> Column:
    """Remove surrounding white space of any kind (`trim` only removes blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_footnote(c: Column) -> Column:
    """Remove one footnote marker from the end, then surrounding white space."""
    return strip(F.regexp_replace(c, FOOTNOTE_MARKER, ""))


def capitalise(c: Column) -> Column:
    """First letter upper case, everything after it lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


def label(c: Column) -> Column:
    """A category label: no footnote, capitalised, NULL when nothing is left."""
    return F.nullif(capitalise(strip_footnote(c)), F.lit(""))


def is_yes(c: Column) -> Column:
    """True for "yes" in any case, false for everything else including NULL."""
    return F.coalesce(F.lower(c) == "yes", F.lit(False))


def missing_to_null(c: Column) -> Column:
    """NULL where a CSV cell holds one of the usual missing-value markers."""
    return F.when(~c.isin(MISSING_MARKERS), c)


def product_code(c: Column) -> Column:
    """A product code as text, digits padded on the left to six places.

    Longer codes and codes with letters are left as they are.
    """
    short_number = (F.length(c) < PRODUCT_CODE_DIGITS) & c.rlike(r"^\d+$")
    return F.when(short_number, F.lpad(c, PRODUCT_CODE_DIGITS, "0")).otherwise(c)


def before_last_underscore(c: Column) -> Column:
    """`HDI_F_2000` -> `HDI_F`; a text without underscore is returned unchanged."""
    return F.regexp_replace(c, r"(?s)^(.*)_[^_]*$", "$1")


def after_last_underscore(c: Column) -> Column:
    """`HDI_F_2000` -> `2000`; NULL for a text without underscore."""
    return F.when(F.contains(c, F.lit("_")), F.substring_index(c, "_", -1))


def to_double(c: Column) -> Column:
    """A text as a double, NULL where it is not a number.

    The form is checked first: a cast that fails costs far more than a match.
    """
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def to_integer(c: Column, type_: str = "int") -> Column:
    """A text as an integer, NULL where it is not a whole number of that type."""
    return F.when(c.rlike(_WHOLE_NUMBER), c.try_cast(type_))


def strict(c: Column, type_: str) -> Column:
    """A cell in another type; a cell that cannot be read so stops the job.

    Unlike a plain cast it does so whether ANSI mode is on or off.
    """
    typed = c.try_cast(type_)
    problem = F.concat(F.lit(f"Not a {type_}: "), c.cast("string"))
    return F.when(c.isNotNull() & typed.isNull(), F.raise_error(problem).cast(type_)).otherwise(
        typed
    )


def number(c: Column) -> Column:
    """Read a number written for people: `$1,234.50` -> 1234.5, NULL if none."""
    return to_double(F.regexp_replace(c, r"[^0-9.\-]", ""))


def format_number(
    c: Column, decimals: int = 0, *, percent: bool = False, millions: bool = False,
    billions: bool = False,
) -> Column:
    """Write a number for people: `1234567.89` -> `1,234,568`."""
    if sum([percent, millions, billions]) > 1:
        raise ValueError("Choose one of percent, millions and billions")
    if percent:
        return F.concat(F.format_number(c * 100, decimals), F.lit("%"))
    if millions:
        return F.format_number(c / 1_000_000, decimals)
    if billions:
        return F.format_number(c / 1_000_000_000, decimals)
    return F.format_number(c, decimals)
