"""Projections: renaming, ordering, flattening and whole-table cell clean-up."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devdata_spark.errors import DataFormattingError


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_first(df: DataFrame, sources: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename where several raw names mean the same harmonised column.

    `sources` maps each harmonised name to its raw names, preferred first. Where
    more than one is present, the first that is not NULL gives the value.
    """
    chosen: dict[str, Column] = {}
    replaced: set[str] = set()
    first_seen: dict[str, str] = {}
    for target, candidates in sources.items():
        present = [c for c in candidates if c in df.columns]
        if present:
            chosen[target] = F.coalesce(*[_exact(c) for c in present])
            replaced.update(present)
            first_seen[min(present, key=df.columns.index)] = target
    projection = []
    for name in df.columns:
        if name in first_seen:
            projection.append(chosen[first_seen[name]].alias(first_seen[name]))
        elif name not in replaced:
            projection.append(_exact(name))
    return df.select(*projection)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns, in that order; an absent one is a formatting error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataFormattingError(f"Missing columns: {missing}")
    return df.select(*[_exact(c) for c in columns])


def require_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Exactly the named raw columns, renamed, in the order of `names`."""
    return rename(require(df, list(names)), names)


def by_position(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Keep columns by their zero-based position and name them; drop the rest."""
    if max(names) >= len(df.columns):
        raise DataFormattingError(
            f"Expected at least {max(names) + 1} columns, found {len(df.columns)}"
        )
    return df.select(*[_exact(df.columns[i]).alias(name) for i, name in names.items()])


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add columns that hold one value in every row."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace every struct column by its fields, at any depth.

    The new name is the path joined by `separator`: `region.id` -> `region_id`.
    Arrays and maps are left as they are. Only the schema is read, no data.
    """
    return df.select(*leaves(df.schema, separator=separator))


def leaves(schema: T.StructType, *under: str, separator: str = "_") -> list[Column]:
    """The fields of a struct at any depth, named by their paths from that struct.

    `under` is the path of the struct itself; without it the struct is the row.
    """

    def of(path: list[str], data_type: T.DataType) -> list[Column]:
        if isinstance(data_type, T.StructType):
            return [
                leaf
                for field in data_type.fields
                for leaf in of([*path, field.name], field.dataType)
            ]
        column = F.col(".".join(_quoted(part) for part in [*under, *path]))
        return [column.alias(separator.join(path))]

    return of([], schema)


def marker_to_null(df: DataFrame, marker: str) -> DataFrame:
    """NULL wherever a whole text cell equals `marker`, in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.replace(marker, None, subset=text) if text else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL wherever a floating-point cell is not a number."""
    kinds = (T.FloatType, T.DoubleType)
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return clean(df, **{n: lambda c: F.when(~F.isnan(c), c) for n in floating})


def clean(df: DataFrame, **cleaners) -> DataFrame:
    """Apply a column function to each named column that is present."""
    present = {c: fn(_exact(c)) for c, fn in cleaners.items() if c in df.columns}
    return df.withColumns(present) if present else df


def _exact(name: str) -> Column:
    return F.col(_quoted(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
