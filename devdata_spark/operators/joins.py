"""Joins of a large table to a lookup table.

Three things are decided from one aggregation over the lookup table before the
join is planned: whether its key is unique, whether NULL keys have to match, and
whether it is small enough to broadcast.

* Small lookup (measured, not assumed): broadcast, the large table never moves.
* Larger lookup: the rows of over-full keys are joined with a broadcast of just
  those keys' lookup rows, and only the other rows are shuffled. No more than one
  key per shuffle partition can be over-full, so that broadcast is small too. It
  is measured all the same; if it does not fit, the plain shuffled join is used
  and adaptive execution splits its skewed partitions.

NULL keys match NULL keys, in both cases.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devdata_spark.errors import DataValidationError
from devdata_spark.scratch import materialise

# Largest lookup table that is sent to every executor, by measured content.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
BROADCAST_MAX_ROWS = 500_000

_FIXED_CELL_BYTES = 16


@dataclass(frozen=True)
class Profile:
    """What one pass over a lookup table tells about it."""

    rows: int
    bytes: int
    duplicate_keys: int
    null_keys: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_MAX_ROWS and self.bytes <= BROADCAST_MAX_BYTES


def profile(lookup: DataFrame, keys: Sequence[str]) -> Profile:
    """Measure a lookup table: size, repeated keys and NULL keys, in one job."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    per_key = lookup.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum(_row_bytes(lookup)).alias("_bytes")
    )
    found = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.count_if(any_null).alias("null_keys"),
    ).first()
    return Profile(**found.asDict())


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    *,
    how: str = "left",
    validate: bool = True,
    measured: Profile | None = None,
    derived: bool = False,
) -> DataFrame:
    """Join `df` to a lookup table on equally named columns.

    `how` is `left`, `left_semi` or `left_anti`. A left join must be many-to-one
    unless `validate` is off, in which case a repeated key repeats the row.
    Pass `measured` to reuse a profile of the same lookup table and key. `derived`
    says that the lookup is an aggregate of a large table by the key, so unique: it is
    written to the shared folder, and measured and joined from there.
    """
    keys = list(on)
    if derived:
        lookup, validate = materialise(lookup, "lookup"), False
    if how != "left":
        lookup = lookup.select(*keys).distinct()
    facts = measured or profile(lookup, keys)
    # a join on names puts the key first: keep the order of `df`, then what is new
    order = list(df.columns)
    if how == "left":
        order += [c for c in lookup.columns if c not in keys]
    if how == "left" and validate and facts.duplicate_keys:
        raise DataValidationError(
            f"The lookup table repeats {facts.duplicate_keys} key(s) of {keys}; "
            "expected one row per key"
        )
    nulls = facts.null_keys > 0
    if facts.fits_broadcast:
        joined = _join(df, F.broadcast(lookup), keys, how, nulls)
    else:
        joined = _attach_large(df, lookup, keys, how, nulls)
    return joined.select(*[F.col(f"`{c}`") for c in order])


def sent_if_small(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The lookup table marked for a broadcast if its measured size allows one, else for a
    shuffled join."""
    return F.broadcast(lookup) if profile(lookup, keys).fits_broadcast else _shuffled(lookup)


def _shuffled(lookup: DataFrame) -> DataFrame:
    """Without this mark Spark goes by the size of compressed files, and would gather a
    table of millions of short rows in the driver to broadcast it."""
    return lookup.hint("merge")


def _attach_large(
    df: DataFrame, lookup: DataFrame, keys: list[str], how: str, nulls: bool
) -> DataFrame:
    large = _shuffled(lookup)
    full = overfull_keys(df, keys)
    if full is None:
        return _join(df, large, keys, how, nulls)
    full_lookup = _join(lookup, F.broadcast(full), keys, "left_semi", True)
    if not profile(full_lookup, keys).fits_broadcast:
        return _join(df, large, keys, how, nulls)
    in_place = _join(df, F.broadcast(full), keys, "left_semi", True)
    moved = _join(df, F.broadcast(full), keys, "left_anti", True)
    return _join(in_place, F.broadcast(full_lookup), keys, how, nulls).unionByName(
        _join(moved, large, keys, how, nulls)
    )


def overfull_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys that alone hold more rows than an even shuffle partition would.

    At most as many keys as there are shuffle partitions can qualify, so they are
    held as a local table. The counts are combined before the shuffle, and only
    the key columns are read. None when there are no such keys.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even_share = max(df.count() // partitions, 1)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    full = counts.where(F.col("_n") > even_share).drop("_n")
    rows = full.collect()
    return df.sparkSession.createDataFrame(rows, full.schema) if rows else None


def map_codes(
    df: DataFrame, names: DataFrame, key: str, name: str, order: str
) -> DataFrame:
    """Add the `name` that a lookup table gives for `key`.

    Where the lookup repeats a key its last row by `order` wins, so rows are
    never repeated. A code that is not found gets NULL.
    """
    last = names.groupBy(key).agg(F.max_by(name, order).alias(name))
    return attach(df, last, [key], derived=True)


def _join(df: DataFrame, other: DataFrame, keys: list[str], how: str, nulls: bool) -> DataFrame:
    if not nulls:
        return df.join(other, keys, how)
    hint = {k: f"_key_{i}" for i, k in enumerate(keys)}
    renamed = other.withColumnsRenamed(hint)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(hint[k])) for k in keys])
    joined = df.join(renamed, same, how)
    return joined.drop(*hint.values())


def _row_bytes(df: DataFrame) -> Column:
    sizes = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_CELL_BYTES
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = F.lit(_FIXED_CELL_BYTES)
        sizes.append(size)
    return reduce(Column.__add__, sizes).cast("bigint")
