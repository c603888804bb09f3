"""Country names and codes of unknown form, resolved to one code.

The country table is an input: `iso3_code`, `iso2_code`, `name_short` and
`regex`, a pattern that recognises the country in a longer name. A name is first
looked up as a code or short name, by an ordinary equality join. Names that this
leaves over meet patterns through an inverted index: every match of a pattern contains
one of a few literals, each literal is known by its rarest stretch of letters, as long as a
literal of its length allows, and a name meets the patterns that are known by one of its
own stretches. Only these pairs are matched. Patterns without such a literal are tried on
every name left over.
"""

import logging
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark import fields, scratch
from devdata_spark.errors import DataValidationError
from devdata_spark.functions import literals, text
from devdata_spark.operators import combine, joins

logger = logging.getLogger(__name__)

NAME_SHORT = "name_short"

# Patterns without a literal become expressions of so many each; more of them than
# `MOST_UNINDEXED` are an error, as each is tried on every name.
PATTERNS_AT_ONCE = 500
MOST_UNINDEXED = 5_000

# Lengths of the stretches that literals are known by: many patterns, such as those with
# numbers of their own, share three letters, but few share eight.
STRETCHES = (literals.SHORTEST, 4, 6, 8, 12, 16, 24)

# Executors get the code with the job and need no package.
register_pickle_by_value(literals)

_EXACT_KEYS = [fields.ISO3_CODE, fields.ISO2_CODE, NAME_SHORT]


def resolve_names(
    df: DataFrame, column: str, countries: DataFrame, to: str = fields.ISO3_CODE
) -> DataFrame:
    """Each distinct name in `column` with its code: columns `column` and `to`.

    `to` is NULL where the name is not found, or where patterns of more than one
    country recognise it.
    """
    names = df.select(column).where(F.col(column).isNotNull()).distinct()
    keyed = names.withColumn("_key", F.lower(text.strip(F.col(column))))
    exact = joins.attach(keyed, _exact_keys(countries, to), ["_key"], derived=True)
    exact = scratch.materialise(exact.drop("_key"), "names")
    left_over = exact.where(F.col(to).isNull()).select(F.col(column).alias("_name"))
    found = codes_by_pattern(left_over, countries.select(F.col(to).alias("_code"), "regex"))
    found = found.select(F.col("_name").alias(column), "_code")
    joined = joins.attach(exact, found, [column], derived=True)
    return joined.select(column, F.coalesce(F.col(to), F.col("_code")).alias(to))


def codes_by_pattern(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """`_name`, `_code`: names that the patterns of exactly one code recognise.

    `names` has distinct names as `_name`, `patterns` has `_code` and `regex`.
    """
    known = scratch.materialise(index(patterns), "patterns")
    pairs = candidates(names, known.where("gram IS NOT NULL"))
    hits = pairs.where(F.rlike("_name", F.concat(F.lit("(?i)"), F.col("regex"))))
    hits = hits.select("_name", "_code")
    others = known.where("gram IS NULL").select("_code", "regex").distinct()
    tried = others.limit(MOST_UNINDEXED + 1).collect()
    if len(tried) > MOST_UNINDEXED:
        raise DataValidationError(
            f"More than {MOST_UNINDEXED} patterns have no text of {literals.SHORTEST} letters "
            "that each of their matches contains"
        )
    if tried:
        codes = _codes_by_pattern(F.col("_name"), [(r[0], r[1]) for r in tried])
        hits = hits.unionByName(names.select("_name", F.explode(codes).alias("_code")))
    one = hits.groupBy("_name").agg(F.min("_code").alias("_code"), F.max("_code").alias("_other"))
    return one.where("_code = _other").drop("_other")


def index(patterns: DataFrame) -> DataFrame:
    """`_code`, `regex`, `gram`: letters of which a match contains at least one row's.

    A pattern has a row for each of its alternatives: of the literal that the alternative
    must contain, the stretch that occurs in the fewest patterns, of the greatest length
    in `STRETCHES` that fits. One without such a literal has a single row of NULL `gram`.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [literals.required(p) for p in batch.column("regex").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_code"), batch.column("regex"), pa.array(found, pa.list_(pa.string()))],
                names=["_code", "regex", "literals"],
            )

    stated = patterns.where("regex IS NOT NULL").select(F.col("_code").cast("string"), "regex")
    # short rows, each of which takes long to read: Spark would deal them to too few tasks
    partitions = int(patterns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stated.repartition(partitions, "_code", "regex").distinct()
    read_ = scratch.materialise(
        dealt.mapInArrow(read, "_code STRING, regex STRING, literals ARRAY<STRING>"), "literals"
    )
    size = F.lit(None).cast("int")
    for n in STRETCHES:
        size = F.when(F.length("literal") >= n, n).otherwise(size)
    grams = read_.select(
        "_code", "regex", F.explode_outer("literals").alias("literal")
    ).withColumn("gram", F.explode_outer(_grams(F.col("literal"), size)))
    sharing = grams.where("gram IS NOT NULL").groupBy("gram").agg(F.count("*").alias("_n"))
    counted = joins.attach(grams, sharing, ["gram"], derived=True)
    return counted.groupBy("_code", "regex", "literal").agg(
        F.min_by("gram", F.struct("_n", "gram")).alias("gram")
    ).select("_code", "regex", "gram")


def candidates(names: DataFrame, known: DataFrame) -> DataFrame:
    """`_name`, `_code`, `regex`: the names that hold the letters a pattern is known by.

    Stretches and names meet as 64-bit hashes; what only a hash brings together is in the
    result too, and does not match.
    """
    sizes = sorted(r[0] for r in known.select(F.length("gram")).distinct().collect())
    lower, none = _lower(F.col("_name")), F.array().cast("array<string>")
    grams = F.flatten(F.array(*[F.coalesce(_grams(lower, F.lit(n)), none) for n in sizes or STRETCHES[:1]]))
    keys = F.array_distinct(F.transform(grams, lambda gram: F.xxhash64(gram)))
    letters = names.select(F.xxhash64("_name").alias("_id"), F.explode(keys).alias("_key"))
    patterns = known.select(F.xxhash64("gram").alias("_key"), "_code", "regex")
    met = letters.join(joins.sent_if_small(patterns, ["_key"]), "_key")
    pairs = met.select("_id", "_code", "regex").distinct()
    return (
        pairs.join(names.withColumn("_id", F.xxhash64("_name")).hint("merge"), "_id")
        .select("_name", "_code", "regex")
    )


def _lower(c: Column) -> Column:
    """ASCII letters in lower case, as patterns that ignore case see them."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _grams(c: Column, size: Column) -> Column:
    """The distinct stretches of `size` letters of a text."""
    starts = F.sequence(F.lit(1), F.length(c) - size + 1)
    grams = F.transform(starts, lambda at: F.substr(c, at, size))
    return F.when(F.length(c) >= size, F.array_distinct(grams))


def add_code(
    df: DataFrame,
    column: str,
    countries: DataFrame,
    *,
    to: str = fields.ISO3_CODE,
    into: str | None = None,
) -> DataFrame:
    """Add the resolved code of the name in `column`; rows are never dropped."""
    resolved = resolve_names(df, column, countries, to)
    return joins.attach(df, resolved, [column], derived=True).withColumnRenamed(to, into or to)


def add_short_name(
    df: DataFrame, countries: DataFrame, into: str = fields.COUNTRY_NAME
) -> DataFrame:
    """Add the short name of the country in `iso3_code`."""
    names = countries.select(fields.ISO3_CODE, F.col(NAME_SHORT).alias(into))
    return joins.attach(df, names, [fields.ISO3_CODE])


def requested_codes(names: str | Sequence[str], countries: DataFrame) -> list[str]:
    """The distinct ISO3 codes of a caller's list of names; unknown ones are logged."""
    wanted = [names] if isinstance(names, str) else list(names)
    table = combine.of_values(countries.sparkSession, wanted, "name")
    resolved = resolve_names(table, "name", countries).collect()
    for row in resolved:
        if row.iso3_code is None:
            logger.warning("Country not found: %s", row.name)
    codes = sorted({r.iso3_code for r in resolved if r.iso3_code is not None})
    if not codes:
        raise ValueError("No valid countries found")
    return codes


def _exact_keys(countries: DataFrame, to: str) -> DataFrame:
    """Lower-cased codes and short names; a code goes before an equal name."""
    tables = [
        countries.select(F.lower(F.col(key)).alias("_key"), F.col(to), F.lit(i).alias("_order"))
        for i, key in enumerate(_EXACT_KEYS)
    ]
    stacked = combine.stack(tables).where("_key IS NOT NULL")
    return stacked.groupBy("_key").agg(F.min_by(to, F.struct("_order", to)).alias(to))


def _codes_by_pattern(name: Column, patterns: list[tuple[str, str]]) -> Column:
    hits = [F.when(name.rlike(f"(?i){regex}"), F.lit(code)) for code, regex in patterns]
    parts = [
        F.array_compact(F.array(*hits[i : i + PATTERNS_AT_ONCE]).cast("array<string>"))
        for i in range(0, len(hits), PATTERNS_AT_ONCE)
    ]
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(none, *parts))
