"""Small analysis helpers on tidy tables.

Groups may be of any size, so none of these uses a window over a whole large group:
group results are aggregated (combined before the shuffle) and joined back.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from devdata_spark import fields
from devdata_spark.operators import combine, joins, latest
from devdata_spark.scratch import materialise

# Distinct values of a group that one task ranks; beyond it the middle is narrowed first.
_RANKED_AT_ONCE = 100_000
# A sketch of this size errs by about 0.3 % of a group's rows; bounds keep three times that.
_SKETCH_K, _MARGIN = 1_000, 0.01
# Each pass leaves about a fiftieth of a group.
_MEDIAN_PASSES = 12


def filter_latest_by(df: DataFrame, by: Sequence[str], date: str) -> DataFrame:
    """The latest row of each group."""
    return latest.newest_per_key(df, by, [date])


def period_average(
    df: DataFrame,
    start,
    end,
    *,
    by: Sequence[str],
    value: str = fields.VALUE,
    period: str = fields.YEAR,
) -> DataFrame:
    """The mean of each group over an inclusive period."""
    inside = df.where(F.col(period).between(start, end))
    return inside.groupBy(*by).agg(F.avg(value).alias(value))


def change_from_date(
    df: DataFrame,
    start,
    end,
    *,
    by: Sequence[str],
    value: str = fields.VALUE,
    date: str = fields.YEAR,
    percentage: bool = False,
) -> DataFrame:
    """The change of each group's value between two dates, in one pass.

    NULL where a group has no value at one of the dates.
    """
    at = F.col(date)
    ends = df.where(at.isin(start, end)).groupBy(*by).agg(
        F.max(F.when(at == F.lit(start), F.col(value))).alias("_start"),
        F.max(F.when(at == F.lit(end), F.col(value))).alias("_end"),
    )
    change = F.col("_end") - F.col("_start")
    if percentage:
        change = F.when(F.col("_start") != 0, change / F.col("_start") * 100)
    return ends.select(*by, change.alias("change"))


def append_new(old: DataFrame, new: DataFrame, *, keys: Sequence[str], date: str) -> DataFrame:
    """Append new rows and keep the newest row of each key; on a tie the new one."""
    both = combine.stack(
        [old.withColumn("_new", F.lit(0)), new.withColumn("_new", F.lit(1))]
    )
    return latest.newest_per_key(both, keys, [date, "_new"]).drop("_new")


def share_of_group(
    df: DataFrame,
    by: Sequence[str],
    *,
    value: str = fields.VALUE,
    into: str = "share",
    exact: str | None = None,
) -> DataFrame:
    """Each value as a share of its group's total.

    With `exact`, such as `decimal(18,2)` for money, the total is added up in that
    type and does not depend on the order in which partitions arrive.
    """
    summed = F.col(value).cast(exact) if exact else F.col(value)
    totals = df.groupBy(*by).agg(F.sum(summed).cast("double").alias("_total"))
    return (
        joins.attach(df, totals, by, derived=True)
        .withColumn(into, _ratio(F.col(value), F.col("_total")))
        .drop("_total")
    )


def share_of_column(df: DataFrame, value: str, of: str, into: str = "share") -> DataFrame:
    """One column as a share of another, such as a value as a share of GDP."""
    return df.withColumn(into, _ratio(F.col(value), F.col(of)))


def add_dimension(
    df: DataFrame, table: DataFrame, on: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Add columns of a lookup table, such as population or income level."""
    return joins.attach(df, table.select(*on, *columns), on)


def group_median(
    df: DataFrame, by: Sequence[str], *, value: str = fields.VALUE, into: str = "median"
) -> DataFrame:
    """The exact median of each group, for groups of any size.

    Groups of many rows are narrowed first: a sketch of the group's distribution bounds
    its middle, rows below and between the bounds are counted exactly, and bounds that
    hold the middle are narrowed again until few distinct values lie between them. Only
    those are ranked. Bounds that miss the middle are moved, so the result is exact
    whatever the sketch says. Nothing of the size of the table is kept.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).alias("_v")).where("_v IS NOT NULL")
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    large = materialise(sizes.where(F.col("_n") > _RANKED_AT_ONCE), "median")
    if large.isEmpty():
        nothing = F.lit(None).cast("double")
        near = rows.withColumns(
            {"_low": F.lit(None).cast("bigint"), "_high": F.lit(None).cast("bigint"),
             "_below": F.lit(0).cast("bigint"), "_from": nothing, "_to": nothing}
        )
    else:
        near = joins.attach(rows, _middles(rows, large, by), by, validate=False)
    between = _between(F.col("_v").cast("double"), "_from", "_to")
    state = ["_low", "_high", "_below"]
    counted = near.where(between).groupBy(*by, *state, "_v").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*by))
    last = F.coalesce("_below", F.lit(0)) + F.sum("_n").over(_running(by, "_v"))
    ranked = counted.select(
        *by, "_v", (last - F.col("_n")).alias("_start"), last.alias("_last"),
        F.coalesce("_low", F.floor((total + 1) / 2)).alias("_low"),
        F.coalesce("_high", F.floor(total / 2) + 1).alias("_high"),
    )
    ends = [
        F.max(F.when((F.col("_start") < F.col(end)) & (F.col(end) <= F.col("_last")), F.col("_v")))
        for end in ("_low", "_high")
    ]
    return ranked.groupBy(*by).agg(((ends[0] + ends[1]) / 2).alias(into))


def _middles(rows: DataFrame, large: DataFrame, by: list[str]) -> DataFrame:
    """For large groups: the ranks of the middle, bounds `_from` and `_to` that hold it,
    and how many rows are `_below`. Bounds are NULL where there are none.

    Each pass is one aggregation over the rows of groups that are still too wide.
    """
    no_bound = F.lit(None).cast("double")
    state = large.select(
        *by, F.floor((F.col("_n") + 1) / 2).alias("_low"),
        (F.floor(F.col("_n") / 2) + 1).alias("_high"), F.lit(0).cast("bigint").alias("_below"),
        no_bound.alias("_from"), no_bound.alias("_to"),
        # bounds to be tried next
        no_bound.alias("_lo"), no_bound.alias("_hi"), F.lit(False).alias("_done"),
    )
    known = state.columns[len(by):]
    x = F.col("_v").cast("double")
    inside = _between(x, "_lo", "_hi")
    for _ in range(_MEDIAN_PASSES):
        met = joins.attach(rows, state.where("NOT _done"), by, validate=False)
        tried = met.where("_low IS NOT NULL").groupBy(*by, *known).agg(
            F.count_if(x < F.col("_lo")).alias("_n_below"),
            F.count_if(inside).alias("_n_in"),
            F.count_if(x == F.col("_lo")).alias("_n_lo"),
            F.count_if(x == F.col("_hi")).alias("_n_hi"),
            F.approx_count_distinct(F.when(inside, F.col("_v"))).alias("_n_values"),
            # common values at the bounds are left out, so the bounds always move
            F.kll_sketch_agg_double(
                F.when(inside & _apart(x, "_lo") & _apart(x, "_hi"), x), F.lit(_SKETCH_K)
            ).alias("_sketch"),
        )
        moved = tried.select(*by, *_narrowed())
        state = materialise(combine.stack([state.where("_done"), moved]), "median")
        if state.where("NOT _done").isEmpty():
            break
    return state.drop("_lo", "_hi", "_done")


def _narrowed() -> list[Column]:
    """The state of a group after its bounds were tried."""
    low, high, below, n_in, n_lo, n_hi = (
        F.col(c) for c in ("_low", "_high", "_n_below", "_n_in", "_n_lo", "_n_hi")
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    under, over = low <= below, high > below + n_in
    holds = ~under & ~over
    few = (F.col("_n_values") <= _RANKED_AT_ONCE) | F.coalesce(lo == hi, F.lit(False))
    done = holds & few

    # the sketch is asked for ranks that do not depend on the row
    steps = round(1 / _MARGIN)
    ranks = F.array(*[F.lit(i / steps) for i in range(steps + 1)])
    quantiles = F.kll_sketch_get_quantile_double("_sketch", ranks)

    def bound(rank: Column, margin: int) -> Column:
        at = (rank - below - n_lo) / (n_in - n_lo - n_hi) * steps
        step = (F.floor(at) if margin < 0 else F.ceil(at)).cast("int") + margin
        between = F.get(quantiles, F.greatest(F.lit(0), F.least(F.lit(steps), step)))
        at_lo, at_hi = rank <= below + n_lo, rank > below + n_in - n_hi
        return F.when(at_lo, lo).when(at_hi, hi).otherwise(between)

    return [
        low, high,
        F.when(holds, below).otherwise(F.col("_below")).alias("_below"),
        F.when(holds, lo).otherwise(F.col("_from")).alias("_from"),
        F.when(holds, hi).otherwise(F.col("_to")).alias("_to"),
        # bounds that missed: the middle is on the side that the counts tell
        F.when(done, None).when(holds, bound(low, -1))
        .when(under, F.col("_from")).otherwise(hi).alias("_lo"),
        F.when(done, None).when(holds, bound(high, 1))
        .when(over, F.col("_to")).otherwise(lo).alias("_hi"),
        done.alias("_done"),
    ]


def _apart(x: Column, bound: str) -> Column:
    return F.col(bound).isNull() | (x != F.col(bound))


def _between(x: Column, first: str, last: str) -> Column:
    return (F.col(first).isNull() | (x >= F.col(first))) & (F.col(last).isNull() | (x <= F.col(last)))


def add_median(
    df: DataFrame, by: Sequence[str], *, value: str = fields.VALUE, into: str = "median"
) -> DataFrame:
    """Add the median of its group to every row."""
    return joins.attach(df, group_median(df, by, value=value, into=into), by, derived=True)


def append_median(
    df: DataFrame, by: Sequence[str], *, value: str = fields.VALUE, labels: dict | None = None
) -> DataFrame:
    """Append one row per group that holds its median; `labels` fills other columns."""
    medians = group_median(df, by, value=value, into=value)
    labelled = medians.withColumns({c: F.lit(v) for c, v in (labels or {}).items()})
    return combine.stack([df, labelled])


def _running(by: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole)
