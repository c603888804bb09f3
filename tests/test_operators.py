import re

import pytest
from pyspark.sql import functions as F

from devdata_spark import quality
from devdata_spark.errors import (
    DataExtractionError,
    DataFormattingError,
    DataValidationError,
)
from devdata_spark.functions import literals
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

# --- coverage ----------------------------------------------------------------


def test_coverage_of_series(spark, rows):
    years = {"a": [1960, 1961, 2030], "b": [2024], None: [1960, 1960], "c": [1900, None, 2101]}
    df = spark.createDataFrame(
        [(s, y, None if y == 2030 else 1.0) for s, found in years.items() for y in found],
        "s STRING, year INT, value DOUBLE",
    )
    covered = coverage.bitmaps(df, ["s"], "year", 1960, 2100)
    assert rows(coverage.report(covered, ["s"], 1960, 2100)) == [
        ("a", 3, 1960, 2030, 68), ("b", 1, 2024, 2024, 0), ("c", 0, None, None, 0), (None, 1, 1960, 1960, 0),
    ]
    asked = spark.createDataFrame([("a",), ("new",), (None,), ("a",)], "s STRING")
    found = coverage.gaps(covered, ["s"], "year", 1960, 2100, series=asked)
    expected = [
        (s, y) for s in ["a", "new", None] for y in range(1960, 2101) if y not in years.get(s, [])
    ]
    assert sorted(map(str, rows(found))) == sorted(map(str, expected))
    valued = coverage.bitmaps(df, ["s"], "year", 1960, 2100, value="value")
    assert rows(coverage.report(valued, ["s"], 1960, 2100))[0] == ("a", 2, 1960, 1961, 0)
    assert coverage.gaps(covered.limit(0), ["s"], "year", 1960, 2100).count() == 0


def test_coverage_is_merged_and_equals_the_missing_rows(spark, rows):
    df = spark.range(400).selectExpr("id % 7 AS s", "CAST(1950 + id * id % 90 AS INT) AS year")
    span = (1950, 2039)
    whole = coverage.bitmaps(df, ["s"], "year", *span)
    parts = [coverage.bitmaps(df.where(f"year % 3 = {i}"), ["s"], "year", *span) for i in range(3)]
    merged = coverage.merge(combine.stack(parts), ["s"], *span)
    assert rows(merged.select("s", F.col("covered").cast("string"))) == rows(
        whole.select("s", F.col("covered").cast("string"))
    )
    asked = df.select("s").distinct().selectExpr("s", "explode(sequence(1950, 2039)) AS year")
    missing = quality.missing_series(asked, df, ["s", "year"])
    assert rows(coverage.gaps(whole, ["s"], "year", *span)) == rows(missing)


def test_coverage_moves_no_row_of_the_table(spark):
    df = spark.range(1000).selectExpr("id % 3 AS s", "CAST(2000 + id % 20 AS INT) AS year")
    plan = coverage.bitmaps(df, ["s"], "year", 2000, 2030)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1


# --- projections -------------------------------------------------------------


def test_rename_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert columns.rename(df, {"a": "x", "zzz": "y"}).columns == ["x", "b"]


def test_rename_first_merges_names_of_one_meaning(spark, rows):
    df = spark.createDataFrame([(1, None, "u"), (2, "b", "v")], "n INT, time_value STRING, time STRING")
    named = columns.rename_first(df, {"year": ["time_value", "time"]})
    assert named.columns == ["n", "year"]
    assert rows(named) == [(1, "u"), (2, "b")]


def test_projection_reports_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert columns.require(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(DataFormattingError, match=r"\['c'\]"):
        columns.require(df, ["a", "c"])
    with pytest.raises(DataFormattingError, match="at least 3 columns"):
        columns.by_position(df, {2: "x"})


def test_flatten_joins_paths_at_any_depth(spark):
    df = spark.createDataFrame(
        [(("i", ("x", 1)), [1])], "a STRUCT<id: STRING, deep: STRUCT<k: STRING, n: INT>>, l ARRAY<INT>"
    )
    flat = columns.flatten(df)
    assert flat.columns == ["a_id", "a_deep_k", "a_deep_n", "l"]
    assert tuple(flat.first()) == ("i", "x", 1, [1])


def test_records_of_undeclared_shape(spark, rows):
    texts = [
        '{"a": 1, "b": {"c": "x", "d e": null}}', '{"a": 2.5, "b": {"c": 3}, "n": [1, {"q": true}]}',
        '{"a": null, "o": {}, "t`q": 1, "p.x": 4, "OBJECT<": "VOID"}', None, " \t", ' {"a": 7}',
    ]
    df = records.parse(spark.createDataFrame(list(enumerate(texts)), "id INT, reply STRING"), "reply")
    wide = records.widen(df)
    assert dict(wide.dtypes) == {
        "id": "int", "OBJECT<": "string", "a": "decimal(21,1)", "b_c": "string", "b_d e": "string",
        "n": "array<string>", "o": "string", "p.x": "bigint", "t`q": "bigint",
    }
    found = wide.select("id", F.col("a").cast("double"), "b_c", "n", "o", "`p.x`", "`t``q`", "`OBJECT<`")
    assert rows(found) == [
        (0, 1.0, "x", None, None, None, None, None),
        (1, 2.5, "3", ["1", '{"q":true}'], None, None, None, None),
        (2, None, None, None, "{}", 4, 1, "VOID"),
        (5, 7.0, None, None, None, None, None, None),
    ]
    report = {r.field: (r.n_records, r.n_values) for r in records.field_report(df).collect()}
    assert report["a"] == (4, 3) and report["b"] == (2, 2) and report["o"] == (1, 1)
    assert records.widen(df.limit(0)).columns == ["id"]


@pytest.mark.parametrize(
    ("reply", "problem"),
    [
        ("{bad", "not JSON objects"), ("[1]", "not JSON objects"), ("5", "not JSON objects"),
        ('{"id": 1}', "columns of the table"), ('{"a": 1, "A": 2}', "columns twice"),
        ('{"a_b": 1, "a": {"b": 2}}', "columns twice"),
    ],
)
def test_records_that_make_no_table(spark, reply, problem):
    df = records.parse(spark.createDataFrame([(1, reply)], "id INT, reply STRING"), "reply")
    with pytest.raises(DataFormattingError, match=problem):
        records.widen(df)


def test_too_many_fields_of_records(spark, monkeypatch):
    monkeypatch.setattr(records, "MAX_FIELDS", 2)
    df = records.parse(spark.createDataFrame([('{"a": 1, "b": 2, "c": 3}',)], "reply STRING"), "reply")
    with pytest.raises(DataFormattingError, match="3 fields"):
        records.widen(df)
    assert records.field_report(df).count() == 3


def test_marker_is_a_whole_cell(spark, rows):
    df = spark.createDataFrame([("-", "b-", 1), ("a", "-", 2)], "x STRING, y STRING, n INT")
    assert rows(columns.marker_to_null(df, "-")) == [("a", None, 2), (None, "b-", 1)]


# --- filters -----------------------------------------------------------------


def test_first_row_of_each_file_is_dropped(spark, rows):
    df = spark.createDataFrame(
        [("a", 3, "z"), ("a", 1, "x"), ("b", 7, "t"), ("b", 9, "u"), ("c", 5, "only")],
        "f STRING, n INT, v STRING",
    )
    kept = filters.drop_first_row(df, "n", "f")
    assert kept.columns == ["f", "n", "v"]
    assert rows(kept) == [("a", 3, "z"), ("b", 9, "u")]


def test_value_and_year_filters(spark):
    df = spark.createDataFrame([(y, c) for y in range(2000, 2010) for c in "ab"], "year INT, c STRING")
    assert filters.select_values(df, "c", None).count() == 20
    assert filters.select_values(df, "c", "a").count() == 10
    assert filters.select_years(df, 2003, 2005).count() == 6
    assert filters.select_years(df, None, 2001).count() == 4
    assert filters.as_list(["b", "a", "a"]) == ["a", "b"]
    with pytest.raises(ValueError, match="Invalid level: x"):
        filters.check_choice("x", ["national"], "level")


def test_aggregates_are_skipped(spark, rows):
    df = spark.createDataFrame([("KEN", 1), ("WLD", 2), ("NEW", 3)], "entity_code STRING, value INT")
    about = spark.createDataFrame([("KEN", False), ("WLD", True)], "entity_code STRING, is_aggregate BOOLEAN")
    assert rows(filters.skip_aggregates(df, about)) == [("KEN", 1), ("NEW", 3)]
    assert rows(filters.skip_aggregates(about)) == [("KEN", False)]
    with pytest.raises(ValueError):
        filters.skip_aggregates(df)


# --- joins -------------------------------------------------------------------


def test_attach_is_many_to_one(spark):
    df = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    lookup = spark.createDataFrame([(1, "x"), (1, "y")], "k INT, label STRING")
    with pytest.raises(DataValidationError, match="repeats 1 key"):
        joins.attach(df, lookup, ["k"])
    assert joins.attach(df, lookup, ["k"], validate=False).count() == 2


def test_attach_matches_null_keys_and_keeps_column_order(spark, rows):
    df = spark.createDataFrame([("v", 1), ("w", None), ("x", 3)], "v STRING, k INT")
    with_null = spark.createDataFrame([("one", 1), ("none", None)], "label STRING, k INT")
    joined = joins.attach(df, with_null, ["k"])
    assert joined.columns == ["v", "k", "label"]
    assert rows(joined) == [("v", 1, "one"), ("w", None, "none"), ("x", 3, None)]
    without = spark.createDataFrame([("one", 1)], "label STRING, k INT")
    assert rows(joins.attach(df, without, ["k"])) == [("v", 1, "one"), ("w", None, None), ("x", 3, None)]


def test_profile_counts_what_the_join_needs(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "d"), (None, None)], "k INT, s STRING")
    found = joins.profile(df, ["k"])
    assert (found.rows, found.duplicate_keys, found.null_keys) == (3, 1, 1)
    assert found.bytes == 3 * (16 + 16) + 4
    empty = joins.profile(df.where("k > 5"), ["k"])
    assert (empty.rows, empty.bytes, empty.duplicate_keys, empty.null_keys) == (0, 0, 0, 0)


def skewed(spark, null_share=0):
    """Two thirds of the rows have key 7, all of them identical; with NULL keys too."""
    hot = spark.range(6000).select(F.lit(7).alias("k"), F.lit("copy").alias("v"))
    cold = spark.range(3000).select((F.col("id") % 100).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    nulls = spark.range(null_share).select(F.lit(None).cast("int").alias("k"), F.lit("null").alias("v"))
    return hot.union(cold).union(nulls)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_key", [False, True])
def test_lookup_too_large_to_broadcast(spark, rows, monkeypatch, how, null_key):
    df = skewed(spark, 4000)
    labels = [(k, f"label {k}") for k in range(0, 90)] + ([(None, "null label")] if null_key else [])
    lookup = spark.createDataFrame(labels, "k INT, label STRING")
    expected = rows(joins.attach(df, lookup, ["k"], how=how))
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    joined = joins.attach(df, lookup, ["k"], how=how)
    assert rows(joined) == expected
    assert joined.columns == (["k", "v", "label"] if how == "left" else ["k", "v"])


def test_rows_of_overfull_keys_are_not_shuffled(spark, monkeypatch):
    df = skewed(spark)
    full = joins.overfull_keys(df, ["k"])
    assert [r.k for r in full.collect()] == [7]
    assert joins.overfull_keys(df.where("k <> 7"), ["k"]) is None
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lookup = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("label"))
        plan = joins.attach(df, lookup, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    in_place, moved = plan.split("SortMergeJoin", 1)
    assert "LeftOuter" in in_place and "BroadcastHashJoin" in in_place
    assert "Exchange hashpartitioning" not in in_place.split("BroadcastExchange")[0]


def test_repeated_lookup_keys_of_an_overfull_key(spark, rows, monkeypatch):
    df = skewed(spark).limit(3000)
    labels = [(7, "a"), (7, "b")] + [(k, "c") for k in range(20)]
    lookup = spark.createDataFrame(labels, "k INT, label STRING")
    expected = df.join(lookup, "k", "left").groupBy("label").count()
    for limit in (10, 1):
        monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", limit)
        joined = joins.attach(df, lookup, ["k"], validate=False)
        assert rows(joined.groupBy("label").count()) == rows(expected)


def test_last_row_names_a_code(spark, rows):
    df = spark.createDataFrame([("HDI",), ("GII",)], "c STRING")
    names = spark.createDataFrame([("HDI", "old", 1), ("HDI", "new", 2)], "c STRING, name STRING, n INT")
    assert rows(joins.map_codes(df, names, "c", "name", "n")) == [("GII", None), ("HDI", "new")]


# --- reshape -----------------------------------------------------------------


def test_wide_to_long_keeps_nulls_and_widens(spark, rows):
    df = spark.createDataFrame([("a", 1, 1.5, "2"), ("b", None, None, " .. ")], "id STRING, i INT, d DOUBLE, `s.t` STRING")
    long = reshape.to_long(df, ["id"])
    assert dict(long.dtypes) == {"id": "string", "indicator_code": "string", "value": "double"}
    assert rows(long) == [
        ("a", "d", 1.5), ("a", "i", 1.0), ("a", "s.t", 2.0),
        ("b", "d", None), ("b", "i", None), ("b", "s.t", None),
    ]


def test_code_and_year_are_split_at_the_last_underscore(spark, rows):
    df = spark.createDataFrame([("A_B_2000",), ("rank",), ("A_x",)], "indicator_code STRING")
    assert rows(reshape.split_code_year(df)) == [("A", None), ("A_B", 2000), ("rank", None)]


def test_map_and_array_rows(spark, rows):
    df = spark.sql("SELECT map('VEN', named_struct('code', 1), 'LBN', named_struct('code', 2)) AS m")
    assert rows(reshape.map_to_rows(df, "m", "iso3")) == [("LBN", 2), ("VEN", 1)]
    nested = spark.sql("SELECT 'K' AS k, array(named_struct('x', 1), named_struct('x', 2)) AS a")
    assert rows(reshape.array_to_rows(nested, "a", ["k"])) == [("K", 1), ("K", 2)]


def test_stack_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n INT, a STRING")
    b = spark.createDataFrame([("y", 2)], "b STRING, n INT")
    assert rows(combine.stack([a, b])) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        combine.stack([])


# --- latest ------------------------------------------------------------------


@pytest.fixture
def series(spark):
    return spark.createDataFrame(
        [
            ("KEN", "P", 2019, 1.0), ("KEN", "P", 2020, 2.0), ("KEN", "P", 2021, None),
            ("UGA", "P", 2018, 3.0), ("UGA", "P", 2021, 4.0), ("UGA", "Q", 2010, 5.0),
        ],
        "entity_code STRING, indicator_code STRING, year INT, value DOUBLE",
    )


def test_most_recent_periods_are_the_same_for_all(series, rows):
    assert rows(latest.most_recent_periods(series, 1), "entity_code", "year") == [("KEN", 2021), ("UGA", 2021)]
    by_series = latest.most_recent_periods(series, 2, series=["indicator_code"])
    assert rows(by_series, "entity_code", "indicator_code", "year") == [
        ("KEN", "P", 2020), ("KEN", "P", 2021), ("UGA", "P", 2021), ("UGA", "Q", 2010),
    ]
    with pytest.raises(ValueError):
        latest.most_recent_periods(series, 0)


def test_most_recent_values_skip_blanks(series, rows):
    found = latest.most_recent_values(series, 2)
    assert rows(found, "entity_code", "indicator_code", "year") == [
        ("KEN", "P", 2019), ("KEN", "P", 2020), ("UGA", "P", 2018), ("UGA", "P", 2021), ("UGA", "Q", 2010),
    ]


def test_top_rows_are_cut_before_the_shuffle(series):
    plan = latest.most_recent_values(series, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Final" in plan.split("Exchange")[0] and "Partial" in plan.split("Exchange")[1]


def test_top_rows_beyond_the_partial_limit(spark, rows):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("v"))
    expected = rows(latest.top_rows(df, 50, by=["g"], order=[F.desc("v")]))
    copies = rows(latest.top_rows(df, 1500, by=["g"], order=[F.asc("v")]))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", 10)
    try:
        assert rows(latest.top_rows(df, 50, by=["g"], order=[F.desc("v")])) == expected
        assert rows(latest.top_rows(df, 1500, by=["g"], order=[F.asc("v")])) == copies
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_newest_row_per_key_settles_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k STRING, t INT, v STRING")
    assert rows(latest.newest_per_key(df, ["k"], ["t"])) == [("a", 2, "z"), ("b", 1, None)]


def test_no_release_is_an_error(spark):
    empty = spark.createDataFrame([], "y INT")
    with pytest.raises(DataExtractionError):
        latest.latest_release(empty, [F.col("y")])


# --- names of countries ------------------------------------------------------


def test_names_of_any_form_are_resolved(spark, countries, rows):
    names = ["ken", " KE ", "Kenya", "Republic of Kenya", "USA", "United States of America", "Atlantis",
             "Kenya and Uganda", None]
    df = spark.createDataFrame(list(enumerate(names)), "n INT, name STRING")
    found = resolve.add_code(df, "name", countries)
    assert found.columns == ["n", "name", "iso3_code"]
    codes = [r.iso3_code for r in found.orderBy("n").collect()]
    assert codes == ["KEN", "KEN", "KEN", "KEN", "USA", "USA", None, None, None]


def test_requested_names_become_unique_codes(countries, caplog):
    assert resolve.requested_codes(["Kenya", "KEN", "UG", "Atlantis"], countries) == ["KEN", "UGA"]
    assert "Country not found: Atlantis" in caplog.text
    with pytest.raises(ValueError, match="No valid countries found"):
        resolve.requested_codes("Atlantis", countries)


def test_many_patterns_are_tried_in_parts(spark, countries, monkeypatch):
    monkeypatch.setattr(resolve, "PATTERNS_AT_ONCE", 2)
    assert resolve.requested_codes(["Republic of Kenya", "Great Britain"], countries) == ["GBR", "KEN"]


# --- types -------------------------------------------------------------------


def test_types_are_found_in_the_data(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "true", "a", 1.0, 1.5, None), ("2", "3", "False", "1", 2.0, None, None), (None, None, None, None, None, None, None)],
        "i STRING, d STRING, b STRING, s STRING, whole DOUBLE, part DOUBLE, none STRING",
    )
    typed = types.convert_types(df)
    assert dict(typed.dtypes) == {
        "i": "bigint", "d": "double", "b": "boolean", "s": "string",
        "whole": "bigint", "part": "double", "none": "string",
    }
    assert dict(types.convert_types(df, {"i": "string"}).dtypes)["i"] == "string"


def test_casts_name_unknown_columns(spark):
    df = spark.createDataFrame([("x",)], "a STRING")
    with pytest.raises(KeyError, match="zzz"):
        types.cast(df, {"zzz": "int"})
    assert types.safe_cast(df, {"a": "int"}).first().a is None


# --- quality -----------------------------------------------------------------

VALID = "col1 BIGINT, col2 DOUBLE, col3 STRING"


def test_valid_table_is_returned(spark):
    df = spark.createDataFrame([(1, 1.0, "a")], VALID)
    assert quality.validate(df, ["col1", "col3"], schema=VALID, not_null=["col1"]) is df


def test_checks_run_in_order(spark):
    empty = spark.createDataFrame([], "col1 BIGINT")
    with pytest.raises(DataValidationError, match="DataFrame is empty"):
        quality.validate(empty, ["col3"])
    with pytest.raises(DataValidationError, match="DataFrame is empty"):
        quality.validate(empty, ["col3"], not_null=["col1"])
    df = spark.createDataFrame([(1, None)], "col1 INT, col2 DOUBLE")
    with pytest.raises(DataValidationError, match=r"Missing columns: \['col3'\]"):
        quality.validate(df, ["col1", "col3"], schema=VALID)
    with pytest.raises(DataValidationError, match="Column 'col1' is int, expected bigint"):
        quality.validate(df, ["col1"], schema=VALID)
    with pytest.raises(DataFormattingError, match="'col2': 1"):
        quality.validate(df, ["col1"], not_null=["col2"])


def test_key_and_code_reports(spark, rows):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "code STRING")
    assert rows(quality.key_violations(df, ["code"])) == [("A", 2)]
    with pytest.raises(DataValidationError, match="not unique"):
        quality.require_unique(df, ["code"])
    assert rows(quality.missing_codes(df, "code", ["C", "A", "C"])) == [("C",)]
    quality.require_codes(df, "code", ["B", "A", "A"])
    with pytest.raises(DataExtractionError, match="not found for indicator code.*'C'"):
        quality.require_codes(df, "code", ["A", "C"])
    with pytest.raises(DataExtractionError, match="No metadata found"):
        quality.require_codes(df, "code", ["C"])


def test_missing_series_and_report(spark, rows):
    requested = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "e STRING, y INT")
    present = spark.createDataFrame([("A", 1, "x"), ("A", 1, "y")], "e STRING, y INT, v STRING")
    assert rows(quality.missing_series(requested, present, ["e", "y"])) == [("A", 2), ("B", 1)]
    report = quality.column_report(spark.createDataFrame([(1, None), (2, 3)], "a INT, b INT"), ["a", "b"])
    assert rows(report) == [(2, 2, 1)]


# --- analysis ----------------------------------------------------------------


def test_latest_average_change_and_append(series, spark, rows):
    assert rows(analysis.filter_latest_by(series, ["entity_code"], "year"), "entity_code", "year") == [
        ("KEN", 2021), ("UGA", 2021),
    ]
    mean = analysis.period_average(series, 2018, 2021, by=["entity_code"])
    assert rows(mean) == [("KEN", 1.5), ("UGA", 3.5)]
    change = analysis.change_from_date(series, 2019, 2020, by=["entity_code"])
    assert rows(change) == [("KEN", 1.0)]
    percent = analysis.change_from_date(series, 2018, 2021, by=["entity_code"], percentage=True)
    assert [(k, v and round(v, 2)) for k, v in rows(percent)] == [("KEN", None), ("UGA", 33.33)]
    old = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "k STRING, d INT, v STRING")
    new = spark.createDataFrame([("a", 1, "new"), ("c", 1, "new"), ("b", 0, "new")], "k STRING, d INT, v STRING")
    assert rows(analysis.append_new(old, new, keys=["k"], date="d")) == [
        ("a", 1, "new"), ("b", 1, "old"), ("c", 1, "new"),
    ]


def test_shares(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 4.0), ("a", 3.0, 0.0), ("b", None, 1.0)], "g STRING, value DOUBLE, gdp DOUBLE")
    assert rows(analysis.share_of_group(df, ["g"]), "g", "share") == [("a", 0.25), ("a", 0.75), ("b", None)]
    assert rows(analysis.share_of_column(df, "value", "gdp"), "share") == [(0.25,), (None,), (None,)]


def test_median_is_exact_for_groups_of_any_size(spark, rows):
    numbers = spark.range(4001)
    df = (
        numbers.select(F.lit("even").alias("g"), (F.col("id") * 37 % 4000).cast("double").alias("value")).where("value < 4000 AND id < 4000")
        .union(numbers.select(F.lit("odd"), F.pow(F.col("id").cast("double"), 3)))
        .union(numbers.select(F.lit("copies"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double"))))
        .union(numbers.select(F.lit(None).cast("string"), (F.col("id") % 7).cast("double")))
        .union(spark.createDataFrame([("one", 2.5), ("one", None), ("none", None)], "g STRING, value DOUBLE"))
    )
    expected = df.where("value IS NOT NULL").groupBy("g").agg(F.percentile("value", 0.5).alias("median"))
    assert rows(analysis.group_median(df, ["g"])) == rows(expected)


@pytest.mark.parametrize("type_", ["double", "bigint", "decimal(20,2)"])
def test_median_of_wide_groups_is_found_between_sketched_bounds(spark, rows, monkeypatch, type_):
    monkeypatch.setattr(analysis, "_RANKED_AT_ONCE", 40)
    monkeypatch.setattr(analysis, "_MARGIN", 0.002)  # so narrow that bounds can miss
    n = F.col("id")
    wide = spark.range(6000).select(
        F.when(n % 5 < 2, "two").when(n % 5 == 2, "far").when(n % 5 == 3, "step").alias("g"),
        F.when(n % 5 == 2, F.pow(F.lit(1.004), n) * F.when(n % 2 == 0, -1).otherwise(1))
        .when(n % 5 == 3, F.when(n < 3000, 1.0).otherwise(2.0))
        .otherwise(n * 7919 % 6007 - 3000).cast(type_).alias("value"),
    )
    small = spark.createDataFrame([("s", 1), ("s", 2), ("n", None)], "g STRING, value INT")
    df = wide.union(small.select("g", F.col("value").cast(type_)))
    expected = df.where("value IS NOT NULL").groupBy("g").agg(F.percentile("value", 0.5).alias("m"))
    found = analysis.group_median(df, ["g"]).withColumn("median", F.col("median").cast("double"))
    assert [(g, pytest.approx(m)) for g, m in rows(found)] == rows(expected)


def test_median_keeps_no_table_in_memory(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0)], "g STRING, value DOUBLE")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert analysis.add_median(df, ["g"]).count() == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_median_as_column_and_as_rows(spark, rows):
    df = spark.createDataFrame([("a", 1.0, "n"), ("a", 4.0, "n"), ("b", 7.0, "n")], "g STRING, value DOUBLE, what STRING")
    assert rows(analysis.add_median(df, ["g"]), "g", "value", "median") == [("a", 1.0, 2.5), ("a", 4.0, 2.5), ("b", 7.0, 7.0)]
    appended = analysis.append_median(df, ["g"], labels={"what": "median"})
    assert rows(appended.where("what = 'median'"), "g", "value") == [("a", 2.5), ("b", 7.0)]
    assert appended.count() == 5


def test_not_a_number_is_null(spark, rows):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "x")], "d DOUBLE, s STRING")
    assert rows(columns.nan_to_null(df)) == [(1.0, "x"), (None, "nan")]
    assert dict(types.convert_types(df).dtypes)["d"] == "bigint"


def test_casts_stop_the_job_in_either_mode(spark):
    df = spark.createDataFrame([("1",), ("x",)], "n STRING")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="Not a int: x"):
                types.cast(df, {"n": "int"}).collect()
            with pytest.raises(Exception, match="Not a double: 1,234"):
                wide = spark.createDataFrame([("a", "1,234")], "k STRING, v STRING")
                reshape.to_long(wide, ["k"]).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_many_top_rows_do_not_compare_the_payload(spark, rows):
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("k"), "id", F.create_map(F.lit("a"), F.col("id")).alias("m")
    )
    top = latest.top_rows(df.repartition(5), 1200, by=["k"], order=[F.desc("id")])
    assert rows(top, "k", "id") == rows(df.where("id >= 600"), "k", "id")
    assert top.where("m['a'] <> id").isEmpty()


def test_dates_are_read_as_their_column_is_written(spark):
    cells = {
        "day": ["05/04/2024", "31/10/2024", "soon", None],
        "month": ["05/04/2024", "10/31/2024", "2024-01-02"],
        "both": ["05/04/2024", "31/10/2024", "10/31/2024"],
        "either": ["05/04/2024", "06/07/2024", "May 2024"],
        "none": ["n/a", None],
    }
    df = spark.createDataFrame([(f, c) for f, cs in cells.items() for c in cs], "f STRING, d STRING")
    parsed = date_forms.parse(df, ["d"], ["f"])
    assert parsed.columns == df.columns
    found = {}
    for r in parsed.collect():
        found.setdefault(r.f, []).append(r.d and r.d.isoformat())
    assert {f: sorted(d, key=str) for f, d in found.items()} == {
        "day": ["2024-04-05", "2024-10-31", None, None],
        "month": ["2024-01-02", "2024-05-04", "2024-10-31"],
        "both": ["2024-04-05", "2024-10-31", "2024-10-31"],
        "either": ["2024-04-05", "2024-05-01", "2024-07-06"],
        "none": [None, None],
    }
    forms = {r.f: (r.form, r.ambiguous_form, r.mixed, r.n_dates, r.n_unparsed, r.n_empty)
             for r in date_forms.forms(df, "d", ["f"]).collect()}
    assert forms == {
        "day": ("d/M/yyyy", "d/M/yyyy", False, 2, 1, 1),
        "month": (None, "M/d/yyyy", False, 3, 0, 0),
        "both": (None, None, True, 3, 0, 0),
        "either": (None, "d/M/yyyy", False, 3, 0, 0),
        "none": (None, None, False, 0, 1, 1),
    }
    # a column without files is one column
    months = df.where("f = 'month'").drop("f")
    assert sorted(str(r.d) for r in date_forms.parse(months, ["d"]).collect()) == [
        "2024-01-02", "2024-05-04", "2024-10-31"
    ]
    assert date_forms.parse(df.limit(0), ["d"]).collect() == []


def test_wide_to_long_is_compiled(spark, tmp_path):
    spark.createDataFrame([("a", "1", ".."), ("b", " 3 ", "NA")], "id STRING, x STRING, y STRING").write.parquet(
        str(tmp_path / "wide")
    )
    wide = spark.read.parquet(str(tmp_path / "wide"))
    settings = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = reshape.to_long(wide, ["id"]).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted((r.id, r.indicator_code, r.value) for r in found if r.value) == [("a", "x", 1.0), ("b", "x", 3.0)]


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        (r"united\s?states|\bu\.?s\.?a\b", None),
        (r"united.?kingdom|britain", ["britain", "kingdom"]),
        (r"^(?=.*\bd\.?\s?r\.?).*congo", ["congo"]),
        (r"\bKENYA\b", ["kenya"]),
        (r"(south|north)ern land", ["ern land"]),
        (r"a(bc)+d", None),
        (r"x(abc){2,}", ["abc"]),
        (r"x(abc)?", None),
        (r"c[oô]te", None),
        (r"\bguinea\b(?!.*bissau)", ["guinea"]),
        (r"(?i)kenya", None),
        (r"[a-z&&[^b]]land", None),
        (r"\p{L}and", None),
        (r"(", None),
        ("", None),
    ],
)
def test_literals_of_patterns(pattern, expected):
    assert literals.required(pattern) == expected


def test_many_patterns_meet_few_names(spark):
    def word(i):
        return "".join("bdfgklmnprst"[i // 12**k % 12] + "aeiou"[i // 7**k % 5] for k in range(4))

    words = [word(i * 37) for i in range(5000)]
    patterns = [(f"C{i}", rf"\b{w}(ia|land)?\b|old\W{w}") for i, w in enumerate(words)]
    patterns += [("ANY", r"x.?y"), ("C7", r"second\s+of"), ("C7b", "second of"), (None, "nothing"), ("N", None)]
    names = [f"The Republic of {w.upper()}ia" for w in words[::25]]
    names += ["second  of", "second of", "xzy", "nobody", "", "ab"]
    names_df = spark.createDataFrame([(n,) for n in names], "_name STRING")
    patterns_df = spark.createDataFrame(patterns, "_code STRING, regex STRING")
    tried = [(c, re.compile(p, re.I)) for c, p in patterns if c and p]
    expected = {}
    for n in names:
        codes = {c for c, p in tried if p.search(n)}
        if len(codes) == 1:
            expected[n] = codes.pop()
    found = {r._name: r._code for r in resolve.codes_by_pattern(names_df, patterns_df).collect()}
    assert found == expected and len(found) > 150
    known = resolve.index(patterns_df)
    assert known.where("gram IS NULL").select("_code").collect() == [("ANY",)]
    pairs = resolve.candidates(names_df, known.where("gram IS NOT NULL")).count()
    assert pairs < 0.02 * len(names) * len(patterns)


def test_patterns_of_many_numbers_meet_few_names(spark):
    numbers = [f"{i * 7:09d}" for i in range(2000)]
    patterns = [(f"C{n}", rf"\bclient\W*{n}(?!\d)") for n in numbers] + [("S", "abcd"), ("T", "client xyz")]
    names = [f"for CLIENT {n}, thanks" for n in numbers[::10]] + ["ABCd", "abc", "to client xyz", ""]
    names_df = spark.createDataFrame([(n,) for n in names], "_name STRING")
    patterns_df = spark.createDataFrame(patterns, "_code STRING, regex STRING")
    found = {r._name: r._code for r in resolve.codes_by_pattern(names_df, patterns_df).collect()}
    expected = {n: f"C{n[11:20]}" for n in names if n.startswith("for")}
    assert found == expected | {"ABCd": "S", "to client xyz": "T"}
    known = resolve.index(patterns_df).where("gram IS NOT NULL")
    assert resolve.candidates(names_df, known).count() < 3 * len(names)


def test_large_lookups_are_not_gathered_in_the_driver(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 10)
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = joins.attach(spark.range(100).select(F.col("id").alias("k")), lookup, ["k"], derived=True)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in found.collect() if r.v is not None) == list(range(0, 100, 2))
