"""Validation rules, the split, the issue texts and the profile."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwright.config import IngestSpec
from layerwright.operators import validate as v
from rows import VALID, raw

SPEC = IngestSpec(min_rows=20)


def outcome(df, spec=SPEC):
    result = v.validate(df, spec)
    return result.valid.count(), result.quarantine.count(), result.issues()


def test_complete_file_passes(spark):
    assert outcome(raw(spark, copies=21)) == (21, 0, [])


@pytest.mark.parametrize("column", ["fare_amount", "tpep_pickup_datetime"])
def test_missing_required_column_rejects_all(spark, column):
    valid, rejected, issues = outcome(raw(spark, copies=10, without=[column]))
    assert (valid, rejected) == (0, 10)
    assert issues == [f"Missing required columns: ['{column}']"]


@pytest.mark.parametrize("column,n", [("tpep_pickup_datetime", 5), ("fare_amount", 3), ("PULocationID", 2)])
def test_nulls_are_rejected(spark, column, n):
    valid, rejected, issues = outcome(raw(spark, *[{column: None}] * n, copies=25))
    assert (valid, rejected, issues) == (25, n, [f"Nulls in {column}: {n} rows"])


def test_negative_distance_is_rejected(spark):
    assert outcome(raw(spark, *[{"trip_distance": -1.5}] * 5, copies=25)) == (
        25, 5, ["Negative trip_distance: 5 rows"])


def test_zero_distance_passes(spark):
    assert outcome(raw(spark, {"trip_distance": 0.0}, copies=25)) == (26, 0, [])


def test_negative_fare_is_rejected(spark):
    assert outcome(raw(spark, *[{"fare_amount": -5.0}] * 3, copies=25)) == (25, 3, ["Negative fare_amount: 3 rows"])


def test_swapped_times_are_rejected(spark):
    swapped = {"tpep_pickup_datetime": datetime(2024, 1, 15, 10), "tpep_dropoff_datetime": datetime(2024, 1, 15, 9)}
    assert outcome(raw(spark, *[swapped] * 4, copies=25)) == (25, 4, ["Pickup >= dropoff: 4 rows"])


def test_equal_times_are_rejected(spark):
    equal = {"tpep_dropoff_datetime": VALID["tpep_pickup_datetime"]}
    assert outcome(raw(spark, *[equal] * 2, copies=25)) == (25, 2, ["Pickup >= dropoff: 2 rows"])


def test_small_file_is_reported_but_kept(spark):
    assert outcome(raw(spark, copies=10), IngestSpec()) == (10, 0, ["Row count 10 below minimum 100,000"])


def test_enough_rows_raise_no_count_issue(spark):
    assert outcome(raw(spark, copies=21))[2] == []
    assert outcome(raw(spark, copies=20))[2] == []


def test_mixed_rows_split_exactly(spark):
    valid, rejected, _ = outcome(raw(spark, *[{"fare_amount": -99.0}] * 50, copies=120))
    assert (valid, rejected) == (120, 50)


def test_all_valid_rows_leave_no_quarantine(spark):
    assert outcome(raw(spark, copies=30))[1] == 0


def test_issue_counts_overlap_and_keep_their_order(spark):
    both = {"fare_amount": -1.0, "trip_distance": -1.0, "passenger_count": None}
    valid, rejected, issues = outcome(raw(spark, both, copies=5))
    assert (valid, rejected) == (5, 1)
    assert issues == [
        "Row count 6 below minimum 20",
        "Nulls in passenger_count: 1 rows",
        "Negative trip_distance: 1 rows",
        "Negative fare_amount: 1 rows",
    ]


def test_nan_counts_as_missing_not_as_negative(spark):
    _, rejected, issues = outcome(raw(spark, {"fare_amount": float("nan")}, copies=25))
    assert (rejected, issues) == (1, ["Nulls in fare_amount: 1 rows"])


def test_large_counts_are_grouped_by_thousands(spark):
    df = raw(spark, {"fare_amount": -1.0}).crossJoin(spark.range(1234)).drop("id")
    assert "Negative fare_amount: 1,234 rows" in outcome(df)[2]


def test_tags_name_the_broken_rules(spark):
    tagged = v.tag(raw(spark, {"fare_amount": -1.0, "passenger_count": None}, {}))
    assert [r[0] for r in tagged.select(v.FAILED).collect()] == [["Nulls in passenger_count", "Negative fare_amount"], []]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "fare_amount": st.sampled_from([None, -1.0, 0.0, 2.5, float("nan")]),
                "trip_distance": st.sampled_from([None, -0.5, 0.0, 9.0]),
                "passenger_count": st.sampled_from([None, 1.0]),
            }
        ),
        min_size=1,
        max_size=12,
    )
)
def test_split_loses_and_invents_no_row(spark, changes):
    df = raw(spark, *changes)
    result = v.validate(df, SPEC)
    assert result.valid.count() + result.quarantine.count() == len(changes)
    assert result.valid.unionByName(result.quarantine).exceptAll(df).count() == 0
    expected = sum(
        c["fare_amount"] is None or c["fare_amount"] != c["fare_amount"] or c["fare_amount"] < 0
        or c["trip_distance"] is None or c["trip_distance"] < 0 or c["passenger_count"] is None
        for c in changes
    )
    assert result.quarantine.count() == expected


def test_reject_rate_and_alert(spark):
    counts = spark.createDataFrame([(0, 0), (100, 5), (100, 6)], "total_rows bigint, reject_rows bigint")
    rows = v.reject_rate(counts).collect()
    assert [(r.reject_pct, r.alert) for r in rows] == [(0.0, False), (5.0, False), (6.0, True)]


def test_run_status(spark):
    cases = spark.createDataFrame(
        [(True, True, True, True), (False, False, True, False), (False, True, False, False),
         (False, True, True, True), (False, True, True, False)],
        "landed boolean, published boolean, readable boolean, issues boolean")
    status = v.run_status(*[F.col(c) for c in cases.columns])
    assert [r[0] for r in cases.select(status).collect()] == [
        "skipped", "not_published", "failed", "success_with_warnings", "success"]


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = raw(spark, {"passenger_count": None, "airport_fee": None}, {"airport_fee": None}, copies=2)
    rows = {r.column_name: r.null_pct for r in v.null_profile(df).collect()}
    assert rows == {"passenger_count": 25.0, "airport_fee": 50.0}


def test_null_profile_of_an_empty_table(spark):
    assert v.null_profile(raw(spark, copies=1).limit(0)).count() == 0
