"""Contracts, freshness and load verification."""

from datetime import date, datetime

import pytest

from layerwright.config import FreshnessSpec
from layerwright.operators import contracts as c
from layerwright.operators import incremental, typed

NOW = "TIMESTAMP_NTZ'2024-02-01 10:30:00'"


def loaded(spark, *times):
    rows = [(date(2024, 1, 30), t) for t in times]
    return spark.createDataFrame(rows, "pickup_date date, _loaded_at timestamp_ntz")


def test_checks_report_failing_rows(spark):
    df = spark.createDataFrame([(1, "LOW"), (1, "LOW"), (None, "ODD"), (3, None)], "k int, t string")
    rows = c.check(df, [c.NotNull("k"), c.Accepted("t", ("LOW", "HIGH")), c.Unique(("k",)), c.NotNull("t")]).collect()
    assert {(r.check_name, r.column_name): (r.failing_rows, r.passed) for r in rows} == {
        ("not_null", "k"): (1, False), ("accepted_values", "t"): (1, False),
        ("unique", "k"): (1, False), ("not_null", "t"): (1, False)}


def test_several_models_are_checked_by_one_scan(spark, tmp_path):
    spark.sql("SELECT * FROM VALUES (1, 'x', 3), (1, 'y', NULL), (2, NULL, 3), (NULL, 'x', 4), (NULL, 'x', 3) AS t (k, v, n)").write.parquet(
        str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    models = {"a": [c.NotNull("v"), c.Unique(("k",))], "b": [c.Accepted("n", (3,)), c.NotNull("k")]}
    result = c.check_once(df, models)
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = [tuple(r) for r in result.collect()]
    assert rows == [("a", "not_null", "v", 1, False), ("a", "unique", "k", 2, False),
                    ("b", "accepted_values", "n", 1, False), ("b", "not_null", "k", 2, False)]
    parts = [(m, *r) for m, contract in models.items() for r in map(tuple, c.check(df, contract).collect())]
    assert sorted(rows) == sorted(parts)
    assert [r.failing_rows for r in c.check_once(df.limit(0), models).collect()] == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        c.check_once(df, {"a": [c.Unique(("k",))], "b": [c.Unique(("v",))]})


def test_published_contracts_hold_fourteen_column_checks():
    assert len(c.STAGING_CONTRACT) + len(c.MART_CONTRACT) == 14


def test_assert_contract(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    c.assert_contract(df.where("k = 1"), [c.NotNull("k")])
    with pytest.raises(c.ContractError, match="not_null"):
        c.assert_contract(df, [c.NotNull("k")])


def test_unaccepted_values_are_listed(spark):
    df = spark.createDataFrame([(1,), (6,), (6,), (None,)], "v int")
    assert [tuple(r) for r in c.unaccepted_values(df, c.Accepted("v", (1, 2))).collect()] == [(6, 2)]


@pytest.mark.parametrize("time,hours,status", [
    (datetime(2024, 2, 1, 10, 29), 0, "FRESH"),
    (datetime(2024, 2, 1, 9, 59), 1, "FRESH"),
    (datetime(2024, 1, 30, 10, 0), 48, "FRESH"),
    (datetime(2024, 1, 30, 9, 59), 49, "STALE"),
])
def test_freshness_counts_hour_marks(spark, time, hours, status):
    row = c.freshness(loaded(spark, time, datetime(2024, 1, 1)), NOW).first()
    assert (row.hours_since_load, row.freshness_status, row.days_since_last_data) == (hours, status, 2)
    assert row.last_load_time == time


def test_freshness_of_an_empty_table(spark):
    row = c.freshness(loaded(spark, datetime(2024, 1, 1)).limit(0), NOW).first()
    assert (row.freshness_status, row.hours_since_load) == ("NO_DATA", None)


@pytest.mark.parametrize("time,status", [
    (datetime(2024, 1, 31, 10, 30), "pass"), (datetime(2024, 1, 31, 10, 29, 59), "warn"),
    (datetime(2024, 1, 30, 10, 30), "warn"), (datetime(2024, 1, 30, 10, 29, 59), "error")])
def test_source_freshness_limits(spark, time, status):
    assert c.source_freshness(loaded(spark, time), NOW).first().status == status


def test_gate_raises_on_late_and_missing_loads(spark):
    c.freshness_gate(loaded(spark, datetime(2024, 2, 1, 8, 0)), NOW)
    for df in (loaded(spark, datetime(2024, 2, 1, 7, 59)), loaded(spark, datetime(2024, 1, 1)).limit(0)):
        with pytest.raises(c.ContractError):
            c.freshness_gate(df, NOW, limits=FreshnessSpec(gate=2))


def test_gate_result_is_a_row(spark):
    rows = c.gate_result(loaded(spark, datetime(2024, 2, 1, 8, 0)), NOW).collect()
    rows += c.gate_result(loaded(spark, datetime(2024, 2, 1, 7, 59)), NOW).collect()
    rows += c.gate_result(loaded(spark, datetime(2024, 1, 1)).limit(0), NOW).collect()
    assert [(r.hours_since_load, r.limit_hours, r.status) for r in rows] == [(2, 2, "pass"), (3, 2, "fail"), (None, 2, "fail")]


def test_span_and_verify(spark):
    df = spark.range(3, 9)
    assert tuple(c.span(df, "id").first()) == (6, 3, 8)
    assert c.verify_rows(df, 6) == 6
    with pytest.raises(c.ContractError):
        c.verify_rows(df, 7)


# Published sample rows: date, hour, zone, trips, averages and totals -> tier-independent enrichment.
GOLDEN = [
    ("2024-01-01", 0, 239, 238, 16.39, 3900.9, 2.78, "Late Night", False, 16.39, 0.17),
    ("2024-01-12", 6, 265, 3, 78.83, 236.49, 12.87, "Morning Rush", False, 78.83, 0.163),
    ("2024-01-13", 12, 1, 1, 53.59, 53.59, 0.0, "Midday", True, 53.59, 0.0),
    ("2024-01-01", 3, 79, 477, 18.85, 8991.69, 2.91, "Late Night", False, 18.85, 0.154),
]


@pytest.mark.parametrize("day,hour,zone,trips,fare,total,tip,segment,weekend,revenue,rate", GOLDEN)
def test_golden_mart_rows(spark, day, hour, zone, trips, fare, total, tip, segment, weekend, revenue, rate):
    from layerwright.functions import scalars

    row = spark.sql(
        f"""SELECT DATE'{day}' AS pickup_date, {hour} AS pickup_hour, 2024 AS pickup_year, 1 AS pickup_month,
          {zone} AS pickup_location_id, {scalars.time_segment(str(hour))} AS time_segment,
          {scalars.is_weekend(f"DATE'{day}'")} AS is_weekend, {trips}L AS trip_count, 1D AS avg_trip_distance_miles,
          1D AS avg_trip_duration_mins, {fare}D AS avg_fare_amount, {total}D AS total_fare_amount,
          {tip}D AS avg_tip_amount, {scalars.demand_tier(str(trips))} AS demand_tier, now() AS _loaded_at"""
    )
    mart = incremental.enriched_demand(incremental.staging_demand(row)).first()
    assert (mart.time_segment, mart.is_weekend_flag) == (segment, weekend)
    assert (mart.revenue_per_trip, mart.tip_rate) == (revenue, rate)
    assert mart.demand_tier == ("MEDIUM" if trips > 100 else "LOW")


def test_missing_denominators_and_weekend(spark):
    row = spark.sql(
        """SELECT 0L AS trip_count, 5D AS total_fare_amount, 0D AS avg_fare_amount, 1D AS avg_tip_amount,
           CAST(NULL AS BOOLEAN) AS is_weekend"""
    )
    mart = incremental.enriched_demand(row).first()
    assert (mart.revenue_per_trip, mart.tip_rate, mart.is_weekend_flag) == (None, None, False)


def test_staging_leaves_out_dateless_and_empty_rows(spark):
    columns = ", ".join(f"CAST(NULL AS STRING) AS {n}" for n in incremental.STAGED if n not in ("pickup_date", "trip_count"))
    df = spark.sql(
        f"""SELECT pickup_date, trip_count, {columns}, now() AS _loaded_at FROM VALUES (DATE'2024-01-01', 1),
            (CAST(NULL AS DATE), 1), (DATE'2024-01-01', 0), (DATE'2024-01-01', NULL) AS t(pickup_date, trip_count)"""
    )
    staged = incremental.staging_demand(df)
    assert staged.count() == 1 and "loaded_at" in staged.columns


def test_typed_load_keeps_good_rows_and_names_bad_columns(spark):
    declared = {"a": "int", "d": "date", "extra": "double"}
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-01"), ("x", "no"), (None, None)], "a string, d string")
    assert [tuple(r) for r in typed.typed_load(df, declared).collect()] == [(1, date(2024, 1, 1), None), (None, None, None)]
    rejects = typed.typed_load_rejects(df, declared).collect()
    assert [r._unreadable for r in rejects] == [["a"], ["a", "d"]]


def test_load_tables_declare_every_mart_column(spark):
    from layerwright.operators import marts, silver
    from rows import raw

    trips = silver.clean(raw(spark, copies=3))
    for table, mart in (("hourly_zone_demand", marts.hourly_zone_demand), ("daily_vendor_revenue", marts.daily_vendor_revenue),
                        ("monthly_payment_mix", marts.monthly_payment_mix), ("pipeline_health_log", marts.stamped_health)):
        rows = typed.mart_to_load_table(mart(trips), table)
        assert rows.count() == 1
        assert set(rows.columns) == {*typed.LOAD_TABLES[table], "_loaded_at"}
        missing = [c for c in typed.LOAD_TABLES[table] if rows.where(f"{c} IS NULL").count()]
        assert not missing


def test_schema_evolution(spark):
    old, new = spark.sql("SELECT 1 AS a, 2 AS b"), spark.sql("SELECT 3 AS A, 4 AS c")
    assert typed.new_columns(old, new) == ["c"]
    assert sorted(map(tuple, typed.evolve(old, new).select("a", "b", "c").collect()), key=str) == [(1, 2, None), (3, None, 4)]
