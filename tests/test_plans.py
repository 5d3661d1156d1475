"""What the plans promise: pruning, pushdown, early limits, no Python workers, no unbounded loops."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from layerwright import session
from layerwright.config import PARTITIONS
from layerwright.operators import marts, silver
from layerwright.sources import bronze, tables
from layerwright.workloads import layers
from rows import raw

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    """Print pushed filters and schemas in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan parquet" in line]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for m in (1, 2):
        raw(spark, copies=4).withColumn(
            "tpep_pickup_datetime", F.expr(f"tpep_pickup_datetime + make_interval(0, {m - 1})")
        ).withColumn("tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + INTERVAL 5 MINUTES")).write.parquet(
            f"{root}/bronze/year=2024/month={m:02d}")
    rows = silver.to_silver(bronze.read_bronze(spark, f"{root}/bronze").drop("year", "month"))
    tables.overwrite_all(rows, f"{root}/silver", PARTITIONS)
    return root


def test_dedup_limits_each_key_before_the_shuffle(spark, lake):
    plan = physical(silver.to_silver(bronze.read_bronze(spark, f"{lake}/bronze")))
    limits = re.findall(r"WindowGroupLimit.*?(Partial|Final)", plan)
    assert limits == ["Final", "Partial"] and plan.index("Exchange") < plan.index("Partial")
    assert plan.count("Exchange hashpartitioning") == 1


def shuffled_records(df):
    """Records each shuffle of ``df`` wrote, after running it without adaptive replanning."""
    found = []

    def visit(node):
        if node.nodeName() == "Exchange":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        visit(execution.executedPlan())
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
    return found


def test_a_hot_key_reaches_the_shuffle_once_per_map_task(spark):
    """A third of the rows share one key; the shuffle carries one of them per map task."""
    df = spark.range(0, 30_000, 1, 4).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS v")
    assert shuffled_records(silver.keep_first(df, ("k",), ("v",))) == [20_000 + 4]
    kept = silver.keep_first(df, ("k",), ("v",))
    assert kept.count() == 20_001 and kept.where("k = -1").first().v == 29_997


def test_a_hot_group_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 4).selectExpr("IF(id % 3 = 0, 0, 1) AS k", "id / 100D AS x", "id % 5 AS d")
    assert shuffled_records(marts.grouped(df, ("k",), total="sum(x)")) == [2 * 4]
    assert shuffled_records(marts.grouped(df, ("k",), kinds="count(DISTINCT d)"))[-1] == 2 * 5 * 4


def test_silver_filters_reach_the_bronze_scan(spark, lake):
    plan = physical(silver.clean(bronze.read_bronze(spark, f"{lake}/bronze", file_columns=False)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for part in ("GreaterThanOrEqual(tpep_pickup_datetime", "LessThan(tpep_pickup_datetime", "LessThan(trip_distance",
                 "GreaterThanOrEqual(trip_distance", "GreaterThanOrEqual(fare_amount", "IsNotNull(tpep_dropoff_datetime"):
        assert part in pushed


def test_rule_counts_read_only_their_columns(spark, lake):
    from layerwright.operators import validate

    df = bronze.read_bronze(spark, f"{lake}/bronze", file_columns=False)
    schema = re.search(r"ReadSchema: struct<(.*?)>", physical(validate.rule_counts(df))).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "PULocationID",
        "DOLocationID", "fare_amount"}


def test_marts_prune_columns_and_partitions(spark, lake):
    trips = tables.read_table(spark, f"{lake}/silver").where("pickup_year = 2024 AND pickup_month = 2")
    plan = physical(marts.monthly_payment_mix(trips))
    assert re.search(r"PartitionFilters: \[.*pickup_month.* = 2.*\], PushedFilters", plan)
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"payment_type", "fare_amount", "tip_amount"}


def test_aggregates_combine_before_shuffling(spark, lake):
    trips = tables.read_table(spark, f"{lake}/silver")
    for build in (marts.hourly_zone_demand, marts.daily_vendor_revenue, marts.monthly_payment_mix, marts.pipeline_health):
        plan = physical(build(trips))
        lowest = plan[plan.rindex("Exchange hashpartitioning"):]
        assert "partial_" in lowest and "Expand" not in lowest
        assert len(scans(plan)) == 1


def test_a_month_filter_drops_the_other_months_files(spark, lake):
    df = bronze.read_bronze(spark, f"{lake}/bronze", file_columns=False).where("month = 2")
    assert "PartitionFilters: [isnotnull(month" in physical(df)


# Building these writes tables, which the oracle tests do already; md5 over files of any size streams their bytes.
WRITTEN = {"stream_file_load", "checksum_manifest", *layers.QUERIES} - {"sample_by_hash", "gate_result"}
BUILT = sorted(n for n in set(registry.queries()) - WRITTEN if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.mark.parametrize("name", BUILT)
def test_no_query_uses_python_rows_or_cross_joins(spark, name):
    plan = physical(registry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert not re.search(r"Python|InPandas|InArrow|ArrowEval", plan)
    loops = plan.count("BroadcastNestedLoopJoin")
    assert loops == (1 if name == "not_in_nullaware" else 0)


def test_shuffle_sizes_follow_the_input(spark):
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.shuffle_partitions(spark, 1 << 20) == configured
    assert session.shuffle_partitions(spark, 1 << 40) == 4096
    assert session.shuffle_partitions(spark, 100 << 40) == 409_600
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    with session.sized_shuffles(spark, 1 << 40):
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "4096"
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) == before


def test_partition_writes_are_rebalanced(spark, lake):
    trips = tables.read_table(spark, f"{lake}/silver")
    assert "REBALANCE_PARTITIONS_BY_COL" in physical(tables.gathered(trips, PARTITIONS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in physical(tables.gathered(trips, PARTITIONS))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
