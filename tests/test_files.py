"""Bronze reads, file manifests, sinks, landing and the layers end to end."""

import hashlib
import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerwright.config import IngestSpec
from layerwright.functions import digests
from layerwright.operators import contracts
from layerwright.plans import landing, medallion
from layerwright.plans.landing import Layout
from layerwright.session import scratch_path, shared_dir
from layerwright.sources import bronze, files, tables
from layerwright.streaming.file_load import load_new_files, loaded, rejected, split_rows
from rows import raw

SPEC = IngestSpec(min_rows=3)


def month(root, year, number):
    return f"{root}/year={year:04d}/month={number:02d}"


def pickup(day, hour=9, minute=0):
    start = datetime(2024, day.month, day.day, hour, minute)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + timedelta(minutes=10)}


@pytest.fixture
def deliveries(spark, tmp_path):
    """Three months: clean, with bad rows and integer passenger counts, and without a required column."""
    root = str(tmp_path / "deliveries")
    jan = [pickup(date(2024, 1, d)) for d in range(1, 6)]
    feb = [pickup(date(2024, 2, d)) for d in range(1, 6)]
    raw(spark, *jan, jan[0]).write.parquet(month(root, 2024, 1))
    raw(spark, *feb, {**feb[0], "fare_amount": -1.0}, {**feb[1], "trip_distance": -2.0}).withColumn(
        "passenger_count", F.col("passenger_count").cast("bigint")
    ).write.parquet(month(root, 2024, 2))
    raw(spark, *[pickup(date(2024, 3, d)) for d in range(1, 4)], without=["fare_amount"]).write.parquet(month(root, 2024, 3))
    return root


def test_bronze_reads_months_with_clashing_types(spark, deliveries):
    Path(month(deliveries, 2024, 1), "files.md5").write_text("not parquet")
    df = bronze.read_bronze(spark, deliveries)
    assert df.count() == 16
    assert dict(df.dtypes)["passenger_count"] == "double"
    assert {(r.year, r.month) for r in df.select("year", "month").distinct().collect()} == {(2024, 1), (2024, 2), (2024, 3)}
    assert df.where("month = 3 AND fare_amount IS NOT NULL").count() == 0
    assert df.where("_file_path IS NULL OR _file_modified_at IS NULL").count() == 0


def test_bronze_merges_agreeing_months_in_one_scan(spark, tmp_path):
    root = str(tmp_path)
    raw(spark, copies=2).write.parquet(month(root, 2024, 1))
    raw(spark, copies=1).withColumn("new_fee", F.lit(1.0)).withColumnRenamed("airport_fee", "Airport_fee").write.parquet(
        month(root, 2024, 2))
    df = bronze.read_bronze(spark, root)
    assert df.count() == 3 and "new_fee" in df.columns and "airport_fee" in df.columns
    assert df.where("airport_fee IS NULL").count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_clashing_types_without_months_are_an_error(spark, tmp_path):
    raw(spark, copies=1).write.parquet(str(tmp_path / "a"))
    raw(spark, copies=1).withColumn("passenger_count", F.lit(1)).write.mode("append").parquet(str(tmp_path / "a"))
    with pytest.raises(ValueError, match="differ"):
        bronze.read_bronze(spark, str(tmp_path / "a"))


def test_manifest_and_checksums(spark, deliveries):
    paths = list(Path(deliveries).rglob("*.parquet"))
    expected = {p.name: (p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()) for p in paths}
    listed = files.file_manifest(spark, deliveries)
    assert {Path(r.path).name: r["size"] for r in listed.collect()} == {n: s for n, (s, _) in expected.items()}
    rows = files.checksum_manifest(spark, deliveries).collect()
    assert {Path(r.path).name: (r["size"], r.md5) for r in rows} == expected


def test_checksums_of_any_bytes(spark, tmp_path):
    contents = {
        "empty": b"", "one": b"1", "ones": b"1" * 70_000, "none": b"\x00\xff\n\r" * 50_000, "last": b"ab1", "not": b"1ab",
        "with space": bytes(range(256)) * 3000 + b"\xef\xbb\xbf",
    }
    for name, data in contents.items():
        (tmp_path / f"{name}.bin").write_bytes(data)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    rows = files.checksum_manifest(spark, str(tmp_path), "*.bin").collect()
    found = {Path(r.path).stem: (r["size"], r.md5) for r in rows}
    assert found == {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in contents.items() if d}
    assert before == {k: spark.conf.get(k) for k in before}


def test_a_file_read_in_pieces_is_an_error():
    import pyarrow as pa

    columns = {"path": ["f", "f"], "size": [9, 9], "data": [b"ab1", b"cd1"]}
    with pytest.raises(ValueError, match="3 bytes"):
        list(files._md5(iter([pa.RecordBatch.from_pydict(columns)])))


def read_by_tasks(spark, folder):
    """The bytes each partition of a manifest's scan gets."""
    cut = files.pieces_at_once(spark, folder, "*.bin")
    rows = files.cut_bytes(spark, folder, "*.bin") if cut is None else cut
    sizes = rows.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("value") + 1).alias("n"))
    return sorted(r.n for r in sizes.collect())


def test_a_large_file_is_summed_by_several_tasks(spark, tmp_path, monkeypatch):
    """Pieces with many cuts, without any and with one at a piece's edge; none is read whole, and no md5 changes."""
    monkeypatch.setattr(files, "PIECE_BYTES", 700_000)
    contents = {
        "mixed": bytes(range(256)) * 9000, "ones": b"1" * 1_500_001, "none": b"\x00\xff\n\r" * 500_000,
        "edges": (b"x" * 699_999 + b"1") * 3, "small": b"ab1", "not": b"1ab", "empty": b"",
    }
    for name, data in contents.items():
        (tmp_path / f"{name}.bin").write_bytes(data)
    built = files.checksum_manifest(spark, str(tmp_path), "*.bin")
    expected = {n: (len(d), hashlib.md5(d).hexdigest()) for n, d in contents.items() if d}
    assert {Path(r.path).stem: (r["size"], r.md5) for r in built.collect()} == expected
    assert built.limit(2).count() == 2 and len(built.coalesce(1).take(1)) == 1


def test_no_task_reads_a_large_file_whole(spark, tmp_path, monkeypatch):
    tasks = spark.sparkContext.defaultParallelism
    size, folder = 8_000_000, str(tmp_path)
    (tmp_path / "large.bin").write_bytes(b"abcdefg1" * (size // 8))
    assert read_by_tasks(spark, folder) == [size]
    monkeypatch.setattr(files, "PIECE_BYTES", 100_000)
    read = read_by_tasks(spark, folder)
    assert sum(read) == size and len(read) <= tasks
    assert max(read) < 2 * size / tasks + 100_000


def test_a_file_without_one_of_its_pieces_is_an_error(monkeypatch):
    """One task alone, whose file has bytes that no task holds."""
    import pyarrow as pa

    class Alone:
        def allGather(self, message):
            return [message]

    monkeypatch.setattr(files.BarrierTaskContext, "get", Alone)
    columns = {"path": ["f", "f"], "size": [9, 9], "start": [0, 0], "length": [6, 6], "data": [b"ab1", b"cd1"]}
    with pytest.raises(ValueError, match="3 bytes"):
        list(files._md5_of_pieces(iter([pa.RecordBatch.from_pydict(columns)])))
    later = {"path": ["f"], "size": [9], "start": [4], "length": [5], "data": [b"ab1"]}
    with pytest.raises(ValueError, match="f: "):
        list(files._md5_of_pieces(iter([pa.RecordBatch.from_pydict(later)])))


def test_an_md5_is_resumed():
    data = bytes(range(256)) * 5
    for cut in (0, 1, 63, 64, 65, 1000, len(data)):
        first = digests.Md5()
        first.update(data[:cut])
        second = digests.Md5(first.state())
        second.update(memoryview(data)[cut:])
        assert second.hexdigest() == hashlib.md5(data).hexdigest() == second.hexdigest()


def test_building_a_manifest_runs_no_job(spark, deliveries):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        files.checksum_manifest(spark, deliveries)
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_landing_keeps_a_foreign_writers_bytes(spark, tmp_path):
    """pandas writes times in nanoseconds; the file is landed as it is, and read to the microsecond."""
    import pandas as pd

    rows = raw(spark, *[pickup(date(2024, 4, d)) for d in range(1, 8)], {"fare_amount": -3.0, **pickup(date(2024, 4, 9))}).toPandas()
    odd = pd.Timestamp("2024-04-30 23:59:59.123456789")
    for column in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        rows[column] = rows[column].astype("datetime64[ns]")
    rows.loc[0, ["tpep_pickup_datetime", "tpep_dropoff_datetime"]] = [odd, odd + pd.Timedelta("1h")]
    folder = Path(month(tmp_path / "in", 2024, 4))
    folder.mkdir(parents=True)
    delivered = folder / "trips of april.parquet"
    rows.to_parquet(delivered, index=False, version="2.6", coerce_timestamps=None)
    (folder / "trips.md5").write_text("beside")
    layout = Layout(str(tmp_path / "lake"))
    control = landing.land(spark, str(tmp_path / "in"), layout, [(2024, 4)], spec=SPEC).collect()
    assert [(r.status, r.rows_ingested, r.reject_rows) for r in control] == [("success_with_warnings", 7, 1)]
    landed = Path(layout.month("bronze", 2024, 4)) / delivered.name
    assert landed.read_bytes() == delivered.read_bytes()
    assert control[0].file_size_bytes == delivered.stat().st_size
    manifest = tables.read_table(spark, layout.path("control", "bronze_files")).collect()
    assert [(Path(r.path).name, r["size"], r.md5) for r in manifest] == [
        (delivered.name, delivered.stat().st_size, hashlib.md5(delivered.read_bytes()).hexdigest())]
    assert not list(Path(layout.path("staging")).rglob("part-*")) if Path(layout.path("staging")).exists() else True
    read = bronze.read_bronze(spark, layout.path("bronze"))
    assert dict(read.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    times = {r.tpep_pickup_datetime for r in read.collect()}
    assert datetime(2024, 4, 30, 23, 59, 59, 123456) in times and datetime(2024, 4, 2, 9, 0) in times


def test_nanoseconds_before_1970(spark):
    df = spark.sql("SELECT -1L AS t, -1L AS u UNION ALL SELECT 1500L, 1500L")
    rows = bronze.as_declared(df, {"t": "timestamp_ntz", "u": "timestamp"}).collect()
    assert sorted(r.t for r in rows) == [datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1970, 1, 1, 0, 0, 0, 1)]
    assert sorted(r.u.microsecond for r in rows) == [1, 999999]


def test_one_scan_per_distinct_schema(spark, tmp_path):
    """Months of two schemas that clash, in turns, and columns that only some months have."""
    root = str(tmp_path)
    for number in range(1, 9):
        rows = raw(spark, copies=number)
        if number % 2:
            rows = rows.withColumn("passenger_count", F.lit(1).cast("bigint"))
        if number > 6:
            rows = rows.withColumn("new_fee", F.lit(1.0))
        rows.coalesce(1).write.parquet(month(root, 2024, number))
    df = bronze.read_bronze(spark, root)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {r.month: r["count"] for r in df.groupBy("month").count().collect()} == {n: n for n in range(1, 9)}
    assert df.where("new_fee IS NOT NULL").count() == 15 and df.where("passenger_count IS NULL").count() == 0


def test_a_corrected_month_replaces_its_quarantine(spark, tmp_path):
    root, layout = str(tmp_path / "in"), Layout(str(tmp_path / "lake"))
    good, bad = pickup(date(2024, 1, 5)), {**pickup(date(2024, 1, 6)), "fare_amount": -1.0}
    for number in (1, 2):
        raw(spark, good, bad, bad).withColumn("note", F.lit(number) if number == 1 else F.lit("x")).write.parquet(month(root, 2024, number))
    months = [(2024, 1), (2024, 2)]
    landing.land(spark, root, layout, months, spec=SPEC)
    held = landing.read_quarantine(spark, layout)
    assert {(r.month, r.note) for r in held.collect()} == {(1, "1"), (2, "x")} and held.count() == 4
    raw(spark, good, good, good).write.mode("overwrite").parquet(month(root, 2024, 1))
    raw(spark, good, good, bad).write.mode("overwrite").parquet(month(root, 2024, 2))
    control = landing.land(spark, root, layout, months, force=True, spec=SPEC).collect()
    assert [(r.status, r.reject_rows) for r in control] == [("success", 0), ("success_with_warnings", 1)]
    assert [(r.year, r.month, r.fare_amount) for r in landing.read_quarantine(spark, layout).collect()] == [(2024, 2, -1.0)]
    assert not Path(layout.month("quarantine", 2024, 1)).exists()


def test_path_values(spark, deliveries):
    df = spark.read.option("recursiveFileLookup", "true").parquet(month(deliveries, 2024, 2))
    row = files.with_path_values(df, ["year", "month", "day"]).select("year", "month", "day").first()
    assert tuple(row) == (2024, 2, None)


def test_overwrite_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "pickup_year int, pickup_month int, v string")
    tables.overwrite_partitions(first, path, ("pickup_year", "pickup_month"))
    change = spark.createDataFrame([(2024, 2, "c")], first.schema)
    tables.overwrite_partitions(change, path, ("pickup_year", "pickup_month"))
    read = tables.read_table(spark, path, view="t")
    assert sorted(r.v for r in read.collect()) == ["a", "c"] == sorted(r.v for r in spark.table("t").collect())
    merged = tables.read_table(spark, path).where("pickup_month = 2").withColumn("v", F.lit("d"))
    tables.replace_read_partitions(merged, path, ("pickup_year", "pickup_month"))
    assert sorted(r.v for r in tables.read_table(spark, path).collect()) == ["a", "d"]
    tables.overwrite_all(change, path, ("pickup_year", "pickup_month"))
    assert [r.v for r in tables.read_table(spark, path).collect()] == ["c"]


def test_json_log_and_history(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(7):
        tables.append_json(spark, {"status": f"s{i}", "run_timestamp": f"2024-01-0{i + 1}"}, path)
    log = tables.read_control(spark, path)
    assert log.columns == tables.CONTROL_SCHEMA.names and log.count() == 7
    assert [r.status for r in tables.run_history(log).collect()] == ["s6", "s5", "s4", "s3", "s2"]


def test_csv_export(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.export_csv(spark.sql("SELECT 1 AS a, 'x,y' AS b").coalesce(1), path)
    assert next(Path(path).glob("*.csv")).read_text() == 'a,b\n1,"x,y"\n'


def test_shared_dir_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


@pytest.mark.parametrize("as_of,n,months", [
    (date(2024, 3, 15), 3, [(2024, 2), (2024, 1), (2023, 12)]), (date(2024, 1, 1), 1, [(2023, 12)])])
def test_month_targets(spark, as_of, n, months):
    assert landing.month_targets(as_of, n) == months
    day = spark.createDataFrame([(as_of,)], "d date")
    assert sorted(map(tuple, landing.month_spine(day, "d", n).collect())) == sorted(months)


def test_time_literals(spark):
    from layerwright.functions.scalars import time_literal

    utc, east = datetime(2024, 1, 1, 12, tzinfo=timezone.utc), datetime(2024, 1, 1, 13, tzinfo=timezone(timedelta(hours=1)))
    assert spark.sql(f"SELECT {time_literal(utc)} = {time_literal(east)} AS same").first().same
    with pytest.raises(ValueError):
        time_literal(datetime(2024, 1, 1, 12))


def test_single_month_target():
    assert landing.month_targets(date(2024, 3, 15), 3, (2023, 5)) == [(2023, 5)]


def test_landing(spark, deliveries, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    broken = Path(month(deliveries, 2024, 4))
    broken.mkdir(parents=True)
    (broken / "part.parquet").write_text("this is no parquet file")
    months = [(2024, m) for m in (1, 2, 3, 4, 5)]
    control = {r.month: r for r in landing.land(spark, deliveries, layout, months, spec=SPEC).collect()}
    assert {m: r.status for m, r in control.items()} == {
        1: "success", 2: "success_with_warnings", 3: "success_with_warnings", 4: "failed", 5: "not_published"}
    assert (control[1].rows_ingested, control[1].reject_rows, control[1].error_message) == (6, 0, "")
    assert (control[2].rows_ingested, control[2].reject_rows) == (5, 2)
    assert control[2].error_message == "Negative trip_distance: 1 rows; Negative fare_amount: 1 rows"
    assert control[3].error_message == "Missing required columns: ['fare_amount']"
    assert (control[3].rows_ingested, control[3].reject_rows) == (0, 3)
    assert control[4].error_message and control[1].file_size_bytes > 0

    landed = {m: bronze.read_parquet(spark, layout.month("bronze", 2024, m)).count() for m in (1, 2, 3)}
    assert landed == {1: 6, 2: 7, 3: 3}
    assert bronze.read_parquet(spark, layout.month("quarantine", 2024, 2)).count() == 2
    assert bronze.read_parquet(spark, layout.month("quarantine", 2024, 3)).count() == 3
    assert not Path(layout.month("quarantine", 2024, 1)).exists()
    notes = tables.read_control(spark, layout.path("control", "quarantine_notes")).orderBy("month").collect()
    assert [(r.month, r.reject_rows) for r in notes] == [(2, 2), (3, 3)]
    manifest = tables.read_table(spark, layout.path("control", "bronze_files")).where("month = 2").collect()
    for r in manifest:
        assert hashlib.md5(Path(r.path.removeprefix("file:")).read_bytes()).hexdigest() == r.md5
        assert (r.row_count, r.valid_rows, r.reject_rows) == (7, 5, 2)

    again = landing.land(spark, deliveries, layout, [(2024, 1), (2024, 2)], spec=SPEC)
    assert {r.status for r in again.collect()} == {"skipped"}
    forced = landing.land(spark, deliveries, layout, [(2024, 1)], force=True, spec=SPEC)
    assert [r.status for r in forced.collect()] == ["success"]
    assert bronze.read_parquet(spark, layout.month("bronze", 2024, 1)).count() == 6
    assert tables.read_control(spark, layout.path("control", "bronze_runs")).count() == 8
    rates = {r.month: r.alert for r in landing.alerts(spark.createDataFrame(list(control.values()))).collect()}
    assert rates == {1: False, 2: True, 3: True, 4: False, 5: False}
    alerts = spark.read.json(layout.path("control", "bronze_alerts")).orderBy("month").collect()
    assert [(r.month, r.reject_rows, r.total_rows) for r in alerts] == [(2, 2, 7), (3, 3, 3)]


def test_layers_end_to_end(spark, deliveries, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    landing.land(spark, deliveries, layout, [(2024, 1), (2024, 2), (2024, 3)], spec=SPEC)
    counts = medallion.build_silver(spark, layout, verify=True)
    assert counts["rows_in"] == 16 and counts["rows_out"] == 10
    # February's two bad rows and March's three without a fare fail rules, January holds one duplicate.
    assert (counts["rows_filtered"], counts["rows_duplicate"]) == (5, 1)
    assert counts["failed_fare_not_negative"] == 4 and counts["failed_distance_not_negative"] == 1
    silver = tables.read_table(spark, layout.path("silver"))
    assert not {"year", "month", "_file_path"} & set(silver.columns)
    medallion.build_gold(spark, layout)
    medallion.export_gold(spark, layout)
    exported = spark.read.option("header", True).csv(layout.path("export", "daily_vendor_revenue"))
    assert exported.count() == 10 and "pickup_year" in exported.columns
    loaded = {t: medallion.load_table(spark, layout, t) for t in medallion.LOAD_SOURCES}
    assert all(loaded.values())
    assert not any(medallion.load_table(spark, layout, t) for t in medallion.LOAD_SOURCES)

    now = datetime.now(timezone.utc)
    mart = medallion.refresh_mart(spark, layout, now)
    assert mart.count() == 10 and mart.where("updated_at IS NULL").count() == 0
    assert medallion.refresh_mart(spark, layout, now).count() == 10

    medallion.build_gold(spark, layout)
    assert medallion.load_table(spark, layout, "hourly_zone_demand") > 0
    raw_rows = tables.read_table(spark, layout.path("raw", "hourly_zone_demand"))
    assert raw_rows.count() == 10
    later = now + timedelta(days=3)
    refreshed = medallion.refresh_mart(spark, layout, later)
    assert refreshed.count() == 10
    stamps = [r[0] for r in refreshed.select("updated_at").distinct().collect()]
    assert stamps == [later.astimezone().replace(microsecond=0, tzinfo=None)]
    with pytest.raises(contracts.ContractError):
        from layerwright.config import FreshnessSpec

        medallion.refresh_mart(spark, layout, later, FreshnessSpec())
    runs = tables.read_control(spark, layout.path("control", "silver_runs")).collect()
    assert [(r.rows_ingested, r.reject_rows) for r in runs] == [(10, 5)]


def test_unreadable_values_are_quarantined_not_fatal(spark, tmp_path):
    deliveries, layout = str(tmp_path / "in"), Layout(str(tmp_path / "lake"))
    rows = raw(spark, copies=4).withColumn("fare_amount", F.lit("n/a"))
    rows.unionByName(raw(spark, copies=2).withColumn("fare_amount", F.lit("7.25"))).write.parquet(month(deliveries, 2024, 1))
    record = landing.land(spark, deliveries, layout, [(2024, 1)], spec=SPEC).first()
    assert (record.status, record.rows_ingested, record.reject_rows) == ("success_with_warnings", 2, 4)
    assert record.error_message == "Nulls in fare_amount: 4 rows"


def test_stream_loads_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], "a string, b int").schema

    def load():
        return load_new_files(spark, source, schema, {"a": "int", "b": "int"}, target, checkpoint, max_files=1)

    def deliver(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    deliver(("1", 1), ("x", 2))
    deliver(("3", 3))
    assert load() == 2
    assert load() == 0
    assert sorted(r.a for r in loaded(spark, target).collect()) == [1, 3]
    assert [(r._unreadable, json.loads(r["row"])) for r in rejected(spark, target).collect()] == [(["a"], {"a": "x", "b": 2})]
    deliver(("4", 4))
    assert load() == 1
    read = loaded(spark, target)
    assert sorted(r.a for r in read.collect()) == [1, 3, 4]
    assert read.where("_loaded_at IS NULL").count() == 0


def test_control_record_is_plain_json(spark, deliveries, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    landing.land(spark, deliveries, layout, [(2024, 9)], spec=SPEC, run_time=datetime(2024, 4, 1, 9))
    text = next(Path(layout.path("control", "bronze_runs")).glob("*.json")).read_text()
    record = json.loads(text)
    assert record["status"] == "not_published" and record["run_timestamp"] == "2024-04-01T09:00:00Z"


@pytest.mark.parametrize("left", ["bronze only", "old rewrite"])
def test_a_month_that_was_not_finished_is_landed_again(spark, deliveries, tmp_path, monkeypatch, left):
    layout = Layout(str(tmp_path / "lake"))
    if left == "old rewrite":
        landing.land(spark, deliveries, layout, [(2024, 2)], spec=SPEC)

    def dies(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(landing, "rejected", dies)
        landing.land(spark, deliveries, layout, [(2024, 2)], force=True, spec=SPEC)
    record = landing.land(spark, deliveries, layout, [(2024, 2)], spec=SPEC).first()
    assert (record.status, record.rows_ingested, record.reject_rows) == ("success_with_warnings", 5, 2)
    assert bronze.read_parquet(spark, layout.month("quarantine", 2024, 2)).count() == 2
    assert landing.land(spark, deliveries, layout, [(2024, 2)], spec=SPEC).first().status == "skipped"


def test_null_months(spark, tmp_path):
    from layerwright.plans.medallion import month_condition

    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS v, 2024 AS pickup_year, 1 AS pickup_month UNION ALL SELECT 2, NULL, NULL").write.partitionBy(
        "pickup_year", "pickup_month").parquet(path)
    assert [r.v for r in tables.read_table(spark, path).where(month_condition([(None, None)])).collect()] == [2]
    (tmp_path / "b" / "year=__HIVE_DEFAULT_PARTITION__" / "month=1").mkdir(parents=True)
    assert bronze.month_dirs(spark, str(tmp_path / "b")) == {}


def test_correction_in_a_later_month_stays(spark, tmp_path):
    deliveries, layout = str(tmp_path / "deliveries"), Layout(str(tmp_path / "lake"))
    trip = pickup(date(2024, 1, 31))
    raw(spark, {**trip, "tip_amount": 1.0}).write.parquet(month(deliveries, 2024, 1))
    raw(spark, {**trip, "tip_amount": 9.0}).write.parquet(month(deliveries, 2024, 2))
    landing.land(spark, deliveries, layout, landing.month_targets(date(2024, 3, 5), 2), spec=IngestSpec(min_rows=1))
    counts = medallion.build_silver(spark, layout)
    assert (counts["rows_in"], counts["rows_duplicate"], counts["rows_out"]) == (2, 1, 1)
    assert [r.tip_amount for r in tables.read_table(spark, layout.path("silver")).collect()] == [9.0]
    log = spark.read.schema(tables.SILVER_RUN_SCHEMA).json(layout.path("control", "silver_runs")).first()
    assert (log.status, log.rows_in, log.rows_duplicate, log.error_message) == ("success", 2, 1, "")


def test_lost_rows_are_noticed(spark, deliveries, tmp_path, monkeypatch):
    layout, write = Layout(str(tmp_path / "lake")), tables.overwrite_all
    landing.land(spark, deliveries, layout, [(2024, 1)], spec=SPEC)
    monkeypatch.setattr(tables, "overwrite_all", lambda df, *rest, **named: write(df.limit(3), *rest, **named))
    with pytest.raises(contracts.ContractError, match="read back 3 rows, expected 5"):
        medallion.build_silver(spark, layout)
    assert tables.read_control(spark, layout.path("control", "silver_runs")).first().status == "failed"


def test_unreadable_rows_are_logged(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    rows = [("2024-01-02", 3, "7", 2024, 1), ("2024-01-02", 4, "many", 2024, 1)]
    mart = spark.createDataFrame(rows, "pickup_date string, pickup_hour int, trip_count string, pickup_year int, pickup_month int")
    mart.coalesce(1).write.partitionBy("pickup_year", "pickup_month").parquet(layout.path("gold", "hourly_zone_demand"))
    assert medallion.load_table(spark, layout, "hourly_zone_demand") == 1
    loaded = tables.read_table(spark, layout.path("raw", "hourly_zone_demand")).collect()
    assert [(r.pickup_hour, r.trip_count) for r in loaded] == [(3, 7)]
    (reject,) = tables.read_table(spark, medallion.rejects_path(layout, "hourly_zone_demand")).collect()
    assert reject["_unreadable"] == ["trip_count"] and "pickup_month=1" in reject["_file_path"]
    assert json.loads(reject["row"])["trip_count"] == "many"


def test_column_of_one_month_shows(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.sql("SELECT 1 AS a, 1 AS m").write.partitionBy("m").parquet(path)
    tables.overwrite_partitions(spark.sql("SELECT 2 AS a, 'x' AS b, 2 AS m"), path, ["m"])
    found = tables.read_table(spark, path, merge=True).orderBy("m").select("a", "b").collect()
    assert [tuple(r) for r in found] == [(1, None), (2, "x")]


def test_health_keeps_earlier_runs_in_any_format(spark, deliveries, tmp_path):
    layout, now = Layout(str(tmp_path / "lake")), datetime.now(timezone.utc)
    landing.land(spark, deliveries, layout, [(2024, 1), (2024, 2)], spec=SPEC)
    for runs in (1, 2):
        assert medallion.run_all(spark, layout, now, fmt="orc").count() == 10
        log = tables.read_table(spark, layout.path("raw", "pipeline_health_log"), "orc")
        assert (log.count(), log.select("health_run_at").distinct().count()) == (2 * runs, runs)
    assert tables.read_table(spark, layout.path("raw", "hourly_zone_demand"), "orc").count() == 10


def test_a_batch_is_split_by_one_scan(spark, tmp_path):
    spark.createDataFrame([("1", 1), ("x", 2)], "a string, b int").write.parquet(str(tmp_path / "in"))
    rows = split_rows(spark.read.parquet(str(tmp_path / "in")), {"a": "int", "b": "int", "c": "double"})
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted((r.a, r.b) for r in rows.collect() if r.outcome == "loaded") == [(1, 1)]


def test_a_load_after_a_crash_shows_each_reject_once(spark, tmp_path, monkeypatch):
    layout, table = Layout(str(tmp_path / "lake")), "hourly_zone_demand"
    schema = "pickup_date string, pickup_hour int, trip_count string, pickup_year int, pickup_month int"

    def deliver(*rows):
        marts = spark.createDataFrame(list(rows), schema)
        tables.overwrite_partitions(marts, layout.path("gold", table), medallion.PARTITIONS)

    def rejects():
        read = tables.read_table(spark, medallion.rejects_path(layout, table))
        return sorted((r.pickup_month, json.loads(r["row"])["trip_count"]) for r in read.collect())

    deliver(("2024-01-02", 3, "many", 2024, 1), ("2024-02-02", 4, "few", 2024, 2), ("2024-02-02", 5, "6", 2024, 2))

    def dies(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(type(spark.range(1).write), "parquet", dies)
        medallion.load_table(spark, layout, table)
    assert rejects() == [(1, "many"), (2, "few")]
    assert medallion.load_table(spark, layout, table) > 0 and rejects() == [(1, "many"), (2, "few")]
    deliver(("2024-02-02", 4, "4", 2024, 2))
    assert medallion.load_table(spark, layout, table) == 1 and rejects() == [(1, "many")]


def test_csv_comes_back_as_it_was(spark, tmp_path):
    rows = [(None, None, 1.5), ("", datetime(2024, 1, 2, 3, 4, 5, 678901), None), (' "a", b\n\r\n\\n ', datetime(1999, 12, 31), float("inf")), ("\\", None, -0.1)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, d double")
    tables.export_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_new_column_reaches_the_months_merged(spark, tmp_path):
    from layerwright.operators.typed import HOURLY_ZONE_DEMAND

    layout, path = Layout(str(tmp_path / "lake")), str(tmp_path / "lake" / "raw" / "hourly_zone_demand")
    values = {c: "1" for c, t in HOURLY_ZONE_DEMAND.items() if t not in ("date", "boolean")}
    values |= {"time_segment": "'Night'", "demand_tier": "'LOW'", "is_weekend": "false", "pickup_year": "2024"}

    def load(number, count, *extra):
        row = {**values, "pickup_date": f"DATE'2024-{number:02d}-05'", "pickup_month": str(number), "trip_count": str(count)}
        row["_loaded_at"] = f"TIMESTAMP'2024-{number:02d}-06 00:00:00'"
        columns = [f"CAST({row[c]} AS {t}) AS {c}" for c, t in HOURLY_ZONE_DEMAND.items()]
        tables.overwrite_partitions(spark.sql(f"SELECT {', '.join([*columns, row['_loaded_at'] + ' AS _loaded_at', *extra])}"), path, medallion.PARTITIONS)

    load(1, 10)
    load(3, 30)
    medallion.refresh_mart(spark, layout, datetime(2024, 3, 6, tzinfo=timezone.utc))
    load(1, 11, "2.5D AS surge")
    mart = medallion.refresh_mart(spark, layout, datetime(2024, 3, 7, tzinfo=timezone.utc))
    assert sorted((r.pickup_month, r.trip_count, r.surge) for r in mart.collect()) == [(1, 11, 2.5), (3, 30, None)]
