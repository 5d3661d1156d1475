"""The layers end to end: bronze to silver, silver to marts, marts to load tables, load tables to the mart."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PARTITIONS, FreshnessSpec, IngestSpec, SilverSpec
from ..functions.scalars import disjunction, time_literal
from ..operators import contracts, incremental, joins, marts, silver, typed
from ..session import sized_shuffles
from ..sources import bronze, files, tables
from .landing import Layout


def silver_accounting(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> dict[str, int]:
    """Rows in, rows failing each rule, duplicates and rows out of a silver run.

    Counted from bronze by its keys, independently of the write: a side effect of the write would count rows
    twice when a lost executor's tasks run again, and a difference would pass a lost row off as a duplicate.
    """
    return silver.run_counts(raw, spec).first().asDict()


def build_silver(
    spark: SparkSession,
    layout: Layout,
    spec: SilverSpec = SilverSpec(),
    ingest: IngestSpec = IngestSpec(),
    fmt: str = "parquet",
    verify: bool = True,
) -> dict[str, int]:
    """Write the silver table from all of bronze and return the run's accounting.

    Bronze is read twice, once to be written and once to be counted by its keys.  ``verify`` raises when the rows read
    back differ from that count; the run is then on record as failed.
    """
    source, path = layout.path("bronze"), layout.path("silver")
    raw = bronze.read_bronze(spark, source, ingest).drop(*bronze.MONTH_COLUMNS)
    with sized_shuffles(spark, tables.path_bytes(spark, source)):
        kept = silver.distinct_clean(raw, spec)
        months = ("year(pickup_datetime) AS pickup_year", "month(pickup_datetime) AS pickup_month")
        together = tables.gathered(kept.selectExpr("*", *months), PARTITIONS).drop(*PARTITIONS)
        rows = silver.stamped(silver.derived(together), spec)
        tables.overwrite_all(rows, path, PARTITIONS, fmt, gather=False)
        counts = silver_accounting(raw, spec)
    written = tables.read_table(spark, path, fmt).count()
    lost = f"read back {written} rows, expected {counts['rows_out']}" if written != counts["rows_out"] else ""
    record = {
        "pipeline": spec.source,
        "layer": "silver",
        "status": "failed" if lost else "success",
        "rows_ingested": written,
        "reject_rows": counts["rows_filtered"],
        "run_timestamp": datetime.now().astimezone().isoformat(),
        "error_message": lost,
        "rows_in": counts["rows_in"],
        "rows_duplicate": counts["rows_duplicate"],
    }
    tables.append_json(spark, record, layout.path("control", "silver_runs"), tables.SILVER_RUN_SCHEMA)
    if lost and verify:
        raise contracts.ContractError(lost)
    return counts


def build_gold(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> None:
    """Write every mart from the silver table; each scan reads only the columns its mart needs."""
    source = layout.path("silver")
    trips = tables.read_table(spark, source, fmt, view="silver_trips")
    with sized_shuffles(spark, tables.path_bytes(spark, source)):
        for name, build in marts.MARTS.items():
            partitions = () if name == "pipeline_health" else PARTITIONS
            tables.overwrite_all(build(trips), layout.path("gold", name), partitions, fmt)


def export_gold(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> None:
    """Write every mart as CSV for reporting tools."""
    for name in marts.MARTS:
        mart = tables.read_table(spark, layout.path("gold", name), fmt)
        tables.export_csv(mart, layout.path("export", name))


LOAD_SOURCES = {
    "hourly_zone_demand": "hourly_zone_demand",
    "daily_vendor_revenue": "daily_vendor_revenue",
    "monthly_payment_mix": "monthly_payment_mix",
    "pipeline_health_log": "pipeline_health",
}


def month_condition(months: Sequence[tuple[int | None, int | None]]) -> str:
    """Partition filter for the given months, known when the query is planned; a missing part is a null partition."""
    year, month = PARTITIONS

    def equal(column: str, value: int | None) -> str:
        return f"{column} IS NULL" if value is None else f"{column} = {value}"

    return disjunction(f"{equal(year, y)} AND {equal(month, m)}" for y, m in months)


def rejects_path(layout: Layout, table: str) -> str:
    return layout.path("control", f"rejected_{table}")


def replace_rejects(spark: SparkSession, rejects: DataFrame, path: str, months: Sequence | None) -> None:
    """Make the rejects of ``months`` those given, none included; without months, replace them all."""
    if months is None:
        tables.overwrite_all(rejects, path)
        return
    for values in months:
        parts = [f"{p}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for p, v in zip(PARTITIONS, values)]
        tables.delete_path(spark, "/".join([path, *parts]))
    of_month = {p: files.path_value(F.col("_file_path"), p) for p in PARTITIONS}
    tables.overwrite_partitions(rejects.withColumns(of_month), path, PARTITIONS)


def load_table(spark: SparkSession, layout: Layout, table: str, fmt: str = "parquet") -> int:
    """Load the mart files not loaded before into ``table`` and return how many there were.

    A month with a new file is reloaded whole from the mart's snapshot, so rewriting a mart does not leave
    its earlier rows in the load table; the health table is a log that keeps the rows of every run.  Rows that do
    not fit the declared types go to a table of rejects, with their file and columns; those of the months loaded replace
    the ones there, so a month loaded again, corrected or after a crash, shows each reject once.  The log of loaded
    paths is written last; a load that dies before loads the same files again.  The driver sees only the months.
    """
    mart_path, target = layout.path("gold", LOAD_SOURCES[table]), layout.path("raw", table)
    log_path = layout.path("control", f"loaded_{table}")
    mart = tables.read_table(spark, mart_path, fmt, merge=True)
    # Other formats than Parquet may keep replaced files beside those of the snapshot.
    manifest = files.file_manifest(spark, mart_path) if fmt == "parquet" else files.rows_per_file(mart)
    new = manifest
    if tables.path_exists(spark, log_path):
        new = files.not_yet_loaded(manifest, tables.read_table(spark, log_path))
    count = new.count()
    if not count:
        return 0
    if LOAD_SOURCES[table] == "pipeline_health":
        touched, months = "true", None
        rows = typed.mart_to_load_table(mart, table)
        if tables.path_exists(spark, target):
            run = (*PARTITIONS, "health_run_at")
            rows = joins.anti_join_nullsafe(rows, tables.read_table(spark, target, fmt), run)
        tables.append_rows(rows, target, fmt)
    else:
        loaded = new.select(*[files.path_value(F.col("path"), p).alias(p) for p in PARTITIONS]).distinct()
        months = [tuple(r) for r in loaded.collect()]
        touched = month_condition(months)
        rows = typed.mart_to_load_table(mart.where(touched), table)
        tables.overwrite_partitions(rows, target, PARTITIONS, fmt)
    replace_rejects(spark, typed.mart_load_rejects(mart.where(touched), table), rejects_path(layout, table), months)
    manifest.write.mode("overwrite").parquet(log_path)
    return count


def refresh_mart(
    spark: SparkSession,
    layout: Layout,
    as_of: datetime,
    limits: FreshnessSpec | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Refresh the demand mart from its load table, check both contracts and return the mart.

    Columns that the load table holds beside its declared ones come into the mart with the months that are merged, and
    are null in the others.
    """
    now = time_literal(as_of)
    loaded = tables.read_table(spark, layout.path("raw", "hourly_zone_demand"), fmt, merge=True)
    if limits is not None:
        contracts.freshness_gate(loaded, now, limits=limits)
    staged = incremental.staging_demand(loaded, typed.undeclared(loaded, "hourly_zone_demand"))
    contracts.assert_contract(staged, contracts.STAGING_CONTRACT)
    path = layout.path("mart", "demand_intelligence")
    if not tables.path_exists(spark, path):
        tables.overwrite_all(incremental.demand_mart(staged, None, now), path, PARTITIONS, fmt)
    else:
        current = tables.read_table(spark, path, fmt, merge=True)
        pending = incremental.pending_months(staged, current, now)
        months = [tuple(r) for r in pending.select(*PARTITIONS).distinct().collect()]
        if months:
            touched = month_condition(months)
            merged = incremental.demand_mart(staged.where(touched), current.where(touched), now)
            tables.replace_read_partitions(merged, path, PARTITIONS, fmt)
    mart = tables.read_table(spark, path, fmt, merge=True)
    contracts.assert_contract(mart, contracts.MART_CONTRACT + contracts.MART_KEY_CONTRACT)
    return mart


def run_all(spark: SparkSession, layout: Layout, as_of: datetime, fmt: str = "parquet") -> DataFrame:
    """Bronze to published mart in one go."""
    build_silver(spark, layout, fmt=fmt)
    build_gold(spark, layout, fmt)
    for table in LOAD_SOURCES:
        load_table(spark, layout, table, fmt)
    return refresh_mart(spark, layout, as_of, fmt=fmt)
