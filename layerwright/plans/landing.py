"""Landing raw monthly deliveries in bronze, with quarantine copies, checksums and control records."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import IngestSpec
from ..functions.scalars import quoted
from ..operators import validate as v
from ..sources import bronze, files, tables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one root."""

    root: str
    dataset: str = "yellow_trips"

    def path(self, layer: str, table: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table or self.dataset}"

    def month(self, layer: str, year: int, month: int) -> str:
        return f"{self.path(layer)}/year={year:04d}/month={month:02d}"


@dataclass(frozen=True)
class Delivery:
    """One published month: its rows as delivered, or why they cannot be read."""

    year: int
    month: int
    folder: str
    rows: DataFrame | None
    error: str = ""


def month_targets(as_of: date, months_back: int, single: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """The months to land: one given month, or ``months_back`` months ending with the last full one."""
    if single:
        return [single]
    last = as_of.year * 12 + as_of.month - 2
    return [divmod_month(last - i) for i in range(months_back)]


def divmod_month(index: int) -> tuple[int, int]:
    """Months counted from year 0 to ``(year, month)``."""
    year, month = divmod(index, 12)
    return year, month + 1


def month_spine(as_of: DataFrame, column: str, months_back: int) -> DataFrame:
    """(year, month) rows for ``months_back`` months before the month of the one date in ``as_of``."""
    last = F.add_months(F.trunc(F.col(column), "month"), -1)
    first = F.add_months(last, 1 - months_back)
    months = as_of.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("first_day"))
    return months.select(F.year("first_day").alias("year"), F.month("first_day").alias("month"))


def open_delivery(spark: SparkSession, folder: str, year: int, month: int) -> Delivery:
    try:
        return Delivery(year, month, folder, bronze.read_parquet(spark, folder, merge=True))
    except bronze.READ_ERRORS as error:
        return Delivery(year, month, folder, None, str(error).splitlines()[0])


def delivery_counts(delivery: Delivery, spec: IngestSpec) -> DataFrame:
    """Rule counts of one delivery; a delivery without a required column is rejected whole."""
    declared = bronze.as_declared(delivery.rows, spec.raw_types)
    missing = v.missing_columns(declared.columns, spec)
    if missing:
        counts = declared.agg(F.expr("count(*) AS total_rows")).selectExpr(
            "total_rows",
            "total_rows AS reject_rows",
            "0 AS position",
            f"{quoted(v.missing_column_issue(missing))} AS rule",
            "total_rows AS rows",
        )
    else:
        counts = v.rule_counts(declared, spec)
    return counts.selectExpr(f"{delivery.year} AS year", f"{delivery.month} AS month", "*")


def rejected(delivery: Delivery, spec: IngestSpec) -> DataFrame:
    """The rows of a delivery that break a rule, in the declared types."""
    declared = bronze.as_declared(delivery.rows, spec.raw_types)
    if v.missing_columns(declared.columns, spec):
        return declared
    return declared.where(v.any_violation(declared, spec))


def issue_texts(counts: Sequence, spec: IngestSpec) -> list[str]:
    """Issues of one delivery in reporting order, from its rule counts."""
    rows = sorted(counts, key=lambda r: r.position)
    whole = [r.rule for r in rows if r.rule.startswith("Missing required columns")]
    if whole:
        return whole
    issues = [f"{r.rule}: {r.rows:,} rows" for r in rows if r.rows]
    total = rows[0].total_rows
    if total < spec.min_rows:
        issues.insert(0, f"Row count {total:,} below minimum {spec.min_rows:,}")
    return issues


def land(
    spark: SparkSession,
    deliveries: str,
    layout: Layout,
    months: Sequence[tuple[int, int]],
    force: bool = False,
    spec: IngestSpec = IngestSpec(),
    run_time: datetime | None = None,
) -> DataFrame:
    """Land ``months`` from the ``year=/month=`` folders below ``deliveries`` and return control records.

    All months are validated by one job that reads only the checked columns.  Bronze then receives the delivered files,
    byte for byte and under their names, and rejected rows are copied to quarantine, whose earlier copy of the month
    goes in any case.  Each step is one job for all months; the driver handles one record per month and file.  Months
    whose reject rate exceeds the limit are logged as warnings and in ``bronze_alerts``.

    A month counts as landed once its file manifest is there.  The manifests are written last, after the control
    records, and taken away before a month is written again, so a run that dies on the way leaves no month that later
    runs would skip.  A month landed again may then have two control records.
    """
    stamp = (run_time or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    published = bronze.month_dirs(spark, deliveries)
    landed = landed_months(spark, layout)
    records, opened = {}, {}
    for key in months:
        if key in landed and not force:
            records[key] = {"status": "skipped"}
        elif key not in published:
            records[key] = {"status": "not_published"}
        else:
            opened[key] = open_delivery(spark, published[key], *key)
            if opened[key].rows is None:
                records[key] = {"status": "failed", "error_message": opened.pop(key).error}
    counted: dict[tuple[int, int], list] = {}
    if opened:
        counts = reduce(DataFrame.unionByName, [delivery_counts(d, spec) for d in opened.values()])
        for row in counts.collect():
            counted.setdefault((row.year, row.month), []).append(row)
        for key in opened:
            tables.delete_path(spark, manifest_path(layout, *key))
        manifest = land_files(spark, opened, layout)
        replace_quarantine(spark, opened, counted, layout, spec)
        sizes = {(r.year, r.month): r.bytes for r in manifest.groupBy("year", "month").agg(F.sum("size").alias("bytes")).collect()}
    for key in opened:
        issues = issue_texts(counted[key], spec)
        total, rejects = counted[key][0].total_rows, counted[key][0].reject_rows
        records[key] = {
            "status": "success_with_warnings" if issues else "success",
            "rows_ingested": total - rejects,
            "reject_rows": rejects,
            "file_size_bytes": sizes.get(key, 0),
            "error_message": "; ".join(issues),
        }
    rows = [
        {
            "pipeline": spec.dataset,
            "layer": "bronze",
            "year": key[0],
            "month": key[1],
            "rows_ingested": 0,
            "reject_rows": 0,
            "file_size_bytes": 0,
            "run_timestamp": stamp,
            "error_message": "",
            **records[key],
        }
        for key in months
    ]
    names = tables.CONTROL_SCHEMA.names
    control = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], tables.CONTROL_SCHEMA)
    tables.append_control(control, layout.path("control", "bronze_runs"))
    over = alerts(control, spec).where("alert").select("year", "month", "reject_rows", "total_rows", "reject_pct")
    found = over.collect()
    if found:
        stamped = over.withColumn("run_timestamp", F.lit(stamp)).coalesce(1)
        stamped.write.mode("append").json(layout.path("control", "bronze_alerts"))
        for r in found:
            log.warning("%04d-%02d: %.2f %% of the rows rejected", r.year, r.month, r.reject_pct)
    if opened:
        commit_months(manifest, opened, counted, layout)
    return control


def landed_months(spark: SparkSession, layout: Layout) -> set[tuple[int, int]]:
    """Months with a file manifest; a month's manifest appears with all its rows at once."""
    return set(bronze.month_dirs(spark, layout.path("control", "bronze_files"), holding="part-*"))


def manifest_path(layout: Layout, year: int, month: int) -> str:
    return f"{layout.path('control', 'bronze_files')}/year={year:04d}/month={month:02d}"


def month_folders(df: DataFrame) -> DataFrame:
    """``year`` and ``month`` as they stand in folder names, so that partitioned writes use :meth:`Layout.month`."""
    return df.withColumns({"year": F.format_string("%04d", "year"), "month": F.format_string("%02d", "month")})


def land_files(spark: SparkSession, opened: Mapping[tuple[int, int], Delivery], layout: Layout) -> DataFrame:
    """Put the delivered files of all months into bronze as they are: ``year, month, path, size, md5, source``.

    Files are copied beside bronze and moved in once every copy has the size and md5 of its original.
    """
    staging = layout.path("staging", f"landing-{uuid.uuid4().hex}")
    copies = files.copy_parquet(spark, [d.folder for d in opened.values()], staging)
    moved = []
    for row in copies.collect():
        key, delivery = next((k, d) for k, d in opened.items() if row.path.startswith(f"{d.folder.rstrip('/')}/"))
        if row.copy is None:
            raise OSError(f"{row.path}: no copy with its {row.size} bytes and md5 {row.md5}")
        target = f"{layout.month('bronze', *key)}/{row.path.removeprefix(delivery.folder.rstrip('/') + '/')}"
        moved.append((*key, target, row.size, row.md5, row.path, row.copy))
    for key in opened:
        tables.delete_path(spark, layout.month("bronze", *key))
    for row in moved:
        tables.move_file(spark, row[-1], row[2])
    tables.delete_path(spark, staging)
    schema = "year int, month int, path string, size bigint, md5 string, source string"
    return spark.createDataFrame([row[:-1] for row in moved], schema)


def replace_quarantine(
    spark: SparkSession, opened: Mapping[tuple[int, int], Delivery], counted: Mapping, layout: Layout, spec: IngestSpec
) -> None:
    """Make quarantine hold the rejected rows of these months as now delivered: replaced, or taken away.

    Deliveries may disagree in columns outside the declared ones; such a column is kept as text where types differ.
    """
    notes, parts = [], []
    for (year, month), delivery in opened.items():
        tables.delete_path(spark, layout.month("quarantine", year, month))
        first = counted[year, month][0]
        if first.reject_rows:
            text = "; ".join(issue_texts(counted[year, month], spec)[:3])
            notes.append({"year": year, "month": month, "reject_rows": first.reject_rows, "error_message": text})
            rows = rejected(delivery, spec).drop(*bronze.MONTH_COLUMNS)
            parts.append(rows.withColumns({"year": F.lit(year), "month": F.lit(month)}))
    if not parts:
        return
    types: dict[str, set[str]] = {}
    for part in parts:
        for column, kind in part.dtypes:
            types.setdefault(column, set()).add(kind)
    parts = [
        p.select(*[F.col(f"`{c}`").cast("string").alias(c) if len(types[c]) > 1 else F.col(f"`{c}`") for c in p.columns])
        for p in parts
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    tables.overwrite_partitions(month_folders(rows), layout.path("quarantine"), bronze.MONTH_COLUMNS)
    names = tables.CONTROL_SCHEMA.names
    noted = spark.createDataFrame([tuple(n.get(c) for c in names) for n in notes], tables.CONTROL_SCHEMA)
    tables.append_control(noted, layout.path("control", "quarantine_notes"))


def read_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """Every rejected row with its ``year`` and ``month``; months whose files differ in columns show all of them."""
    return tables.read_table(spark, layout.path("quarantine"), merge=True)


def commit_months(manifest: DataFrame, opened: Iterable[tuple[int, int]], counted: Mapping, layout: Layout) -> None:
    """Write the file manifests of landed months, which mark them as complete."""
    counts = [(*key, counted[key][0].total_rows, counted[key][0].reject_rows) for key in opened]
    schema = "year int, month int, row_count bigint, reject_rows bigint"
    counts = manifest.sparkSession.createDataFrame(counts, schema).withColumn("valid_rows", F.expr("row_count - reject_rows"))
    rows = month_folders(counts.join(manifest, ["year", "month"], "left"))
    tables.overwrite_partitions(rows, layout.path("control", "bronze_files"), bronze.MONTH_COLUMNS)


def alerts(control: DataFrame, spec: IngestSpec = IngestSpec()) -> DataFrame:
    """Landed months with their reject rate and whether it exceeds the alert limit."""
    return v.reject_rate(control.selectExpr("*", "rows_ingested + reject_rows AS total_rows"), spec)
