"""The batch job: a folder of workbooks or exports in, report datasets out."""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass

from pyspark.sql import SparkSession

from wrenchline.config import DEFAULT_CONFIG, EngineConfig
from wrenchline.operators import metrics
from wrenchline.operators.metrics import batch_result
from wrenchline.plans.report import Lookups, build_reports
from wrenchline.sources import exports, line_tables, lookups, reports, workbook
from wrenchline.storage import staged, work_folder

log = logging.getLogger(__name__)

FORMATS = ("xlsx", *line_tables.FORMATS)


@dataclass(frozen=True)
class BatchPaths:
    """Folders of a run; reference files as patterns inside ``reference``.

    ``input`` is a folder or a list of files.
    """

    input: str | list[str]
    reference: str
    output: str
    id_lists: str
    registrations: str
    bonus_norms: str
    type_coefficients: str | None = None
    ignore_list: str = "ignore_item.txt"


def read_lookups(spark: SparkSession, paths: BatchPaths) -> Lookups:
    def cells(pattern: str):
        return workbook.read_cells(spark, paths.reference, pattern, first_sheet_only=False)

    types = paths.type_coefficients
    return Lookups(
        registrations=lookups.registrations_from_cells(cells(paths.registrations)),
        bonus_rows=lookups.bonus_from_cells(cells(paths.bonus_norms)),
        reference=lookups.reference_from_cells(cells(paths.id_lists)),
        ignore_items=lookups.ignore_items(spark, f"{paths.reference}/{paths.ignore_list}"),
        type_coefficient_rows=lookups.type_coefficients_from_cells(cells(types)) if types else None,
    )


def staged_lookups(spark: SparkSession, paths: BatchPaths, work: str) -> Lookups:
    """The lookups decoded once; every dataset reads the stored tables."""
    found = read_lookups(spark, paths)
    tables = {f.name: getattr(found, f.name) for f in dataclasses.fields(found)}
    return Lookups(**{name: None if df is None else staged(df, f"{work}/{name}") for name, df in tables.items()})


def run_batch(
    spark: SparkSession,
    paths: BatchPaths,
    run_id: str,
    cfg: EngineConfig = DEFAULT_CONFIG,
    buckets: int = 16,
    file_format: str = "xlsx",
) -> dict[str, str]:
    """Write all report datasets of a run; returns their folders.

    Files are read once into a staged table. A file that lacks a required column or
    cannot be read appears as ``failed`` in the status dataset and gives nothing to the
    others; the other packages go on. A package without lines has hours of 0. A missing
    ignore list is a row of the status dataset, ``missing`` under its own name.

    The staged tables stay below the work folder under the run's name; a run of the same
    name replaces them, and they can be removed once the run has ended.
    """
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}; expected one of {FORMATS}")
    work = f"{work_folder(spark, paths.output + '/_work')}/wrenchline/{run_id}"
    if file_format == "xlsx":
        cells = staged(workbook.read_cells(spark, paths.input), f"{work}/cells")
        found = line_tables.ingest_status(cells, cfg)
    else:
        read = exports.read_folder(spark, paths.input, file_format, cfg, lambda df, name: staged(df, f"{work}/{name}"))
        found = read.status
    if lookups.is_missing(spark, f"{paths.reference}/{paths.ignore_list}"):
        row = (paths.ignore_list, "missing", 0, "no ignore list: nothing is ignored")
        found = found.unionByName(spark.createDataFrame([row], "workpack_id string, status string, rows bigint, error string"))
    written = {"status": reports.write_report(found, paths.output, "status", run_id, buckets)}
    status = spark.read.schema(found.schema).parquet(written["status"])
    result = {row["status"]: row["packages"] for row in batch_result(status).collect()}
    if not result:
        log.warning("no files in %s", paths.input)
    log.info("packages: %s", result)

    if file_format == "xlsx":
        # Rows that a file gave before it turned out unreadable are no result.
        failed = status.where("status = 'failed'").select("workpack_id")
        lines = line_tables.lines_from_cells(cells.join(failed, "workpack_id", "left_anti"), cfg)
        lines = staged(lines, f"{work}/lines")
    else:
        lines = read.lines
    seen = None

    def stage(df, name):
        nonlocal seen
        if name == "kept_lines":  # this write also counts for the run as a whole
            df, seen = metrics.observe_stages(df, cfg)
        return staged(df, f"{work}/{name}")

    whole = status.where("status = 'ok'").select("workpack_id")
    datasets = build_reports(lines, staged_lookups(spark, paths, work), cfg, stage, whole)
    written["run_totals"] = f"{paths.output}/run_totals/run={run_id}"
    metrics.stage_totals(spark, seen).coalesce(1).write.mode("overwrite").parquet(written["run_totals"])
    return written | reports.write_reports(datasets, paths.output, run_id, buckets)
