"""spark-submit entry of the batch job.

    spark-submit run_job.py --input DIR --reference DIR --output DIR --run-id ID \
        --id-lists ids.xlsx --registrations regis.xlsx --bonus-norms norms.xlsx \
        [--format csv|json|parquet|xlsx] [--settings settings.json]
"""

from __future__ import annotations

import argparse
import dataclasses

from wrenchline.config import DEFAULT_CONFIG
from wrenchline.operators.metrics import batch_result
from wrenchline.plans.batch import FORMATS, BatchPaths, run_batch
from wrenchline.session import build_session
from wrenchline.shipping import ship_package
from wrenchline.sources.settings import read_settings


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Hour reports of a folder of work packages.")
    for name in ("input", "reference", "output", "run-id", "id-lists", "registrations", "bonus-norms"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--type-coefficients")
    parser.add_argument("--ignore-list", default=BatchPaths.ignore_list)
    parser.add_argument("--format", choices=FORMATS, default="xlsx")
    parser.add_argument("--settings", help="JSON file with fields of EngineConfig")
    parser.add_argument("--coefficient-system", choices=("seq", "type"), help="overrides the settings")
    parser.add_argument("--buckets", type=int, default=16)
    args = parser.parse_args(argv)

    names = [f.name for f in dataclasses.fields(BatchPaths)]
    paths = BatchPaths(**{name: getattr(args, name) for name in names})
    spark = build_session()
    ship_package(spark)
    cfg = read_settings(spark, args.settings) if args.settings else DEFAULT_CONFIG
    if args.coefficient_system:
        cfg = dataclasses.replace(cfg, coefficient_system=args.coefficient_system)
    written = run_batch(spark, paths, args.run_id, cfg, args.buckets, args.format)
    status = spark.read.schema("workpack_id string, status string").parquet(written["status"])
    batch_result(status).show()
    for name, path in sorted(written.items()):
        print(f"{name}: {path}")
    spark.stop()


if __name__ == "__main__":
    main()
