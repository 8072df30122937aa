"""Command line: driver selection alone, a whole run, or predictions of saved models.

    python -m tidecast select  --prices P --drivers D --out O [--fast]
    python -m tidecast run     --prices P [--drivers D] --out O [--anchor DATE] [--fast]
    python -m tidecast predict --prices P --registry R --out O [--drivers D]

Tables are Parquet: prices (series_id, ds, price), drivers (series_id, driver, ds, raw).
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from .operators import calendar, reports
from .plans import pipeline
from .plans.config import Run
from .sources.shared import Scratch


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidecast")
    parser.add_argument("command", choices=["select", "run", "predict"])
    for name in ("--prices", "--out"):
        parser.add_argument(name, required=True)
    for name in ("--drivers", "--registry", "--anchor", "--techniques"):
        parser.add_argument(name)
    parser.add_argument("--frequency", default="monthly", choices=["monthly", "quarterly"])
    parser.add_argument("--saved-at", default="2025-01-01")
    parser.add_argument("--fast", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tidecast").getOrCreate()
    save = Scratch(spark, "run").save
    run = Run(frequency=args.frequency)
    run = replace(run.fast() if args.fast else run, **({"anchor": args.anchor} if args.anchor else {}))
    prices = save(calendar.dense_grid(spark.read.parquet(args.prices), run.frequency))
    raw = spark.read.parquet(args.drivers) if args.drivers else None
    if args.command == "select":
        pipeline.select_drivers(prices, raw, run, save=save).write.mode("overwrite").parquet(f"{args.out}/selected")
    elif args.command == "run":
        out = pipeline.run_batch(prices, raw, run, args.techniques.split(",") if args.techniques else None, save)
        for name, df in out.items():
            if df is not None:
                df.write.mode("overwrite").parquet(f"{args.out}/{name}")
        pipeline.model_registry(out["ranks"], out["best"], prices, args.saved_at).write.mode("append").parquet(f"{args.out}/registry")
        told = [("run", "info" if not r.failed else "warning", f"{r.stage}: {r.series} series, {r.rows} rows, {r.failed} failed") for r in reports.run_summary(out).collect()]
        reports.append_log(told, spark, f"{args.out}/run_log", args.saved_at)
    else:
        gated = pipeline.prepare_drivers(prices, raw)[1] if raw is not None else None
        pipeline.predict(spark.read.parquet(args.registry), prices, gated, run.frequency).write.mode("overwrite").parquet(f"{args.out}/predictions")


if __name__ == "__main__":
    main()
