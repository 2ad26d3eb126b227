"""Command line: profile a table, train on it, compare two trained runs.

    python -m ridgeline profile TABLE OUT
    python -m ridgeline train TABLE OUT [--baseline-only] [--encoder ignore|keep] [--grid distributed|single-node]
    python -m ridgeline compare FIRST SECOND OUT

TABLE is a CSV file or folder of the turbine measurements, or a parquet folder.
The session is the one ``spark-submit`` configures.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ridgeline.model import TURBINE
from ridgeline.operators.quality import turbine_rules
from ridgeline.operators.regression import DISTRIBUTED_GRID, SINGLE_NODE_GRID
from ridgeline.plans import comparison, profile, training
from ridgeline.sources.files import read_csv, read_parquet
from ridgeline.sources.scratch import discard_staged

# The bin edges of the wind speed.
WIND_EDGES = (0, 3, 5, 10, 15, 20, 25, 30)


def measurements(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path, TURBINE.schema())


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ridgeline")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("profile")
    p.add_argument("table")
    p.add_argument("out")
    t = commands.add_parser("train")
    t.add_argument("table")
    t.add_argument("out")
    t.add_argument("--baseline-only", action="store_true")
    t.add_argument("--encoder", choices=("keep", "ignore"), default="keep")
    t.add_argument("--grid", choices=("distributed", "single-node"), default="distributed")
    t.add_argument("--scale", action="store_true")
    c = commands.add_parser("compare")
    c.add_argument("first")
    c.add_argument("second")
    c.add_argument("out")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"ridgeline-{chosen.command}").getOrCreate()
    if chosen.command == "profile":
        table = measurements(spark, chosen.table)
        profile.run_profile(table, TURBINE, chosen.out, turbine_rules(), "wind_speed", WIND_EDGES, "maintenance_status")
    elif chosen.command == "train":
        grid = DISTRIBUTED_GRID if chosen.grid == "distributed" else SINGLE_NODE_GRID
        table = measurements(spark, chosen.table)
        training.run_training(
            spark, table, TURBINE, chosen.out, grid, chosen.encoder, chosen.scale, chosen.baseline_only
        )
    else:
        runs = [
            comparison.load_run(spark, path, path.rstrip("/").rsplit("/", 1)[-1], "Spark ML", TURBINE)
            for path in (chosen.first, chosen.second)
        ]
        comparison.run_comparison(*runs, TURBINE, chosen.out)
    discard_staged(spark)


if __name__ == "__main__":
    main()
