"""Workflow 1: load, check, profile.

    spark-submit -m riskframe.plans.profile_job --data-path P --target T --output-dir O
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from riskframe.config import Config
from riskframe.functions.columns import kept
from riskframe.operators.profile import profile_tables
from riskframe.plans.common import check, gate, read_input
from riskframe.session import build_session
from riskframe.sources.sinks import write_json, write_table


def run(spark: SparkSession, config: Config, output_dir: str) -> dict[str, DataFrame]:
    """Writes the quality report, stops on errors, then writes the profiling tables and returns them as written.

    The typed input is held meanwhile, so the file is parsed once for all checks and tables.
    """
    with kept(read_input(spark, config)) as df:
        report = check(df, config)
        write_json(spark, report.document(), f"{output_dir}/quality_report")
        write_table(report.table(), f"{output_dir}/quality_table")
        gate(report)
        tables = profile_tables(df, config.data.target_column, report.numerical_columns, report.categorical_columns)
        for name, table in tables.items():
            write_table(table, f"{output_dir}/{name}")
    return {name: spark.read.schema(table.schema).option("header", True).csv(f"{output_dir}/{name}")
            for name, table in tables.items()}


def main() -> None:
    parser = argparse.ArgumentParser(description="Load, check and profile a table.")
    parser.add_argument("--data-path", required=True)
    parser.add_argument("--data-format", default="csv")
    parser.add_argument("--target", required=True)
    parser.add_argument("--output-dir", default=None)
    args = parser.parse_args()
    config = Config()
    config.data.data_path, config.data.data_format = args.data_path, args.data_format
    config.data.target_column = args.target
    run(build_session("profile"), config, args.output_dir or config.artifacts.profile_dir)


if __name__ == "__main__":
    main()
