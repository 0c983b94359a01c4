"""Run one job with settings from the environment: `python -m tierlake <job>`, or this file given to spark-submit."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from tierlake.config import BRIDGED_VIEW, DIRECT_VIEW, DocumentJob, GoldJob, MappingJob, RelationalJob
from tierlake.operators.gold import read_view
from tierlake.plans import jobs

JOBS = {
    "ingest-relational": lambda spark: jobs.ingest_relational(spark, RelationalJob.from_env()),
    "ingest-documents": lambda spark: jobs.ingest_documents(spark, DocumentJob.from_env()),
    "map-sources": lambda spark: jobs.map_sources(spark, MappingJob.from_env()),
    "publish-direct-gold": lambda spark: jobs.publish_gold(spark, GoldJob.from_env()),
    "publish-bridged-gold": lambda spark: jobs.publish_gold(spark, GoldJob.from_env(bridged=True)),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierlake")
    parser.add_argument("job", choices=[*JOBS, "show-gold"])
    shown = os.environ.get("GOLD_VIEW") or DIRECT_VIEW
    parser.add_argument("--view", default=shown, help=f"view to show, e.g. {DIRECT_VIEW} or {BRIDGED_VIEW}")
    chosen = parser.parse_args(arguments)
    # The catalog must outlive this process, or the next job finds none of its tables.
    spark = SparkSession.builder.appName(f"tierlake {chosen.job}").enableHiveSupport().getOrCreate()
    try:
        if chosen.job == "show-gold":
            read_view(spark, chosen.view).show(truncate=False)
        else:
            JOBS[chosen.job](spark)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
