"""Command line: python -m samplewright.app flow=job.xml [key=value …]"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .plans import nodes  # noqa: F401  registers the processors
from .plans.workflow import build_job, parse_arguments, run_job
from .sources import sinks, text


def main(args: list[str]) -> None:
    options = parse_arguments(args)
    spark = SparkSession.builder.appName(options.get("name", "samplewright")).config("spark.scheduler.mode", "FAIR").getOrCreate()
    xml = text.read_config(spark, options["flow"])
    done = options.get("donePath")
    if done:
        sinks.mark_done(spark, done, False)
    run_job(spark, lambda: build_job(xml), options, int(options.get("pipelineParallelism", 2)))
    if done:
        sinks.mark_done(spark, done)


if __name__ == "__main__":
    main(sys.argv[1:])
