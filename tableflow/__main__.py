"""Run one spec file: ``spark-submit ... -m tableflow job.json`` or ``python -m tableflow job.json``."""

from __future__ import annotations

import sys

from tableflow import PipelineSpec, run, start_session


def main(arguments: list[str]) -> None:
    if len(arguments) != 1:
        sys.exit("usage: python -m tableflow <spec.json>")
    spec = PipelineSpec.from_file(arguments[0])
    spark = start_session(spec.settings)
    try:
        run(spark, spec)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
