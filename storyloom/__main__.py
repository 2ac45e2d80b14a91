"""Steps from the command line: ``python -m storyloom list`` and ``python -m storyloom run STEP --input PATH ... --output PATH [--set NAME=VALUE ...]``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from storyloom.plans import steps


def setting(text: str) -> tuple[str, object]:
    """NAME=VALUE, the value as JSON where it is that."""
    name, sep, value = text.partition("=")
    if not sep:
        raise argparse.ArgumentTypeError("settings are NAME=VALUE")
    try:
        return name, json.loads(value)
    except ValueError:
        return name, value


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="storyloom", description=__doc__)
    sub = parser.add_subparsers(dest="what", required=True)
    sub.add_parser("list", help="the steps in order")
    run = sub.add_parser("run", help="one step over Parquet inputs")
    run.add_argument("step")
    run.add_argument("--input", action="append", required=True, help="Parquet, in the order of the step's inputs")
    run.add_argument("--output", required=True, help="folder; a step with several results gets a subfolder for each")
    run.add_argument("--set", action="append", type=setting, default=[])
    got = parser.parse_args(args)
    if got.what == "list":
        for step, title in steps.list_steps():
            print(step, title)
        return 0
    if got.step not in steps.STEPS:
        parser.error(f"no step {got.step}")
    spark = SparkSession.builder.appName(f"storyloom {got.step}").getOrCreate()
    out = steps.run_step(got.step, *[spark.read.parquet(p) for p in got.input], **dict(got.set))
    for i, frame in enumerate([out] if isinstance(out, DataFrame) else out):
        frame.write.mode("errorifexists").parquet(got.output if isinstance(out, DataFrame) else f"{got.output}/{i}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
