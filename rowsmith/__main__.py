"""Run a job: ``spark-submit -m`` style entry for files on shared storage.

    python -m rowsmith severity ACCIDENTS_CSV OUTPUT
    python -m rowsmith intrusion TRAIN_CSV TEST_CSV OUTPUT
    python -m rowsmith readings COUNT OUTPUT
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from rowsmith import build_session
from rowsmith.fixed_values import ACCIDENT_SCHEMA
from rowsmith.plans import intrusion, severity
from rowsmith.plans import readings as readings_job
from rowsmith.sources.delimited import read_delimited
from rowsmith.sources.generated import readings
from rowsmith.sources.sinks import write_metrics
from rowsmith.storage import release

SEVERITY_OPTIONS = ("fit_on", "split", "null_policy", "scaling", "class_weights")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rowsmith")
    parser.add_argument("--master", help="Spark master; spark-submit sets it otherwise")
    jobs = parser.add_subparsers(dest="job", required=True)
    accidents = jobs.add_parser("severity")
    accidents.add_argument("accidents")
    accidents.add_argument("output")
    accidents.add_argument("--variant", default="cluster", choices=sorted(severity.VARIANTS))
    accidents.add_argument("--fit-on", choices=("all", "train"))
    accidents.add_argument("--split", choices=("stratified", "random"))
    accidents.add_argument("--null-policy", choices=("drop", "count"))
    accidents.add_argument("--scaling", choices=("sample", "population"))
    accidents.add_argument("--class-weights", action="store_const", const=True)
    attacks = jobs.add_parser("intrusion")
    attacks.add_argument("train")
    attacks.add_argument("test")
    attacks.add_argument("output")
    attacks.add_argument("--with-difficulty", action="store_true")
    attacks.add_argument("--handle-invalid", default="error", choices=("error", "skip", "keep"))
    generated = jobs.add_parser("readings")
    generated.add_argument("count", type=int)
    generated.add_argument("output")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    arguments = _arguments(argv)
    spark = build_session(f"rowsmith-{arguments.job}", arguments.master)
    if arguments.job == "severity":
        given = {name: getattr(arguments, name) for name in SEVERITY_OPTIONS}
        changes = {name: value for name, value in given.items() if value is not None}
        options = replace(severity.VARIANTS[arguments.variant], **changes)
        accidents = read_delimited(spark, arguments.accidents, ACCIDENT_SCHEMA)
        write_metrics(severity.run(accidents, options, report=True), arguments.output)
    elif arguments.job == "intrusion":
        train, test = (intrusion.read(spark, p) for p in (arguments.train, arguments.test))
        write_metrics(
            intrusion.run(train, test, arguments.with_difficulty, arguments.handle_invalid, report=True),
            arguments.output,
        )
    else:
        rows = readings(spark, arguments.count)
        readings_job.high_readings(rows).write.parquet(f"{arguments.output}/high")
        readings_job.totals(rows).write.parquet(f"{arguments.output}/totals")
    release(spark)


if __name__ == "__main__":
    main()
